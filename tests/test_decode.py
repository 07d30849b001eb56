from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.rsvps import rsvp, wire
from turnout.functions import normalize
from turnout.operators import flatten
from turnout.sources import (
    decode_json,
    decode_payload,
    decoded_rsvps,
    encode_payload,
    quarantined,
)

RICH = rsvp(
    topics=("A", "B"),
    venue={"venue_name": "hall", "lon": 1.5, "lat": None, "venue_id": 9.0},
) | {
    "member": {
        "member_id": 123456789.0,
        "other_services": {
            "twitter": {"identifier": "@a"}, "facebook": None, "tumblr": {"identifier": None},
            "flickr": None, "linkedin": None,
        },
        "photo": "p",
        "member_name": "Zoë 漢",
    },
}


def records(df):
    return sorted(str(row.asDict(recursive=True)) for row in df.collect())


def payloads(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value binary")


class TestProtobuf:
    @pytest.fixture(autouse=True)
    def _needs_protobuf(self):
        pytest.importorskip("google.protobuf")

    def test_round_trip_keeps_every_field(self, spark):
        original = wire(spark, [RICH, rsvp(topics=())])
        decoded = decode_payload(encode_payload(original))
        assert quarantined(decoded).count() == 0
        assert records(decoded_rsvps(decoded)) == records(original)

    def test_missing_list_decodes_as_empty(self, spark):
        decoded = decode_payload(encode_payload(wire(spark, [rsvp(topics=None)])))
        assert decoded_rsvps(decoded).first()["group"]["group_topics"] == []

    def test_bad_payloads_are_set_aside_whole(self, spark):
        good = bytes(encode_payload(wire(spark, [RICH])).first()["value"])
        visibility = bytes([0x12, 6]) + b"public"
        bad = [b"\xff\xff\xff", good[:-5], visibility, b""]
        decoded = decode_payload(payloads(spark, good, *bad, None))
        assert decoded_rsvps(decoded).count() == 1
        assert sorted(bytes(r.corrupt) for r in quarantined(decoded).collect()) == sorted([*bad, b""])

    def test_text_that_is_not_utf8_is_kept(self, spark):
        good = bytes(encode_payload(wire(spark, [RICH])).first()["value"])
        decoded = decode_payload(payloads(spark, good.replace("ë".encode(), b"\xff\xfe"), good))
        names = [r.member.member_name for r in decoded_rsvps(decoded).collect()]
        assert sorted(names) == ["Zoë 漢", "Zo\ufffd\ufffd 漢"]

    def test_failfast_fails_the_job(self, spark):
        with pytest.raises(Exception, match="missing required fields"):
            decode_payload(payloads(spark, b""), mode="FAILFAST").collect()

    def test_failfast_passes_good_messages(self, spark):
        decoded = decode_payload(encode_payload(wire(spark, [RICH])), mode="FAILFAST")
        assert flatten(normalize(decoded_rsvps(decoded))).first()["member_id"] == 123456789


class TestJson:
    def texts(self, spark, records):
        return wire(spark, records).select(F.to_json(F.struct("*")).alias("value"))

    def test_round_trip(self, spark):
        records_ = [RICH, rsvp(topics=("A",))]
        decoded = decode_json(self.texts(spark, records_))
        assert quarantined(decoded).count() == 0
        assert flatten(normalize(decoded_rsvps(decoded))).exceptAll(
            flatten(normalize(wire(spark, records_)))
        ).count() == 0

    def test_bad_texts_are_set_aside_whole(self, spark):
        good = self.texts(spark, [rsvp()]).first()["value"]
        bad = ["", "{", good[:-3], '{"visibility":"public"}', good.replace('"topic_name":"A"', '"x":1')]
        df = spark.createDataFrame([(v,) for v in [good, *bad, None]], "value string")
        decoded = decode_json(df)
        assert decoded_rsvps(decoded).count() == 1
        assert sorted(bytes(r.corrupt).decode() for r in quarantined(decoded).collect()) == sorted([*bad, ""])

    def test_failfast_fails_the_job(self, spark):
        df = spark.createDataFrame([("{",)], "value string")
        with pytest.raises(Exception, match="cannot decode RSVP"):
            decode_json(df, mode="FAILFAST").collect()

    def test_text_is_parsed_once(self, spark, capsys):
        good = decoded_rsvps(decode_json(self.texts(spark, [rsvp()])))
        good.select("rsvp_id").explain()
        assert capsys.readouterr().out.count("from_json(") == 1


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        decode_json(spark.createDataFrame([("",)], "value string"), mode="DROPMALFORMED")
