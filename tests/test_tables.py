from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from turnout.functions import day_label, normalize, window_text
from turnout.operators import flatten
from turnout.schema import RSVP_SCHEMA_RELAXED
from turnout.sources import read_rsvps, read_table, rsvps_from_events

SF_DIR = f"{TESTDATA}/sf0.01"


def test_every_event_becomes_one_rsvp_of_the_wire_schema(spark):
    events = read_table(spark, SF_DIR, "events")
    rsvps = rsvps_from_events(events)
    assert rsvps.count() == events.count()
    assert [(f.name, f.dataType.simpleString()) for f in rsvps.schema] == [
        (f.name, f.dataType.simpleString()) for f in RSVP_SCHEMA_RELAXED
    ]


def test_member_names_are_those_of_the_customer_table(spark):
    members = flatten(normalize(rsvps_from_events(read_table(spark, SF_DIR, "events"))))
    customers = read_table(spark, SF_DIR, "customer").select(
        F.col("c_custkey").alias("member_id"), F.col("c_name").alias("member_name")
    )
    pairs = members.select("member_id", "member_name").distinct()
    assert pairs.count() > 0
    assert pairs.exceptAll(customers).count() == 0


def test_rsvps_survive_files(spark, folder):
    rsvps = rsvps_from_events(read_table(spark, SF_DIR, "events"))
    expected = flatten(normalize(rsvps)).collect()
    for fmt in ("parquet", "orc", "json"):
        rsvps.write.format(fmt).save(folder(fmt))
        stored = flatten(normalize(read_rsvps(spark, folder(fmt), fmt)))
        assert sorted(map(str, stored.collect())) == sorted(map(str, expected))


def test_a_time_range_reaches_the_scan(spark, folder, capsys):
    rsvps_from_events(read_table(spark, SF_DIR, "events")).write.parquet(folder("in"))
    day = read_rsvps(spark, folder("in"), between=(datetime(2024, 1, 10), datetime(2024, 1, 11)))
    day.explain("formatted")
    assert "GreaterThanOrEqual(mtime," in capsys.readouterr().out
    labels = normalize(day).select(day_label(F.col("event_time")).alias("day")).distinct().collect()
    assert [r.day for r in labels] == ["2024.01.10"]


def test_session_zone_does_not_matter(spark):
    def labelled(session):
        rsvps = normalize(rsvps_from_events(read_table(session, SF_DIR, "events")))
        shown = rsvps.select("rsvp_id", day_label(F.col("event_time")), window_text(F.col("event_time"), millis=True))
        return sorted(map(tuple, shown.collect()))

    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    assert labelled(other) == labelled(spark)
