from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tests.rsvps import at, frame, rows, rsvp, wire
from turnout.functions import (
    set_aside,
    usable,
    alert_message,
    day_label,
    normalize,
    with_ingest_time,
    with_write_timestamp,
)
from turnout.functions.columns import seconds_in
from turnout.operators import (
    explode_topics,
    flatten,
    members,
    top_k,
    topic_arrays,
    windowed_counts,
    with_position,
    yes_responses,
)


def counts_frame(spark, values, window="2024-01-01 00:00:00"):
    return spark.createDataFrame(
        [(at(window), key, count) for key, count in values], "window_start timestamp, id int, count bigint"
    ).withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 60 SECONDS"))


def test_sliding_membership(spark):
    counts = windowed_counts(members(frame(spark, [rsvp("2024-01-01 00:00:05")])), ["member_id"], "60 seconds", "20 seconds")
    starts = [text for (text,) in rows(counts, F.date_format("window_start", "HH:mm:ss"))]
    assert starts == ["00:00:00", "23:59:20", "23:59:40"]
    assert {r["count"] for r in counts.collect()} == {1}


def test_window_start_is_inside_and_end_is_outside(spark):
    df = frame(spark, [rsvp("2024-01-01 00:00:20"), rsvp("2024-01-01 00:00:19.999")])
    counts = windowed_counts(members(df), ["member_id"], "20 seconds")
    assert rows(counts, F.date_format("window_start", "ss"), "count") == [("00", 1), ("20", 1)]


@pytest.mark.parametrize("length, slide", [("60 seconds", "20 seconds"), ("1 minute", "15 seconds"), ("50 seconds", "20 seconds"), ("20 seconds", None)])
def test_panes_equal_direct_counts(spark, length, slide):
    df = frame(spark, [rsvp(f"2024-01-01 00:0{i % 3}:{(7 * i) % 60:02d}", member=i % 4) for i in range(60)])
    results = [
        rows(windowed_counts(members(df), ["member_id"], length, slide, panes=panes), "window_start", "window_end", "member_id", "count")
        for panes in (False, True)
    ]
    assert results[0] == results[1]


def test_row_without_a_time_is_in_no_window(spark):
    df = frame(spark, [rsvp(mtime=math.nan), rsvp()])
    assert rows(windowed_counts(members(df), ["member_id"], "20 seconds"), "count") == [(1,)]


def test_tie_inside_top_k(spark):
    best = with_position(top_k(counts_frame(spark, [(1, 3), (2, 2), (3, 2), (4, 1)]), 5, keys=["id"]))
    assert rows(best, "id", "position") == [(1, 1), (2, 2), (3, 2), (4, 3)]


def test_tie_at_the_cut_goes_to_the_smallest_keys(spark):
    best = with_position(top_k(counts_frame(spark, [(i, 1) for i in (6, 3, 1, 5, 2, 4)]), 5, keys=["id"]))
    assert rows(best, "id", "position") == [(i, 1) for i in range(1, 6)]


def test_each_window_has_its_own_ranking(spark):
    both = counts_frame(spark, [(1, 9), (2, 8)]).unionByName(counts_frame(spark, [(3, 1)], "2024-01-01 00:00:20"))
    assert rows(with_position(top_k(both, 1, keys=["id"])), "id", "position") == [(1, 1), (3, 1)]


def test_global_ranking(spark):
    df = counts_frame(spark, [(1, 3), (2, 7), (3, 7), (4, 1)])
    best = with_position(top_k(df, 3, keys=["id"], within=()), within=())
    assert rows(best, "id", "position") == [(1, 2), (2, 1), (3, 1)]


def test_response_filter_is_case_sensitive(spark):
    df = frame(spark, [rsvp(response=r) for r in ("yes", "no", "YES")])
    assert yes_responses(df).count() == 1
    assert members(df).count() == 3


def test_topics_of_null_empty_and_repeated_lists(spark):
    df = frame(spark, [rsvp(topics=t) for t in (None, (), ("A", "A"), ("A", "B"))])
    counted = explode_topics(df).groupBy("topic").count()
    assert rows(counted, "topic", "count") == [("A", 3), ("B", 1)]


def test_topic_arrays_project_through_the_structs(spark):
    df = topic_arrays(frame(spark, [rsvp(topics=("A", "B"))]))
    assert df.schema["topic_name"].dataType.simpleString() == "array<string>"
    assert df.first()["topic_name"] == ["A", "B"]


def test_normalize_types_and_bad_numbers(spark):
    df = normalize(wire(spark, [rsvp(member=123456789), rsvp(rsvp_id=math.nan), rsvp(rsvp_id=1e300)]))
    types = dict(flatten(df).dtypes)
    assert types["member_id"] == types["rsvp_id"] == types["guests"] == types["group_id"] == types["venue_id"] == "bigint"
    assert types["event_time"] == "timestamp"
    assert sorted(r.rsvp_id is None for r in flatten(df).collect()) == [False, True, True]
    assert flatten(df).where("member_id = 123456789").count() == 1


def test_times_that_no_timestamp_holds_are_null(spark):
    df = frame(spark, [rsvp(mtime=m) for m in (9e18, -9e18, math.inf, math.nan, 253402300799999.0)])
    assert df.where("event_time IS NULL").count() == 4


def test_usable_times(spark):
    far = at("2999-01-01 00:00:00").timestamp() * 1000
    df = frame(spark, [rsvp(mtime=m) for m in (-9e15, math.nan, 9e15)] + [rsvp(member=4), rsvp(member=5, mtime=far)])
    assert rows(usable(df), "member.member_id") == [(4,), (5,)]
    assert set_aside(df).count() == 3


def test_event_time_is_mtime_in_milliseconds(spark):
    text = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSS")
    assert frame(spark, [rsvp("2024-01-01 00:00:05.250")]).select(text).first()[0] == "2024-01-01 00:00:05.250"


def test_day_label_at_the_edge(spark):
    df = spark.createDataFrame([(at("2024-01-01 00:00:00"),), (at("2023-12-31 23:59:59"),)], "t timestamp")
    assert rows(df, day_label(F.col("t"))) == [("2023.12.31",), ("2024.01.01",)]


def test_write_timestamp_has_second_resolution(spark):
    df = spark.createDataFrame([(at("2024-01-01 00:00:05.900"),)], "window_end timestamp")
    assert with_write_timestamp(df).first()["timestamp"] == 1704067205000.0
    now = with_write_timestamp(df, F.current_timestamp()).first()["timestamp"]
    assert now > 1704067205000.0 and now % 1000 == 0


def test_alert_message(spark):
    df = spark.createDataFrame([(123456789, "Ann", 7), (1, None, 7)], "id bigint, name string, n bigint")
    texts = df.select(alert_message(F.col("id"), F.col("name"), F.col("n"), "20 seconds").alias("m"))
    assert [r.m for r in texts.collect()] == [
        "User > 123456789 (Ann) < sent > 7 < rsvps in 20 seconds ! This is shady - please verify !",
        None,
    ]


def test_ingest_time_is_one_instant(spark):
    assert with_ingest_time(spark.range(100)).select("ingest_time").distinct().count() == 1


@pytest.mark.parametrize("text, seconds", [("20 seconds", 20), ("1 minute", 60), ("2 hours", 7200), ("1 day", 86400)])
def test_seconds_in(text, seconds):
    assert seconds_in(text) == seconds


@pytest.mark.parametrize("text", ["", "20", "x seconds", "2 months", "-5 seconds"])
def test_seconds_in_rejects(text):
    with pytest.raises(ValueError):
        seconds_in(text)
