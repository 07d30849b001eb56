"""What the plans must look like to hold at cluster scale, and that hot keys change nothing."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tests.conftest import TESTDATA
from tests.rsvps import frame, rows, rsvp
from turnout import plans
from turnout.functions import normalize
from turnout.sources import read_rsvps, rsvps_from_events
from turnout.streaming import JobConfig, start_members, stream_session
from turnout.streaming.jobs import rsvp_stream

SF_DIR = f"{TESTDATA}/sf0.001"
JOBS = {
    "members": plans.most_active_members,
    "topics": plans.trending_topics,
    "bursts": plans.burst_members,
    "alerts": lambda rsvps: plans.alert_payload(plans.burst_members(rsvps)),
}


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture
def stored(spark, folder):
    """RSVPs as a nested Parquet table."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    rsvps_from_events(events).write.parquet(folder("rsvps"))
    return normalize(read_rsvps(spark, folder("rsvps")))


@pytest.mark.parametrize("job", sorted(JOBS))
def test_no_job_joins_broadcasts_or_gathers_in_one_task(stored, capsys, job):
    text = plan(JOBS[job](stored), capsys)
    for operator in ("Join", "Cartesian", "Broadcast", "SinglePartition", "Python", "Arrow"):
        assert operator not in text


@pytest.mark.parametrize("job, fields", [
    ("members", "mtime:double,member:struct<member_id:double,member_name:string>"),
    ("bursts", "mtime:double,member:struct<member_id:double,member_name:string>"),
    ("topics", "response:string,mtime:double,group:struct<group_topics:array<struct<topic_name:string>>>"),
])
def test_only_the_needed_nested_fields_are_read(stored, capsys, job, fields):
    schema = re.search(r"ReadSchema: struct<(.*)>", plan(JOBS[job](stored), capsys)).group(1)
    flat = lambda text: sorted(re.findall(r"\w+:\w+", text))
    assert flat(schema) == flat(fields)


def test_a_stream_reads_only_the_needed_nested_fields(spark, folder, capsys):
    """The stream's own plan, after the check of its times."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    rsvps_from_events(events).write.parquet(folder("in"))
    cfg = JobConfig(input_path=folder("in"), output_path=folder("out"), checkpoint_path=folder("cp"), available_now=True)
    session = stream_session(spark, 2)
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # keep the plan that reads
    query = start_members(rsvp_stream(session, cfg), cfg)
    query.awaitTermination()
    capsys.readouterr()
    query.explain()
    text = capsys.readouterr().out
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert sorted(re.findall(r"\w+:\w+", schema)) == sorted(
        ["mtime:double", "member:struct", "member_id:double", "member_name:string"]
    )


def test_response_filter_reaches_the_scan(stored, capsys):
    assert "EqualTo(response,yes)" in plan(plans.trending_topics(stored), capsys)


@pytest.mark.parametrize("job, shuffles", [("members", 2), ("topics", 3), ("bursts", 1), ("alerts", 1)])
def test_rows_are_counted_and_cut_before_each_shuffle(stored, capsys, job, shuffles):
    text = plan(JOBS[job](stored), capsys)
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == shuffles
    assert "partial_count(1)" in text
    if job in ("members", "topics"):
        assert re.search(r"row_number\(\), \d+, Partial", text)


def test_global_ranking_takes_k_rows_per_task(stored, capsys):
    assert "TakeOrderedAndProject" in plan(plans.trending_overall(stored), capsys)


@pytest.mark.parametrize("name, columns", [("top_members", 2), ("top_topics", 3), ("burst_members", 2), ("yes_rsvps", 3)])
def test_registered_queries_read_few_columns(spark, capsys, name, columns):
    schema = re.search(r"ReadSchema: struct<(.*)>", plan(driver.queries()[name](spark, SF_DIR), capsys)).group(1)
    assert len(schema.split(",")) == columns


def test_hot_member_and_hot_window(spark):
    """A third of the rows belong to one member, and half of them to one window."""
    n = 30_000
    ids = spark.range(n).withColumn("member", F.expr("IF(id % 3 = 0, 7, 100 + id % 5000)"))
    base = frame(spark, [rsvp()])
    rsvps = ids.crossJoin(base.drop("member", "event_time")).select(
        "response", "group",
        F.struct(F.col("member").cast("bigint").alias("member_id"), F.concat(F.lit("m"), "member").alias("member_name")).alias("member"),
        F.expr("timestamp_seconds(1704067200 + IF(id % 2 = 0, 5, id % 3600))").alias("event_time"),
    )
    counted = plans.member_counts(rsvps, "20 seconds", None)
    assert counted.agg(F.sum("count")).first()[0] == n
    best = plans.most_active_members(rsvps, "20 seconds", None, k=1)
    crowded = best.where("window_start = timestamp'2024-01-01 00:00:00'")
    want = sum(1 for i in range(n) if i % 3 == 0 and (i % 2 == 0 or i % 3600 < 20))
    assert rows(crowded, "member_id", "count", "position") == [(7, want, 1)]
