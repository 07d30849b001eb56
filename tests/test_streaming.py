from __future__ import annotations

import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.rsvps import at, frame, rows, rsvp, wire
from turnout import plans
from turnout.sinks import latest_windows, read_alerts, read_index
from turnout.sinks.index import INDEX_COLUMNS
from turnout.sources import encode_payload
from turnout.streaming import (
    JobConfig,
    await_jobs,
    jobs,
    read_panes,
    run_jobs,
    start_members,
    start_topics,
    stream_session,
)

BASE = at("2024-01-01 00:00:00").timestamp()


def clock(second):
    return time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(BASE + second))


def some_rsvps(seed, first, last, n=120):
    """Random RSVPs between two seconds of the day, with ties, a hot member and hot topics."""
    pick = random.Random(seed)
    return [
        rsvp(
            clock(pick.randrange(first, last)),
            member=1 if pick.random() < 0.35 else pick.randrange(2, 12),
            response=pick.choice(["yes", "yes", "no"]),
            topics=pick.choices("ABCDEFGHIJKLMN", k=pick.randrange(0, 4)),
        )
        for _ in range(n)
    ]


def feed(spark, path, records):
    wire(spark, records).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def cfg(folder):
    return JobConfig(
        input_path=folder("in"), output_path=folder("out"), checkpoint_path=folder("cp"),
        available_now=True,
    )


def index(spark, cfg, name):
    stored = latest_windows(read_index(spark, cfg.index(name), INDEX_COLUMNS[name]))
    return rows(stored, *[c for c in stored.columns if c not in ("timestamp", "batch_id")])


def expected(spark, records):
    rsvps = frame(spark, records)
    plain = {
        "agg-users": plans.most_active_members(rsvps),
        "agg-topics": plans.trending_topics(rsvps),
        "agg-rascals": plans.burst_members(rsvps),
    }
    columns = {
        "agg-users": ("window_start", "window_end", "member_id", "member_name", "count", "position", "dateForIndex"),
        "agg-topics": ("window_start", "window_end", "topic", "count", "position", "dateForIndex"),
        "agg-rascals": ("window_start", "window_end", "member_name", "member_id", "count", "dateForIndex"),
    }
    return {name: rows(df, *columns[name]) for name, df in plain.items()}


def test_streams_equal_batch(spark, cfg):
    records = some_rsvps(1, 0, 200, n=400)
    feed(spark, cfg.input_path, records)
    await_jobs(run_jobs(spark, cfg))
    want = expected(spark, records)
    assert all(want.values())
    for name, wanted in want.items():
        assert index(spark, cfg, name) == wanted
    alerts = plans.alert_payload(plans.burst_members(frame(spark, records)))
    assert rows(read_alerts(spark, cfg.index("alerts")), "value") == rows(alerts, "value")


def test_restart_equals_one_run(spark, cfg):
    parts = [some_rsvps(i, 100 * i, 100 * i + 100, n=200) for i in range(3)]
    for part in parts:
        feed(spark, cfg.input_path, part)
        await_jobs(run_jobs(spark, cfg))
    want = expected(spark, sum(parts, []))
    for name in want:
        assert index(spark, cfg, name) == want[name]


def test_unordered_files_one_at_a_time_equal_batch(spark, cfg):
    parts = [some_rsvps(i, 60 * i, 60 * i + 60, n=80) for i in (3, 0, 2, 1)]
    for part in parts:
        feed(spark, cfg.input_path, part)
    cfg = replace(cfg, input_options={"maxFilesPerTrigger": "1"})
    await_jobs(run_jobs(spark, cfg))
    want = expected(spark, sum(parts, []))
    for name in want:
        assert index(spark, cfg, name) == want[name]
    # One alert for each burst, whatever the number of batches that its window took.
    assert read_alerts(spark, cfg.index("alerts")).count() == len(want["agg-rascals"])


def test_late_row_corrects_its_windows(spark, cfg):
    session = stream_session(spark, 2)
    early, late = [rsvp(clock(5), member=1)] * 6 + [rsvp(clock(200), member=2)], [rsvp(clock(6), member=1)]
    for part in (early, late):
        feed(spark, cfg.input_path, part)
        start_members(jobs.rsvp_stream(session, cfg), cfg).awaitTermination()
    want = expected(spark, early + late)
    assert len(want["agg-rascals"]) == 1
    assert index(spark, cfg, "agg-users") == want["agg-users"]
    assert index(spark, cfg, "agg-rascals") == want["agg-rascals"]
    assert read_alerts(spark, cfg.index("alerts")).count() == 1


def test_unusable_and_far_times(spark, cfg):
    far = rsvp(member=9, mtime=at("2999-01-01 00:00:00").timestamp() * 1000)
    none = rsvp(member=8, mtime=9e18)
    records = [rsvp(clock(5), member=1), far, none]
    feed(spark, cfg.input_path, records)
    start_members(jobs.rsvp_stream(stream_session(spark, 2), cfg), cfg).awaitTermination()
    assert index(spark, cfg, "agg-users") == expected(spark, records)["agg-users"]
    panes = read_panes(spark, cfg.index("panes-members"), jobs.MEMBER_KEYS)
    assert rows(panes.where("pane_start IS NULL"), "member_id", "count") == [(8, 1)]


def test_new_checkpoint_on_old_output_is_refused(spark, cfg, folder):
    feed(spark, cfg.input_path, [rsvp(clock(5))])
    session = stream_session(spark, 2)
    start_members(jobs.rsvp_stream(session, cfg), cfg).awaitTermination()
    fresh = replace(cfg, checkpoint_path=folder("other"))
    with pytest.raises(ValueError, match="another checkpoint"):
        start_members(jobs.rsvp_stream(session, fresh), fresh)


def test_failed_batch_is_repeated_without_duplicates(spark, cfg, monkeypatch):
    records = some_rsvps(2, 0, 100, n=300)
    feed(spark, cfg.input_path, records)
    session = stream_session(spark, 2)
    publish = jobs.publish_alerts

    def fail_after_the_index(*args):
        raise RuntimeError("publisher is down")

    monkeypatch.setattr(jobs, "publish_alerts", fail_after_the_index)
    with pytest.raises(Exception, match="publisher is down"):
        await_jobs([start_members(jobs.rsvp_stream(session, cfg), cfg)])
    monkeypatch.setattr(jobs, "publish_alerts", publish)
    start_members(jobs.rsvp_stream(session, cfg), cfg).awaitTermination()
    want = expected(spark, records)["agg-rascals"]
    assert want and index(spark, cfg, "agg-rascals") == want
    assert read_alerts(spark, cfg.index("alerts")).count() == len(want)


def test_no_bursts_no_alert_folder(spark, cfg, tmp_path):
    feed(spark, cfg.input_path, [rsvp(clock(0)), rsvp(clock(100))])
    start_members(jobs.rsvp_stream(stream_session(spark, 2), cfg), cfg).awaitTermination()
    assert not list((tmp_path / "out" / "alerts").glob("batch_id=*"))


@pytest.mark.parametrize("payload, fmt", [("protobuf", "parquet"), ("json", "parquet"), ("json", "text")])
def test_payloads_are_decoded_once_and_bad_ones_kept(spark, cfg, payload, fmt):
    records = some_rsvps(3, 0, 100, n=150)
    if payload == "protobuf":
        pytest.importorskip("google.protobuf")
        messages = encode_payload(wire(spark, records))
    else:
        text = F.to_json(F.struct("*")).cast("string" if fmt == "text" else "binary")
        messages = wire(spark, records).select(text.alias("value"))
    bad = spark.createDataFrame([(b"{",), (b"}",)], "value binary")
    messages.unionByName(bad.withColumn("value", F.col("value").cast(messages.schema["value"].dataType))).coalesce(1).write.format(fmt).save(cfg.input_path)
    cfg = replace(cfg, payload=payload, input_format=fmt)
    await_jobs(run_jobs(spark, cfg))
    want = expected(spark, records)
    for name in want:
        assert index(spark, cfg, name) == want[name]
    assert sorted(bytes(r.corrupt) for r in jobs.read_quarantine(spark, cfg).collect()) == [b"{", b"}"]


def test_continuous_run_ends_after_its_minutes(spark, cfg):
    records = some_rsvps(4, 0, 100, n=100)
    wire(spark, records).select(F.to_json(F.struct("*")).cast("binary").alias("value")).coalesce(1).write.parquet(cfg.input_path)
    cfg = replace(cfg, payload="json", available_now=False, batch_interval="1 second")
    started = time.monotonic()
    queries = run_jobs(spark, cfg)
    await_jobs(queries, run_minutes=0.6)
    assert 36 <= time.monotonic() - started < 120
    assert not any(query.isActive for query in queries)
    assert index(spark, cfg, "agg-users") == expected(spark, records)["agg-users"]


def test_windows_by_arrival(spark, cfg):
    cfg = replace(cfg, time_col="ingest_time", length="2 seconds", slide="1 second")
    session = stream_session(spark, 2)
    feed(spark, cfg.input_path, [rsvp(clock(0), member=1), rsvp(clock(90000), member=1)])
    start_members(jobs.rsvp_stream(session, cfg), cfg).awaitTermination()
    time.sleep(4)
    feed(spark, cfg.input_path, [rsvp(clock(0), member=2)])
    start_members(jobs.rsvp_stream(session, cfg), cfg).awaitTermination()
    stored = read_index(spark, cfg.index("agg-users"), INDEX_COLUMNS["agg-users"])
    assert rows(stored.where("member_id = 1"), "count") == [(2,), (2,)]
    assert stored.where("window_end < timestamp'2024-06-01 00:00:00'").count() == 0


def test_topics_stream_alone(spark, cfg):
    records = some_rsvps(5, 0, 100)
    feed(spark, cfg.input_path, records)
    start_topics(jobs.rsvp_stream(stream_session(spark, 2), cfg), cfg).awaitTermination()
    assert index(spark, cfg, "agg-topics") == expected(spark, records)["agg-topics"]


def test_stream_session_leaves_the_callers_settings(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    session = stream_session(spark, 3)
    assert "RocksDB" in session.conf.get(name)
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get(name) == before
