from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.rsvps import frame, rows, rsvp
from turnout import plans
from turnout.sinks import (
    compact_day,
    latest_windows,
    publish_alerts,
    publish_once,
    read_alerts,
    read_index,
    read_published,
    shared_dir,
    write_daily,
    write_static,
)
from turnout.sinks.folders import subfolders
from turnout.sinks.index import INDEX_COLUMNS

RASCALS = INDEX_COLUMNS["agg-rascals"]


def bursts(spark, members=(1,), day="2024-01-01"):
    return plans.burst_members(frame(spark, [rsvp(f"{day} 00:00:05", member=m) for m in members] * 7))


def read(spark, path):
    return read_index(spark, path, RASCALS)


def test_day_names_the_folder_and_is_not_stored(spark, folder, tmp_path):
    write_daily(bursts(spark), folder("idx"), batch_id=0)
    assert [p.name for p in (tmp_path / "idx").glob("dateForIndex=*")] == ["dateForIndex=2024.01.01"]
    files = list((tmp_path / "idx").rglob("*.parquet"))
    stored = spark.read.parquet(str(files[0])).columns
    assert "dateForIndex" not in stored and "timestamp" in stored
    assert rows(read(spark, folder("idx")), "member_id", "dateForIndex", "batch_id") == [(1, "2024.01.01", 0)]


def test_day_filter_prunes_folders(spark, folder, capsys):
    write_daily(bursts(spark), folder("idx"), batch_id=0)
    read(spark, folder("idx")).where("dateForIndex = '2024.01.01'").explain("formatted")
    assert "PartitionFilters: [isnotnull(dateForIndex" in capsys.readouterr().out


def test_repeated_batch_replaces_itself(spark, folder):
    for _ in range(2):
        write_daily(bursts(spark), folder("idx"), batch_id=3)
        write_static(bursts(spark), folder("static"), batch_id=3)
    assert read(spark, folder("idx")).count() == 1
    static = read_index(spark, folder("static"), f"{RASCALS}, dateForIndex string", day_col=None)
    assert rows(static, "member_id", "dateForIndex", "batch_id") == [(1, "2024.01.01", 3)]


def test_batches_and_days_add_up(spark, folder):
    write_daily(bursts(spark), folder("idx"), batch_id=0)
    write_daily(bursts(spark, (1, 2), "2024-01-02"), folder("idx"), batch_id=1)
    write_daily(bursts(spark, (3,)), folder("idx"), batch_id=2)
    assert rows(read(spark, folder("idx")), "dateForIndex", "batch_id", "member_id") == [
        ("2024.01.01", 0, 1), ("2024.01.01", 2, 3), ("2024.01.02", 1, 1), ("2024.01.02", 1, 2),
    ]


def test_one_day_is_read_alone(spark, folder):
    for day in ("2024-01-01", "2024-01-02"):
        write_daily(bursts(spark, day=day), folder("idx"), batch_id=0)
    one = read_index(spark, folder("idx"), RASCALS, day="2024.01.02")
    assert rows(one, "dateForIndex", "member_id", "batch_id") == [("2024.01.02", 1, 0)]
    assert all("2024.01.02" in file for file in one.inputFiles())


def test_write_timestamp_is_stored(spark, folder):
    write_daily(bursts(spark), folder("idx"), batch_id=0)
    assert rows(read(spark, folder("idx")), "timestamp") == [(1704067220000.0,)]
    write_daily(bursts(spark), folder("now"), batch_id=0, at=F.current_timestamp())
    assert read(spark, folder("now")).first()["timestamp"] > 1704067220000.0


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_file_formats(spark, folder, fmt):
    write_daily(bursts(spark), folder("idx"), batch_id=0, fmt=fmt)
    assert read_index(spark, folder("idx"), RASCALS, fmt=fmt).first()["count"] == 7


def test_published_alerts_are_one_message_per_line(spark, folder):
    alerts = plans.alert_payload(bursts(spark, (1, 2)))
    for _ in range(2):
        publish_alerts(alerts, folder("alerts"), batch_id=1)
    assert rows(read_alerts(spark, folder("alerts")), "value", "batch_id") == sorted(
        (r["value"], 1) for r in alerts.collect()
    )


def test_published_alerts_with_keys(spark, folder):
    publish_alerts(plans.alert_payload(bursts(spark)), folder("alerts"), fmt="parquet")
    assert spark.read.parquet(folder("alerts")).drop("batch_id").columns == ["key", "value"]


def test_no_alerts_no_folder(spark, folder, tmp_path):
    publish_alerts(plans.alert_payload(bursts(spark).limit(0)), folder("alerts"))
    assert not list((tmp_path / "alerts").glob("batch_id=*"))


def test_publishing_runs_the_plan_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    alerts = plans.alert_payload(bursts(spark, (1, 2)))
    publish_alerts(alerts.mapInArrow(count, alerts.schema), folder("alerts"))
    assert seen.value == 2


def test_every_alert_is_published(spark):
    many = frame(spark, [rsvp(member=m) for m in range(1000)] * 7)
    assert plans.alert_payload(plans.burst_members(many)).count() == 1000


def test_two_runs_on_one_day_and_their_latest_windows(spark, folder):
    forenoon, afternoon = ([rsvp(f"2024-01-01 {h:02}:00:05", member=h)] * 7 for h in (9, 15))
    for run, records in enumerate((forenoon, afternoon)):
        write_daily(plans.burst_members(frame(spark, records)), folder("idx"), batch_id=run)
    assert rows(latest_windows(read(spark, folder("idx"))), "member_id") == [(9,), (15,)]
    write_daily(plans.burst_members(frame(spark, forenoon + forenoon)), folder("idx"), batch_id=2)
    latest = rows(latest_windows(read(spark, folder("idx"))), "member_id", "count")
    assert latest == [(9, 14), (15, 7)]
    for _ in range(2):
        compact_day(spark, folder("idx"), RASCALS, "2024.01.01")
        assert rows(latest_windows(read(spark, folder("idx"))), "member_id", "count") == latest


def test_shared_dir_is_under_the_clusters_folder(spark):
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert first.startswith(base.rstrip("/"))


def test_a_batch_is_published_once_and_whole(spark, folder, monkeypatch):
    alerts = plans.alert_payload(bursts(spark, (1, 2)))
    want = sorted((r["value"],) for r in alerts.collect())

    def fail(*args):
        raise RuntimeError("cut short")

    with monkeypatch.context() as patch:
        patch.setattr("turnout.sinks.alerts.mark_whole", fail)
        with pytest.raises(RuntimeError, match="cut short"):
            publish_once(alerts, folder("alerts"), 0)
    assert read_published(spark, folder("alerts")).count() == 0
    assert publish_once(alerts, folder("alerts"), 0)
    assert not publish_once(alerts.limit(1), folder("alerts"), 0)
    publish_alerts(alerts, folder("alerts"), batch_id=1, fmt="committed")
    assert rows(read_published(spark, folder("alerts")), "value") == sorted(want * 2)


def test_compaction_into_a_new_batch_keeps_what_is_read(spark, folder, monkeypatch):
    for run in range(3):
        write_daily(bursts(spark, (run, run + 1)), folder("idx"), batch_id=run)
    want = rows(latest_windows(read(spark, folder("idx"))), "member_id", "count")

    def fail(*args):
        raise RuntimeError("cut short")

    with monkeypatch.context() as patch:
        patch.setattr("turnout.sinks.index.delete_folder", fail)
        with pytest.raises(RuntimeError, match="cut short"):
            compact_day(spark, folder("idx"), RASCALS, "2024.01.01", batch_id=7)
    for _ in range(2):
        assert rows(latest_windows(read(spark, folder("idx"))), "member_id", "count") == want
        compact_day(spark, folder("idx"), RASCALS, "2024.01.01", batch_id=7)
    assert subfolders(spark, f"{folder('idx')}/dateForIndex=2024.01.01") == ["batch_id=7"]


def test_latest_windows_gather_no_window_in_one_task(spark, folder, capsys):
    write_daily(bursts(spark), folder("idx"), batch_id=0)
    latest_windows(read(spark, folder("idx"))).explain("formatted")
    text = capsys.readouterr().out
    assert "partial_max" in text and "Window" not in text
