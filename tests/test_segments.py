"""Panes in segments, closed days and what a stream keeps of its past."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.rsvps import at, rows, rsvp
from tests.test_streaming import clock, expected, feed, index
from turnout.sinks import latest_windows, read_alerts, read_index
from turnout.sinks.folders import subfolders
from turnout.sinks.index import INDEX_COLUMNS
from turnout.streaming import JobConfig, jobs, read_panes, segments, start_members, stream_session
from turnout.streaming.segments import Segments, reach

KEYS = "member_id bigint"


@pytest.fixture
def cfg(folder):
    return JobConfig(
        input_path=folder("in"), output_path=folder("out"), checkpoint_path=folder("cp"), available_now=True,
    )


def run(spark, cfg, *parts):
    session = stream_session(spark, 2)
    for part in parts:
        feed(spark, cfg.input_path, part)
        start_members(jobs.rsvp_stream(session, cfg), cfg).awaitTermination()


def batch(spark, number, day="2024-01-01"):
    """Counts of one batch: a pane of its own member and one that all batches share."""
    return spark.createDataFrame(
        [(at(f"{day} 00:00:00"), 0, 1), (at(f"{day} 00:00:20"), number, number + 1)], "pane_start timestamp, member_id bigint, count bigint"
    ).coalesce(1)


def totals(store, **chosen):
    return rows(store.read(**chosen).groupBy("pane_start", "member_id").agg(F.sum("count").alias("count")), "member_id", "count")


def test_segments_are_merged_by_age_and_stay_few(spark, folder, monkeypatch):
    monkeypatch.setattr(segments, "FAN", 3)
    store = Segments(spark, folder("panes"), KEYS)
    for number in range(30):
        store.write(batch(spark, number), number)
        store.merge(number - 1)
        # At most two of each tier wait for a third, besides the batch that may be repeated.
        assert len(subfolders(spark, folder("panes"))) <= 2 * 4 + 1
    assert totals(store) == sorted([(0, 30), (0, 1)] + [(n, n + 1) for n in range(1, 30)])
    listed = store.listed()
    assert [s.first for s in listed[1:]] == [s.last + 1 for s in listed[:-1]] and listed[-1].last == 29


@pytest.mark.parametrize("step", ["store", "mark_whole", "delete_folder"])
def test_merge_cut_short_changes_no_read(spark, folder, monkeypatch, step):
    monkeypatch.setattr(segments, "FAN", 3)
    store = Segments(spark, folder("panes"), KEYS)
    for number in range(3):
        store.write(batch(spark, number), number)
    want = totals(store)

    def fail(*args):
        raise RuntimeError("cut short")

    with monkeypatch.context() as patch:
        if step == "store":
            patch.setattr(segments, "day_label", fail)
        else:
            patch.setattr(segments, step, fail)
        with pytest.raises(RuntimeError, match="cut short"):
            store.merge(2)
    assert totals(store) == want
    store.merge(2)
    assert totals(store) == want
    store.clean()
    assert totals(store) == want
    assert subfolders(spark, folder("panes")) == ["batches=0-2"]


def test_a_batch_that_is_not_whole_does_not_count(spark, folder, monkeypatch):
    store = Segments(spark, folder("panes"), KEYS)
    store.write(batch(spark, 0), 0)
    with monkeypatch.context() as patch:
        patch.setattr(segments, "mark_whole", lambda *args: (_ for _ in ()).throw(RuntimeError("cut short")))
        with pytest.raises(RuntimeError, match="cut short"):
            store.write(batch(spark, 1), 1)
    assert totals(store) == [(0, 1), (0, 1)]
    store.write(batch(spark, 1), 1)
    store.write(batch(spark, 1), 1)
    assert totals(store) == [(0, 1), (0, 2), (1, 2)]


def test_only_wanted_days_are_read(spark, folder):
    store = Segments(spark, folder("panes"), KEYS)
    for number, day in enumerate(("0500-03-01", "1970-01-01", "2024-01-01", "2024-01-02")):
        store.write(batch(spark, number, day), number)
    assert store.days(1) == {date(1970, 1, 1)}
    files = store.read([date(2024, 1, 1), date(500, 3, 1)]).inputFiles()
    assert sorted({file.split("day=")[1].split("/")[0] for file in files}) == ["2024.01.01", "500.03.01"]
    assert totals(store, days=[]) == []


def test_days_that_windows_reach():
    assert reach([date(2024, 1, 10)], "60 seconds") == {date(2024, 1, n) for n in (9, 10, 11)}
    assert reach([date(1, 1, 1), date(9999, 12, 31)], "1 day") == {date(1, 1, 1), date(1, 1, 2), date(9999, 12, 30), date(9999, 12, 31)}


def test_rows_of_far_off_years_take_no_window_from_others(spark, cfg, monkeypatch):
    years = ["0001-01-03 00:00:05", "0500-06-01 12:00:00", "1970-01-01 00:00:01", "2024-01-01 00:00:05", "9999-12-29 23:59:30"]
    records = [rsvp(time, member=n) for n, time in enumerate(years)] * 7
    read, seen = Segments.read, []

    def watched(self, days=None, *args, **kwargs):
        seen.append(set(days or ()))
        return read(self, days, *args, **kwargs)

    monkeypatch.setattr(Segments, "read", watched)
    run(spark, cfg, records)
    want = expected(spark, records)
    assert len(want["agg-rascals"]) == 5
    for name in ("agg-users", "agg-rascals"):
        assert index(spark, cfg, name) == want[name]
    # The days touched and their neighbours, none of the millions between.
    assert seen and max(map(len, seen)) <= 3 * len(years)


def test_a_horizon_closes_days_and_counts_what_comes_later(spark, cfg):
    cfg = replace(cfg, horizon="1 day")
    day = lambda d, member, n=1: [rsvp(f"2024-01-{d:02} 12:00:05", member=member)] * n
    parts = [day(1, 1, 7) + day(2, 1), day(5, 2), day(1, 3, 2) + day(4, 3) + day(6, 3), day(9, 4), day(12, 5)]
    run(spark, cfg, *parts)
    late = read_panes(spark, cfg.index("panes-members"), jobs.MEMBER_KEYS, late=True)
    assert rows(late, "member_id", "count") == [(3, 2)]
    on_time = sum(parts, [])
    on_time = [r for r in on_time if not (r["member"]["member_id"] == 3 and r["mtime"] == at("2024-01-01 12:00:05").timestamp() * 1000)]
    want = expected(spark, on_time)
    for name in ("agg-users", "agg-rascals"):
        assert index(spark, cfg, name) == want[name]
    # When the last batch came, days before the 8th were closed; panes a day further back are gone.
    final = jobs.closed_windows(spark, cfg, "agg-users")
    assert {r.window_end.day for r in final.collect()} == {1, 2, 4, 5, 6}
    kept = read_panes(spark, cfg.index("panes-members"), jobs.MEMBER_KEYS)
    assert {r.pane_start.day for r in kept.collect()} == {9, 12}
    for label in ("2024.01.01", "2024.01.05"):
        assert len(subfolders(spark, f"{cfg.index('agg-users')}/dateForIndex={label}")) == 1


def test_a_far_future_time_closes_nothing(spark, cfg):
    cfg = replace(cfg, horizon="1 day")
    run(spark, cfg, [rsvp("2999-01-01 00:00:05")], [rsvp("2024-01-01 00:00:05", member=2)], [rsvp("2024-01-01 00:00:06", member=3)])
    assert read_panes(spark, cfg.index("panes-members"), jobs.MEMBER_KEYS, late=True).count() == 0


def test_what_is_kept_does_not_grow_with_the_days(spark, cfg, monkeypatch):
    monkeypatch.setattr(segments, "FAN", 2)
    cfg = replace(cfg, horizon="1 day", input_options={"maxFilesPerTrigger": "1"})
    parts = [[rsvp(f"2024-01-{d:02} {h:02}:00:05", member=d) for h in (1, 13)] * 7 for d in range(1, 15)]
    for part in parts:
        feed(spark, cfg.input_path, part)
    read, sizes = Segments.read, []

    def watched(self, *args, **kwargs):
        found = read(self, *args, **kwargs)
        sizes.append(len(found.inputFiles()))
        return found

    monkeypatch.setattr(Segments, "read", watched)
    start_members(jobs.rsvp_stream(stream_session(spark, 2), cfg), cfg).awaitTermination()
    assert max(sizes[-8:]) <= max(sizes[4:16])
    store = Segments(spark, cfg.index("panes-members"), jobs.MEMBER_KEYS)
    assert sum(len(store.labels(s)) for s in store.listed()) <= 5
    assert index(spark, cfg, "agg-rascals") == expected(spark, sum(parts, []))["agg-rascals"]


@pytest.mark.parametrize("step", ["compact_day", "mark_whole"])
def test_closing_cut_short_is_repeated(spark, cfg, monkeypatch, step):
    cfg = replace(cfg, horizon="1 day")
    parts = [[rsvp("2024-01-01 00:00:05", member=1)] * 7, [rsvp("2024-01-01 00:00:06", member=1)], [rsvp("2024-01-20 00:00:05", member=2)], [rsvp("2024-01-20 00:00:05", member=3)]]
    run(spark, cfg, *parts[:3])
    want = expected(spark, sum(parts, []))["agg-users"]
    real, calls = getattr(jobs, step), []

    def fail_once(*args, **kwargs):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("cut short")
        return real(*args, **kwargs)

    monkeypatch.setattr(jobs, step, fail_once)
    with pytest.raises(Exception, match="cut short"):
        run(spark, cfg, parts[3])
    start_members(jobs.rsvp_stream(stream_session(spark, 2), cfg), cfg).awaitTermination()
    assert index(spark, cfg, "agg-users") == want
    final = {(r.window_start.minute, r.window_start.second): r.versions for r in jobs.closed_windows(spark, cfg, "agg-users").collect()}
    assert final[(0, 0)] == 2 and set(final.values()) == {2}


def test_the_cap_holds_for_a_window_over_all_batches(spark, cfg):
    cfg = replace(cfg, max_alerts=3)
    parts = [[rsvp(clock(5), member=m)] * n for m, n in ((1, 7), (2, 9))] + [[rsvp(clock(6), member=m) for m in (3, 4, 5)] * 8 + [rsvp(clock(25), member=1)] * 7]
    run(spark, cfg, *parts)
    sent = [r.value for r in read_alerts(spark, cfg.index("alerts")).collect()]
    first = [value for value in sent if "member 1" not in value or '"count":7' in value]
    assert len(sent) == 4 and sum("member 1" in value for value in sent) == 2 and len(first) == 4
    assert sum('"member_id":3' in value for value in sent) == 1 and not any('"member_id":4' in value for value in sent)


def test_empty_names_get_an_alert_of_their_own(spark, cfg):
    named = lambda name: {**rsvp(clock(5)), "member": {**rsvp()["member"], "member_name": name}}
    run(spark, cfg, [named("")] * 7, [named("m")] * 7)
    assert read_alerts(spark, cfg.index("alerts")).count() == 2


def test_repeated_messages_count_once_if_asked(spark, cfg):
    cfg = replace(cfg, redelivered_within="1 hour")
    first = [rsvp(clock(n), member=n % 3, rsvp_id=n) for n in range(20)]
    anew = [rsvp(clock(100), member=1, rsvp_id=1)]
    unknown = [rsvp(clock(n), member=7, rsvp_id=float("nan")) for n in (1, 1)]
    run(spark, cfg, first + first[:5], first + anew + unknown)
    assert index(spark, cfg, "agg-users") == expected(spark, first + anew + unknown)["agg-users"]


def test_two_versions_of_a_window_and_the_latest(spark, cfg):
    run(spark, cfg, [rsvp(clock(5), member=1)], [rsvp(clock(6), member=2)] * 2)
    stored = read_index(spark, cfg.index("agg-users"), INDEX_COLUMNS["agg-users"], days=["2024.01.01", "2023.12.31", "2030.01.01"])
    assert rows(latest_windows(stored).where("position = 1"), "member_id", "count") == [(2, 2)] * 3
