"""Sliding counts, levels of panes, crowded moments, summaries and positions against plain forms."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.rsvps import at, rows
from turnout.operators import (
    covered_counts,
    covering_panes,
    crowded_moments,
    frequent_top_k,
    numbered,
    pane_levels,
    sliding_counts,
    summaries,
    top_k,
    windowed_counts,
    with_position,
)

KEYS = ["who"]
BASE = int(at("2024-01-01 00:00:00").timestamp() * 1e6)


def some(spark, n=400, span=7200, seed=0, hot=0.33):
    """Rows at random times, a third of one key, some without a time or a key, some before 1970."""
    pick = random.Random(seed)
    unit = lambda: pick.choice([(1, span * 1_000_000), (20_000_000, span // 20)])
    records = [
        (pick.choice([BASE, BASE, BASE, -3600_000_000]) + step * pick.randrange(many),
         "hot" if pick.random() < hot else pick.choice(["a", "b", "c", None]))
        for step, many in (unit() for _ in range(n))
    ] + [(None, "a"), (BASE, "a"), (BASE, "a"), (BASE + 60_000_000, "b")]
    return spark.createDataFrame(records, "micros bigint, who string").select(F.timestamp_micros("micros").alias("event_time"), "who")


def counts(df):
    return Counter(map(tuple, df.select("window_start", "window_end", "who", "count").collect()))


@pytest.mark.parametrize("length, slide", [("60 seconds", "20 seconds"), ("1 hour", "20 seconds"), ("50 seconds", "20 seconds"), ("20 seconds", "20 seconds")])
def test_differences_equal_windows(spark, length, slide):
    df = some(spark)
    assert counts(sliding_counts(df, KEYS, length, slide)) == counts(windowed_counts(df, KEYS, length, slide))


def test_differences_move_each_row_twice(spark, capsys):
    df = some(spark)
    sliding_counts(df, KEYS, "1 hour", "20 seconds").explain("formatted")
    text = capsys.readouterr().out
    assert "Expand" not in text and "partial_sum" in text
    # Changes per key and slide at most, however many rows a key has.
    assert text.split("\n\n")[0].count("Exchange") == 2


@pytest.mark.parametrize("length, slide", [("2 hours", "1 hour"), ("1 hour", None), ("70 minutes", "10 minutes"), ("3 hours", "20 minutes")])
def test_levels_equal_windows(spark, length, slide):
    df = some(spark, span=20_000)
    levels = pane_levels(df, KEYS, ["1 hour", "10 minutes", "2 hours"])
    assert counts(covered_counts(levels, KEYS, length, slide)) == counts(windowed_counts(df, KEYS, length, slide))


def test_a_window_takes_the_fewest_panes(spark):
    df = spark.range(0, 86400 * 2, 20).select(F.timestamp_seconds(F.col("id") + BASE // 1_000_000).alias("event_time"), F.lit("x").alias("who"))
    levels = pane_levels(df, KEYS, ["20 seconds", "1 hour", "1 day"])
    used = covering_panes(levels, KEYS, "1 day", "20 minutes").groupBy("window_start").agg(F.count("*").alias("panes"), F.sum("count").alias("n"))
    by_start = {r.window_start: (r.panes, r.n) for r in used.collect()}
    midnight, later = at("2024-01-01 00:00:00").replace(tzinfo=None), at("2024-01-01 05:20:00").replace(tzinfo=None)
    assert by_start[midnight] == (1, 4320)
    # 23 hours, and 40 and 20 minutes at the ends, instead of 4,320 small panes.
    assert by_start[later] == (23 + 120 + 60, 4320)


def test_levels_must_nest(spark):
    with pytest.raises(ValueError, match="divide"):
        pane_levels(some(spark), KEYS, ["40 seconds", "1 minute"])
    with pytest.raises(ValueError, match="smallest"):
        covering_panes(pane_levels(some(spark), KEYS, ["1 minute"]), KEYS, "90 seconds")


@pytest.mark.parametrize("threshold, seconds", [(2, 20), (6, 20), (3, 1)])
def test_crowded_moments_equal_plain_search(spark, threshold, seconds):
    df = some(spark, n=1500, span=1200, seed=3)
    found = crowded_moments(df, KEYS, f"{seconds} seconds", threshold)
    got = Counter(map(tuple, found.select("who", F.unix_micros("since"), F.unix_micros("until")).collect()))
    times = {}
    for who, t in df.where("event_time IS NOT NULL").select("who", F.unix_micros("event_time")).collect():
        times.setdefault(who, []).append(t)
    want = Counter()
    for who, all_times in times.items():
        for t in set(all_times):
            before = sorted((u for u in all_times if t - seconds * 1_000_000 < u <= t), reverse=True)
            if len(before) > threshold:
                want[(who, before[threshold], t)] += 1
    assert got == want and want


def test_a_crowd_across_an_edge_is_found(spark):
    df = spark.createDataFrame([(at("2024-01-01 00:00:19") if n < 4 else at("2024-01-01 00:00:21"), "x") for n in range(7)], "event_time timestamp, who string")
    assert windowed_counts(df, KEYS, "20 seconds").where("count > 6").count() == 0
    assert crowded_moments(df, KEYS, "20 seconds", 6).count() == 1


def test_a_hot_key_is_split_by_time(spark, capsys):
    crowded_moments(some(spark), KEYS, "20 seconds", 6).explain("formatted")
    assert "_bucket" in capsys.readouterr().out.split("Window")[1]


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_summaries_prove_the_exact_top_k(spark, folder, size):
    pick = random.Random(size)
    records = [(at("2024-01-01 00:00:00").replace(minute=pick.randrange(12) * 5), f"t{int(pick.paretovariate(0.7)) % 60}", pick.randrange(1, 9)) for _ in range(600)]
    panes = spark.createDataFrame(records, "pane_start timestamp, who string, count bigint").groupBy("pane_start", "who").agg(F.sum("count").alias("count"))
    panes.write.parquet(folder("panes"))
    stored = spark.read.parquet(folder("panes"))
    got = frequent_top_k(stored, KEYS, 4, "20 minutes", "5 minutes", size=size)
    totals = stored.groupBy(F.window("pane_start", "20 minutes", "5 minutes").alias("w"), "who").agg(F.sum("count").alias("count"))
    want = top_k(totals.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "who", "count"), 4, KEYS)
    assert counts(got) == counts(want)


def test_a_summary_bounds_what_it_leaves_out(spark):
    panes = spark.createDataFrame([(at("2024-01-01 00:00:00"), f"k{i}", 10 - i) for i in range(6)] + [(at("2024-01-01 00:01:00"), "k0", 1)], "pane_start timestamp, who string, count bigint")
    assert rows(summaries(panes, KEYS, 2), "who", "count", "cut") == [("k0", 1, 0), ("k0", 10, 8), ("k1", 9, 8)]


def test_numbers_run_through_all_ranges(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("x"))
    got = numbered(df, [F.desc("x")])
    assert [n for _, n in sorted(map(tuple, got.collect()), reverse=True)] == list(range(1, 10_001))
    assert numbered(df.limit(0), [F.desc("x")]).count() == 0


def test_positions_of_a_million_rows(spark, capsys):
    """A third of the rows share one count."""
    df = spark.range(1_000_000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 70_001).alias("count"))
    ranked = with_position(df, within=())
    ranked.explain("formatted")
    assert "SinglePartition" not in capsys.readouterr().out
    df.createOrReplaceTempView("positions_input")
    want = spark.sql("SELECT id, count, dense_rank() OVER (ORDER BY count DESC) AS position FROM positions_input")
    assert ranked.exceptAll(want).isEmpty() and ranked.count() == 1_000_000


def test_positions_with_nulls_and_few_rows(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7), (4, 5)], "id int, count int")
    assert rows(with_position(df, within=()), "id", "position") == [(1, 2), (2, 3), (3, 1), (4, 2)]
    assert rows(with_position(df, within=(), cut=True), "id", "position") == [(1, 2), (2, 3), (3, 1), (4, 2)]
