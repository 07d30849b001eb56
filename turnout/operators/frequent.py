"""Top-k per window from bounded summaries of panes, proved by exact counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnout.operators.rank import WINDOW_BOUNDS, top_k
from turnout.sinks.folders import shared_dir


def summaries(panes: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """The ``size`` largest counts of each pane, and in ``cut`` the largest count left out.

    Of ``pane_start``, keys and ``count`` with one row per pane and key. A key that is not there has
    at most ``cut`` in that pane; 0 means that nothing was left out. Each task keeps ``size + 1``
    rows of a pane before the shuffle.
    """
    order = [F.desc("count"), *[F.col(key).asc_nulls_last() for key in keys]]
    by_pane = Window.partitionBy("pane_start")
    ranked = panes.withColumn("_place", F.row_number().over(by_pane.orderBy(*order))).where(F.col("_place") <= size + 1)
    cut = F.max(F.when(F.col("_place") > size, F.col("count")).otherwise(0)).over(by_pane)
    return ranked.withColumn("cut", cut).where(F.col("_place") <= size).drop("_place")


def _placed(panes: DataFrame, length: str, slide: str | None, *columns: str) -> DataFrame:
    windows = panes.select(F.window("pane_start", length, slide).alias("window"), *columns)
    return windows.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *columns)


def frequent_top_k(
    panes: DataFrame, keys: Sequence[str], k: int, length: str, slide: str | None = None, size: int = 64
) -> DataFrame:
    """The ``k`` largest totals of each window, with exact counts; ties at the cut as in ``top_k``.

    ``panes`` has ``pane_start``, keys and ``count``, one row per pane and key, and is read more than
    once, so it should be stored; panes must divide windows and slides. The summaries of a window's
    panes give each key a least and a most it can total, and say what a key in none of them can.
    Keys that may be among the best are counted exactly. A window in which a key that no summary
    holds might be is not proved; those windows alone are tried again with larger summaries.
    Sizes grow until no pane leaves anything out, so every window is proved in the end.
    """
    spark, root = panes.sparkSession, shared_dir(panes.sparkSession, "frequent")
    found, todo, step = None, None, 0
    while True:
        kept = summaries(panes, keys, size)
        held = _placed(kept, length, slide, *keys, "count", "cut")
        cuts = _placed(kept.select("pane_start", "cut").distinct(), length, slide, "cut")
        if todo is not None:
            held, cuts = (part.join(todo, "window_start", "left_semi") for part in (held, cuts))
        missed = cuts.groupBy("window_start").agg(F.sum("cut").alias("missed"))
        bounds = held.groupBy(*WINDOW_BOUNDS, *keys).agg(F.sum("count").alias("least"), F.sum("cut").alias("known"))
        best = top_k(bounds, k, keys, by="least", within=("window_start",))
        edge = best.groupBy("window_start").agg(F.min("least").alias("edge"), F.count(F.lit(1)).alias("n"))
        judged = edge.join(missed, "window_start").select(
            "window_start", F.when(F.col("n") < k, 0).otherwise(F.col("edge")).alias("edge"), "missed",
            ((F.col("missed") == 0) | ((F.col("n") == k) & (F.col("missed") < F.col("edge")))).alias("proved"),
        )
        judged.write.parquet(f"{root}/{step}/judged")
        judged = spark.read.parquet(f"{root}/{step}/judged")
        may = F.col("least") + F.col("missed") - F.col("known") >= F.col("edge")
        candidates = bounds.join(judged.where("proved"), "window_start").where(may).select("window_start", *keys)
        candidates.write.parquet(f"{root}/{step}/candidates")
        candidates = spark.read.parquet(f"{root}/{step}/candidates")
        # Only panes' rows of candidate keys are placed in windows.
        named = candidates.select(*[F.col(key).alias(f"_{key}") for key in keys]).distinct()
        same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
        exact = _placed(panes.join(named, same, "left_semi"), length, slide, *keys, "count")
        wanted = candidates.select(F.col("window_start").alias("_start"), *[F.col(key).alias(f"_{key}") for key in keys])
        totals = exact.join(wanted, [F.col("window_start") == F.col("_start"), *same], "left_semi").groupBy(*WINDOW_BOUNDS, *keys)
        totals = top_k(totals.agg(F.sum("count").alias("count")), k, keys)
        found = totals if found is None else found.unionByName(totals)
        todo = judged.where("NOT proved").select("window_start")
        if todo.isEmpty():
            return found
        size, step = 4 * size, step + 1
