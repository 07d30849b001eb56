"""Top-k, dense positions and running numbers, per time window or over the whole frame."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnout.sinks.folders import shared_dir

WINDOW_BOUNDS = ("window_start", "window_end")


def _order(by: str, keys: Sequence[str]) -> list[Column]:
    return [F.col(by).desc(), *[F.col(key).asc_nulls_last() for key in keys]]


def top_k(
    df: DataFrame,
    k: int,
    keys: Sequence[str],
    by: str = "count",
    within: Sequence[str] = WINDOW_BOUNDS,
) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ties at the cut go to the smallest ``keys``.

    Per window, Spark keeps at most ``k`` rows of a window in each task before the shuffle, so
    one crowded window does not land whole on one task. With no ``within`` the cut is global and
    each task likewise contributes ``k`` rows.
    """
    if not within:
        return df.orderBy(*_order(by, keys)).limit(k)
    ranked = Window.partitionBy(*within).orderBy(*_order(by, keys))
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= k).drop("_rank")


def numbered(df: DataFrame, order: Sequence[Column], name: str = "number") -> DataFrame:
    """All rows with a running number from 1 in the given order, counted by many tasks.

    Rows are dealt out by ranges of ``order`` and sorted within each, each range is counted from 1,
    and what lies before a range is added: one row per range, never the rows themselves. The ranges
    are stored first, since a repeated task might cut them elsewhere. Rows that ``order`` does not
    tell apart lie in one range; give it columns that do.
    """
    spark, at = df.sparkSession, shared_dir(df.sparkSession, "numbered")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranged.withColumns({"_range": F.spark_partition_id(), "_within": within}).write.parquet(f"{at}/rows")
    stored = spark.read.parquet(f"{at}/rows")
    # A row per range.
    sizes = sorted(map(tuple, stored.groupBy("_range").agg(F.max("_within")).collect()))
    before = accumulate((size for _, size in sizes), initial=0)
    starts = spark.createDataFrame([(part, n) for (part, _), n in zip(sizes, before)], "_range int, _before bigint")
    placed = stored.join(F.broadcast(starts), "_range")
    return placed.select(*df.columns, (F.col("_before") + F.col("_within")).alias(name))


def with_position(
    df: DataFrame, by: str = "count", within: Sequence[str] = WINDOW_BOUNDS, cut: bool = False
) -> DataFrame:
    """Add ``position``: 1 for the largest ``by``, shared by ties, without gaps; null comes last.

    Per window, the rows of one window are ranked in one task: meant for frames cut by ``top_k``.
    Without ``within``, a frame of any size is ranked by its distinct values of ``by``: those are
    numbered by many tasks, and their numbers joined to the rows. ``cut`` says that ``top_k`` has
    left so few rows that one task may rank them all.
    """
    if within or cut:
        groups = list(within) or [F.lit(1)]
        return df.withColumn(
            "position", F.dense_rank().over(Window.partitionBy(*groups).orderBy(F.col(by).desc()))
        )
    values = numbered(df.select(F.col(by).alias("_value")).distinct(), [F.col("_value").desc()], "_position")
    joined = df.join(values, df[by].eqNullSafe(values["_value"]), "left")
    return joined.select(*df.columns, F.col("_position").cast("int").alias("position"))
