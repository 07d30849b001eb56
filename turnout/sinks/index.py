"""Result indexes as partitioned tables, written so that a repeated batch replaces itself."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.functions.columns import with_write_timestamp
from turnout.sinks.folders import delete_folder, shared_dir, subfolders

_BOUNDS = "window_start timestamp, window_end timestamp"

#: Stored columns per index; the partition columns are appended on reading.
INDEX_COLUMNS = {
    "agg-users": f"{_BOUNDS}, member_id bigint, member_name string, count bigint, position int, timestamp double",
    "agg-topics": f"{_BOUNDS}, topic string, count bigint, position int, timestamp double",
    "agg-rascals": f"{_BOUNDS}, member_name string, member_id bigint, count bigint, timestamp double",
}


def _write(df: DataFrame, path: str, partitions: list[str], batch_id: int, fmt: str, at) -> None:
    stamped = with_write_timestamp(df, at).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    # One shuffle on the partition columns: few files per folder, and with adaptive execution a
    # folder that holds most of the rows is split over several tasks.
    (
        stamped.hint("rebalance", *partitions)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .save(path)
    )


def write_daily(
    df: DataFrame,
    path: str,
    batch_id: int,
    day_col: str = "dateForIndex",
    fmt: str = "parquet",
    at: Column | None = None,
) -> None:
    """Write results under ``path/<day>/<batch>``; the day names the folder and is not stored.

    Repeating a batch overwrites exactly its own folders, provided that its rows carry the same
    days again, which labels taken from ``window_end`` do. Other batches' results stay, so each
    run needs an id of its own; a window that several batches have written has the result of the
    highest id (``latest_windows``).
    """
    _write(df, path, [day_col, "batch_id"], batch_id, fmt, at)


def write_static(
    df: DataFrame,
    path: str,
    batch_id: int,
    fmt: str = "parquet",
    at: Column | None = None,
) -> None:
    """Write results to one index without a day, keeping every column of ``df``."""
    _write(df, path, ["batch_id"], batch_id, fmt, at)


def read_index(
    spark: SparkSession,
    path: str,
    columns: str,
    day_col: str | None = "dateForIndex",
    fmt: str = "parquet",
    day: str | None = None,
    days: Iterable[str] | None = None,
) -> DataFrame:
    """Read an index back; the day stays text.

    A filter on the day prunes folders after listing them all. ``day`` or ``days`` list those days'
    folders only, which matters once many days have many batches; ``days`` that are not there are
    passed over.
    """
    partitions = f"{day_col} string, batch_id bigint" if day_col else "batch_id bigint"
    reader = spark.read.schema(f"{columns}, {partitions}").format(fmt)
    if day is not None:
        return reader.option("basePath", path).load(f"{path}/{day_col}={day}")
    if days is not None:
        there = set(subfolders(spark, path))
        paths = [f"{path}/{day_col}={label}" for label in sorted(set(days)) if f"{day_col}={label}" in there]
        if not paths:
            return spark.createDataFrame([], f"{columns}, {partitions}")
        return reader.option("basePath", path).load(paths)
    return reader.load(path)


def latest_windows(stored: DataFrame) -> DataFrame:
    """Of each window only the rows of the last batch that wrote it.

    The last batch of each window is found by partial sums, not by bringing its rows together.
    """
    bounds = ["window_start", "window_end"]
    last = stored.groupBy(*[F.col(name).alias(f"_{name}") for name in bounds]).agg(F.max("batch_id").alias("_last"))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in bounds]
    return stored.join(last, [*same, F.col("batch_id") == F.col("_last")], "left_semi")


def compact_day(
    spark: SparkSession, path: str, columns: str, day: str, day_col: str = "dateForIndex", fmt: str = "parquet",
    batch_id: int | None = None,
) -> None:
    """Bring a closed day's latest windows together in one batch's folder, by as many tasks as it takes.

    Without ``batch_id`` it is the folder of the day's last batch, and the others, superseded by it,
    may be deleted; nothing is lost if the run ends halfway, as long as no batch of that day is
    written meanwhile. With the id of a batch that has no rows of that day, nothing that is there is
    replaced: reads give the same windows before, during and after, superseded folders are deleted
    last, and a run that was cut short may be repeated.
    """
    folder = f"{path}/{day_col}={day}"
    latest = latest_windows(read_index(spark, path, columns, day_col, fmt, day))
    last = latest.agg(F.max("batch_id")).first()[0]
    if last is None:
        return
    # Stored first: the folder that is read may also be the one that is replaced.
    staged = f"{shared_dir(spark, 'compaction')}/{day}"
    latest.write.format(fmt).save(staged)
    kept = spark.read.format(fmt).schema(latest.schema).load(staged)
    into = last if batch_id is None else batch_id
    (
        kept.withColumn("batch_id", F.lit(into).cast("bigint")).hint("rebalance")
        .write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(day_col, "batch_id").save(path)
    )
    if batch_id is not None:
        for name in subfolders(spark, folder):
            if name != f"batch_id={into}":
                delete_folder(spark, f"{folder}/{name}")
