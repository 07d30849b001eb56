"""Session settings that streaming queries need."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """A session on the same context for streams; the caller's own settings stay as they are.

    Window state goes to RocksDB, so it may outgrow the executor heap, with changelog
    checkpoints, so a batch uploads its changes only. Its files grow as they fill, since each of
    a batch's many stores would otherwise set some megabytes aside. ``shuffle_partitions`` (the
    caller's count if not given) becomes fixed with a query's first checkpoint: size it for the peak.
    """
    session = spark.newSession()
    partitions = shuffle_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    for name, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.streaming.stateStore.providerClass": _STATE_STORE,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    }.items():
        session.conf.set(name, value)
    return session


@contextmanager
def adaptive(batch: DataFrame) -> Iterator[DataFrame]:
    """Plan the work on a ``foreachBatch`` frame adaptively.

    Spark turns adaptive execution off in a stream's session because stateful steps need a
    fixed partition count. Ranking and writing do not: with it, the few rows of a finished
    window run as few tasks and land in few files, and a large replayed batch is balanced.
    """
    conf = batch.sparkSession.conf
    before = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "true")
    try:
        yield batch
    finally:
        conf.set("spark.sql.adaptive.enabled", before)
