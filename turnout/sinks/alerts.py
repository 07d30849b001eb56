"""Publishing alerts, one message each, written by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.sinks.folders import is_whole, mark_whole, subfolders

_QUEUE_FORMATS = ("kafka",)


def publish_alerts(
    alerts: DataFrame,
    path: str | None = None,
    batch_id: int = 0,
    fmt: str = "text",
    options: dict[str, str] | None = None,
) -> None:
    """Publish the ``value`` of each alert, running its plan once.

    File formats write one message per line under ``path/batch_id=<id>``, so that a repeated
    batch replaces itself and others stay; formats other than ``text`` also keep the ``key``.
    Without alerts there is no such folder. ``fmt='kafka'`` sends key and value to the topic
    named in ``options``; there a repeated batch is sent again (at least once). ``fmt='committed'``
    publishes in two phases, see ``publish_once``.
    """
    if fmt == "committed":
        publish_once(alerts, path, batch_id)
        return
    columns = ["value"] if fmt == "text" else ["key", "value"]
    chosen = alerts.select(*columns)
    if fmt in _QUEUE_FORMATS:
        chosen.write.format(fmt).options(**(options or {})).save()
        return
    (
        chosen.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.format(fmt).options(**(options or {}))
        .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
        .save(path)
    )


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Messages published as ``text``, with their ``batch_id``."""
    return spark.read.schema("value string, batch_id bigint").text(path)


def publish_once(alerts: DataFrame, path: str, batch_id: int) -> bool:
    """Publish a batch's alerts all or not at all; False if that batch was published before.

    The tasks write the messages to the batch's folder; they count once the driver has marked it
    as whole. A batch that failed before that is written anew, and one that is marked stays as it
    is, also if a repeated run would give other alerts: each is published exactly once.
    """
    at = f"{path}/batch={batch_id}"
    if is_whole(alerts.sparkSession, at):
        return False
    alerts.select("value").write.mode("overwrite").option("partitionOverwriteMode", "static").text(at)
    mark_whole(alerts.sparkSession, at)
    return True


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """Messages published in two phases, those of whole batches only."""
    at = [f"{path}/{name}" for name in subfolders(spark, path) if is_whole(spark, f"{path}/{name}")]
    return spark.read.text(at) if at else spark.createDataFrame([], "value string")
