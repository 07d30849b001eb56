"""Folders that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Written last into a folder whose content is whole. Spark's readers pass over names like this.
_MARKER = "_committed"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path under the cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then uses its warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/turnout/{purpose}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    """A path and its store, whatever store that is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether there is anything under a path."""
    folder, store = _located(spark, path)
    return store.exists(folder) and len(store.listStatus(folder)) > 0


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if there is no such folder."""
    folder, store = _located(spark, path)
    if not store.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(folder) if status.isDirectory())


def delete_folder(spark: SparkSession, path: str) -> None:
    folder, store = _located(spark, path)
    store.delete(folder, True)


def mark_whole(spark: SparkSession, path: str, marker: str = _MARKER) -> None:
    """Say that a folder's content is whole: the step that makes it count."""
    folder, store = _located(spark, f"{path}/{marker}")
    store.create(folder, True).close()


def is_whole(spark: SparkSession, path: str, marker: str = _MARKER) -> bool:
    folder, store = _located(spark, f"{path}/{marker}")
    return store.exists(folder)
