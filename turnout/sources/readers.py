"""Batch and streaming readers over any source Spark has a format for."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnout.schema import RSVP_SCHEMA_RELAXED

#: Formats that fix the type of ``value`` themselves.
_VALUE_FORMATS = ("kafka", "text")


def _load(spark, path, fmt, streaming, options, schema) -> DataFrame:
    reader = (spark.readStream if streaming else spark.read).format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**(options or {}))
    return reader.load(path) if path else reader.load()


def read_rsvps(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    streaming: bool = False,
    options: dict[str, str] | None = None,
    between: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """RSVP records in wire form from files (parquet, orc, json), with the schema fixed up front.

    ``between`` keeps records from the first time until before the second; it reaches the scan as
    a range of ``mtime``. Widen it by a window's length where whole windows are wanted. Times
    without a zone are meant in UTC.

    A file stream replays by offset after a failure, so nothing is kept in executor memory
    between batches. ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` in ``options`` sets the
    rate limit.
    """
    records = _load(spark, path, fmt, streaming, options, RSVP_SCHEMA_RELAXED)
    return in_range(records, *between) if between else records


def in_range(records: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Records in wire form with ``start <= mtime < end``, compared as stored so that scans prune."""
    first, last = (
        (t if t.tzinfo else t.replace(tzinfo=timezone.utc)).timestamp() * 1000 for t in (start, end)
    )
    return records.where((F.col("mtime") >= first) & (F.col("mtime") < last))


def read_payloads(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    streaming: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Undecoded messages as one column ``value``, from a queue or from files.

    ``fmt='kafka'`` works when that connector is on the class path; pass its settings (servers,
    topic, ``maxOffsetsPerTrigger``) as ``options``. ``fmt='text'`` reads one message per line,
    such as JSON lines that should be checked rather than read as columns; other file formats
    hold a binary column ``value``.
    """
    schema = None if fmt in _VALUE_FORMATS else T.StructType().add("value", T.BinaryType())
    return _load(spark, path, fmt, streaming, options, schema).select("value")
