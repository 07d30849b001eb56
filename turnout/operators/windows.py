"""Counts per time window and key, the same code for batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.functions.columns import seconds_in


def windowed_counts(
    df: DataFrame,
    keys: Sequence[str],
    length: str,
    slide: str | None = None,
    time_col: str = "event_time",
    watermark: str | None = None,
    panes: bool = False,
) -> DataFrame:
    """``count`` of rows per window of ``length`` (every ``slide``, else tumbling) and ``keys``.

    Each map task counts its own rows before the shuffle, so a key that holds a third of the
    data costs one row per task and window. On a stream, ``watermark`` bounds the state to the
    open windows and lets append mode emit each window once it is final; on a batch frame it
    has no effect. Rows without a time belong to no window.

    A sliding window puts every row into ``length / slide`` windows. ``panes`` counts per slide
    first and places those counts instead of the rows: faster where a key has many rows per
    slide, as topics do, slower where it has about one, as members do, because of the second
    shuffle. It applies to batch frames whose ``slide`` divides ``length``; streams keep to one
    stateful step.
    """
    if watermark:
        df = df.withWatermark(time_col, watermark)
    if panes and slide and not df.isStreaming and seconds_in(length) % seconds_in(slide) == 0:
        per_pane = df.groupBy(F.window(time_col, slide).alias("window"), *keys).count()
        df = per_pane.select(F.col("window.start").alias(time_col), *keys, "count")
        total = F.sum("count")
    else:
        total = F.count("*")
    counts = df.groupBy(F.window(time_col, length, slide).alias("window"), *keys)
    return counts.agg(total.alias("count")).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        "count",
    )
