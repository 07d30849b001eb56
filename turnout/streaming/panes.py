"""Counts per pane: what the streaming analyses keep of the rows they have seen.

A pane is a stretch of time that divides every window and slide of an analysis. Each micro-batch
adds its own counts per pane and key (see ``segments``). Rows that come late add to their old
panes, until a horizon, if there is one, has closed their day.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.functions.columns import seconds_in
from turnout.streaming.segments import Segments, reach


def pane_seconds(*intervals: str | None) -> int:
    """The longest pane that divides all intervals."""
    return gcd(*(seconds_in(interval) for interval in intervals if interval is not None))


def pane_start(at: Column, seconds: int) -> Column:
    micros = F.unix_micros(at)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(seconds * 1_000_000)))


def pane_counts(rows: DataFrame, keys: Sequence[str], seconds: int, time_col: str) -> DataFrame:
    """``pane_start, count`` and the keys. Rows without a usable time are counted under a null pane."""
    return rows.groupBy(pane_start(F.col(time_col), seconds).alias("pane_start"), *keys).count()


def read_panes(spark: SparkSession, path: str, keys: str, late: bool = False) -> DataFrame:
    """All stored counts, or those of rows that came too late; ``keys`` are the key columns with their types."""
    return Segments(spark, path, keys).read(late=late)


def window_totals(panes: DataFrame, keys: Sequence[str], length: str, slide: str | None) -> DataFrame:
    """Counts per window and key, from counts per pane. Panes without a time are in no window."""
    totals = panes.groupBy(F.window("pane_start", length, slide).alias("window"), *keys).agg(
        F.sum("count").alias("count")
    )
    return totals.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "count"
    )


def touched_windows(panes: Segments, batch_id: int, length: str, slide: str | None) -> DataFrame | None:
    """Counts of every window that has a pane of this batch, over all batches up to it.

    Of what is stored, only the days that those windows reach are listed and read: the set of
    them, so rows of far-off times bring in no day between. None if the batch has no usable time.
    """
    days = panes.days(batch_id)
    if not days:
        return None
    window = F.window("pane_start", length, slide)["start"].alias("window_start")
    touched = panes.read(days, only=batch_id).select(window).distinct()
    near = panes.read(reach(days, length), up_to=batch_id)
    return window_totals(near, panes.names, length, slide).join(touched, "window_start", "left_semi")
