"""Sliding counts by differences, by a hierarchy of panes, and bursts within any stretch of time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnout.functions.columns import seconds_in

_MICROS = 1_000_000


def _floor(at: Column, seconds: int) -> Column:
    micros = F.unix_micros(at)
    return micros - F.pmod(micros, F.lit(seconds * _MICROS))


def sliding_counts(
    df: DataFrame, keys: Sequence[str], length: str, slide: str, time_col: str = "event_time"
) -> DataFrame:
    """``count`` of rows per window of ``length`` every ``slide`` and ``keys``, as ``windowed_counts``.

    Counts can be taken back: a row enters with the first window that holds it and leaves with the
    first that no longer does. Each row is two changes, however many windows it is in; changes are
    summed before the shuffle, and a running sum per key gives every window's count. That moves
    less than placing rows in ``length / slide`` windows where this is large. A key that holds a
    third of the rows has one change for each slide at most. Rows without a time are in no window.
    """
    step, span = seconds_in(slide) * _MICROS, seconds_in(length) * _MICROS
    pane = _floor(F.col(time_col), seconds_in(slide))
    # The last window that holds a row starts with its pane; the first one after its time less the length.
    first = _floor(F.timestamp_micros(F.unix_micros(F.col(time_col)) - span), seconds_in(slide)) + step
    changes = df.where(F.col(time_col).isNotNull()).select(
        *keys,
        F.explode(F.array(
            F.struct(first.alias("at"), F.lit(1).alias("by")), F.struct((pane + step).alias("at"), F.lit(-1).alias("by"))
        )).alias("change"),
    )
    summed = changes.groupBy(*keys, F.col("change.at").alias("at")).agg(F.sum("change.by").alias("by"))
    by_key = Window.partitionBy(*keys).orderBy("at")
    running = summed.where("by <> 0").select(
        *keys, "at", F.sum("by").over(by_key).alias("count"), F.lead("at").over(by_key).alias("next")
    )
    # Windows between two changes have the same count.
    starts = F.explode(F.sequence("at", F.col("next") - step, F.lit(step))).alias("start")
    windows = running.where("count > 0").select(*keys, "count", starts)
    return windows.select(
        F.timestamp_micros("start").alias("window_start"), F.timestamp_micros(F.col("start") + span).alias("window_end"),
        *keys, "count",
    )


def pane_levels(df: DataFrame, keys: Sequence[str], sizes: Sequence[str], time_col: str = "event_time") -> dict[int, DataFrame]:
    """Counts per pane and key for each size of pane, by its seconds; larger panes from smaller ones.

    Each size must divide the next. Rows without a time are in no pane.
    """
    seconds = sorted(map(seconds_in, sizes))
    if any(b % a for a, b in zip(seconds, seconds[1:])):
        raise ValueError(f"each size of pane must divide the next: {sizes}")
    timed = df.where(F.col(time_col).isNotNull())
    levels, source, at, total = {}, timed, F.col(time_col), F.count(F.lit(1))
    for size in seconds:
        counted = source.groupBy(F.timestamp_micros(_floor(at, size)).alias("pane_start"), *keys).agg(total.alias("count"))
        levels[size] = source = counted
        at, total = F.col("pane_start"), F.sum("count")
    return levels


def covering_panes(levels: Mapping[int, DataFrame], keys: Sequence[str], length: str, slide: str | None = None) -> DataFrame:
    """``window_start``, keys, ``count`` of the fewest panes that make up each window.

    A pane belongs to the cover of the windows that hold it but not the larger pane around it. So a
    window takes large panes within and small ones only at its ends, whatever its length.
    """
    span, step = seconds_in(length), seconds_in(slide or length)
    sizes = sorted(levels)
    if span % sizes[0] or step % sizes[0]:
        raise ValueError(f"the smallest pane must divide length and slide: {sizes[0]} s")
    parts = []
    for size, larger in zip(sizes, [*sizes[1:], None]):
        start = F.unix_micros("pane_start")
        # Starts of the windows that hold the pane: multiples of the slide.
        last = _floor(F.col("pane_start"), step)
        first = _floor(F.timestamp_micros(start + (size - span) * _MICROS - 1), step) + step * _MICROS
        held = F.when(first <= last, F.sequence(first, last, F.lit(step * _MICROS))).otherwise(F.array().cast("array<bigint>"))
        if larger:
            around = _floor(F.col("pane_start"), larger)
            held = F.filter(held, lambda s: (s > around) | (s + span * _MICROS < around + larger * _MICROS))  # noqa: B023
        parts.append(levels[size].select(F.explode(held).alias("start"), *keys, "count"))
    placed = parts[0]
    for part in parts[1:]:
        placed = placed.unionByName(part)
    return placed.select(F.timestamp_micros("start").alias("window_start"), *keys, "count")


def covered_counts(levels: Mapping[int, DataFrame], keys: Sequence[str], length: str, slide: str | None = None) -> DataFrame:
    """``count`` per window and keys from panes of several sizes, as ``windowed_counts`` from rows."""
    totals = covering_panes(levels, keys, length, slide).groupBy("window_start", *keys).agg(F.sum("count").alias("count"))
    end = F.timestamp_micros(F.unix_micros("window_start") + seconds_in(length) * _MICROS)
    return totals.select("window_start", end.alias("window_end"), *keys, "count")


def crowded_moments(
    df: DataFrame, keys: Sequence[str], length: str, threshold: int, time_col: str = "event_time"
) -> DataFrame:
    """``keys, since, until``: moments at which a key has had more than ``threshold`` rows within ``length``.

    Fixed windows miss a crowd that lies across an edge; here the stretch ends at the row itself.
    ``until`` is that row's time, ``since`` the time of the row ``threshold`` places before it, less
    than ``length`` earlier. Rows of one time count together, so a moment has one result. Rows
    without a time are left out; null keys are keys.

    Time is cut into buckets as long as several stretches, and each row also looks on from the next
    bucket, so a stretch is always whole in one. The rows of a key are sorted per bucket, and a
    key with a third of all rows is spread over as many tasks as it has buckets.
    """
    span = seconds_in(length) * _MICROS
    bucket = 16 * span
    at = F.unix_micros(time_col)
    into = F.pmod(at, F.lit(bucket))
    number, near_end = at - into, into >= bucket - span
    places = F.when(near_end, F.array(number, number + bucket)).otherwise(F.array(number))
    placed = df.where(F.col(time_col).isNotNull()).select(*keys, at.alias("_at"), number.alias("_own"), F.explode(places).alias("_bucket"))
    before = F.lag("_at", threshold).over(Window.partitionBy(*keys, "_bucket").orderBy("_at"))
    crowded = placed.withColumn("_since", before).where(
        (F.col("_bucket") == F.col("_own")) & (F.col("_at") - F.col("_since") < span)
    )
    return crowded.groupBy(*keys, "_at").agg(F.max("_since").alias("_since")).select(
        *keys, F.timestamp_micros("_since").alias("since"), F.timestamp_micros("_at").alias("until")
    )
