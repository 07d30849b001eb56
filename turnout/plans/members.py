"""Most active members per window: every response counts, whatever its value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.functions.columns import day_label
from turnout.operators.project import members
from turnout.operators.rank import top_k, with_position
from turnout.operators.windows import windowed_counts

KEYS = ("member_id", "member_name")


def member_counts(
    rsvps: DataFrame,
    length: str = "60 seconds",
    slide: str | None = "20 seconds",
    time_col: str = "event_time",
    watermark: str | None = None,
) -> DataFrame:
    """RSVPs per window and member. A member who changes name is counted once per name."""
    return windowed_counts(members(rsvps, time_col), KEYS, length, slide, time_col, watermark)


def rank_members(counts: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most active members of each finished window, with day label and position."""
    best = with_position(top_k(counts, k, keys=KEYS))
    return best.withColumn("dateForIndex", day_label(F.col("window_end")))


def most_active_members(
    rsvps: DataFrame,
    length: str = "60 seconds",
    slide: str | None = "20 seconds",
    k: int = 5,
    time_col: str = "event_time",
) -> DataFrame:
    """Batch form: count, then rank."""
    return rank_members(member_counts(rsvps, length, slide, time_col), k)


def most_active_overall(rsvps: DataFrame, k: int = 5) -> DataFrame:
    """The same ranking over all given RSVPs at once, without windows."""
    counts = rsvps.select("member.member_id", "member.member_name").groupBy(*KEYS).count()
    return with_position(top_k(counts, k, keys=KEYS, within=()), within=(), cut=True)
