"""Trending topics per window, among accepted RSVPs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.functions.columns import day_label
from turnout.operators.project import explode_topics, yes_responses
from turnout.operators.rank import top_k, with_position
from turnout.operators.windows import windowed_counts

KEYS = ("topic",)


def topic_counts(
    rsvps: DataFrame,
    length: str = "60 seconds",
    slide: str | None = "20 seconds",
    time_col: str = "event_time",
    watermark: str | None = None,
) -> DataFrame:
    """Mentions per window and topic in "yes" RSVPs.

    Topics are a small vocabulary with many mentions per slide, so batch counts go by panes.
    """
    topics = explode_topics(yes_responses(rsvps), time_col)
    return windowed_counts(topics, KEYS, length, slide, time_col, watermark, panes=True)


def rank_topics(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most mentioned topics of each finished window, with day label and position."""
    best = with_position(top_k(counts, k, keys=KEYS))
    return best.withColumn("dateForIndex", day_label(F.col("window_end")))


def trending_topics(
    rsvps: DataFrame,
    length: str = "60 seconds",
    slide: str | None = "20 seconds",
    k: int = 10,
    time_col: str = "event_time",
) -> DataFrame:
    """Batch form: count, then rank."""
    return rank_topics(topic_counts(rsvps, length, slide, time_col), k)


def trending_overall(rsvps: DataFrame, k: int = 10) -> DataFrame:
    """The same ranking over all given RSVPs at once, without windows."""
    counts = explode_topics(yes_responses(rsvps)).groupBy(*KEYS).count()
    return with_position(top_k(counts, k, keys=KEYS, within=()), within=(), cut=True)
