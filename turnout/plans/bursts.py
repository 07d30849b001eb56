"""Members whose activity bursts past a threshold, and the alert for each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.functions.columns import ALERT_TITLE, alert_message, day_label
from turnout.operators.project import members
from turnout.operators.rank import WINDOW_BOUNDS, top_k
from turnout.operators.windows import windowed_counts

#: The fields of a published alert, in order.
ALERT_FIELDS = ("member_name", "member_id", "dateForIndex", "count", "title", "message")

#: The reduced form for readers that need only the text.
SLIM_ALERT_FIELDS = ("title", "message")


def burst_members(
    rsvps: DataFrame,
    length: str = "20 seconds",
    slide: str | None = None,
    threshold: int = 6,
    time_col: str = "event_time",
    watermark: str | None = None,
) -> DataFrame:
    """Members with more than ``threshold`` RSVPs in a window; also legal on a stream."""
    counts = windowed_counts(
        members(rsvps, time_col), ("member_name", "member_id"), length, slide, time_col, watermark
    )
    bursts = counts.where(F.col("count") > threshold)
    return bursts.withColumn("dateForIndex", day_label(F.col("window_end")))


def alert_payload(
    bursts: DataFrame,
    length: str = "20 seconds",
    max_alerts: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One JSON alert per burst as ``key`` and ``value``, with its window's bounds.

    With ``max_alerts``, at most so many per window are kept, the largest counts first. Null
    fields are left out of the JSON.
    """
    chosen = top_k(bursts, max_alerts, keys=("member_id", "member_name")) if max_alerts else bursts
    texts = chosen.withColumns({
        "title": F.lit(ALERT_TITLE),
        "message": alert_message(
            F.col("member_id"), F.col("member_name"), F.col("count"), length
        ),
    })
    return texts.select(
        *WINDOW_BOUNDS,
        F.col("member_id").cast("string").alias("key"),
        F.to_json(F.struct(*(columns or ALERT_FIELDS))).alias("value"),
    )
