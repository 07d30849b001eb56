"""From the wire record, where every id and time is a double, to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _whole(number: Column) -> Column:
    """Double to bigint. NaN, infinities and overflow turn null rather than failing the job."""
    return number.try_cast("bigint")


def _instant(millis: Column) -> Column:
    """Epoch milliseconds to a timestamp; null if no timestamp can hold it. The argument occurs
    once, so that Spark can merge this into the scan's projection and prune what is unused."""
    return F.timestamp_micros(F.try_multiply(_whole(millis), F.lit(1000)))


#: Milliseconds at the start of the year 1 and before that of the year 10000.
FIRST_MILLIS, LAST_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def _event_time(millis: Column) -> Column:
    """Null for times outside the years 1 to 9999, which labels and windows cannot express. The
    bound is fixed, so that batch and stream agree on it whenever they run. Overflowing sums test
    it with one occurrence of the argument, as in ``_instant``."""
    up, down = F.lit((1 << 63) - 1 - LAST_MILLIS), F.lit(FIRST_MILLIS + (1 << 63))
    whole = F.try_subtract(F.try_add(_whole(millis), up), up)
    return F.timestamp_micros(F.try_multiply(F.try_add(F.try_subtract(whole, down), down), F.lit(1000)))


def usable(rsvps: DataFrame, time_col: str = "event_time") -> DataFrame:
    """The normalized rows that windows count."""
    return rsvps.where(F.col(time_col).isNotNull())


def set_aside(rsvps: DataFrame, time_col: str = "event_time") -> DataFrame:
    """The normalized rows that no window counts, for lack of a usable time."""
    return rsvps.where(F.col(time_col).isNull())


def normalize(rsvps: DataFrame) -> DataFrame:
    """Cast ids to bigint and times to timestamps; ``mtime`` becomes ``event_time``.

    Ids become bigint on purpose: a double of nine or more digits prints as ``1.23E8``
    in alert texts. Every step is a struct-field expression, so a column that a job does not
    read is still pruned from the scan.
    """
    return rsvps.select(
        F.col("venue").withField("venue_id", _whole(F.col("venue.venue_id"))).alias("venue"),
        "visibility",
        "response",
        _whole(F.col("guests")).alias("guests"),
        F.col("member").withField("member_id", _whole(F.col("member.member_id"))).alias("member"),
        _whole(F.col("rsvp_id")).alias("rsvp_id"),
        _event_time(F.col("mtime")).alias("event_time"),
        F.col("event").withField("time", _instant(F.col("event.time"))).alias("event"),
        F.col("group").withField("group_id", _whole(F.col("group.group_id"))).alias("group"),
    )
