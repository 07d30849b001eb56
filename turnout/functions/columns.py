"""Labels, stamps and texts, each a built-in column expression."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The day label's pattern and the texts of an alert.
DAY_PATTERN = "y.MM.dd"
ALERT_TITLE = "User in frenzy detected!"
ALERT_PARTS = (
    "User > ",
    " (",
    ") < sent > ",
    " < rsvps in ",
    " seconds ! This is shady - please verify !",
)

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds_in(interval: str) -> int:
    """Whole seconds in an interval such as ``'20 seconds'`` or ``'1 day'``."""
    words = interval.split()
    if len(words) != 2 or not words[0].isdigit() or words[1].rstrip("s") not in _UNITS:
        raise ValueError(f"expected '<number> <unit>' with a unit of {sorted(_UNITS)}: {interval!r}")
    return int(words[0]) * _UNITS[words[1].rstrip("s")]


def delta_of(interval: str) -> timedelta:
    return timedelta(seconds=seconds_in(interval))


def epoch_millis(ts: Column) -> Column:
    """Whole milliseconds since the epoch as a double, the wire form of a time."""
    return F.unix_millis(ts.cast("timestamp")).cast("double")


def _utc_date(at: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(at) / 86400).cast("int"))


def day_label(at: Column) -> Column:
    """The day of ``at`` in UTC, whatever the session's time zone, written like ``2024.01.31``."""
    return F.date_format(_utc_date(at), DAY_PATTERN)


def window_text(at: Column, millis: bool = False) -> Column:
    """An instant as text in UTC, so that readers in any time zone see the same value."""
    seconds = F.unix_seconds(at)
    clock = [(seconds / 3600, 24), (seconds / 60, 60), (seconds / 1, 60)]
    parts = [F.lpad(F.pmod(F.floor(n), F.lit(m)).cast("string"), 2, "0") for n, m in clock]
    text = F.concat(_utc_date(at).cast("string"), F.lit(" "), F.concat_ws(":", *parts))
    if not millis:
        return text
    return F.concat(text, F.lit("."), F.lpad(F.pmod(F.unix_millis(at), F.lit(1000)).cast("string"), 3, "0"))


def with_ingest_time(df: DataFrame, name: str = "ingest_time") -> DataFrame:
    """Stamp rows with their arrival: all rows of one micro-batch get the same instant."""
    return df.withColumn(name, F.current_timestamp())


def with_write_timestamp(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Add ``timestamp``: epoch milliseconds as a double, at second resolution.

    ``at`` defaults to ``window_end``, which makes a replay write the same value;
    pass ``F.current_timestamp()`` to stamp with the time of writing instead.
    """
    at = F.col("window_end") if at is None else at
    return df.withColumn("timestamp", F.unix_timestamp(at).cast("double") * 1000)


def alert_message(member_id: Column, member_name: Column, count: Column, length: str) -> Column:
    """Text of a burst alert; null if any part is null. The window length appears in seconds."""
    who, open_name, sent, within, ending = ALERT_PARTS
    return F.concat(
        F.lit(who), member_id.cast("string"),
        F.lit(open_name), member_name,
        F.lit(sent), count.cast("string"),
        F.lit(f"{within}{seconds_in(length)}{ending}"),
    )
