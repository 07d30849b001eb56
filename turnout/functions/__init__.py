"""Column-level building blocks."""

from turnout.functions.columns import (
    alert_message,
    day_label,
    epoch_millis,
    window_text,
    with_ingest_time,
    with_write_timestamp,
)
from turnout.functions.normalize import normalize, set_aside, usable

__all__ = [
    "alert_message",
    "day_label",
    "epoch_millis",
    "normalize",
    "window_text",
    "with_ingest_time",
    "set_aside",
    "usable",
    "with_write_timestamp",
]
