"""Where results go: per-day and static indexes, and published alerts."""

from turnout.sinks.alerts import publish_alerts, publish_once, read_alerts, read_published
from turnout.sinks.folders import has_files, shared_dir
from turnout.sinks.index import compact_day, latest_windows, read_index, write_daily, write_static

__all__ = [
    "compact_day",
    "has_files",
    "latest_windows",
    "publish_alerts",
    "publish_once",
    "read_alerts",
    "read_index",
    "read_published",
    "shared_dir",
    "write_daily",
    "write_static",
]
