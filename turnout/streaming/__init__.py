"""The analyses as Structured Streaming queries."""

from turnout.streaming.config import JobConfig
from turnout.streaming.jobs import (
    await_jobs,
    rsvp_stream,
    run_jobs,
    start_ingest,
    start_members,
    start_topics,
)
from turnout.streaming.panes import read_panes, window_totals
from turnout.streaming.session import stream_session

__all__ = [
    "JobConfig",
    "await_jobs",
    "rsvp_stream",
    "read_panes",
    "run_jobs",
    "start_ingest",
    "start_members",
    "start_topics",
    "stream_session",
    "window_totals",
]
