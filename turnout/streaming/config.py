"""Parameters of the streaming application."""

from __future__ import annotations

from dataclasses import dataclass, field

from turnout.functions.columns import seconds_in

PAYLOADS = ("columns", "protobuf", "json")
QUEUE_FORMATS = ("kafka",)
TIME_COLUMNS = ("event_time", "ingest_time")


@dataclass(frozen=True)
class JobConfig:
    """Where a run reads, writes and checkpoints, and the parameters of its three analyses.

    The defaults of the windows, ranks and threshold are those of the original
    application, but for a cap on alerts: there is none unless ``max_alerts`` sets one.
    ``time_col='ingest_time'`` windows by arrival instead of by ``mtime``. ``horizon`` closes days
    that lie so far before the latest one, in whole days; without it no row ever comes too late.
    ``redelivered_within`` counts a message that arrives again within that time once; by default
    every arrival counts.
    """

    input_path: str | None
    output_path: str
    checkpoint_path: str
    input_format: str = "parquet"
    input_options: dict[str, str] = field(default_factory=dict)
    payload: str = "columns"
    decode_mode: str = "PERMISSIVE"
    decode_with_jar: bool = False

    time_col: str = "event_time"
    length: str = "60 seconds"
    slide: str = "20 seconds"
    top_members: int = 5
    top_topics: int = 10
    burst_length: str = "20 seconds"
    burst_slide: str | None = None
    burst_threshold: int = 6
    max_alerts: int | None = None
    horizon: str | None = None
    redelivered_within: str | None = None
    alert_format: str = "text"
    alert_options: dict[str, str] = field(default_factory=dict)

    batch_interval: str = "20 seconds"
    available_now: bool = False
    run_minutes: float = 0

    def __post_init__(self):
        if self.payload not in PAYLOADS:
            raise ValueError(f"payload must be one of {PAYLOADS}: {self.payload!r}")
        if self.time_col not in TIME_COLUMNS:
            raise ValueError(f"time_col must be one of {TIME_COLUMNS}: {self.time_col!r}")
        if self.payload == "columns" and self.input_format in QUEUE_FORMATS:
            raise ValueError("a queue holds payloads, not columns: set payload")
        for name in ("length", "slide", "burst_length", "burst_slide", "batch_interval", "horizon", "redelivered_within"):
            if getattr(self, name) is not None:
                seconds_in(getattr(self, name))
        if min(self.top_members, self.top_topics, 1 if self.max_alerts is None else self.max_alerts) < 1:
            raise ValueError("top_members, top_topics and max_alerts must be at least 1")
        if self.input_path is None and self.input_format not in QUEUE_FORMATS:
            raise ValueError("input_path may be absent for a queue only")
        if self.run_minutes < 0:
            raise ValueError("run_minutes must not be negative")

    def index(self, name: str) -> str:
        return f"{self.output_path.rstrip('/')}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.checkpoint_path.rstrip('/')}/{name}"

    def trigger(self) -> dict:
        """Trigger arguments: everything there is and then stop, or one batch per interval."""
        if self.available_now:
            return {"availableNow": True}
        return {"processingTime": self.batch_interval}
