"""Command line of the streaming application, for ``spark-submit``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from turnout.sources.decode import MODES
from turnout.streaming import JobConfig, await_jobs, run_jobs
from turnout.streaming.config import PAYLOADS, TIME_COLUMNS


def _pairs(entries: Sequence[str]) -> dict[str, str]:
    return dict(entry.split("=", 1) for entry in entries)


def parse(args: Sequence[str] | None = None) -> JobConfig:
    parser = argparse.ArgumentParser(description="Windowed analytics over a stream of RSVPs.")
    parser.add_argument("--input", help="folder of RSVP files; not for a queue")
    parser.add_argument("--input-format", default="parquet")
    parser.add_argument("--input-option", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--payload", choices=PAYLOADS, default="columns")
    parser.add_argument("--decode-mode", choices=MODES, default="PERMISSIVE")
    parser.add_argument("--decode-with-jar", action="store_true", help="decode protobuf in the JVM")
    parser.add_argument("--output", required=True, help="folder for the indexes and alerts")
    parser.add_argument("--checkpoint", required=True, help="folder for offsets and state")
    parser.add_argument("--window", type=int, default=60, help="ranking window, in seconds")
    parser.add_argument("--slide", type=int, default=20, help="ranking slide, in seconds")
    parser.add_argument("--burst-window", type=int, default=20, help="burst window, in seconds")
    parser.add_argument("--burst-slide", type=int, help="burst slide, in seconds; tumbling if absent")
    parser.add_argument("--threshold", type=int, default=6, help="RSVPs above which a member bursts")
    parser.add_argument("--max-alerts", type=int, help="most alerts per window; all if absent")
    parser.add_argument("--horizon-days", type=int, help="days before the latest one that stay open; all if absent")
    parser.add_argument("--redelivered-within", type=int, help="seconds within which a repeated message counts once")
    parser.add_argument("--top-members", type=int, default=5)
    parser.add_argument("--top-topics", type=int, default=10)
    parser.add_argument("--batch", type=int, default=20, help="batch interval, in seconds")
    parser.add_argument("--time-column", choices=TIME_COLUMNS, default="event_time")
    parser.add_argument("--alert-format", default="text")
    parser.add_argument("--alert-option", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--minutes", type=float, default=0, help="running time; 0 runs on")
    parser.add_argument("--available-now", action="store_true", help="process what is there, then end")
    given = parser.parse_args(args)
    return JobConfig(
        input_path=given.input,
        input_format=given.input_format,
        input_options=_pairs(given.input_option),
        payload=given.payload,
        decode_mode=given.decode_mode,
        decode_with_jar=given.decode_with_jar,
        output_path=given.output,
        checkpoint_path=given.checkpoint,
        length=f"{given.window} seconds",
        slide=f"{given.slide} seconds",
        burst_length=f"{given.burst_window} seconds",
        burst_slide=f"{given.burst_slide} seconds" if given.burst_slide else None,
        burst_threshold=given.threshold,
        max_alerts=given.max_alerts,
        horizon=f"{given.horizon_days} days" if given.horizon_days is not None else None,
        redelivered_within=f"{given.redelivered_within} seconds" if given.redelivered_within else None,
        top_members=given.top_members,
        top_topics=given.top_topics,
        batch_interval=f"{given.batch} seconds",
        time_col=given.time_column,
        alert_format=given.alert_format,
        alert_options=_pairs(given.alert_option),
        run_minutes=given.minutes,
        available_now=given.available_now,
    )


def main(args: Sequence[str] | None = None) -> None:
    cfg = parse(args)
    spark = SparkSession.builder.appName("turnout").getOrCreate()
    await_jobs(run_jobs(spark, cfg), cfg.run_minutes)


if __name__ == "__main__":
    main()
