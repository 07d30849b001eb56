"""Streaming queries: counts per pane are stored, and windows computed from them.

Each micro-batch stores its own counts per pane and key, then computes the windows that it
touches anew from all stored panes, and stores their results. A window's result is there as soon
as its first row is, and is replaced when more rows come, however late. No watermark is needed,
and no row is dropped. A repeated batch replaces what it had written.

A run that goes on for months needs a ``horizon``: days that lie so far before the latest one are
closed. Their windows are final and brought together, their panes are forgotten, and rows that
come for them later are counted apart. Without a horizon panes stay, merged by age.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from turnout.functions import day_label, normalize, with_ingest_time
from turnout.functions.columns import seconds_in
from turnout.operators import explode_topics, members, top_k, yes_responses
from turnout.plans import alert_payload, rank_members, rank_topics
from turnout.sinks import compact_day, has_files, publish_alerts, read_index, write_daily
from turnout.sinks.folders import is_whole, mark_whole, subfolders
from turnout.sinks.index import INDEX_COLUMNS
from turnout.sources import (
    decode_json,
    decode_payload,
    decoded_rsvps,
    quarantined,
    read_payloads,
    read_rsvps,
)
from turnout.sources.decode import DECODED_SCHEMA
from turnout.streaming.config import JobConfig
from turnout.streaming.panes import pane_counts, pane_seconds, touched_windows
from turnout.streaming.segments import Segments, day_of, label_of, reach
from turnout.streaming.session import adaptive, stream_session

MEMBER_KEYS = "member_id bigint, member_name string"
TOPIC_KEYS = "topic string"


def _start(
    rsvps: DataFrame, on_batch: Callable[[DataFrame, int], None], name: str, outputs: list[str], cfg: JobConfig
) -> StreamingQuery:
    spark = rsvps.sparkSession
    # Batch ids start over with a new checkpoint, and would replace what earlier ones wrote.
    if not has_files(spark, cfg.checkpoint(name)):
        for output in outputs:
            if has_files(spark, cfg.index(output)):
                raise ValueError(f"{cfg.index(output)} holds results of another checkpoint; use a new output_path")

    def adaptively(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch):
            on_batch(batch, batch_id)

    return (
        rsvps.writeStream.queryName(name)
        .option("checkpointLocation", cfg.checkpoint(name))
        .trigger(**cfg.trigger())
        .foreachBatch(adaptively)
        .start()
    )


def start_members(rsvps: DataFrame, cfg: JobConfig) -> StreamingQuery:
    """The most active members of every window, bursting members, and an alert for each burst.

    One scan serves all three: the panes divide the windows of each. They are in ``panes-members``,
    results in ``agg-users``, ``agg-rascals`` and ``alerts``. An alert is sent once for a window
    and member, by the batch in which the count first passes the threshold, with the count then.
    """
    pane = pane_seconds(cfg.length, cfg.slide, cfg.burst_length, cfg.burst_slide)

    def fold(batch: DataFrame, batch_id: int) -> None:
        panes = Segments(batch.sparkSession, cfg.index("panes-members"), MEMBER_KEYS)
        open_from = panes.closed_before(cfg.horizon, batch_id - 1)
        panes.write(pane_counts(batch, panes.names, pane, cfg.time_col), batch_id, open_from)
        counts = touched_windows(panes, batch_id, cfg.length, cfg.slide)
        if counts is not None:
            write_daily(rank_members(counts, cfg.top_members), cfg.index("agg-users"), batch_id)
            _fold_bursts(panes, batch_id, cfg)
        _tidy(panes, ["agg-users", "agg-rascals"], max(cfg.length, cfg.burst_length, key=seconds_in), batch_id, open_from)

    # Projected before the batches are cut, so that the scan reads no more.
    return _start(members(rsvps, cfg.time_col), fold, "members", ["panes-members", "agg-users", "agg-rascals", "alerts"], cfg)


def _fold_bursts(panes: Segments, batch_id: int, cfg: JobConfig) -> None:
    """Bursts of the windows that a batch touches, and alerts for those that are new."""
    spark, path = panes.spark, cfg.index("agg-rascals")
    counts = touched_windows(panes, batch_id, cfg.burst_length, cfg.burst_slide)
    bursts = counts.where(F.col("count") > cfg.burst_threshold)
    bursts = bursts.withColumn("dateForIndex", day_label(F.col("window_end")))
    write_daily(bursts, path, batch_id)
    # The alerts come from what was stored, which is small, not from the panes once more; and what
    # was sent before is looked up on the days that the batch reaches, not in all history.
    days = [label_of(day) for day in reach(panes.days(batch_id), cfg.burst_length)]
    stored = read_index(spark, path, INDEX_COLUMNS["agg-rascals"], days=days)
    own = stored.where(F.col("batch_id") == batch_id)
    known = stored.where(F.col("batch_id") < batch_id).select(
        *[F.col(k).alias(f"known_{k}") for k in ("window_start", *panes.names)]
    ).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"known_{k}")) for k in ("window_start", *panes.names)]
    new = own.join(known, same, "left_anti")
    if cfg.max_alerts:
        new = _within_cap(new, known, cfg.max_alerts)
    publish_alerts(alert_payload(new, cfg.burst_length), cfg.index("alerts"), batch_id, cfg.alert_format, cfg.alert_options)


def _within_cap(new: DataFrame, known: DataFrame, cap: int) -> DataFrame:
    """The new bursts for which a window has alerts left, after those of earlier batches."""
    sent = known.groupBy(F.col("known_window_start").alias("sent_window")).agg(F.count(F.lit(1)).alias("sent"))
    # A window has ``cap`` alerts in all, so no more of its new bursts are needed.
    best = top_k(new, cap, keys=("member_id", "member_name"))
    order = [F.desc("count"), F.col("member_id").asc_nulls_last(), F.col("member_name").asc_nulls_last()]
    placed = best.withColumn("place", F.row_number().over(Window.partitionBy("window_start").orderBy(*order)))
    left = F.lit(cap) - F.coalesce(F.col("sent"), F.lit(0))
    joined = placed.join(sent, placed["window_start"] == sent["sent_window"], "left")
    return joined.where(F.col("place") <= left).select(*new.columns)


def start_topics(rsvps: DataFrame, cfg: JobConfig) -> StreamingQuery:
    """The trending topics of every window: panes in ``panes-topics``, results in ``agg-topics``."""
    pane = pane_seconds(cfg.length, cfg.slide)

    def fold(batch: DataFrame, batch_id: int) -> None:
        panes = Segments(batch.sparkSession, cfg.index("panes-topics"), TOPIC_KEYS)
        open_from = panes.closed_before(cfg.horizon, batch_id - 1)
        panes.write(pane_counts(batch, panes.names, pane, cfg.time_col), batch_id, open_from)
        counts = touched_windows(panes, batch_id, cfg.length, cfg.slide)
        if counts is not None:
            write_daily(rank_topics(counts, cfg.top_topics), cfg.index("agg-topics"), batch_id)
        _tidy(panes, ["agg-topics"], cfg.length, batch_id, open_from)

    topics = explode_topics(yes_responses(rsvps), cfg.time_col)
    return _start(topics, fold, "topics", ["panes-topics", "agg-topics"], cfg)


def _tidy(panes: Segments, indexes: list[str], longest: str, batch_id: int, open_from: date | None) -> None:
    """Merge old segments, and close the days before ``open_from``. May be repeated at any point."""
    panes.merge(batch_id - 1)
    if open_from is None:
        return
    # A window that is open may reach back into closed days.
    back = -(-seconds_in(longest) // 86400)
    if open_from.toordinal() > back + 1:
        panes.forget(date.fromordinal(open_from.toordinal() - back))
    root = panes.path.rsplit("/", 1)[0]
    for index in indexes:
        close_days(panes.spark, root, index, open_from, batch_id)


CLOSED_COLUMNS = "window_start timestamp, window_end timestamp, versions bigint"


def close_days(spark: SparkSession, root: str, index: str, before: date, batch_id: int) -> None:
    """Bring the windows of an index that ended on days before ``before`` into their final form.

    ``closed-<index>`` gets a row for each window with the number of batches that wrote it, and the
    day's folders become one, under ``batch_id``. Days that are done are marked and passed over.
    """
    path, done = f"{root}/{index}", f"{root}/closed-{index}"
    closed = {name for name in subfolders(spark, done) if is_whole(spark, f"{done}/{name}")}
    for name in subfolders(spark, path):
        label = name.removeprefix("dateForIndex=")
        if name in closed or not name.startswith("dateForIndex=") or (day_of(label) or before) >= before:
            continue
        if not is_whole(spark, f"{done}/{name}", "_counted"):
            stored = read_index(spark, path, INDEX_COLUMNS[index], day=label)
            versions = stored.groupBy("window_start", "window_end").agg(F.count_distinct("batch_id").alias("versions"))
            versions.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{done}/{name}")
            mark_whole(spark, f"{done}/{name}", "_counted")
        compact_day(spark, path, INDEX_COLUMNS[index], label, batch_id=batch_id)
        mark_whole(spark, f"{done}/{name}")


def closed_windows(spark: SparkSession, cfg: JobConfig, index: str) -> DataFrame:
    """``window_start, window_end, versions`` of every final window of an index."""
    done = cfg.index(f"closed-{index}")
    paths = [f"{done}/{name}" for name in subfolders(spark, done) if is_whole(spark, f"{done}/{name}")]
    return spark.read.schema(CLOSED_COLUMNS).parquet(*paths) if paths else spark.createDataFrame([], CLOSED_COLUMNS)


def _decode(payloads: DataFrame, cfg: JobConfig) -> DataFrame:
    if cfg.payload == "json":
        return decode_json(payloads, mode=cfg.decode_mode)
    return decode_payload(payloads, mode=cfg.decode_mode, use_jar=cfg.decode_with_jar)


def start_ingest(session: SparkSession, cfg: JobConfig) -> StreamingQuery:
    """Decode payloads once into the ``decoded`` table, which the three analyses then stream.

    The file sink commits each batch exactly once. Undecodable messages stay in the same table,
    in the column ``corrupt``; see ``read_quarantine``.
    """
    payloads = read_payloads(
        session, cfg.input_path, cfg.input_format, streaming=True, options=cfg.input_options
    )
    return (
        _decode(payloads, cfg)
        .writeStream.queryName("decoded")
        .format("parquet")
        .option("path", cfg.index("decoded"))
        .option("checkpointLocation", cfg.checkpoint("decoded"))
        .trigger(**cfg.trigger())
        .start()
    )


def read_quarantine(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """The messages that ``start_ingest`` could not decode."""
    return quarantined(spark.read.schema(DECODED_SCHEMA).parquet(cfg.index("decoded")))


def rsvp_stream(session: SparkSession, cfg: JobConfig) -> DataFrame:
    """The stream of normalized RSVPs that the analyses read."""
    if cfg.payload == "columns":
        wire = read_rsvps(
            session, cfg.input_path, cfg.input_format, streaming=True, options=cfg.input_options
        )
    else:
        staged = session.readStream.schema(DECODED_SCHEMA).parquet(cfg.index("decoded"))
        wire = decoded_rsvps(staged)
    rsvps = normalize(wire)
    if cfg.redelivered_within:
        rsvps = once(rsvps, cfg.redelivered_within)
    elif cfg.time_col == "ingest_time":
        rsvps = with_ingest_time(rsvps)
    return rsvps


def once(rsvps: DataFrame, within: str) -> DataFrame:
    """Each message once, of those that arrive again ``within`` a time; adds ``ingest_time``.

    A message is an RSVP's id and ``event_time``, so a member who answers anew is counted anew. What
    was seen is kept in the state store by arrival, which never goes back: no row is late, whatever
    its event time, and the state holds what arrived within that time. Messages without an id or a
    time cannot be told apart, and all of them stay.
    """
    arrived = with_ingest_time(rsvps).withWatermark("ingest_time", within)
    # Rows that cannot be told apart get a key of their own.
    own = F.when(F.col("rsvp_id").isNull() | F.col("event_time").isNull(), F.uuid())
    keyed = arrived.withColumn("_own", own)
    return keyed.dropDuplicatesWithinWatermark(["rsvp_id", "event_time", "_own"]).drop("_own")


def run_jobs(spark: SparkSession, cfg: JobConfig) -> list[StreamingQuery]:
    """Start everything: ingest if payloads need decoding, then the analyses.

    Members with bursts and topics are separate queries with separate checkpoints, so each restarts
    on its own, and each reads only the columns it needs. A run on an existing checkpoint resumes it.
    """
    session = stream_session(spark)
    queries = []
    if cfg.payload != "columns":
        ingest = start_ingest(session, cfg)
        queries.append(ingest)
        if cfg.available_now:
            ingest.awaitTermination()
    rsvps = rsvp_stream(session, cfg)
    return queries + [start(rsvps, cfg) for start in (start_members, start_topics)]


def await_jobs(queries: list[StreamingQuery], run_minutes: float = 0) -> None:
    """Wait for the queries to end, at most ``run_minutes`` if that is not 0, then stop them.

    A failed query raises here and stops the others; a supervisor can then restart the
    application, which resumes from the checkpoints.
    """
    deadline = time.monotonic() + run_minutes * 60 if run_minutes else float("inf")
    try:
        while (active := [query for query in queries if query.isActive]) and (
            left := deadline - time.monotonic()
        ) > 0:
            _raise_failures(queries)
            active[0].awaitTermination(max(0.1, min(1.0, left)))
        _raise_failures(queries)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def _raise_failures(queries: list[StreamingQuery]) -> None:
    for query in queries:
        if query.exception() is not None:
            raise query.exception()
