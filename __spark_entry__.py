"""

Every query runs a library function over the whole ``events`` table, read as RSVPs (see
``turnout.sources.tables``). The test tables are sparse, about one event in four minutes at
sf0.01, so most queries use 6 h windows every 2 h, and 1 day windows for bursts; the ``minute``
queries run the library's own 60 s / 20 s defaults.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from importlib.util import find_spec
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout import plans
from turnout.functions import normalize, set_aside, usable, window_text, with_write_timestamp
from turnout.operators import (
    covered_counts,
    crowded_moments,
    explode_topics,
    flatten,
    frequent_top_k,
    members,
    pane_levels,
    sliding_counts,
    topic_arrays,
    with_position,
    yes_responses,
)
from turnout.sinks import (
    latest_windows,
    publish_alerts,
    publish_once,
    read_alerts,
    read_index,
    read_published,
    shared_dir,
    write_daily,
    write_static,
)
from turnout.sinks.index import INDEX_COLUMNS
from turnout.sources import (
    decode_json,
    decode_payload,
    decoded_rsvps,
    encode_payload,
    in_range,
    read_table,
    rsvps_from_events,
)
from turnout.streaming import (
    JobConfig,
    await_jobs,
    read_panes,
    rsvp_stream,
    run_jobs,
    start_members,
    start_topics,
    stream_session,
    window_totals,
)
from turnout.streaming.jobs import MEMBER_KEYS, closed_windows

llm = None
# The package of training-data operators may be left out; if it is there, it must import.
if find_spec("turnout.llm") and find_spec("turnout.llm.queries"):
    from turnout.llm import queries as llm

LENGTH, SLIDE, BURST, BURST_SLIDE = "6 hours", "2 hours", "1 day", "6 hours"
DAY = (datetime(2024, 1, 10), datetime(2024, 1, 11))
MEMBER_NAMES = ["member_id", "member_name"]
CAP_THRESHOLD, CAP = 2, 10
CROWD, CROWD_LENGTH = 2, "12 hours"
HORIZON_DAYS, PART_DAYS, LATE_OF = 3, 10, 40
DECODE_PARTITIONS = 16


# --- inputs ---------------------------------------------------------------------------------


def _wire(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    return rsvps_from_events(read_table(spark, sf_dir, "events", streaming))


def _rsvps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(_wire(spark, sf_dir))


def _shown(df: DataFrame) -> DataFrame:
    """Window bounds as text, which compares the same in every engine."""
    bounds = {
        name: window_text(F.col(name)) for name in ("window_start", "window_end") if name in df.columns
    }
    return df.withColumns(bounds)


def _instant_shown(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", window_text(F.col("event_time"), millis=True))


# --- projections and filters ----------------------------------------------------------------


def rsvp_flatten(spark, sf_dir):
    return _instant_shown(flatten(_rsvps(spark, sf_dir)))


def q_topic_arrays(spark, sf_dir):
    topics = topic_arrays(_rsvps(spark, sf_dir))
    return _instant_shown(topics).select("event_time", F.array_join("topic_name", "|").alias("topics"))


def yes_rsvps(spark, sf_dir):
    yes = yes_responses(_rsvps(spark, sf_dir))
    return _instant_shown(yes.select("rsvp_id", "event_time", "response"))


def topic_explode(spark, sf_dir):
    return _instant_shown(explode_topics(_rsvps(spark, sf_dir)))


def day_range(spark, sf_dir):
    """One day's records, cut out at the scan."""
    return _instant_shown(flatten(normalize(in_range(_wire(spark, sf_dir), *DAY))))


def usable_counts(spark, sf_dir):
    """How many records windows count and how many are set aside; some times are made unusable."""
    which = F.col("rsvp_id") % 50
    broken = F.when(which == 7, F.lit(1e18)).when(which == 8, F.lit(float("nan"))).when(which != 9, F.col("mtime"))
    rsvps = normalize(_wire(spark, sf_dir).withColumn("mtime", broken))
    parts = usable(rsvps).select(F.lit("usable").alias("part")).unionByName(set_aside(rsvps).select(F.lit("set aside").alias("part")))
    return parts.groupBy("part").count()


# --- windowed counts and rankings -----------------------------------------------------------


def topic_counts(spark, sf_dir):
    return _shown(plans.topic_counts(_rsvps(spark, sf_dir), LENGTH, SLIDE))


def member_counts(spark, sf_dir):
    return _shown(plans.member_counts(_rsvps(spark, sf_dir), LENGTH, SLIDE))


def top_members(spark, sf_dir):
    return _shown(plans.most_active_members(_rsvps(spark, sf_dir), LENGTH, SLIDE))


def top_topics(spark, sf_dir):
    return _shown(plans.trending_topics(_rsvps(spark, sf_dir), LENGTH, SLIDE))


def top_members_minute(spark, sf_dir):
    return _shown(plans.most_active_members(_rsvps(spark, sf_dir)))


def top_topics_minute(spark, sf_dir):
    return _shown(plans.trending_topics(_rsvps(spark, sf_dir)))


def top_members_global(spark, sf_dir):
    return plans.most_active_overall(_rsvps(spark, sf_dir))


def top_topics_global(spark, sf_dir):
    return plans.trending_overall(_rsvps(spark, sf_dir))


def member_counts_by_differences(spark, sf_dir):
    """Windows of a day that slide by the hour: each row is moved twice, not 24 times."""
    return _shown(sliding_counts(members(_rsvps(spark, sf_dir)), MEMBER_NAMES, BURST, "1 hour"))


def member_counts_by_levels(spark, sf_dir):
    """Windows of a day every 6 hours, each from the fewest panes of an hour, 6 hours and a day."""
    levels = pane_levels(members(_rsvps(spark, sf_dir)), MEMBER_NAMES, ["1 hour", "6 hours", "1 day"])
    return _shown(covered_counts(levels, MEMBER_NAMES, BURST, BURST_SLIDE))


def top_topics_by_summaries(spark, sf_dir):
    """The best topics of every window, from bounded summaries of stored panes."""
    topics = explode_topics(yes_responses(_rsvps(spark, sf_dir)))
    pane = F.window("event_time", SLIDE)["start"].alias("pane_start")
    at = shared_dir(spark, "topic-panes")
    topics.groupBy(pane, "topic").count().write.parquet(at)
    return _shown(frequent_top_k(spark.read.parquet(at), ["topic"], 10, LENGTH, SLIDE, size=16))


def member_positions(spark, sf_dir):
    """Every member's position over the whole table, ranked by many tasks."""
    counts = members(_rsvps(spark, sf_dir)).groupBy(*MEMBER_NAMES).count()
    return with_position(counts, within=())


# --- bursts and alerts ----------------------------------------------------------------------


def burst_members(spark, sf_dir):
    return _shown(plans.burst_members(_rsvps(spark, sf_dir), BURST))


def burst_members_sliding(spark, sf_dir):
    return _shown(plans.burst_members(_rsvps(spark, sf_dir), BURST, BURST_SLIDE))


def crowded_members(spark, sf_dir):
    """Bursts within any stretch of time, not only within windows of the clock."""
    moments = crowded_moments(members(_rsvps(spark, sf_dir)), MEMBER_NAMES, CROWD_LENGTH, CROWD)
    return moments.withColumns({name: window_text(F.col(name), millis=True) for name in ("since", "until")})


def alert_payloads(spark, sf_dir):
    bursts = plans.burst_members(_rsvps(spark, sf_dir), BURST)
    return _shown(plans.alert_payload(bursts, BURST))


def alert_payloads_slim(spark, sf_dir):
    bursts = plans.burst_members(_rsvps(spark, sf_dir), BURST)
    return _shown(plans.alert_payload(bursts, BURST, columns=plans.SLIM_ALERT_FIELDS))


def alert_cap(spark, sf_dir):
    """The cap per window, set so low that it takes effect on the test tables."""
    bursts = plans.burst_members(_rsvps(spark, sf_dir), BURST, threshold=CAP_THRESHOLD)
    return _shown(plans.alert_payload(bursts, BURST, max_alerts=CAP))


# --- sinks, read back -----------------------------------------------------------------------


def write_timestamp(spark, sf_dir):
    best = plans.most_active_members(_rsvps(spark, sf_dir), LENGTH, SLIDE)
    return _shown(with_write_timestamp(best).select("window_end", "member_id", "timestamp"))


def daily_partition_counts(spark, sf_dir):
    path = shared_dir(spark, "agg-users")
    best = plans.most_active_members(_rsvps(spark, sf_dir), LENGTH, SLIDE)
    write_daily(best, path, batch_id=0)
    stored = read_index(spark, path, INDEX_COLUMNS["agg-users"])
    return stored.groupBy("dateForIndex").agg(
        F.count("*").alias("count"), F.sum("timestamp").alias("timestamps")
    )


def static_sink_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "static-topics")
    best = plans.trending_topics(_rsvps(spark, sf_dir), LENGTH, SLIDE)
    write_static(best, path, batch_id=0)
    columns = INDEX_COLUMNS["agg-topics"] + ", dateForIndex string"
    return _shown(read_index(spark, path, columns, day_col=None))


def alert_publish_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "alerts")
    alerts = plans.alert_payload(plans.burst_members(_rsvps(spark, sf_dir), BURST), BURST)
    publish_alerts(alerts, path)
    return read_alerts(spark, path)


def alerts_published_once(spark, sf_dir):
    """A batch published in two phases, and a second run of it that changes nothing."""
    path = shared_dir(spark, "alerts-once")
    alerts = plans.alert_payload(plans.burst_members(_rsvps(spark, sf_dir), BURST), BURST)
    for _ in range(2):
        publish_once(alerts, path, batch_id=0)
    return read_published(spark, path)


def optional_fields(spark, sf_dir):
    """Venues that are there or not, and topic lists that are null, empty or repeat a topic."""
    which, topics = F.col("rsvp_id") % 7, F.col("group.group_topics")
    odd = F.when(which == 0, None).when(which == 1, F.slice(topics, 1, 0)).when(which == 2, F.concat(topics, topics)).otherwise(topics)
    venue = F.struct(
        F.concat(F.lit("Venue "), (F.col("rsvp_id") % 11).cast("int")).alias("venue_name"), F.lit(0.0).alias("lon"),
        F.lit(0.0).alias("lat"), (F.col("rsvp_id") % 11).alias("venue_id"),
    )
    wire = _wire(spark, sf_dir).withColumns({
        "group": F.col("group").withField("group_topics", odd), "venue": F.when(F.col("rsvp_id") % 3 == 0, venue),
    })
    rsvps = normalize(wire)
    venues = flatten(rsvps).groupBy(F.lit("venue").alias("field"), F.col("venue_name").alias("value")).count()
    counted = explode_topics(rsvps).groupBy(F.lit("topic").alias("field"), F.col("topic").alias("value")).count()
    return venues.unionByName(counted)


# --- streams: replayed to the end, results read back ----------------------------------------


def _stream(spark: SparkSession, sf_dir: str, purpose: str) -> tuple[DataFrame, JobConfig]:
    """The table's records as files, and the stream of them that the application reads."""
    session = stream_session(spark, spark.sparkContext.defaultParallelism)
    root = shared_dir(spark, purpose)
    _wire(spark, sf_dir).write.parquet(f"{root}/in")
    cfg = _config(root)
    return rsvp_stream(session, cfg), cfg


def _config(root: str, **settings) -> JobConfig:
    return replace(JobConfig(
        input_path=f"{root}/in",
        output_path=f"{root}/out",
        checkpoint_path=f"{root}/checkpoints",
        length=LENGTH,
        slide=SLIDE,
        burst_length=BURST,
        available_now=True,
    ), **settings)


def _stored(spark, cfg, index) -> DataFrame:
    return latest_windows(read_index(spark, cfg.index(index), INDEX_COLUMNS[index])).drop("batch_id")


def stream_scan_count(spark, sf_dir):
    rsvps, cfg = _stream(spark, sf_dir, "scan")
    path = cfg.index("responses")
    (
        rsvps.groupBy("response").count()
        .writeStream.outputMode("complete")
        .option("checkpointLocation", cfg.checkpoint("responses"))
        .trigger(**cfg.trigger())
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path))
        .start()
        .awaitTermination()
    )
    return spark.read.schema("response string, count bigint").parquet(path)


def stream_member_counts(spark, sf_dir):
    """Counts of every window, from the panes that the stream has stored."""
    rsvps, cfg = _stream(spark, sf_dir, "member-counts")
    start_members(rsvps, cfg).awaitTermination()
    panes = read_panes(spark, cfg.index("panes-members"), MEMBER_KEYS)
    return _shown(window_totals(panes, ["member_id", "member_name"], cfg.length, cfg.slide))


def stream_redelivered(spark, sf_dir):
    """Every third message sent twice, counted once: the counts are those of the plain table."""
    session = stream_session(spark, spark.sparkContext.defaultParallelism)
    root, wire = shared_dir(spark, "redelivered"), _wire(spark, sf_dir)
    wire.unionByName(wire.where(F.col("rsvp_id") % 3 == 0)).write.parquet(f"{root}/in")
    cfg = _config(root, redelivered_within="1 day")
    start_members(rsvp_stream(session, cfg), cfg).awaitTermination()
    panes = read_panes(spark, cfg.index("panes-members"), MEMBER_KEYS)
    return _shown(window_totals(panes, ["member_id", "member_name"], cfg.length, cfg.slide))


def stream_arrival_windows(spark, sf_dir):
    """Windows by arrival, which is when the query runs: what each member has over all of them."""
    session = stream_session(spark, spark.sparkContext.defaultParallelism)
    root = shared_dir(spark, "arrival")
    _wire(spark, sf_dir).write.parquet(f"{root}/in")
    cfg = _config(root, time_col="ingest_time", slide=LENGTH)
    start_members(rsvp_stream(session, cfg), cfg).awaitTermination()
    panes = read_panes(spark, cfg.index("panes-members"), MEMBER_KEYS)
    totals = window_totals(panes, ["member_id", "member_name"], cfg.length, None)
    return totals.groupBy("member_id", "member_name").agg(F.sum("count").alias("count"))


def stream_horizon(spark, sf_dir):
    """Three parts of the month, one after the other, some rows a part late; days close behind.

    Final windows with the number of batches that wrote them, the best members of all windows, and
    the rows that came too late.
    """
    session = stream_session(spark, spark.sparkContext.defaultParallelism)
    root, wire = shared_dir(spark, "horizon"), _wire(spark, sf_dir)
    part = F.least(F.floor((F.dayofmonth(F.timestamp_millis(F.col("mtime").cast("bigint"))) - 1) / PART_DAYS), F.lit(2))
    part = F.least(part + F.when(F.col("rsvp_id") % LATE_OF == 3, 1).otherwise(0), F.lit(2))
    cfg = _config(root, horizon=f"{HORIZON_DAYS} days")
    for number in range(3):
        wire.where(part == number).write.mode("append").parquet(f"{root}/in")
        start_members(rsvp_stream(session, cfg), cfg).awaitTermination()
    final = closed_windows(spark, cfg, "agg-users").select(
        F.lit("final").alias("kind"), "window_start", F.lit(None).cast("bigint").alias("member_id"), F.col("versions").alias("n")
    )
    best = _stored(spark, cfg, "agg-users").select(F.lit("best").alias("kind"), "window_start", "member_id", F.col("count").alias("n"))
    late = read_panes(spark, cfg.index("panes-members"), MEMBER_KEYS, late=True)
    late = late.groupBy(F.lit("late").alias("kind"), F.col("pane_start").alias("window_start"), "member_id").agg(F.sum("count").alias("n"))
    return final.unionByName(best).unionByName(late).withColumn("window_start", window_text(F.col("window_start")))


def stream_payload_jobs(spark, sf_dir):
    """The whole application on raw messages: decode once, then every index and the alerts."""
    root = shared_dir(spark, "messages")
    encode_payload(_messages(spark, sf_dir)).write.parquet(f"{root}/in")
    cfg = JobConfig(
        input_path=f"{root}/in", output_path=f"{root}/out", checkpoint_path=f"{root}/checkpoints",
        length=LENGTH, slide=SLIDE, burst_length=BURST, available_now=True, payload="protobuf",
    )
    await_jobs(run_jobs(spark, cfg))
    rows = None
    for index, key in (("agg-users", "member_name"), ("agg-topics", "topic"), ("agg-rascals", "member_name")):
        stored = _shown(_stored(spark, cfg, index)).select(
            F.lit(index).alias("output"), "window_start", F.col(key).alias("key"), "count", "dateForIndex"
        )
        rows = stored if rows is None else rows.unionByName(stored)
    alerts = read_alerts(spark, cfg.index("alerts")).select(F.lit("alerts").alias("output"), F.col("value").alias("key"))
    return rows.unionByName(alerts, allowMissingColumns=True)


def _replayed(spark, sf_dir, start, index) -> DataFrame:
    rsvps, cfg = _stream(spark, sf_dir, index)
    start(rsvps, cfg).awaitTermination()
    return _shown(_stored(spark, cfg, index))


def stream_top_members(spark, sf_dir):
    return _replayed(spark, sf_dir, start_members, "agg-users")


def stream_top_topics(spark, sf_dir):
    return _replayed(spark, sf_dir, start_topics, "agg-topics")


def stream_burst_members(spark, sf_dir):
    return _replayed(spark, sf_dir, start_members, "agg-rascals")


def stream_alerts(spark, sf_dir):
    rsvps, cfg = _stream(spark, sf_dir, "alerts")
    start_members(rsvps, cfg).awaitTermination()
    return read_alerts(spark, cfg.index("alerts")).select("value")


# --- decoding -------------------------------------------------------------------------------


def _messages(spark, sf_dir) -> DataFrame:
    # Decoding costs far more per row than the shuffle that spreads a small table's rows.
    return rsvps_from_events(read_table(spark, sf_dir, "events").repartition(DECODE_PARTITIONS))


def _incomplete(spark, sf_dir) -> DataFrame:
    """RSVPs of which those answering "no" lack a required field."""
    visibility = F.when(F.col("response") == "yes", F.col("visibility"))
    return _messages(spark, sf_dir).withColumn("visibility", visibility)


def decode_roundtrip(spark, sf_dir):
    decoded = decode_payload(encode_payload(_messages(spark, sf_dir)))
    return _instant_shown(flatten(normalize(decoded_rsvps(decoded))))


def decode_quarantine(spark, sf_dir):
    decoded = decode_payload(encode_payload(_incomplete(spark, sf_dir)))
    outcome = F.when(F.col("corrupt").isNull(), "decoded").otherwise("quarantined")
    return decoded.groupBy(outcome.alias("outcome")).count()


def json_roundtrip(spark, sf_dir):
    texts = _incomplete(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    return _instant_shown(flatten(normalize(decoded_rsvps(decode_json(texts)))))


# --- driver functions -----------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the most active members of every window."""
    return top_members(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator or job; each takes (spark, sf_dir) and returns a frame."""
    registered = {
        "rsvp_flatten": rsvp_flatten,
        "topic_arrays": q_topic_arrays,
        "yes_rsvps": yes_rsvps,
        "topic_explode": topic_explode,
        "day_range": day_range,
        "usable_counts": usable_counts,
        "topic_counts": topic_counts,
        "member_counts": member_counts,
        "top_members": top_members,
        "top_topics": top_topics,
        "top_members_minute": top_members_minute,
        "top_topics_minute": top_topics_minute,
        "top_members_global": top_members_global,
        "top_topics_global": top_topics_global,
        "member_counts_by_differences": member_counts_by_differences,
        "member_counts_by_levels": member_counts_by_levels,
        "top_topics_by_summaries": top_topics_by_summaries,
        "member_positions": member_positions,
        "burst_members": burst_members,
        "burst_members_sliding": burst_members_sliding,
        "crowded_members": crowded_members,
        "alerts_published_once": alerts_published_once,
        "optional_fields": optional_fields,
        "alert_payloads": alert_payloads,
        "alert_payloads_slim": alert_payloads_slim,
        "alert_cap": alert_cap,
        "write_timestamp": write_timestamp,
        "daily_partition_counts": daily_partition_counts,
        "static_sink_roundtrip": static_sink_roundtrip,
        "alert_publish_roundtrip": alert_publish_roundtrip,
        "stream_scan_count": stream_scan_count,
        "stream_member_counts": stream_member_counts,
        "stream_top_members": stream_top_members,
        "stream_top_topics": stream_top_topics,
        "stream_burst_members": stream_burst_members,
        "stream_alerts": stream_alerts,
        "stream_redelivered": stream_redelivered,
        "stream_arrival_windows": stream_arrival_windows,
        "stream_horizon": stream_horizon,
        "json_roundtrip": json_roundtrip,
        "decode_roundtrip": decode_roundtrip,
        "decode_quarantine": decode_quarantine,
        "stream_payload_jobs": stream_payload_jobs,
    }
    return registered | (llm.queries() if llm else {})


# --- the same results in SQL ----------------------------------------------------------------

_BASE = """
base AS (
  SELECT event_id, user_id, event_type,
         date_trunc('milliseconds', ts) AS event_time,
         CASE WHEN event_type = 'error' THEN 'no' ELSE 'yes' END AS response,
         'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS member_name,
         regexp_extract(props, '"k":\\s*(\\d+)', 1) AS interest
  FROM events
),
rsvp AS (
  SELECT *, [event_type, 'interest ' || interest,
             'series ' || CAST(TRY_CAST(interest AS INTEGER) // 10 AS VARCHAR)] AS topics
  FROM base
)"""

_FLAT = """
SELECT event_id AS rsvp_id, strftime(event_time, '%Y-%m-%d %H:%M:%S.%g') AS event_time,
       response, 'public' AS visibility, CAST(0 AS BIGINT) AS guests,
       user_id AS member_id, member_name,
       CAST(event_id AS VARCHAR) AS event_id, event_type AS event_name,
       '/events/' || event_id AS event_url,
       user_id % 97 AS group_id, 'Group ' || (user_id % 97) AS group_name,
       'Springfield' AS group_city, 'us' AS group_country,
       CAST(NULL AS VARCHAR) AS group_state,
       CAST(NULL AS BIGINT) AS venue_id, CAST(NULL AS VARCHAR) AS venue_name
FROM rsvp"""

_TIME = "strftime(event_time, '%Y-%m-%d %H:%M:%S.%g')"
_BOUNDS = """strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end"""
_DAY = "strftime(window_end, '%Y.%m.%d')"
_MENTIONS = "mention AS (SELECT event_time, unnest(topics) AS topic FROM rsvp WHERE response = 'yes')"
_MEMBER = "user_id AS member_id, member_name"


def _windowed(source: str, keys: str, unit: str, slide: int, length: int) -> str:
    """CTE ``finished``: rows per window and key."""
    names = ", ".join(key.split(" AS ")[-1] for key in keys.split(", "))
    return f"""
placed AS (
  SELECT {keys}, time_bucket(INTERVAL {slide} {unit}, event_time, TIMESTAMP '1970-01-01')
                 - i * INTERVAL {slide} {unit} AS window_start
  FROM {source}, unnest(generate_series(0, {length // slide - 1})) AS s(i)
  WHERE event_time IS NOT NULL
),
finished AS (
  SELECT window_start, window_start + INTERVAL {length} {unit} AS window_end, {names}, count(*) AS count
  FROM placed GROUP BY ALL
)"""


def _ranked(keys: str, k: int) -> str:
    """CTE ``ranked``: the k best of each window with dense positions."""
    return f"""
cut AS (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY count DESC, {keys}) AS rn FROM finished
),
ranked AS (
  SELECT * EXCLUDE (rn), CAST(dense_rank() OVER (
    PARTITION BY window_start ORDER BY count DESC) AS INTEGER) AS position
  FROM cut WHERE rn <= {k}
)"""


def _alerts(threshold: int, cap: int = 1 << 62) -> str:
    """CTE ``alert``: bursts, as many as the cap allows, with title, text and the JSON of all six fields."""
    # The title and the parts of the message.
    return f"""
burst AS (SELECT *, {_DAY} AS day FROM finished WHERE count > {threshold}),
chosen AS (
  SELECT *, row_number() OVER (
    PARTITION BY window_start ORDER BY count DESC, member_id, member_name) AS rn FROM burst
),
alert AS (
  SELECT *, 'User in frenzy detected!' AS title,
         'User > ' || member_id || ' (' || member_name || ') < sent > ' || count
         || ' < rsvps in 86400 seconds ! This is shady - please verify !' AS message
  FROM chosen WHERE rn <= {cap}
),
payload AS (
  SELECT *, '{{"member_name":"' || member_name || '","member_id":' || member_id
            || ',"dateForIndex":"' || day || '","count":' || count
            || ',"title":"' || title || '","message":"' || message || '"}}' AS value
  FROM alert
)"""


def _application_sql() -> str:
    """All indexes and the alerts as rows of one table."""
    shown = f"strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start"
    columns = f"count, {_DAY} AS \"dateForIndex\""

    def part(output: str, ctes: list[str], key: str, table: str, where: str = "") -> str:
        return f"(WITH {','.join([_BASE, *ctes])} SELECT '{output}' AS output, {shown}, {key} AS key, {columns} FROM {table}{where})"

    days = _windowed("rsvp", _MEMBER, "DAY", 1, 1)
    members = [_windowed("rsvp", _MEMBER, "HOUR", 2, 6), _ranked("member_id, member_name", 5)]
    topics = [_MENTIONS, _windowed("mention", "topic", "HOUR", 2, 6), _ranked("topic", 10)]
    alerts = (
        f"(WITH {','.join([_BASE, days, _alerts(6)])} SELECT 'alerts' AS output, CAST(NULL AS VARCHAR) AS window_start,"
        " value AS key, CAST(NULL AS BIGINT) AS count, CAST(NULL AS VARCHAR) AS \"dateForIndex\" FROM payload)"
    )
    return " UNION ALL ".join([
        part("agg-users", members, "member_name", "ranked"),
        part("agg-topics", topics, "topic", "ranked"),
        part("agg-rascals", [days], "member_name", "finished", " WHERE count > 6"),
        alerts,
    ])


def _horizon_sql() -> str:
    """Parts and the days that were closed when each came; then windows of the rows on time."""
    return f"""
dealt AS (
  SELECT *, event_time::DATE AS day,
         least(least((dayofmonth(event_time) - 1) // {PART_DAYS}, 2)
               + CASE WHEN event_id % {LATE_OF} = 3 THEN 1 ELSE 0 END, 2) AS part FROM rsvp
),
parts AS (SELECT part, max(day) AS latest FROM dealt GROUP BY part),
opened AS (
  SELECT p.part, (SELECT max(latest) FROM parts b WHERE b.part < p.part) - {HORIZON_DAYS} AS open_from FROM parts p
),
placed AS (
  SELECT d.*, coalesce(day < open_from, false) AS late,
         time_bucket(INTERVAL 2 HOUR, event_time, TIMESTAMP '1970-01-01') AS pane FROM dealt d JOIN opened USING (part)
),
windowed AS (
  SELECT *, pane - i * INTERVAL 2 HOUR AS window_start FROM placed, unnest([0, 1, 2]) AS s(i) WHERE NOT late
),
finished AS (SELECT window_start, user_id AS member_id, member_name, count(*) AS count FROM windowed GROUP BY ALL),
{_ranked("member_id, member_name", 5)},
versions AS (
  SELECT window_start, count(DISTINCT part) AS versions FROM windowed GROUP BY window_start
  HAVING (window_start + INTERVAL 6 HOUR)::DATE < (SELECT max(open_from) FROM opened)
),
told AS (
  SELECT 'final' AS kind, window_start, CAST(NULL AS BIGINT) AS member_id, versions AS n FROM versions
  UNION ALL SELECT 'best', window_start, member_id, count FROM ranked
  UNION ALL SELECT 'late', pane, user_id, count(*) FROM placed WHERE late GROUP BY ALL
)"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query, over the same tables."""
    members = _windowed("rsvp", _MEMBER, "HOUR", 2, 6)
    topics = f"{_MENTIONS},{_windowed('mention', 'topic', 'HOUR', 2, 6)}"
    members_minute = _windowed("rsvp", _MEMBER, "SECOND", 20, 60)
    topics_minute = f"{_MENTIONS},{_windowed('mention', 'topic', 'SECOND', 20, 60)}"
    days = _windowed("rsvp", _MEMBER, "DAY", 1, 1)
    sliding_days = _windowed("rsvp", _MEMBER, "HOUR", 6, 24)
    best_members, best_topics = _ranked("member_id, member_name", 5), _ranked("topic", 10)
    stamp = "CAST(epoch(window_end) AS BIGINT) * 1000.0::DOUBLE"
    member_rows = f"{_BOUNDS}, member_id, member_name, count"
    topic_rows = f"{_BOUNDS}, topic, count"

    def sql(*ctes: str, select: str) -> str:
        return f"WITH {','.join([_BASE, *ctes])}\n{select}"

    bodies = {
        "rsvp_flatten": sql(select=_FLAT),
        "topic_arrays": sql(
            select=f"SELECT {_TIME} AS event_time, array_to_string(topics, '|') AS topics FROM rsvp"
        ),
        "yes_rsvps": sql(
            select=f"SELECT event_id AS rsvp_id, {_TIME} AS event_time, response FROM rsvp WHERE response = 'yes'"
        ),
        "topic_explode": sql(select=f"SELECT {_TIME} AS event_time, unnest(topics) AS topic FROM rsvp"),
        "topic_counts": sql(topics, select=f"SELECT {topic_rows} FROM finished"),
        "member_counts": sql(members, select=f"SELECT {member_rows} FROM finished"),
        "top_members": sql(
            members, best_members,
            select=f"SELECT {member_rows}, position, {_DAY} AS \"dateForIndex\" FROM ranked",
        ),
        "top_topics": sql(
            topics, best_topics,
            select=f"SELECT {topic_rows}, position, {_DAY} AS \"dateForIndex\" FROM ranked",
        ),
        "top_members_minute": sql(
            members_minute, best_members,
            select=f"SELECT {member_rows}, position, {_DAY} AS \"dateForIndex\" FROM ranked",
        ),
        "top_topics_minute": sql(
            topics_minute, best_topics,
            select=f"SELECT {topic_rows}, position, {_DAY} AS \"dateForIndex\" FROM ranked",
        ),
        "top_members_global": sql(
            f"best AS (SELECT {_MEMBER}, count(*) AS count FROM rsvp GROUP BY ALL"
            " ORDER BY count DESC, member_id, member_name LIMIT 5)",
            select="SELECT *, CAST(dense_rank() OVER (ORDER BY count DESC) AS INTEGER) AS position FROM best",
        ),
        "top_topics_global": sql(
            _MENTIONS,
            "best AS (SELECT topic, count(*) AS count FROM mention GROUP BY ALL"
            " ORDER BY count DESC, topic LIMIT 10)",
            select="SELECT *, CAST(dense_rank() OVER (ORDER BY count DESC) AS INTEGER) AS position FROM best",
        ),
        "burst_members": sql(
            days, select=f"SELECT {member_rows}, {_DAY} AS \"dateForIndex\" FROM finished WHERE count > 6"
        ),
        "burst_members_sliding": sql(
            sliding_days, select=f"SELECT {member_rows}, {_DAY} AS \"dateForIndex\" FROM finished WHERE count > 6"
        ),
        "day_range": sql(
            select=f"{_FLAT} WHERE event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-11'"
        ),
        "usable_counts": sql(
            select="SELECT CASE WHEN event_id % 50 IN (7, 8, 9) THEN 'set aside' ELSE 'usable' END AS part,"
            " count(*) AS count FROM rsvp GROUP BY 1"
        ),
        "member_counts_by_differences": sql(
            _windowed("rsvp", _MEMBER, "HOUR", 1, 24), select=f"SELECT {member_rows} FROM finished"
        ),
        "member_counts_by_levels": sql(sliding_days, select=f"SELECT {member_rows} FROM finished"),
        "top_topics_by_summaries": sql(topics, best_topics, select=f"SELECT {topic_rows} FROM ranked"),
        "member_positions": sql(
            f"counts AS (SELECT {_MEMBER}, count(*) AS count FROM rsvp GROUP BY ALL)",
            select="SELECT *, CAST(dense_rank() OVER (ORDER BY count DESC) AS INTEGER) AS position FROM counts",
        ),
        "crowded_members": sql(
            f"""moments AS (SELECT DISTINCT {_MEMBER}, event_time FROM rsvp),
            held AS (
              SELECT m.*, list_reverse_sort(list(r.event_time)) AS times
              FROM moments m JOIN rsvp r ON r.user_id = m.member_id
                AND r.event_time <= m.event_time AND r.event_time > m.event_time - INTERVAL {CROWD_LENGTH}
              GROUP BY ALL
            )""",
            select=f"SELECT member_id, member_name, strftime(times[{CROWD + 1}], '%Y-%m-%d %H:%M:%S.%g') AS since,"
            f" strftime(event_time, '%Y-%m-%d %H:%M:%S.%g') AS until FROM held WHERE len(times) > {CROWD}",
        ),
        "alerts_published_once": sql(days, _alerts(6), select="SELECT value FROM payload"),
        "optional_fields": sql(
            """odd AS (
              SELECT CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN [] WHEN 2 THEN topics || topics ELSE topics END AS list FROM rsvp
            ),
            fields AS (
              SELECT 'venue' AS field, CASE WHEN event_id % 3 = 0 THEN 'Venue ' || event_id % 11 END AS value FROM rsvp
              UNION ALL SELECT 'topic', unnest(list) FROM odd
            )""",
            select="SELECT field, value, count(*) AS count FROM fields GROUP BY ALL",
        ),
        "stream_redelivered": sql(members, select=f"SELECT {member_rows} FROM finished"),
        "stream_arrival_windows": sql(select=f"SELECT {_MEMBER}, count(*) AS count FROM rsvp GROUP BY ALL"),
        "stream_horizon": sql(
            _horizon_sql(),
            select="SELECT kind, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, member_id, n FROM told",
        ),
        "alert_payloads": sql(
            days, _alerts(6),
            select=f"SELECT {_BOUNDS}, CAST(member_id AS VARCHAR) AS key, value FROM payload",
        ),
        "alert_payloads_slim": sql(
            days, _alerts(6),
            select=f"SELECT {_BOUNDS}, CAST(member_id AS VARCHAR) AS key,"
            """ '{"title":"' || title || '","message":"' || message || '"}' AS value FROM payload""",
        ),
        "alert_cap": sql(
            days, _alerts(CAP_THRESHOLD, CAP),
            select=f"SELECT {_BOUNDS}, CAST(member_id AS VARCHAR) AS key, value FROM payload",
        ),
        "write_timestamp": sql(
            members, best_members,
            select="SELECT strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, member_id,"
            f" {stamp} AS timestamp FROM ranked",
        ),
        "daily_partition_counts": sql(
            members, best_members,
            select=f"SELECT {_DAY} AS \"dateForIndex\", count(*) AS count, sum({stamp}) AS timestamps"
            " FROM ranked GROUP BY 1",
        ),
        "static_sink_roundtrip": sql(
            topics, best_topics,
            select=f"SELECT {topic_rows}, position, {_DAY} AS \"dateForIndex\", {stamp} AS timestamp,"
            " CAST(0 AS BIGINT) AS batch_id FROM ranked",
        ),
        "alert_publish_roundtrip": sql(
            days, _alerts(6), select="SELECT value, CAST(0 AS BIGINT) AS batch_id FROM payload"
        ),
        "stream_scan_count": sql(select="SELECT response, count(*) AS count FROM rsvp GROUP BY response"),
        "stream_member_counts": sql(members, select=f"SELECT {member_rows} FROM finished"),
        "stream_top_members": sql(
            members, best_members,
            select=f"SELECT {member_rows}, position, {_DAY} AS \"dateForIndex\", {stamp} AS timestamp FROM ranked",
        ),
        "stream_payload_jobs": _application_sql(),
        "stream_top_topics": sql(
            topics, best_topics,
            select=f"SELECT {topic_rows}, position, {_DAY} AS \"dateForIndex\", {stamp} AS timestamp FROM ranked",
        ),
        "stream_burst_members": sql(
            days,
            select=f"SELECT {member_rows}, {_DAY} AS \"dateForIndex\", {stamp} AS timestamp"
            " FROM finished WHERE count > 6",
        ),
        "stream_alerts": sql(days, _alerts(6), select="SELECT value FROM payload"),
        "json_roundtrip": sql(select=f"{_FLAT} WHERE response = 'yes'"),
        "decode_roundtrip": sql(select=_FLAT),
        "decode_quarantine": sql(
            select="SELECT CASE WHEN response = 'yes' THEN 'decoded' ELSE 'quarantined' END AS outcome,"
            " count(*) AS count FROM rsvp GROUP BY 1"
        ),
    }
    bodies |= llm.oracle_sql() if llm else {}
    return {name: text for name, text in bodies.items() if name in queries()}
