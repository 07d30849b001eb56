"""Bridge from the ``events`` table to RSVP records (an input fixture, not an operator)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.functions.columns import epoch_millis
from turnout.schema import RSVP_SCHEMA_RELAXED


def read_table(spark: SparkSession, sf_dir: str, name: str, streaming: bool = False) -> DataFrame:
    """A test table as a batch or streaming frame; it may be one file or a folder of files."""
    path = f"{sf_dir}/{name}.parquet"
    table = spark.read.parquet(path)
    if not streaming:
        return table
    # The file stream takes a folder or a glob, never the path of one file; braces make a glob
    # that matches this name only, file or folder.
    return spark.readStream.schema(table.schema).parquet(f"{sf_dir}/{{{name}}}.parquet")


def _topic(name: Column) -> Column:
    return F.struct(F.lower(F.translate(name, " ", "-")).alias("urlkey"), name.alias("topic_name"))


def rsvps_from_events(events: DataFrame) -> DataFrame:
    """One wire-form RSVP per event, computed row by row: no join, no shuffle.

    The member is the event's user, under the name the ``customer`` table has for that key;
    ``error`` events answer "no", all others "yes"; the group's topics are the event type, the
    interest ``k`` found in ``props`` and the series of ten it lies in.
    """
    user, event_id = F.col("user_id"), F.col("event_id")
    at = F.col("ts")
    if dict(events.dtypes)["ts"] == "timestamp_ntz":
        # Times without a zone are meant in UTC, whatever the session's zone.
        at = F.concat(at.cast("string"), F.lit("Z")).cast("timestamp")
    interest = F.regexp_extract("props", r'"k":\s*(\d+)', 1)
    series = F.concat(F.lit("series "), (interest.try_cast("int") / 10).cast("int").cast("string"))
    absent = F.lit(None)
    wire = {field.name: field.dataType for field in RSVP_SCHEMA_RELAXED}
    columns = {
        "venue": absent.cast(wire["venue"]),
        "visibility": F.lit("public"),
        "response": F.when(F.col("event_type") == "error", "no").otherwise("yes"),
        "guests": F.lit(0.0),
        "member": F.struct(
            user.cast("double").alias("member_id"),
            absent.cast(wire["member"]["other_services"].dataType).alias("other_services"),
            absent.cast("string").alias("photo"),
            F.concat(F.lit("Customer#"), F.lpad(user.cast("string"), 9, "0")).alias("member_name"),
        ),
        "rsvp_id": event_id.cast("double"),
        "mtime": epoch_millis(at),
        "event": F.struct(
            F.col("event_type").alias("event_name"),
            event_id.cast("string").alias("event_id"),
            epoch_millis(at).alias("time"),
            F.concat(F.lit("/events/"), event_id.cast("string")).alias("event_url"),
        ),
        "group": F.struct(
            F.array(
                _topic(F.col("event_type")),
                _topic(F.concat(F.lit("interest "), interest)),
                _topic(series),
            ).alias("group_topics"),
            F.lit("Springfield").alias("group_city"),
            F.lit("us").alias("group_country"),
            (user % 97).cast("double").alias("group_id"),
            F.concat(F.lit("Group "), (user % 97).cast("string")).alias("group_name"),
            F.lit(0.0).alias("group_lon"),
            F.concat(F.lit("group-"), (user % 97).cast("string")).alias("group_urlname"),
            absent.cast("string").alias("group_state"),
            F.lit(0.0).alias("group_lat"),
        ),
    }
    return events.select(*[columns[name].alias(name) for name in wire])
