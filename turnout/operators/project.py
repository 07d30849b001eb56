"""Projections and filters over RSVP records. All are row-local, so batch and stream agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def members(rsvps: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Who responded and when: the nested member fields, for every response."""
    return rsvps.select(time_col, "member.member_id", "member.member_name")


def yes_responses(rsvps: DataFrame) -> DataFrame:
    """Accepted RSVPs only; the comparison is case-sensitive."""
    return rsvps.where(F.col("response") == "yes")


def topic_arrays(rsvps: DataFrame, time_col: str = "event_time") -> DataFrame:
    """The topic names of each RSVP's group, read through the array of structs."""
    return rsvps.select(time_col, F.col("group.group_topics.topic_name").alias("topic_name"))


def explode_topics(rsvps: DataFrame, time_col: str = "event_time") -> DataFrame:
    """One row per topic of an RSVP's group. Null and empty lists vanish; a topic listed twice
    counts twice."""
    return rsvps.select(time_col, F.explode("group.group_topics.topic_name").alias("topic"))


def flatten(rsvps: DataFrame) -> DataFrame:
    """The scalar fields of a normalized RSVP as flat columns."""
    return rsvps.select(
        "rsvp_id",
        "event_time",
        "response",
        "visibility",
        "guests",
        "member.member_id",
        "member.member_name",
        "event.event_id",
        "event.event_name",
        "event.event_url",
        "group.group_id",
        "group.group_name",
        "group.group_city",
        "group.group_country",
        "group.group_state",
        "venue.venue_id",
        "venue.venue_name",
    )
