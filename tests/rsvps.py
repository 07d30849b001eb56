"""Hand-made RSVPs in wire form."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import types as T

from turnout.functions import normalize
from turnout.schema import RSVP_SCHEMA


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def rsvp(time="2024-01-01 00:00:05", member=1, name=None, response="yes", topics=("A",), rsvp_id=1, **other):
    millis = at(time).timestamp() * 1000
    record = {
        "venue": None,
        "visibility": "public",
        "response": response,
        "guests": 0.0,
        "member": {
            "member_id": float(member),
            "other_services": None,
            "photo": None,
            "member_name": name or f"member {member}",
        },
        "rsvp_id": float(rsvp_id),
        "mtime": millis,
        "event": {"event_name": "e", "event_id": "e1", "time": None, "event_url": "/e1"},
        "group": {
            "group_topics": None
            if topics is None
            else [{"urlkey": topic.lower(), "topic_name": topic} for topic in topics],
            "group_city": "c",
            "group_country": "us",
            "group_id": 1.0,
            "group_name": "g",
            "group_lon": 0.0,
            "group_urlname": "g",
            "group_state": None,
            "group_lat": 0.0,
        },
    }
    return record | other


def wire(spark, records):
    return spark.createDataFrame(records, _nullable_topics())


def _nullable_topics():
    """The wire schema, except that a list of topics may be missing, as files can have it."""
    fields = []
    for field in RSVP_SCHEMA:
        if field.name == "group":
            inner = [
                T.StructField(f.name, f.dataType, True) if f.name == "group_topics" else f
                for f in field.dataType
            ]
            field = T.StructField("group", T.StructType(inner), False)
        fields.append(field)
    return T.StructType(fields)


def frame(spark, records):
    return normalize(wire(spark, records))


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())
