"""The RSVP record: its wire contract, and the Spark schemas that follow from it."""

from __future__ import annotations

from pyspark.sql import types as T

REQUIRED, OPTIONAL, REPEATED = "required", "optional", "repeated"

# The proto2 wire contract of an RSVP message. Each entry is
# (field name, field number, label, type); a nested list is a nested message.
_ACCOUNT = [("identifier", 1, OPTIONAL, "string")]

RSVP_FIELDS = [
    ("venue", 1, OPTIONAL, [
        ("venue_name", 1, OPTIONAL, "string"),
        ("lon", 2, OPTIONAL, "double"),
        ("lat", 3, OPTIONAL, "double"),
        ("venue_id", 4, OPTIONAL, "double"),
    ]),
    ("visibility", 2, REQUIRED, "string"),
    ("response", 3, REQUIRED, "string"),
    ("guests", 4, REQUIRED, "double"),
    ("member", 5, REQUIRED, [
        ("member_id", 1, REQUIRED, "double"),
        ("other_services", 2, OPTIONAL, [
            ("twitter", 1, OPTIONAL, _ACCOUNT),
            ("facebook", 2, OPTIONAL, _ACCOUNT),
            ("tumblr", 3, OPTIONAL, _ACCOUNT),
            ("flickr", 4, OPTIONAL, _ACCOUNT),
            ("linkedin", 5, OPTIONAL, _ACCOUNT),
        ]),
        ("photo", 3, OPTIONAL, "string"),
        ("member_name", 4, REQUIRED, "string"),
    ]),
    ("rsvp_id", 6, REQUIRED, "double"),
    ("mtime", 7, REQUIRED, "double"),
    ("event", 8, REQUIRED, [
        ("event_name", 1, REQUIRED, "string"),
        ("event_id", 2, REQUIRED, "string"),
        ("time", 3, OPTIONAL, "double"),
        ("event_url", 4, REQUIRED, "string"),
    ]),
    ("group", 10, REQUIRED, [
        ("group_topics", 1, REPEATED, [
            ("urlkey", 1, REQUIRED, "string"),
            ("topic_name", 2, REQUIRED, "string"),
        ]),
        ("group_city", 2, REQUIRED, "string"),
        ("group_country", 3, REQUIRED, "string"),
        ("group_id", 4, REQUIRED, "double"),
        ("group_name", 5, REQUIRED, "string"),
        ("group_lon", 6, REQUIRED, "double"),
        ("group_urlname", 7, REQUIRED, "string"),
        ("group_state", 8, OPTIONAL, "string"),
        ("group_lat", 9, REQUIRED, "double"),
    ]),
]

_SCALARS = {"string": T.StringType(), "double": T.DoubleType()}


def struct_of(fields, strict: bool = True) -> T.StructType:
    """Spark struct for a wire field list; ``strict`` keeps required fields not-null."""
    struct = T.StructType()
    for name, _, label, kind in fields:
        data_type = struct_of(kind, strict) if isinstance(kind, list) else _SCALARS[kind]
        if label == REPEATED:
            data_type = T.ArrayType(data_type, containsNull=not strict)
        struct.add(name, data_type, nullable=not strict or label == OPTIONAL)
    return struct


#: One RSVP as it arrives: every id and time is a double.
RSVP_SCHEMA = struct_of(RSVP_FIELDS)

#: The same record with every field nullable, as file and text readers produce it.
RSVP_SCHEMA_RELAXED = struct_of(RSVP_FIELDS, strict=False)

