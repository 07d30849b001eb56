from __future__ import annotations

import pytest
from pyspark.sql import types as T

from turnout.schema import RSVP_FIELDS, RSVP_SCHEMA, RSVP_SCHEMA_RELAXED


def test_top_level_fields():
    assert RSVP_SCHEMA.names == [
        "venue", "visibility", "response", "guests", "member", "rsvp_id", "mtime", "event", "group",
    ]
    assert [f.name for f in RSVP_SCHEMA if f.nullable] == ["venue"]


def test_every_id_and_time_is_a_double():
    member, event = RSVP_SCHEMA["member"].dataType, RSVP_SCHEMA["event"].dataType
    assert member["member_id"].dataType == T.DoubleType()
    assert RSVP_SCHEMA["rsvp_id"].dataType == RSVP_SCHEMA["mtime"].dataType == T.DoubleType()
    assert event["event_id"].dataType == T.StringType()


def test_topics_are_an_array_of_structs():
    topics = RSVP_SCHEMA["group"].dataType["group_topics"].dataType
    assert topics.elementType.names == ["urlkey", "topic_name"]


def test_linked_accounts_are_three_levels_deep():
    services = RSVP_SCHEMA["member"].dataType["other_services"].dataType
    assert services.names == ["twitter", "facebook", "tumblr", "flickr", "linkedin"]
    assert all(s.dataType.names == ["identifier"] for s in services)


def test_relaxed_schema_allows_null_everywhere():
    assert all(f.nullable for f in RSVP_SCHEMA_RELAXED)
    assert all(f.nullable for f in RSVP_SCHEMA_RELAXED["group"].dataType)


def test_descriptor_follows_the_contract():
    descriptor_pb2 = pytest.importorskip("google.protobuf.descriptor_pb2")
    from turnout.sources.decode import descriptor_set

    message = descriptor_pb2.FileDescriptorSet.FromString(descriptor_set()).file[0].message_type[0]
    assert [(f.name, f.number) for f in message.field] == [(f[0], f[1]) for f in RSVP_FIELDS]
    assert 9 not in [f.number for f in message.field]
