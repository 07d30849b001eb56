"""Where RSVPs come from: files, queues, raw payloads and the bridge from event tables."""

from turnout.sources.decode import (
    decode_json,
    decode_payload,
    decoded_rsvps,
    encode_payload,
    quarantined,
)
from turnout.sources.readers import in_range, read_payloads, read_rsvps
from turnout.sources.tables import read_table, rsvps_from_events

__all__ = [
    "decode_json",
    "decode_payload",
    "decoded_rsvps",
    "encode_payload",
    "quarantined",
    "read_payloads",
    "read_rsvps",
    "read_table",
    "rsvps_from_events",
    "in_range",
]
