"""Event sources and the event codecs."""

from .dispatch import SOURCES, read_event_records, read_events
from .files import read_events_files, write_events_json
from .generate import generate_events
from .kafka import (
    decode_events,
    encode_events,
    read_events_kafka,
    read_events_kafka_raw,
    start_events_kafka_sink,
    write_events_kafka,
)
from .quarantine import bad_records, check_records, count_reasons, good_events, read_records, start_quarantine
from .tables import stream_web_events, web_events, web_events_from_table

__all__ = [
    "SOURCES",
    "bad_records",
    "check_records",
    "count_reasons",
    "decode_events",
    "encode_events",
    "generate_events",
    "good_events",
    "read_event_records",
    "read_events",
    "read_events_files",
    "read_events_kafka",
    "read_events_kafka_raw",
    "read_records",
    "start_events_kafka_sink",
    "start_quarantine",
    "stream_web_events",
    "web_events",
    "web_events_from_table",
    "write_events_json",
    "write_events_kafka",
]
