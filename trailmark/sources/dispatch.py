"""Source choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .files import read_events_files
from .kafka import read_events_kafka, read_events_kafka_raw
from .quarantine import read_records

SOURCES = ("files", "kafka")
_READERS = {"files": read_events_files, "kafka": read_events_kafka}
# Where the reference job reads when an option is not given.
_DEFAULTS = {
    "files": {"path": "./data/events"},
    "kafka": {"brokers": "localhost:9092", "topic": "webevents"},
}
_OPTIONS = {
    "files": {"input_path": "path", "max_files_per_trigger": "max_files_per_trigger"},
    "kafka": {"brokers": "brokers", "topic": "topic", "starting_offsets": "starting_offsets", "options": "options"},
}


_RECORD_READERS = {"files": read_records, "kafka": read_events_kafka_raw}


def read_events(spark: SparkSession, source: str = "files", streaming: bool = True, with_arrival: bool = False,
                with_position: bool = False, **opts) -> DataFrame:
    """``files`` (``input_path``, ``max_files_per_trigger``) or ``kafka`` (``brokers``, ``topic``,
    ``starting_offsets``, ``options`` of the connector); another source or an option of neither is an
    error.  Options of the other source are ignored, so a job can pass both sets.  ``with_arrival`` adds
    ``arrivalTime`` (the broker's time, or the time the file was written); ``with_position`` the record's place in
    the topic, which files do not have."""
    arguments = _arguments(source, opts) | ({"with_arrival": True} if with_arrival else {})
    if with_position:
        if source != "kafka":
            raise ValueError(f"records of {source!r} have no position; only those of 'kafka' have")
        arguments["with_position"] = True
    return _READERS[source](spark, streaming=streaming, **arguments)


def read_event_records(spark: SparkSession, source: str = "files", streaming: bool = True, **opts) -> DataFrame:
    """The source's records as they are (column ``value``), for ``sources.quarantine``; options as ``read_events``."""
    arguments = _arguments(source, opts)
    return _RECORD_READERS[source](spark, streaming=streaming, **arguments)


def _arguments(source: str, opts: dict) -> dict:
    if source not in SOURCES:
        raise ValueError(f"unknown source {source!r} (expected one of: {', '.join(SOURCES)})")
    unknown = set(opts) - {o for names in _OPTIONS.values() for o in names}
    if unknown:
        raise ValueError(f"unknown source options: {', '.join(sorted(unknown))}")
    given = {arg: opts[o] for o, arg in _OPTIONS[source].items() if opts.get(o) is not None}
    return {**_DEFAULTS[source], **given}
