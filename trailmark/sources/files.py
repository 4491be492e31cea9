"""JSON-lines event files: read (S1, batch or stream) and write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ARRIVAL_TIME, EVENT_COLUMNS, EVENT_SCHEMA


def read_events_files(
    spark: SparkSession,
    path: str,
    streaming: bool = True,
    max_files_per_trigger: int | None = None,
    with_arrival: bool = False,
) -> DataFrame:
    """One JSON object per line, explicit schema (never inferred), PERMISSIVE.

    A malformed line becomes an all-NULL row (and later vanishes, having no event
    time); a field of the wrong type becomes NULL alone.  The reference reads one
    file per trigger; that throttles intake, so here it is an option.  ``with_arrival`` adds
    ``arrivalTime``, the time a record's file was written.
    """
    if streaming:
        reader = spark.readStream.schema(EVENT_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
        events = reader.json(path)
    else:
        events = spark.read.schema(EVENT_SCHEMA).json(path)
    return events.select("*", F.col("_metadata.file_modification_time").alias(ARRIVAL_TIME)) if with_arrival else events


def write_events_json(events: DataFrame, path: str, mode: str = "error", compression: str | None = None) -> None:
    """Write the 11 event fields as JSON lines (valid JSON, NULL fields omitted)."""
    writer = events.select(*EVENT_COLUMNS).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)
