"""Named queries over the driver's tables: ``(spark, sf_dir) -> DataFrame``.

Each query maps ``events.parquet`` to web events (``sources.tables``) and runs the
library operators on the whole table.  Result shapes are flattened for comparison
with the DuckDB oracles: windows become ``window_start``/``window_end``,
timestamps are naive UTC (``timestamp_ntz``), and paths are text
(``|`` between pages, ``<null>`` for a NULL page).

Streaming queries read the events table itself as a stream of Parquet files, run the real
streaming plan with ``availableNow`` and read the sink (below the cluster's
checkpoint folder) back with an explicit schema.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import render_path
from ..operators.errors import error_counts, error_totals, errors_by_count
from ..operators.events import prepare_events, with_event_watermark
from ..operators.heatmap import click_heatmap, click_heatmap_total, top_heatmap
from ..operators.sessions import session_paths
from ..operators.user_paths import preview_user_paths_of, user_paths
from ..session import ensure_utc, scratch_dir
from ..sources.files import read_events_files, write_events_json
from ..sources.kafka import decode_events, encode_events
from ..sources.quarantine import check_records, count_reasons, good_events, read_records, start_quarantine
from ..sources.tables import (
    ARRIVAL_BATCHES,
    arrivals,
    damaged_records,
    events_table,
    hot_web_events,
    stream_web_events,
    topic_records,
    web_events,
    web_events_from_table,
)
from ..streaming.deltas import HEATMAP, PATHS, DeltaStore, Mergeable, start_delta_store
from ..streaming.open_sessions import read_session_batches, start_open_sessions
from ..streaming.sessions import checkpoint_watermark, query_watermark, read_stream_sessions, start_session_cells
from ..streaming.sinks import start_parquet_sink, start_update_parquet_sink
from ..streaming.snapshots import (
    HEATMAP_SNAPSHOT_SCHEMA,
    PATH_SNAPSHOT_SCHEMA,
    read_fragment_paths,
    read_latest_snapshot,
    start_heatmap_snapshots,
    start_path_fragments,
    start_path_snapshots,
)
from ..streaming.upserts import UpsertTable, start_upsert_sink

STREAM_TIMEOUT_MINUTES = 30
AVAILABLE_NOW = {"availableNow": True}

QueryFn = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------------------- shapes
def _ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz")


def _flat_window(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *rest,
    )


def path_text(c: str = "path") -> F.Column:
    return render_path(c, "|", "<null>")


def _session_shape(df: DataFrame) -> DataFrame:
    return df.select("userId", _ntz("sessionStart").alias("sessionStart"),
                     _ntz("sessionEnd").alias("sessionEnd"), path_text().alias("path_text"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_events(web_events(spark, sf_dir))


# --------------------------------------------------------------------------- batch
def q_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.withColumn("eventTime", _ntz("eventTime"))


def q_heatmap_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_window(click_heatmap(_events(spark, sf_dir)))


def q_errors_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_window(error_counts(_events(spark, sf_dir)))


def _q_sessions(gap: int) -> QueryFn:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _session_shape(session_paths(_events(spark, sf_dir), gap))

    q.__name__ = f"q_session_paths_{gap}m"
    return q


def q_heatmap_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_heatmap_total(_events(spark, sf_dir))


def q_heatmap_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_heatmap(click_heatmap_total(_events(spark, sf_dir)), 10)


def q_error_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors_by_count(error_totals(_events(spark, sf_dir)))


def q_user_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_paths(_events(spark, sf_dir)).select("userId", path_text().alias("path_text"))


def q_user_paths_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 where one user holds a third of the rows."""
    return user_paths(prepare_events(hot_web_events(spark, sf_dir))).select("userId", path_text().alias("path_text"))


def q_session_paths_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 where one user holds a third of the rows."""
    return _session_shape(session_paths(prepare_events(hot_web_events(spark, sf_dir)), 30))


def q_user_paths_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview_user_paths_of(_events(spark, sf_dir), 5)


def q_jsonl_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 write then S1 (batch) read of the whole mapped table."""
    path = scratch_dir(spark, "jsonl")
    write_events_json(web_events(spark, sf_dir), path)
    return read_events_files(spark, path, streaming=False)


def q_kafka_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8 encode then S3/S4 decode: Kafka rows without a broker."""
    return decode_events(encode_events(web_events(spark, sf_dir)))


def q_user_paths_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 in the order of the topic: records with their positions through the codec."""
    events = prepare_events(decode_events(topic_records(spark, sf_dir), with_position=True))
    return user_paths(events, order="arrival").select("userId", path_text().alias("path_text"))


def q_quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of records of which some are damaged."""
    return good_events(check_records(damaged_records(spark, sf_dir)))


def q_quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_reasons(check_records(damaged_records(spark, sf_dir)))


# --------------------------------------------------------------------------- streaming
def _stream_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    return prepare_events(stream_web_events(spark, sf_dir)), scratch_dir(spark, "stream")


def _run(query) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(f"streaming query failed: {query.exception()}")


HEATMAP_SINK_SCHEMA = T.StructType(
    [
        T.StructField("window", T.StructType([T.StructField("start", T.TimestampType()),
                                              T.StructField("end", T.TimestampType())])),
        T.StructField("pageUrl", T.StringType()),
        T.StructField("element", T.StringType()),
        T.StructField("xBucket", T.IntegerType()),
        T.StructField("yBucket", T.IntegerType()),
        T.StructField("count", T.LongType()),
    ]
)
PATHS_SINK_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("sessionStart", T.TimestampType()),
        T.StructField("sessionEnd", T.TimestampType()),
        T.StructField("path", T.ArrayType(T.StringType())),
    ]
)
ERRORS_SINK_SCHEMA = T.StructType(
    [
        T.StructField("window", HEATMAP_SINK_SCHEMA["window"].dataType),
        T.StructField("pageUrl", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def q_stream_heatmap_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, base = _stream_input(spark, sf_dir)
    heat = click_heatmap(with_event_watermark(events, STREAM_TIMEOUT_MINUTES))
    _run(start_parquet_sink(heat, f"{base}/out", f"{base}/chk", trigger=AVAILABLE_NOW))
    return _flat_window(spark.read.schema(HEATMAP_SINK_SCHEMA).parquet(f"{base}/out"))


def q_stream_paths_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, base = _stream_input(spark, sf_dir)
    paths = session_paths(with_event_watermark(events, STREAM_TIMEOUT_MINUTES), STREAM_TIMEOUT_MINUTES,
                          strategy="session_window")
    _run(start_parquet_sink(paths, f"{base}/out", f"{base}/chk", trigger=AVAILABLE_NOW))
    return _session_shape(spark.read.schema(PATHS_SINK_SCHEMA).parquet(f"{base}/out"))


def q_stream_errors_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode: a key may repeat across batches; its latest row has the highest count."""
    events, base = _stream_input(spark, sf_dir)
    errs = error_counts(with_event_watermark(events, STREAM_TIMEOUT_MINUTES))
    _run(start_update_parquet_sink(errs, f"{base}/out", f"{base}/chk", trigger=AVAILABLE_NOW))
    rows = spark.read.schema(ERRORS_SINK_SCHEMA).parquet(f"{base}/out")
    latest = rows.groupBy("window", "pageUrl").agg(F.max("count").alias("count"))
    return _flat_window(latest)


def q_snapshot_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, base = _stream_input(spark, sf_dir)
    _run(start_path_snapshots(events, f"{base}/out", f"{base}/chk", trigger=AVAILABLE_NOW))
    snap = read_latest_snapshot(spark, f"{base}/out", PATH_SNAPSHOT_SCHEMA)
    return snap.select("userId", path_text().alias("path_text"))


def q_snapshot_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, base = _stream_input(spark, sf_dir)
    _run(start_heatmap_snapshots(events, f"{base}/out", f"{base}/chk", trigger=AVAILABLE_NOW))
    return read_latest_snapshot(spark, f"{base}/out", HEATMAP_SNAPSHOT_SCHEMA)


def q_stream_session_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 in streaming with spread state: (user, second, page) counts, then stitched."""
    events, base = _stream_input(spark, sf_dir)
    query = start_session_cells(events, f"{base}/out", f"{base}/chk", STREAM_TIMEOUT_MINUTES, trigger=AVAILABLE_NOW)
    _run(query)
    sessions = read_stream_sessions(spark, f"{base}/out", query_watermark(query))
    return _session_shape(sessions)


def q_stream_user_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 with bounded state: minute fragments closed by the watermark, then paths."""
    events, base = _stream_input(spark, sf_dir)
    _run(start_path_fragments(events, f"{base}/out", f"{base}/chk", STREAM_TIMEOUT_MINUTES, trigger=AVAILABLE_NOW))
    return read_fragment_paths(spark, f"{base}/out").select("userId", path_text().alias("path_text"))


def _run_batches(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame, str], object],
                 after: Callable[[str, int], object] | None = None) -> str:
    """Late and repeated arrivals: the query is restarted on its checkpoint for each batch of new files.

    ``start`` gets the stream and the base folder and returns the started query; ``after`` gets the base folder
    and the batch once the query has read it.
    """
    ensure_utc(spark)
    base = scratch_dir(spark, "stream")
    raw = events_table(spark, sf_dir)
    for batch in range(ARRIVAL_BATCHES):
        write_events_json(web_events_from_table(arrivals(raw, batch)), f"{base}/input", mode="append")
        _run(start(prepare_events(read_events_files(spark, f"{base}/input", streaming=True)), base))
        if after is not None:
            after(base, batch)
    return base


def _after_each_batch(spark: SparkSession, sf_dir: str, kind: Mergeable) -> DataFrame:
    """The merged deltas after each of the four arrival batches (column ``after_batch``)."""
    store: list[DeltaStore] = []  # one reader, which opens a segment once

    def keep(base: str, batch: int) -> None:
        if not store:
            store.append(DeltaStore(spark, f"{base}/store", kind, fanout=2))
        store[0].read().write.parquet(f"{base}/results/after_batch={batch}")

    base = _run_batches(spark, sf_dir, lambda events, base: start_delta_store(
        events, f"{base}/store", f"{base}/chk", kind, trigger=AVAILABLE_NOW, fanout=2), keep)
    return spark.read.parquet(f"{base}/results")


def q_delta_heatmap_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4/K6 from the store of deltas, after every batch."""
    return _after_each_batch(spark, sf_dir, HEATMAP)


def q_delta_paths_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6/K5 from the store of deltas, after every batch."""
    return _after_each_batch(spark, sf_dir, PATHS).select("after_batch", "userId", path_text().alias("path_text"))


def q_stream_session_window_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``session_window`` over four batches with late rows, some of which merge open sessions."""
    base = _run_batches(spark, sf_dir, lambda events, base: start_parquet_sink(
        session_paths(with_event_watermark(events, STREAM_TIMEOUT_MINUTES), STREAM_TIMEOUT_MINUTES, strategy="session_window"),
        f"{base}/out", f"{base}/chk", trigger=AVAILABLE_NOW))
    return _session_shape(spark.read.schema(PATHS_SINK_SCHEMA).parquet(f"{base}/out"))


def q_stream_open_sessions_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same results without a state entry per user."""
    base = _run_batches(spark, sf_dir, lambda events, base: start_open_sessions(
        events, f"{base}/out", f"{base}/chk", STREAM_TIMEOUT_MINUTES, trigger=AVAILABLE_NOW))
    return _session_shape(read_session_batches(spark, f"{base}/out", f"{base}/chk"))


def q_quarantine_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second sink: bad records of a stream of lines, with their reasons."""
    base = scratch_dir(spark, "stream")
    damaged_records(spark, sf_dir).write.text(f"{base}/input")
    _run(start_quarantine(read_records(spark, f"{base}/input"), f"{base}/out", f"{base}/chk", trigger=AVAILABLE_NOW))
    rows = spark.read.schema("record string, reasons array<string>").parquet(f"{base}/out")
    return rows.select("record", F.array_join("reasons", "; ").alias("reasons"))


def q_stream_session_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spread-state sessions over four batches with late rows, restarted between them."""
    base = _run_batches(spark, sf_dir, lambda events, base: start_session_cells(
        events, f"{base}/out", f"{base}/chk", STREAM_TIMEOUT_MINUTES, trigger=AVAILABLE_NOW))
    return _session_shape(read_stream_sessions(spark, f"{base}/out", checkpoint_watermark(spark, f"{base}/chk")))


def q_stream_errors_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every update row over four batches: a window that several batches touch repeats with growing counts."""
    base = _run_batches(spark, sf_dir, lambda events, base: start_update_parquet_sink(
        error_counts(with_event_watermark(events, STREAM_TIMEOUT_MINUTES)), f"{base}/out", f"{base}/chk", trigger=AVAILABLE_NOW))
    return _flat_window(spark.read.schema(ERRORS_SINK_SCHEMA).parquet(f"{base}/out").drop("batch_id"))


def q_stream_errors_upsert_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, W7 as a table with one row per key: its rows after each of the four batches."""
    schema = T.StructType([f for f in ERRORS_SINK_SCHEMA if f.name != "batch_id"])
    base = _run_batches(
        spark, sf_dir, lambda events, base: start_upsert_sink(
            error_counts(with_event_watermark(events, STREAM_TIMEOUT_MINUTES)), f"{base}/table", f"{base}/chk", trigger=AVAILABLE_NOW),
        lambda base, batch: UpsertTable(spark, f"{base}/table", schema).read().write.parquet(f"{base}/results/after_batch={batch}"))
    return _flat_window(spark.read.parquet(f"{base}/results"))


def queries() -> dict[str, QueryFn]:
    return {
        "event_time": q_event_time,
        "heatmap_10m": q_heatmap_10m,
        "errors_5m": q_errors_5m,
        "session_paths_30m": _q_sessions(30),
        "session_paths_2m": _q_sessions(2),
        "heatmap_total": q_heatmap_total,
        "heatmap_top10": q_heatmap_top10,
        "error_totals": q_error_totals,
        "user_paths": q_user_paths,
        "user_paths_hot": q_user_paths_hot,
        "user_paths_arrival": q_user_paths_arrival,
        "session_paths_hot": q_session_paths_hot,
        "user_paths_preview": q_user_paths_preview,
        "jsonl_source": q_jsonl_source,
        "kafka_codec": q_kafka_codec,
        "stream_heatmap_append": q_stream_heatmap_append,
        "stream_paths_append": q_stream_paths_append,
        "stream_errors_update": q_stream_errors_update,
        "snapshot_paths": q_snapshot_paths,
        "snapshot_heatmap": q_snapshot_heatmap,
        "stream_user_paths": q_stream_user_paths,
        "stream_session_cells": q_stream_session_cells,
        "stream_session_late": q_stream_session_late,
        "stream_errors_late": q_stream_errors_late,
        "stream_errors_upsert_late": q_stream_errors_upsert_late,
        "stream_session_window_late": q_stream_session_window_late,
        "stream_open_sessions_late": q_stream_open_sessions_late,
        "delta_heatmap_late": q_delta_heatmap_late,
        "delta_paths_late": q_delta_paths_late,
        "quarantine_good": q_quarantine_good,
        "quarantine_bad": q_quarantine_bad,
        "quarantine_counts": q_quarantine_counts,
    }


__all__ = ["queries"]
