"""Structured Streaming: sinks, snapshots and the three-query job."""

from .deltas import ARRIVAL_PATHS, ERRORS, HEATMAP, PATHS, DeltaStore, report, start_delta_store, start_report
from .open_sessions import read_session_batches, session_log, start_open_sessions
from .pipeline import await_all, await_any, build_queries, rejected_so_far, run_pipeline
from .sessions import (
    checkpoint_watermark,
    query_watermark,
    read_stream_sessions,
    start_session_cells,
    write_stream_sessions,
)
from .sinks import start_console_sink, start_parquet_sink, start_sink, start_update_parquet_sink
from .snapshots import (
    latest_snapshot_id,
    read_fragment_paths,
    read_latest_snapshot,
    start_heatmap_snapshots,
    start_path_fragments,
    start_path_snapshots,
)
from .upserts import UpsertTable, start_upsert_sink

__all__ = [
    "ARRIVAL_PATHS",
    "ERRORS",
    "HEATMAP",
    "PATHS",
    "DeltaStore",
    "UpsertTable",
    "await_all",
    "await_any",
    "build_queries",
    "checkpoint_watermark",
    "latest_snapshot_id",
    "query_watermark",
    "read_fragment_paths",
    "read_latest_snapshot",
    "read_session_batches",
    "read_stream_sessions",
    "rejected_so_far",
    "report",
    "run_pipeline",
    "session_log",
    "start_console_sink",
    "start_delta_store",
    "start_heatmap_snapshots",
    "start_open_sessions",
    "start_parquet_sink",
    "start_report",
    "start_path_fragments",
    "start_path_snapshots",
    "start_session_cells",
    "start_sink",
    "start_update_parquet_sink",
    "start_upsert_sink",
    "write_stream_sessions",
]
