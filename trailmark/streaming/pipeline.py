"""The streaming job (J1): one event source, three independent stateful queries.

Each query keeps its own checkpoint, offsets and watermark (the watermark of a
query only moves with the rows that reach it: the click / error filters sit below
it after optimisation).  ``trigger={"availableNow": True}`` makes a finite run
that processes everything present and emits every window the final watermark
closes.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import rejected_event_times
from ..operators.errors import error_counts
from ..operators.events import prepare_events, with_event_watermark
from ..operators.heatmap import click_heatmap
from ..operators.sessions import session_paths
from ..schema import DEFAULT_SESSION_GAP_MINUTES
from ..sources.dispatch import read_event_records, read_events
from ..sources.quarantine import start_quarantine
from .deltas import HEATMAP, PATHS_BY, start_delta_store, start_report
from .open_sessions import start_open_sessions
from .sessions import start_session_cells
from .sinks import start_sink
from .snapshots import SNAPSHOT_TRIGGER, start_heatmap_snapshots, start_path_snapshots

# Default sink of each query and its output mode per sink (Parquet takes append only; the
# console heatmap shows updates).  The reference prints the errors; here they are kept, since the
# console shows a few rows of a batch and stores none.
DEFAULT_SINKS = {"heatmap": "parquet", "paths": "parquet", "errors": "parquet_updates"}
OUTPUT_MODES = {
    ("heatmap", "parquet"): "append",
    ("heatmap", "console"): "update",
    ("heatmap", "parquet_updates"): "update",
    ("paths", "parquet"): "append",
    ("paths", "console"): "append",
    ("paths", "parquet_updates"): "append",  # session windows take append only
    ("errors", "console"): "update",
    ("errors", "parquet_updates"): "update",
    ("errors", "parquet"): "append",
    ("heatmap", "parquet_upserts"): "update",
    ("errors", "parquet_upserts"): "update",
}


def build_queries(events: DataFrame, session_timeout_minutes: int = DEFAULT_SESSION_GAP_MINUTES) -> dict[str, DataFrame]:
    """The three streaming results over prepared events (P1/P2 applied)."""
    wm = with_event_watermark(events, session_timeout_minutes)
    return {
        "heatmap": click_heatmap(wm),
        "paths": session_paths(wm, session_timeout_minutes, strategy="session_window"),
        "errors": error_counts(wm),
    }


def run_pipeline(
    spark: SparkSession,
    source: str = "files",
    output_path: str = "./out",
    checkpoint_path: str = "./chk",
    session_timeout_minutes: int = DEFAULT_SESSION_GAP_MINUTES,
    trigger: dict | None = None,
    sinks: dict[str, str] | None = None,
    max_event_time: str | None = None,
    session_state: str = "per_user",
    all_time: bool | str = False,
    report: bool = False,
    quarantine: bool = False,
    max_lead_minutes: float | None = None,
    path_order: str = "time",
    **source_opts,
) -> dict[str, StreamingQuery]:
    """Read -> events -> start heatmap, paths and errors; returns the queries.

    ``all_time`` also starts the all-time results ``all_paths`` and ``all_heatmap`` (K5, K6): ``True`` or
    ``"snapshots"`` writes the whole result with every trigger, ``"deltas"`` keeps a store of deltas
    (``streaming.deltas``).  ``report`` prints the busiest cells, the errors by page and a preview of the paths
    with every trigger, from stores below ``<output_path>/all_time``.  ``quarantine`` keeps records that cannot be read, with
    reasons, in ``<output_path>/quarantine``.  ``max_lead_minutes`` gives no event time to rows that are
    further ahead of their arrival.  ``path_order="arrival"`` (topics only) keeps the all-time paths of the stores of
    deltas and of the report in the order of the topic.  The paths query counts the rows whose time gave no event time (metric
    ``event_time``; ``rejected_so_far``).

    ``sinks`` overrides the per-query sink (``parquet``, ``parquet_updates``, ``parquet_upserts`` for
    heatmap and errors: one row per key, ``streaming.upserts``; ``console``); outputs go to ``<output_path>/<name>`` with checkpoints in
    ``<checkpoint_path>/<name>``.  Callers wait with ``await_any`` or
    ``q.awaitTermination()``.

    ``session_state="spread"`` replaces the per-user ``session_window`` state of the paths query by a
    table of open cells (``streaming.open_sessions``): the same sessions at the same time, read with
    ``read_session_batches(spark, path, checkpoint)``.  ``session_state="cells"`` writes (user, second, page)
    counts to ``<output_path>/paths`` (``streaming.sessions``); read the sessions with
    ``read_stream_sessions(spark, path, query_watermark(q))`` or store them with ``write_stream_sessions``.
    """
    if session_state not in ("per_user", "spread", "cells"):
        raise ValueError(f"session_state must be per_user, spread or cells, got {session_state!r}")
    if all_time not in (True, False, "snapshots", "deltas"):
        raise ValueError(f"all_time must be snapshots or deltas, got {all_time!r}")
    if path_order not in PATHS_BY:
        raise ValueError(f"path_order must be one of {', '.join(PATHS_BY)}, got {path_order!r}")
    if path_order == "arrival" and (all_time not in (False, "deltas") or not (all_time or report)):
        raise ValueError("path_order='arrival' needs all_time='deltas' or the report")
    if session_timeout_minutes is None or session_timeout_minutes <= 0:
        raise ValueError(f"sessionTimeoutMinutes must be positive, got {session_timeout_minutes!r}")
    chosen = {**DEFAULT_SINKS, **(sinks or {})}
    for name, sink in chosen.items():
        if (name, sink) not in OUTPUT_MODES:
            raise ValueError(f"unknown sink {sink!r} of {name!r}")
    if session_state != "per_user" and "paths" in (sinks or {}):
        raise ValueError(f"with session_state={session_state!r} the paths query has a sink of its own; leave its sink out")
    raw = read_events(spark, source, streaming=True, with_arrival=max_lead_minutes is not None,
                      with_position=path_order == "arrival", **source_opts)
    events = prepare_events(raw, max_event_time, max_lead_minutes)
    counted = events.observe("event_time", rejected_event_times())
    started: dict[str, StreamingQuery] = {}
    try:
        if session_state != "per_user":
            start_paths = start_open_sessions if session_state == "spread" else start_session_cells
            started["paths"] = start_paths(
                counted, f"{output_path}/paths", f"{checkpoint_path}/paths", session_timeout_minutes, trigger
            )
        results = build_queries(events, session_timeout_minutes) | {
            "paths": build_queries(counted, session_timeout_minutes)["paths"]}
        for name, df in results.items():
            if name in started:
                continue
            started[name] = start_sink(
                df,
                chosen[name],
                OUTPUT_MODES[(name, chosen[name])],
                f"{output_path}/{name}",
                f"{checkpoint_path}/{name}",
                trigger,
                query_name=None,
            )
        if all_time == "deltas":
            for name, kind in (("all_paths", PATHS_BY[path_order]), ("all_heatmap", HEATMAP)):
                started[name] = start_delta_store(events, f"{output_path}/{name}", f"{checkpoint_path}/{name}", kind, trigger or SNAPSHOT_TRIGGER)
        elif all_time:
            for name, start in (("all_paths", start_path_snapshots), ("all_heatmap", start_heatmap_snapshots)):
                started[name] = start(events, f"{output_path}/{name}", f"{checkpoint_path}/{name}", trigger)
        if report:
            started["report"] = start_report(events, f"{output_path}/all_time", f"{checkpoint_path}/report", trigger or SNAPSHOT_TRIGGER,
                                             path_order=path_order)
        if quarantine:
            records = read_event_records(spark, source, streaming=True, **source_opts)
            started["quarantine"] = start_quarantine(records, f"{output_path}/quarantine", f"{checkpoint_path}/quarantine", trigger=trigger)
    except Exception:
        for q in started.values():
            q.stop()
        raise
    return started


def rejected_so_far(queries: dict[str, StreamingQuery]) -> dict[str, int]:
    """From the recent progress of a job: rows without event time though they have a time, records read, and bad ones."""
    totals: dict[str, int] = {}
    for q in queries.values():
        for progress in q.recentProgress:
            for metrics in (progress.get("observedMetrics") or {}).values():
                for name, n in (metrics.asDict() if hasattr(metrics, "asDict") else metrics).items():
                    if n is not None:
                        totals[name] = totals.get(name, 0) + n
    return totals


def await_any(queries: dict[str, StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Block until one of these queries ends, stop all, raise its failure if it failed.

    Looks at the given queries only: one that failed before the wait counts, and
    other queries of the session do not.
    """
    try:
        while all(q.isActive for q in queries.values()):
            time.sleep(poll_seconds)
    finally:
        ended = [q for q in queries.values() if not q.isActive]
        for q in queries.values():
            q.stop()
    for q in ended:
        if q.exception() is not None:
            raise q.exception()


def await_all(queries: dict[str, StreamingQuery]) -> None:
    """Finite runs (``availableNow``): wait for every query; raise the first failure."""
    failed = None
    for q in queries.values():
        try:
            q.awaitTermination()
        except Exception as exc:  # keep waiting for the others, report afterwards
            failed = failed or exc
    if failed is not None:
        raise failed
