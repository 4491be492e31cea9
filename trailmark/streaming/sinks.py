"""Streaming sinks (K1-K4) and triggers.

``trigger`` is the keyword form of ``DataStreamWriter.trigger``:
``{"availableNow": True}`` for a finite run, ``{"processingTime": "5 seconds"}``
for a service.  ``None`` keeps Spark's default (as fast as possible).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .upserts import start_upsert_sink


def _writer(df: DataFrame, output_mode: str, checkpoint: str | None, trigger: dict | None, query_name: str | None):
    w = df.writeStream.outputMode(output_mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return w


def start_parquet_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "append",
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """K1/K2: Parquet files, exactly-once through the checkpoint (append mode only)."""
    if output_mode != "append":
        raise ValueError("the Parquet file sink supports append mode only")
    return _writer(df, "append", checkpoint, trigger, query_name).format("parquet").option("path", path).start()


def start_console_sink(
    df: DataFrame,
    output_mode: str = "update",
    checkpoint: str | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
    truncate: bool = False,
) -> StreamingQuery:
    """K3/K4: print each micro-batch (collects to the driver: demos and tests only)."""
    return (
        _writer(df, output_mode, checkpoint, trigger, query_name)
        .format("console")
        .option("truncate", str(truncate).lower())
        .start()
    )


def start_update_parquet_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "update",
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Update/complete-mode rows to Parquet, one folder per micro-batch
    (``<path>/batch_id=<n>``).  A retried batch overwrites its own folder, so the
    output stays exactly-once; readers keep the latest row per key."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _writer(df, output_mode, checkpoint, trigger, query_name).foreachBatch(write_batch).start()


def start_sink(
    df: DataFrame,
    sink: str,
    output_mode: str,
    path: str | None,
    checkpoint: str | None,
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Selectable sink: ``parquet`` (append), ``parquet_updates`` (update), ``parquet_upserts`` (update, one row
    per key), ``console``."""
    if sink == "parquet":
        return start_parquet_sink(df, path, checkpoint, output_mode, trigger, query_name)
    if sink == "parquet_updates":
        return start_update_parquet_sink(df, path, checkpoint, output_mode, trigger, query_name)
    if sink == "parquet_upserts":
        return start_upsert_sink(df, path, checkpoint, None, trigger, query_name)
    if sink == "console":
        return start_console_sink(df, output_mode, checkpoint, trigger, query_name)
    raise ValueError(f"unknown sink {sink!r} (expected parquet|parquet_updates|parquet_upserts|console)")
