"""Cumulative snapshots of all-time results (K5, K6, K7).

Each trigger writes the whole current result as JSON lines to
``<out>/snapshot_id=<batch id>``.  The batch id, not the wall clock, names the
snapshot, so a retried batch overwrites itself.  Snapshots are all-time (the
reference labels them "last 5s" but accumulates from the start).

``start_path_fragments`` is the bounded-state alternative for the paths: minute
fragments are final once the watermark passes them and are appended to Parquet;
paths are assembled from that table when needed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.events import fill_event_defaults, with_event_watermark
from ..operators.heatmap import click_heatmap_total
from ..operators.user_paths import assemble_user_paths, user_path_fragments
from ..schema import DEFAULT_SESSION_GAP_MINUTES, EVENT_TIME

SNAPSHOT_TRIGGER = {"processingTime": "5 seconds"}  # K7

PATH_SNAPSHOT_SCHEMA = T.StructType(
    [T.StructField("userId", T.StringType()), T.StructField("path", T.ArrayType(T.StringType()))]
)
HEATMAP_SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("pageUrl", T.StringType()),
        T.StructField("element", T.StringType()),
        T.StructField("xBucket", T.IntegerType()),
        T.StructField("yBucket", T.IntegerType()),
        T.StructField("count", T.LongType()),
    ]
)


def _start(df: DataFrame, to_rows, out: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    def write_snapshot(batch: DataFrame, batch_id: int) -> None:
        to_rows(batch).write.mode("overwrite").json(f"{out}/snapshot_id={batch_id}")

    return (
        df.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or SNAPSHOT_TRIGGER))
        .foreachBatch(write_snapshot)
        .start()
    )


def start_path_snapshots(events: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """K5: ``{"userId", "path": [...]}`` per user.  The state is the per-(user, chunk)
    fragment set; each snapshot assembles the paths as a batch job."""
    return _start(user_path_fragments(events), assemble_user_paths, out, checkpoint, trigger)


def start_heatmap_snapshots(events: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """K6: ``{"pageUrl","element","xBucket","yBucket","count"}`` per cell."""
    return _start(click_heatmap_total(events), lambda b: b, out, checkpoint, trigger)


FRAGMENT_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("chunk", T.TimestampType()),
        T.StructField(
            "cells",
            T.ArrayType(T.StructType([T.StructField("timestamp", T.LongType()),
                                      T.StructField("pageUrl", T.StringType())])),
        ),
    ]
)


def start_path_fragments(
    events: DataFrame,
    out: str,
    checkpoint: str,
    session_timeout_minutes: int = DEFAULT_SESSION_GAP_MINUTES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """A6 with bounded state: per (user, minute of event time) the distinct
    (timestamp, page) pairs, appended to Parquet once the watermark closes the
    minute.  State holds only minutes younger than the watermark delay (instead of
    all history, as the complete-mode snapshot does); rows later than the
    watermark and rows without event time are dropped, as in every other
    streaming result.  Read the paths with ``read_fragment_paths``.
    """
    wm = with_event_watermark(events, session_timeout_minutes)
    ev = fill_event_defaults(wm).filter(F.col("pageUrl") != F.lit(""))
    frags = ev.groupBy("userId", F.window(EVENT_TIME, "1 minute").alias("w")).agg(
        F.collect_set(F.struct("timestamp", "pageUrl")).alias("cells")
    )
    return (
        frags.select("userId", F.col("w.start").alias("chunk"), "cells")
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or SNAPSHOT_TRIGGER))
        .start()
    )


def read_fragment_paths(spark: SparkSession, out: str) -> DataFrame:
    """``userId, path`` assembled (as a batch job) from the fragments written so far."""
    minute = F.expr("unix_seconds(chunk) div 60").alias("chunk")
    return assemble_user_paths(spark.read.schema(FRAGMENT_SCHEMA).parquet(out).select("userId", minute, "cells"))


def latest_snapshot_id(spark: SparkSession, out: str) -> int | None:
    """The newest snapshot whose writer has committed (its folder holds ``_SUCCESS``).

    Lists the snapshot folders only, not their files, and looks into the newest ones
    until one is complete.
    """
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(out)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return None
    names = (s.getPath().getName() for s in fs.listStatus(top) if s.isDirectory())
    ids = sorted((int(m.group(1)) for n in names if (m := re.fullmatch(r"snapshot_id=(\d+)", n))), reverse=True)
    return next((i for i in ids if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{out}/snapshot_id={i}/_SUCCESS"))), None)


def read_latest_snapshot(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The newest complete snapshot under ``out`` (empty result if none was written).

    A snapshot that is being written, or whose writer failed, is passed over.
    """
    newest = latest_snapshot_id(spark, out)
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{out}/snapshot_id={newest}")
