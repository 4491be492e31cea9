"""Skew-safe streaming session paths (bounded, spread state).

``session_window`` keeps one state entry per user: a user holding a third of the
stream is one state partition, and its open session holds every event.  Here the
stateful step is only the (user, second, page) count: state keys spread a hot
user over seconds, identical copies collapse into a count, and a row is appended
to Parquet once the watermark passes its second.  Sessions are stitched from that
table by the batch chunked plan.

Late rows.  ``session_window`` drops a row once ``t + gap <= watermark`` (its own session
would be closed).  The cells' watermark is therefore one gap behind the job's, so a
row is late here under the same condition.  A session is final once ``sessionEnd <=`` that
later watermark: every row that could extend it lies at or before its end and so is
either written or late.  Two differences remain: rows come one gap later, and
a late row that extends a session which ``session_window`` has already emitted is merged
here but starts a second, overlapping session there.

The gap is stored beside the cells (``<out>_gap``) and checked by writers and readers, chunks and
days follow from epoch seconds alone, and the watermark can be read from the
checkpoint after a restart (``checkpoint_watermark``).
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.sessions import _gap_seconds, sessions_from_cells
from ..schema import DEFAULT_SESSION_GAP_MINUTES, EVENT_TIME

DAY_SECONDS = 86_400

CELL_SCHEMA = T.StructType(
    [
        T.StructField("uk", T.StringType()),
        T.StructField("un", T.BooleanType()),
        T.StructField("s", T.LongType()),
        T.StructField("pageUrl", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("day", T.LongType()),  # partition column of the cell table: days since the epoch
    ]
)


def start_session_cells(
    events: DataFrame,
    out: str,
    checkpoint: str,
    gap_minutes: float = DEFAULT_SESSION_GAP_MINUTES,
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append (user, second, page) counts to Parquet once the watermark passes the second."""
    gap_s = _gap_seconds(gap_minutes)
    _store_gap(events.sparkSession, out, gap_s)
    delay_s = 60 * max(1, int(gap_minutes)) + gap_s  # the job's watermark delay, and a gap
    wm = events.withWatermark(EVENT_TIME, f"{delay_s} seconds")
    # NULL event time would be a key the watermark never evicts; such rows form no session anyway.
    timed = wm.filter(F.col(EVENT_TIME).isNotNull())
    counts = timed.groupBy("userId", EVENT_TIME, "pageUrl").agg(F.count(F.lit(1)).alias("n"))
    cells = counts.select(
        F.coalesce(F.col("userId"), F.lit("")).alias("uk"),
        F.col("userId").isNull().alias("un"),
        F.unix_seconds(EVENT_TIME).alias("s"),
        "pageUrl",
        "n",
        F.floor(F.unix_seconds(EVENT_TIME) / F.lit(DAY_SECONDS)).alias("day"),
    )
    # partitioned by day, so a reader of recent sessions prunes old cells
    w = cells.writeStream.outputMode("append").format("parquet").option("path", out).partitionBy("day")
    w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def _gap_path(out: str) -> str:
    return f"{out.rstrip('/')}_gap"


def _stored_gap(spark: SparkSession, out: str) -> int | None:
    try:
        row = spark.read.schema("gap_seconds long").parquet(_gap_path(out)).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if row is None else row["gap_seconds"]


def _store_gap(spark: SparkSession, out: str, gap_s: int) -> None:
    stored = _stored_gap(spark, out)
    if stored is None:
        spark.range(1).select(F.lit(gap_s).cast("long").alias("gap_seconds")).write.mode("overwrite").parquet(_gap_path(out))
    elif stored != gap_s:
        raise ValueError(f"the cells in {out} have a gap of {stored} s, not {gap_s} s")


def query_watermark(query: StreamingQuery) -> str:
    """The event-time watermark of a query's last micro-batch (ISO text, UTC)."""
    progress = query.lastProgress or {}
    found = (progress.get("eventTime") or {}).get("watermark")
    if found is None:
        raise ValueError("the query has run no micro-batch since it started; use checkpoint_watermark")
    return found


def checkpoint_watermark(spark: SparkSession, checkpoint: str) -> str:
    """The watermark of the last committed micro-batch, from a query's checkpoint (ISO text, UTC)."""
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/offsets").select(name.alias("batch"), "value").filter("value LIKE '{%'")
    done = spark.read.text(f"{checkpoint.rstrip('/')}/commits").select(name.alias("batch")).distinct()
    ms = F.get_json_object("value", "$.batchWatermarkMs").cast("long")
    row = lines.join(done, "batch").agg(F.max(ms).alias("ms")).first()
    if row is None or row["ms"] is None:
        raise ValueError(f"no committed micro-batch in {checkpoint}")
    return dt.datetime.fromtimestamp(row["ms"] / 1000, dt.UTC).isoformat()


def _seconds_of(text: str | None, name: str) -> float:
    """Epoch seconds of ISO text that names its zone."""
    if text is None:
        raise ValueError(f"{name} is needed: an ISO time with a zone")
    when = dt.datetime.fromisoformat(text)
    if when.tzinfo is None:
        raise ValueError(f"{name} needs a zone, such as 2024-01-01T00:00:00Z: {text!r}")
    return when.timestamp()


def read_stream_sessions(
    spark: SparkSession,
    out: str,
    until: str,
    gap_minutes: float | None = None,
    since: str | None = None,
) -> DataFrame:
    """Final sessions from the cell table: ``sessionEnd <= until`` (the query's watermark).

    ``gap_minutes`` may be left out; a gap other than the stored one is an error.  With ``since``, only
    sessions starting at or after it, reading only cells from ``since - 2 gaps`` on (day
    partitions before that are pruned): the chunk before a session's first chunk lies
    inside that range, so a session that really started earlier is recognised and
    left out, and every returned row is exact.
    """
    end_s = _seconds_of(until, "until")
    gap_s = _stored_gap(spark, out)
    if gap_s is None:
        raise ValueError(f"no stored gap beside {out}: was it written by start_session_cells?")
    if gap_minutes is not None and _gap_seconds(gap_minutes) != gap_s:
        raise ValueError(f"the cells in {out} have a gap of {gap_s} s, not {_gap_seconds(gap_minutes)} s")
    cells = spark.read.schema(CELL_SCHEMA).parquet(out)
    if since is not None:
        start_s = _seconds_of(since, "since")
        lower = math.floor(start_s) - 2 * gap_s
        cells = cells.filter((F.col("day") >= lower // DAY_SECONDS) & (F.col("s") >= lower))
    sessions = sessions_from_cells(cells, gap_s / 60).filter(F.unix_seconds("sessionEnd") <= end_s)
    if since is not None:
        sessions = sessions.filter(F.unix_seconds("sessionStart") >= start_s)
    return sessions


def write_stream_sessions(spark: SparkSession, out: str, until: str, target: str, since: str | None = None) -> None:
    """K2 rows (userId, sessionStart, sessionEnd, path) of the final sessions, as Parquet."""
    read_stream_sessions(spark, out, until, since=since).write.mode("overwrite").parquet(target)
