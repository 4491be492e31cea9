"""Session paths of a stream, on time, without a state entry per user.

``session_window`` keeps the whole open session of a user in one state entry.  Here the state is a
table of *open cells*: (user, second, page) counts of the sessions that the watermark
has not closed yet.  Every micro-batch

1. drops rows without time and rows that are late (``t + gap <= watermark`` of the batches before,
   as ``session_window`` does), and counts the rest into cells;
2. adds the cells that were open before, and moves the watermark by the largest time it saw;
3. finds the sessions of the pool with the chunked plan of ``operators.sessions``, in which a user
   is spread over its chunks and only thin rows (first and last second) are ordered per user;
4. appends the sessions that end at or before the watermark to the output, as rows of K2
   (userId, sessionStart, sessionEnd, path);
5. writes the cells of the others as the next open table.

So a session is out after the batch that closes it, a late row that extends a session which is
out starts another, and one that joins two open sessions merges them -- the results of
``session_window`` (which needs a batch without data after each batch for the same).

Exactly once.  Every folder is named by the batch id and written with overwrite, from the
open table of the batch before, so a batch that is replayed after a crash gives the same rows in
the same place.  ``log/batch=<n>`` (watermark, counts, gap) is written last and marks the batch as
done: readers take the sessions of done batches only.  The state lies in the
checkpoint folder; its size is that of the open sessions, not of the history.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.sessions import _gap_seconds, sessions_from_cells
from ..schema import DEFAULT_SESSION_GAP_MINUTES, EVENT_TIME

CELLS = "uk string, un boolean, s long, pageUrl string, n long"
CELL_COLUMNS = ("uk", "un", "s", "pageUrl")
SESSION_SCHEMA = T.StructType([
    T.StructField("userId", T.StringType()), T.StructField("sessionStart", T.TimestampType()),
    T.StructField("sessionEnd", T.TimestampType()), T.StructField("path", T.ArrayType(T.StringType()))])
LOG_SCHEMA = "watermark long, rows long, late long, untimed long, sessions long, gap long, delay long"

_FRESH_SQL = """
SELECT coalesce(userId, '') AS uk, userId IS NULL AS un, unix_seconds(eventTime) AS s, pageUrl, count(1) AS n
FROM {events} GROUP BY 1, 2, 3, 4
"""

# The chunks whose session has ended at the watermark.  Rows per user in the windows are one per chunk (a gap long);
# a chunk never holds a session break (see operators.sessions).
_CLOSED_SQL = """
WITH chunks AS (
  SELECT uk, un, coalesce(floor(s / {gap}), 0) AS chunk, min(s) AS first_s, max(s) AS last_s FROM {cells} GROUP BY 1, 2, 3),
linked AS (
  SELECT *, coalesce(lag(chunk) OVER w = chunk - 1 AND first_s - lag(last_s) OVER w <= {gap}, false) AS continues
  FROM chunks WINDOW w AS (PARTITION BY uk, un ORDER BY chunk)),
starts AS (
  SELECT uk, un, chunk, last_s, last(CASE WHEN NOT continues THEN first_s END, true) OVER (
    PARTITION BY uk, un ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS start_s
  FROM linked),
ended AS (
  SELECT uk, un, start_s FROM starts GROUP BY uk, un, start_s HAVING max(last_s) + {gap} <= {watermark})
SELECT uk, un, chunk FROM starts JOIN ended USING (uk, un, start_s)
"""


class OpenSessions:
    """The open cells and the log of one streaming query, below its checkpoint."""

    def __init__(self, spark: SparkSession, out: str, checkpoint: str, gap_minutes: float, delay_minutes: float | None = None):
        self.spark, self.out, self.state = spark, out.rstrip("/"), f"{checkpoint.rstrip('/')}/open_sessions"
        self.gap = _gap_seconds(gap_minutes)
        # the job's watermark delay: R11
        self.delay = 60 * max(1, int(gap_minutes)) if delay_minutes is None else int(60 * delay_minutes)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self, name: str):
        return self._path(name).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def done(self) -> list[int]:
        """The batches whose log entry is complete."""
        return done_batches(self.spark, self.state)

    def log(self, batch: int):
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.state}/log/batch={batch}").first()

    # ---- one micro-batch
    def advance(self, events: DataFrame, batch: int) -> None:
        before = batch - 1 if batch - 1 in self.done() else None
        if batch > 0 and before is None:
            raise ValueError(f"{self.state} has no batch {batch - 1}")
        last = None if before is None else self.log(before)
        if last is not None and (last["gap"], last["delay"]) != (self.gap, self.delay):
            raise ValueError(f"{self.state} has a gap of {last['gap']} s and a delay of {last['delay']} s, not {self.gap} s and {self.delay} s")
        pool, seen = self._pool(events, batch, before, last)
        top = seen["top"]
        watermark = None if last is None else last["watermark"]
        if top is not None:
            watermark = max(top - self.delay, top - self.delay if watermark is None else watermark)
        closed = None if watermark is None else self.spark.sql(_CLOSED_SQL, cells=pool, gap=self.gap, watermark=int(watermark))
        sessions = self._write_sessions(pool, closed, batch)
        self._write_open(pool, closed, batch)
        entry = [(watermark, seen["rows"], seen["late"], seen["untimed"], sessions, self.gap, self.delay)]
        self.spark.createDataFrame(entry, LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.state}/log/batch={batch}")
        self._clean(batch)

    def _pool(self, events: DataFrame, batch: int, before: int | None, last) -> tuple[DataFrame, dict]:
        """The batch's cells and the open ones, written once; and what was seen on the way.

        Late and untimed rows are counted in the same pass, as cells of their own.
        """
        mark = None if last is None else last["watermark"]
        late = f"coalesce(s + {self.gap} <= {mark}, false)" if mark is not None else "false"
        cells = self.spark.sql(_FRESH_SQL, events=events.select("userId", EVENT_TIME, "pageUrl")).selectExpr(*CELL_COLUMNS, f"{late} AS late", "n", "n AS fresh")
        if before is not None:
            opened = self._open(before).selectExpr(*CELL_COLUMNS, "false AS late", "n", "0L AS fresh")
            cells = cells.unionAll(opened).groupBy(*CELL_COLUMNS, "late").agg(F.sum("n").alias("n"), F.sum("fresh").alias("fresh"))
        path = f"{self.state}/pool/batch={batch}"
        cells.write.mode("overwrite").parquet(path)
        pool = self.spark.read.schema(f"{CELLS}, late boolean, fresh long").parquet(path)
        seen = pool.agg(
            F.coalesce(F.sum("fresh"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(F.col("late"), F.col("fresh"))), F.lit(0)).alias("late"),
            F.coalesce(F.sum(F.when(F.col("s").isNull(), F.col("fresh"))), F.lit(0)).alias("untimed"),
            F.max(F.when(F.col("fresh") > 0, F.col("s"))).alias("top")).first().asDict()
        return pool.filter("NOT late AND s IS NOT NULL").select(*CELL_COLUMNS, "n"), seen

    def _open(self, batch: int) -> DataFrame:
        return self.spark.read.schema(CELLS).parquet(f"{self.state}/open/batch={batch}")

    def _chunked(self, cells: DataFrame) -> DataFrame:
        return cells.withColumn("chunk", F.coalesce(F.floor(F.col("s") / self.gap), F.lit(0)))

    def _write_sessions(self, pool: DataFrame, closed: DataFrame | None, batch: int) -> int:
        final = pool.limit(0) if closed is None else self._chunked(pool).join(closed, ["uk", "un", "chunk"], "left_semi").select(pool.columns)
        path = f"{self.out}/batch_id={batch}"
        sessions_from_cells(final, self.gap / 60).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(SESSION_SCHEMA).parquet(path).count()

    def _write_open(self, pool: DataFrame, closed: DataFrame | None, batch: int) -> None:
        rest = pool if closed is None else self._chunked(pool).join(closed, ["uk", "un", "chunk"], "left_anti").select(pool.columns)
        rest.write.mode("overwrite").parquet(f"{self.state}/open/batch={batch}")

    def _clean(self, batch: int) -> None:
        """Pools go at once; the open table of the batch before stays for a replay."""
        fs = self._fs(self.state)
        fs.delete(self._path(f"{self.state}/pool/batch={batch}"), True)
        top = self._path(f"{self.state}/open")
        for s in fs.listStatus(top):
            m = re.fullmatch(r"batch=(\d+)", s.getPath().getName())
            if m and int(m.group(1)) < batch - 1:
                fs.delete(s.getPath(), True)


def start_open_sessions(
    events: DataFrame,
    out: str,
    checkpoint: str,
    gap_minutes: float = DEFAULT_SESSION_GAP_MINUTES,
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """K2 rows of final sessions below ``out`` (a folder per batch); read them with ``read_session_batches``."""
    _gap_seconds(gap_minutes)

    def advance(batch: DataFrame, batch_id: int) -> None:
        OpenSessions(batch.sparkSession, out, checkpoint, gap_minutes).advance(batch, batch_id)

    w = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(advance)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def done_batches(spark: SparkSession, state: str) -> list[int]:
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/log")
    fs = top.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(top):
        return []
    numbers = [int(m.group(1)) for s in fs.listStatus(top) if (m := re.fullmatch(r"batch=(\d+)", s.getPath().getName()))]
    return sorted(n for n in numbers if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{state}/log/batch={n}/_SUCCESS")))


def read_session_batches(spark: SparkSession, out: str, checkpoint: str) -> DataFrame:
    """The sessions of all done batches: ``userId, sessionStart, sessionEnd, path``."""
    done = done_batches(spark, f"{checkpoint.rstrip('/')}/open_sessions")
    rows = spark.createDataFrame([], SESSION_SCHEMA)
    if done:
        # one scan over the folder; batches that are not done are pruned as partitions
        schema = T.StructType([*SESSION_SCHEMA.fields, T.StructField("batch_id", T.LongType())])
        rows = spark.read.schema(schema).parquet(out).filter(F.col("batch_id") <= done[-1]).drop("batch_id")
    return rows


def session_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """batch, watermark (timestamp), rows, late, untimed, sessions of every done batch."""
    state = f"{checkpoint.rstrip('/')}/open_sessions"
    done = done_batches(spark, state)
    if not done:
        return spark.createDataFrame([], "batch long, watermark timestamp, rows long, late long, untimed long, sessions long")
    schema = f"{LOG_SCHEMA}, batch long"
    return spark.read.schema(schema).parquet(f"{state}/log").filter(F.col("batch") <= done[-1]).select(
        "batch", F.timestamp_seconds("watermark").alias("watermark"), "rows", "late", "untimed", "sessions")


def open_sessions_watermark(spark: SparkSession, checkpoint: str) -> str | None:
    """The watermark after the last done batch (ISO text, UTC)."""
    state = f"{checkpoint.rstrip('/')}/open_sessions"
    done = done_batches(spark, state)
    row = spark.read.schema(LOG_SCHEMA).parquet(f"{state}/log/batch={done[-1]}").first() if done else None
    return None if row is None or row["watermark"] is None else dt.datetime.fromtimestamp(row["watermark"], dt.UTC).isoformat()
