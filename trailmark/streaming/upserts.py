"""Windowed results as a table with one row per key (K3, W7): days that are merged while open, then sealed.

In update mode a window's row comes again whenever it changes.  Here a micro-batch is merged with
the stored rows of the days its windows start on (UTC), and only these days are written again;
all others stay the files they are.  A day is sealed once the watermark is a day past its end (a
window may be up to a day long): no row can come for it any more, and it is never rewritten.

Layout below the table's folder::

    fresh/batch=<id>/day=<d>/    the rows of the batch being merged
    rows/batch=<id>/day=<d>/     the merged rows of the days that a batch touched
    log/version=<id>/            for each day the batch that holds its rows, and whether it is sealed

A version counts once its folder holds ``_SUCCESS``.  Its rows are written before it and from the version before, so a
batch that is replayed after a crash writes the same rows to the same place, and one that had committed is passed over.
The version also names the streaming query; another checkpoint, whose batch ids start again, is an error.
Folders leave the disk ``KEEP_VERSIONS`` commits after they left the log, so a reader may finish on its version.

Rows are spread by key.  The driver holds the log only: one row per day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .deltas import QUERY_ID
from .folders import VersionedFolder

KEEP_VERSIONS = 4
DAY_SECONDS = 86_400
#: The column that is no key, of the library's windowed results.
COUNT = "count"

LOG_SCHEMA = "day string, batch long, sealed boolean, query string"
# whole days since the epoch: no session time zone
_DAY_SQL = f"cast(date_add(DATE'1970-01-01', cast(floor(unix_seconds(window.start) / {DAY_SECONDS}) AS int)) AS string) AS day"


class Day(NamedTuple):
    """Where the rows of a day are, and whether they are final."""

    batch: int
    sealed: bool


class TableVersion(NamedTuple):
    """The table after a batch."""

    batch: int
    query: str | None
    days: dict[str, Day]


EMPTY_TABLE = TableVersion(-1, None, {})


def _closed(day: str, watermark: float) -> bool:
    start = dt.datetime.fromisoformat(day).replace(tzinfo=dt.UTC).timestamp()
    return start + 2 * DAY_SECONDS <= watermark


class UpsertTable(VersionedFolder):
    """The latest row per key of a windowed result (column ``window``); one writer, any number of readers.

    ``keys`` are all columns but ``count`` unless given.  NULL is a key like any other.  Of rows that repeat a key inside one
    batch, which update mode does not give, the greatest counts.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str] | None = None):
        super().__init__(spark, path)
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
        self.keys = keys or [n for n in schema.names if n != COUNT]
        if "window" not in self.keys:
            raise ValueError("an upsert table needs the key 'window'")

    # ---- versions
    def version(self, number: int | None = None) -> TableVersion:
        """A committed version (the newest unless named), numbered by its batch."""
        there = self.versions()
        if number is None:
            if not there:
                return EMPTY_TABLE
            number = there[-1]
        if number not in there:
            raise ValueError(f"{self.path} has no version {number}")
        rows = self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/log/version={number}").collect()
        return TableVersion(number, rows[0]["query"], {r["day"]: Day(r["batch"], r["sealed"]) for r in rows if r["day"] is not None})

    def _commit(self, version: TableVersion) -> None:
        # the first row has no day, so that a table without rows has a log too
        rows = [(None, None, None, version.query)] + [(day, *where, version.query) for day, where in sorted(version.days.items())]
        self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/log/version={version.batch}")

    # ---- writing
    def append(self, rows: DataFrame, batch: int, query: str | None = None, watermark: float | None = None) -> TableVersion:
        """Merge the rows of a batch; ``watermark`` (epoch seconds) is the one the batch ran with."""
        last = self.version()
        if last.query is not None and query is not None and last.query != query:
            raise ValueError(f"{self.path} belongs to the streaming query {last.query}, not {query}: a new checkpoint needs a new table")
        if batch <= last.batch:
            return last
        fresh = f"fresh/batch={batch}"
        # written first: the batch is computed once, and its days are the folders
        rows.selectExpr(*self.schema.names, _DAY_SQL).write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/{fresh}")
        touched = sorted(n.removeprefix("day=") for n in self._listed(fresh) if n.startswith("day="))
        late = [day for day in touched if day in last.days and last.days[day].sealed]
        if late:
            raise ValueError(f"batch {batch} has rows of sealed days: {', '.join(late)}")
        if touched:
            self._merge([f"{fresh}/day={day}" for day in touched], [_folder(day, last.days[day]) for day in touched if day in last.days], batch)
        days = last.days | {day: Day(batch, False) for day in touched}
        if watermark is not None:
            days = {day: where._replace(sealed=where.sealed or _closed(day, watermark)) for day, where in days.items()}
        version = TableVersion(batch, query or last.query, days)
        self._commit(version)
        self._clean(version)
        return version

    def _merge(self, fresh: list[str], stored: list[str], batch: int) -> None:
        rows = self._rows(fresh).withColumn("newer", F.lit(True))
        if stored:
            rows = rows.unionByName(self._rows(stored).withColumn("newer", F.lit(False)))
        values = [n for n in self.schema.names if n not in self.keys]
        latest = rows.groupBy(*self.keys).agg(F.max(F.struct("newer", *values)).alias("latest"))
        columns = [n if n in self.keys else f"latest.`{n}` AS `{n}`" for n in self.schema.names]
        latest.selectExpr(*columns, _DAY_SQL).write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/rows/batch={batch}")

    def _clean(self, newest: TableVersion) -> None:
        """Remove what only versions out of reach needed: their folders first, so that a crash leaves nothing behind."""
        fs, there = self._fs(), self.versions()
        kept = there[-KEEP_VERSIONS:]
        needed = {_folder(day, where) for n in kept for day, where in (newest if n == newest.batch else self.version(n)).days.items()}
        for n in there[:-KEEP_VERSIONS]:
            for folder in {_folder(day, where) for day, where in self.version(n).days.items()} - needed:
                fs.delete(self._path(folder), True)
            fs.delete(self._path(f"log/version={n}"), True)
        fs.delete(self._path("fresh"), True)

    # ---- reading
    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, days: Iterable[str] | None = None, open_only: bool = False, version: int | None = None) -> DataFrame:
        """The rows, one per key: of all days, of some (``yyyy-mm-dd``), or of those that may still change."""
        wanted = None if days is None else set(days)
        there = self.version(version).days
        return self._rows([_folder(day, where) for day, where in sorted(there.items())
                           if (wanted is None or day in wanted) and not (open_only and where.sealed)])


def _folder(day: str, where: Day) -> str:
    return f"rows/batch={where.batch}/day={day}"


def batch_watermark(spark: SparkSession, checkpoint: str, batch: int) -> float | None:
    """The watermark (epoch seconds) a micro-batch runs with, from the query's log of offsets; none before the first."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch}").filter("value LIKE '{%'")
    ms = lines.agg(F.max(F.get_json_object("value", "$.batchWatermarkMs").cast("long")).alias("ms")).first()["ms"]
    return ms / 1000 if ms else None


def start_upsert_sink(df: DataFrame, path: str, checkpoint: str, keys: list[str] | None = None, trigger: dict | None = None,
                      query_name: str | None = None) -> StreamingQuery:
    """Keep a windowed result (update mode) as an ``UpsertTable``; read it with ``UpsertTable(spark, path, schema).read()``."""
    schema = df.schema

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = UpsertTable(spark, path, schema, keys)
        table.append(batch, batch_id, spark.sparkContext.getLocalProperty(QUERY_ID), batch_watermark(spark, checkpoint, batch_id))

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(merge)
    if query_name:
        writer = writer.queryName(query_name)
    return (writer.trigger(**trigger) if trigger else writer).start()
