"""All-time results as a log of deltas (A4-A6, K5, K6 without ``complete`` mode).

A micro-batch is aggregated alone (no streaming state) and written as one immutable
*segment*; a later result is the merge of all live segments.  When ``FANOUT`` segments of a
level have gathered they are merged into one of the next level, so a row is rewritten once per
level (a logarithmic number of times) instead of with every trigger.

Layout below the store's folder::

    segments/<id>/part-*.parquet     a batch's or a compaction's rows
    log/version=<n>/part-*.parquet   the live segments and the last batch after n commits

A version counts once its folder holds ``_SUCCESS``.  A batch's segment is named by the batch id
and written before its version, so a batch that is replayed after a crash overwrites its own
segment, and one that had committed is passed over.  The version also names the
streaming query: another checkpoint, whose batch ids start again, is an error instead of silently
passed-over batches.  Segments leave the disk ``KEEP_VERSIONS`` commits after they left the log,
so a reader may finish on the version it started with.

``Mergeable`` says how rows combine; ``HEATMAP``, ``ERRORS`` and ``PATHS`` are the three
results, ``ARRIVAL_PATHS`` the paths in the order of the topic.  Rows are spread by key (a hot user by its time chunks), nothing is collected
but the log (one row per live segment).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.errors import error_totals, errors_by_count
from ..operators.heatmap import click_heatmap_total, top_heatmap
from ..operators.user_paths import DEFAULT_CHUNK_MS, arrival_fragments, assemble_user_paths, preview_user_paths, user_path_fragments
from ..schema import HEATMAP_KEYS, PREVIEW_USERS, TOP_HEATMAP_CELLS
from .folders import VersionedFolder

FANOUT, KEEP_VERSIONS = 4, 4

LOG_SCHEMA = "segment string, level int, first_batch long, last_batch long, batch long, query string"
QUERY_ID = "sql.streaming.queryId"


class Mergeable(NamedTuple):
    """A result whose parts can be merged: the rows of some events, and the rows of several parts."""

    name: str
    part: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    result: Callable[[DataFrame], DataFrame]
    schema: T.StructType


def _sum_by(*keys: str) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: rows.groupBy(*keys).agg(F.sum("count").alias("count"))


def _merge_fragments(*keys: str) -> Callable[[DataFrame], DataFrame]:
    cells = "array_distinct(flatten(collect_list(cells))) AS cells"
    return lambda rows: rows.groupBy(*keys).agg(F.expr(cells))


def _same(rows: DataFrame) -> DataFrame:
    return rows


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_CELLS = T.ArrayType(_schema(("timestamp", T.LongType()), ("pageUrl", T.StringType())))
HEATMAP = Mergeable("heatmap", click_heatmap_total, _sum_by(*HEATMAP_KEYS), _same, _schema(
    ("pageUrl", T.StringType()), ("element", T.StringType()), ("xBucket", T.IntegerType()), ("yBucket", T.IntegerType()),
    ("count", T.LongType())))
ERRORS = Mergeable("errors", error_totals, _sum_by("pageUrl"), _same, _schema(("pageUrl", T.StringType()), ("count", T.LongType())))
PATHS = Mergeable("paths", lambda events: user_path_fragments(events, DEFAULT_CHUNK_MS), _merge_fragments("userId", "chunk"), assemble_user_paths, _schema(
    ("userId", T.StringType()), ("chunk", T.LongType()), ("cells", _CELLS)))
ARRIVAL_PATHS = Mergeable("arrival_paths", arrival_fragments, _merge_fragments("userId", "lane", "chunk"), assemble_user_paths, _schema(
    ("userId", T.StringType()), ("lane", T.IntegerType()), ("chunk", T.LongType()),
    ("cells", T.ArrayType(_schema(("position", T.LongType()), ("pageUrl", T.StringType()))))))
#: The paths of each order.
PATHS_BY = {"time": PATHS, "arrival": ARRIVAL_PATHS}


class Segment(NamedTuple):
    segment: str
    level: int
    first_batch: int
    last_batch: int


class Version(NamedTuple):
    """The live segments after a commit; ``batch`` is the last one in them, ``query`` the writer's id."""

    number: int
    batch: int
    query: str | None
    segments: tuple[Segment, ...]


EMPTY = Version(-1, -1, None, ())


class DeltaStore(VersionedFolder):
    """A result kept as segments below ``path``; one writer, any number of readers."""

    def __init__(self, spark: SparkSession, path: str, kind: Mergeable, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError(f"fanout must be at least 2, got {fanout}")
        super().__init__(spark, path)
        self.kind, self.fanout = kind, fanout
        self.opened: dict[str, DataFrame] = {}

    # ---- versions
    def version(self, number: int | None = None) -> Version:
        """A committed version (the newest unless named)."""
        there = self.versions()
        if number is None:
            number = there[-1] if there else None
        if number is None:
            return EMPTY
        if number not in there:
            raise ValueError(f"{self.path} has no version {number}")
        rows = self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/log/version={number}").collect()
        segments = sorted((Segment(r["segment"], r["level"], r["first_batch"], r["last_batch"]) for r in rows), key=lambda s: s.first_batch)
        return Version(number, rows[0]["batch"], rows[0]["query"], tuple(segments))

    def _commit(self, version: Version) -> None:
        rows = [(*s, version.batch, version.query) for s in version.segments]
        self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/log/version={version.number}")

    # ---- writing
    def append(self, events: DataFrame, batch: int, query: str | None = None) -> Version:
        """Add the events of a batch; a batch that was committed before is passed over."""
        last = self.version()
        if last.query is not None and query is not None and last.query != query:
            raise ValueError(f"{self.path} belongs to the streaming query {last.query}, not {query}: a new checkpoint needs a new store")
        if batch <= last.batch:
            return last
        added = Segment(f"batch-{batch:020d}", 0, batch, batch)
        self._write(self.kind.part(events), added)
        version = Version(last.number + 1, batch, query or last.query, (*last.segments, added))
        self._commit(version)
        return self.compact(version)

    def _write(self, rows: DataFrame, segment: Segment) -> None:
        columns = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.kind.schema])
        columns.write.mode("overwrite").parquet(f"{self.path}/segments/{segment.segment}")

    def compact(self, version: Version) -> Version:
        """Merge every level that is full, lowest first, and remove what no kept version needs."""
        level = 0
        while level <= max(s.level for s in version.segments):
            full = [s for s in version.segments if s.level == level]
            if len(full) >= self.fanout:
                merged = Segment(f"level-{level + 1}-{version.number + 1:020d}", level + 1, full[0].first_batch, full[-1].last_batch)
                self._write(self.kind.merge(self._rows(full)), merged)
                kept = tuple(s for s in version.segments if s.level != level)
                version = version._replace(number=version.number + 1, segments=tuple(sorted((*kept, merged), key=lambda s: s.first_batch)))
                self._commit(version)
            level += 1
        self._clean(version)
        return version

    def _clean(self, newest: Version) -> None:
        fs, there = self._fs(), self.versions()
        kept = [n for n in there if n > newest.number - KEEP_VERSIONS]
        needed = {s.segment for n in kept for s in self.version(n).segments}
        for name in self._listed("segments"):
            if name not in needed:
                fs.delete(self._path(f"segments/{name}"), True)
        for n in there:
            if n not in kept:
                fs.delete(self._path(f"log/version={n}"), True)

    # ---- reading
    def _rows(self, segments: list[Segment] | tuple[Segment, ...]) -> DataFrame:
        parts = [self.spark.read.schema(self.kind.schema).parquet(f"{self.path}/segments/{s.segment}") for s in segments]
        return self._union(parts)

    def _union(self, parts: list[DataFrame]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.kind.schema)
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionAll(p)
        return rows

    def read(self, version: int | None = None) -> DataFrame:
        """The merged result.  Segments that this reader has opened before are not opened again."""
        live = self.version(version).segments
        self.opened = {s.segment: self.opened.get(s.segment) or self._rows([s]) for s in live}
        return self.kind.result(self.kind.merge(self._union(list(self.opened.values()))))

    def rows(self) -> DataFrame:
        """The merged parts, before they become results."""
        self.read()
        return self.kind.merge(self._union(list(self.opened.values())))

    def changes(self, since: int) -> DataFrame:
        """Merged rows of the batches after batch ``since``, from the segments that hold only such batches.

        Raises if a compaction has merged batches of both sides; a consumer then reads anew.
        """
        live = self.version().segments
        if any(s.first_batch <= since < s.last_batch for s in live):
            raise ValueError(f"batches after {since} have been merged with earlier ones in {self.path}")
        return self.kind.merge(self._rows([s for s in live if s.first_batch > since]))


def start_delta_store(events: DataFrame, path: str, checkpoint: str, kind: Mergeable, trigger: dict | None = None,
                      fanout: int = FANOUT) -> StreamingQuery:
    """Keep ``kind`` of an event stream as deltas; read it with ``DeltaStore(spark, path, kind).read()``."""

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        DeltaStore(spark, path, kind, fanout).append(batch, batch_id, spark.sparkContext.getLocalProperty(QUERY_ID))

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add)
    return (writer.trigger(**trigger) if trigger else writer).start()


# ------------------------------------------------------------------ the periodic report
def all_time(path_order: str = "time") -> tuple[Mergeable, ...]:
    """What the report keeps."""
    return HEATMAP, ERRORS, PATHS_BY[path_order]


def report(spark: SparkSession, path: str, k: int = TOP_HEATMAP_CELLS, users: int = PREVIEW_USERS,
           path_order: str = "time") -> dict[str, DataFrame]:
    """O2, O3, O4 of the stores below ``path``: the ``k`` busiest cells, errors by page, the first ``users`` paths.

    Only the paths of the first users are assembled; their ids (``users`` of them) are broadcast.
    """
    heat, errors, paths = (DeltaStore(spark, f"{path}/{kind.name}", kind) for kind in all_time(path_order))
    fragments = paths.rows()
    first = fragments.select("userId").distinct().orderBy("userId").limit(users)
    chosen = assemble_user_paths(fragments.join(F.broadcast(first), "userId", "left_semi"))
    return {"heatmap": top_heatmap(heat.read(), k), "errors": errors_by_count(errors.read()), "paths": preview_user_paths(chosen, users)}


def start_report(events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, show: bool = True,
                 path_order: str = "time") -> StreamingQuery:
    """Keep the three all-time results as deltas below ``path`` and print the report with every trigger."""

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty(QUERY_ID)
        for kind in all_time(path_order):
            DeltaStore(spark, f"{path}/{kind.name}", kind).append(batch, batch_id, query)
        if show:
            for name, rows in report(spark, path, path_order=path_order).items():
                print(f"{name} after batch {batch_id}")
                rows.show(100, truncate=False)

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add)
    return (writer.trigger(**trigger) if trigger else writer).start()
