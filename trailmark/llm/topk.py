"""Exact top-k search with an impact-ordered, score-at-a-time index.

Vectors are quantised to ``floor(256 * x)`` and dealt into blocks of about
``BLOCK_VECTORS`` by a hash of the id.  A block's index lists, for every dimension, its vectors by
impact (their quantised value), so equal impacts form a posting segment and all
segments above any contribution are one range per dimension.  A query takes the
segments of all dimensions by descending contribution ``q_d * impact``, adding them to the
vectors' accumulators.  After a round down to contribution ``c`` no vector can still
gain more than ``c`` (or its dimension's largest) from a dimension that it was not yet seen
in; that bound and the k-th best exact score so far prove which vectors cannot be members.
Only when few possible members are left does the round stop; those are scored exactly.
Without proof all segments are processed.

Every block's index is written once, as one row.  Index rows and queries are dealt out by block and
sorted so that a block's index comes first and its queries stream behind it: the index crosses the
network once, whatever the number of queries, a task holds one block, and each block passes on k rows
per query.

Defined cases: null vectors and vectors with a null or non-finite component take no part;
only vectors of equal length are compared; rows that repeat a vec_id are candidates and queries of
their own (a query's own row is left out, not its id); a null vec_id is a candidate that comes
last among equal scores; other ties go to the smaller vec_id; fewer candidates than k give all of them;
an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table

#: Vectors of an index block (mean), and results per query.
BLOCK_VECTORS, TOP_K = 16_384, 5
SCALE, QUERY_EVERY = 256, 50
#: Rounds end at these shares of the largest contribution; stop when at most this share is left.
ROUNDS = (0.25, 0.12, 0.05, 0.0)
STOP_SHARE = 1 / 16
#: Vectors scored after a round for the k-th best score so far.
_PROBES = 32
_SHIFT = 48
_UNIT = 1 << _SHIFT
_NO_ID = np.iinfo(np.int64).max


def quantised(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """row, vec_id, dim, q (bigint array) of the vectors that take part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(math.inf)), F.lit(False)))
    return vectors.filter(F.col(vector).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.size(vector).alias("dim"),
        F.transform(x, lambda v: F.floor(v * SCALE).cast("long")).alias("q"))


# ------------------------------------------------------------------ the index
#: A block's index (kind 0) and a query for it (kind 1) in one layout, so that they can stream together.
ROW_SCHEMA = "dim int, block int, kind int, rows binary, ids binary, q binary, impact_order binary"


def _pack(key: tuple, group: pa.Table) -> pa.Table:
    """A block's vectors and, per dimension, the order of their impacts."""
    rows, ids = group.column("row").to_numpy(), group.column("vec_id").fill_null(_NO_ID).to_numpy()
    at = np.lexsort([rows, ids])
    dim = key[0].as_py()
    q = group.column("q").combine_chunks().flatten().to_numpy().reshape(len(ids), dim)[at]
    order = np.argsort(q, axis=0, kind="stable").T.astype(np.uint16 if len(ids) <= 1 << 16 else np.int32)
    if not q.size or np.abs(q).max() < 1 << 31:
        q = q.astype(np.int32)
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()), "kind": pa.array([0], pa.int32()),
        "rows": [rows[at].tobytes()], "ids": [ids[at].tobytes()], "q": [q.tobytes()],
        "impact_order": [np.ascontiguousarray(order).tobytes()]})


class BlockIndex:
    """The impact-ordered postings of one block, its vectors in the order of their ids."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, q: np.ndarray, order: np.ndarray):
        self.rows, self.ids, self.q, self.order = rows, ids, q, order
        self.n, self.dim = q.shape
        self.impacts = np.take_along_axis(q.T, order, axis=1)
        if self.dim:
            self.low, self.high = self.impacts[:, 0], self.impacts[:, -1]

    @classmethod
    def of(cls, row: dict) -> BlockIndex:
        """From an index row; the widths of the numbers follow from the lengths."""
        rows, ids, dim = np.frombuffer(row["rows"], np.int64), np.frombuffer(row["ids"], np.int64), row["dim"]
        cells = max(1, len(ids) * dim)
        q = np.frombuffer(row["q"], f"i{len(row['q']) // cells or 8}").astype(np.int64).reshape(len(ids), dim)
        order = np.frombuffer(row["impact_order"], np.int32 if len(row["impact_order"]) // cells == 4 else np.uint16)
        return cls(rows, ids, q, order.reshape(dim, len(ids)))

    def _ranges(self, query: list[int], floors: list[int], c: int) -> list[tuple[int, int]]:
        """Per dimension the posting range whose contribution, less its least, is at least ``c``."""
        found = []
        for d, (x, least) in enumerate(zip(query, floors, strict=True)):
            if x == 0:
                found.append((0, 0))
            elif x > 0:  # impact >= (c + least) / x
                found.append((int(np.searchsorted(self.impacts[d], -(-(c + least) // x), "left")), self.n))
            else:  # impact <= (c + least) / x
                found.append((0, int(np.searchsorted(self.impacts[d], (c + least) // x, "right"))))
        return found

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of the k best rows other than row ``own`` (ties: smaller id)."""
        at = self._members(query, self.rows != own, k)
        scores = self.q[at] @ query
        if len(at) > k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            at, scores = at[scores >= kth], scores[scores >= kth]
        best = np.lexsort((self.ids[at], -scores))[:k]
        return at[best], scores[best]

    def _members(self, query: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
        """Positions that may be among the k best, proven by bounds after some round."""
        if not self.dim:
            return np.flatnonzero(allowed)
        ends = query * self.low, query * self.high
        least = np.minimum(*ends)
        gains = np.maximum(*ends) - least
        xs, floors = query.tolist(), least.tolist()
        # what a vector has gained and, above it, in how many dimensions it was seen: one sum for both where it fits
        unit = _UNIT if int(gains.sum()) < _UNIT and self.dim < 1 << 14 else 0
        sums, apart = np.zeros(self.n, np.int64), np.zeros(0 if unit else self.n, np.int64)
        done = [(self.n, self.n) if x > 0 else (0, 0) for x in xs]
        known: int | None = None
        probes = min(self.n, max(_PROBES, k + 1))
        for share in ROUNDS:
            c = int(share * int(gains.max()))
            ranges = self._ranges(xs, floors, c)
            for d, ((a, b), (a0, b0)) in enumerate(zip(ranges, done, strict=True)):
                # what this round adds: below the last round's range going down, above it going up
                a, b = (a, a0) if xs[d] > 0 else (b0, b)
                if b > a:
                    segment = self.order[d, a:b]
                    np.add.at(sums, segment, self.impacts[d, a:b] * xs[d] + (unit - floors[d]))
                    if not unit:
                        np.add.at(apart, segment, 1)
            done = [(min(r[0], o[0]), r[1]) if x > 0 else (0, max(r[1], o[1])) for r, o, x in zip(ranges, done, xs, strict=True)]
            # a dimension that a vector was not seen in adds less than c, and no more than its gain
            rest = int(np.minimum(c, gains).sum()) + int(least.sum())
            most = (sums & (unit - 1)) - (sums >> _SHIFT) * c + rest if unit else sums - apart * c + rest
            best = np.argpartition(most, self.n - probes)[self.n - probes:]
            best = best[allowed[best]]
            if len(best) >= k:
                kth = int(np.partition(self.q[best] @ query, len(best) - k)[len(best) - k])
                known = kth if known is None else max(known, kth)
            left = np.flatnonzero(allowed if known is None else allowed & (most >= known))
            if len(left) <= max(_PROBES, STOP_SHARE * self.n):
                return left
        return left


# ------------------------------------------------------------------ searching
FOUND_SCHEMA = "query_row long, query_id long, vec_id long, score long"


def _stream(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Blocks, each followed by its queries: k rows per query and block."""
    block: BlockIndex | None = None
    place: tuple[int, int] | None = None
    for b in batches:
        found: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for i in range(b.num_rows):
            row = {name: b.column(name)[i].as_py() for name in ("dim", "block", "kind")}
            if row["kind"] == 0:
                block, place = BlockIndex.of(b.slice(i, 1).to_pylist()[0]), (row["dim"], row["block"])
                continue
            if block is None or place != (row["dim"], row["block"]):
                continue  # no vector was dealt to this block
            own, qid = (np.frombuffer(b.column(c)[i].as_py(), np.int64)[0] for c in ("rows", "ids"))
            at, scores = block.top(np.frombuffer(b.column("q")[i].as_py(), np.int64), int(own), k)
            found.append((int(own), int(qid), block.ids[at], scores))
        sizes = [len(x[3]) for x in found]
        none = [np.empty(0, np.int64)]
        ids = np.concatenate([x[2] for x in found] or none)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([x[j] for x in found], np.int64), sizes)) for j in (0, 1)]
            + [pa.array(ids, mask=ids == _NO_ID), pa.array(np.concatenate([x[3] for x in found] or none).astype(np.int64))],
            ["query_row", "query_id", "vec_id", "score"])


def _query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ends = b.column("q").offsets.to_numpy()
        flat = b.column("q").values.to_numpy()
        own = [np.int64(x).tobytes() for x in b.column("row").to_pylist()]
        ids = [np.int64(x).tobytes() for x in b.column("vec_id").to_pylist()]
        q = [flat[ends[i]:ends[i + 1]].tobytes() for i in range(b.num_rows)]
        n = b.num_rows
        yield pa.RecordBatch.from_arrays(
            [b.column("dim"), pa.array(np.zeros(n, np.int32)), pa.array(np.ones(n, np.int32)), *[pa.array(x, pa.binary()) for x in (own, ids, q)],
             pa.nulls(n, pa.binary())], ["dim", "block", "kind", "rows", "ids", "q", "impact_order"])


def build_index(rows: DataFrame, n_blocks: int) -> DataFrame:
    """One row per block of the ``quantised`` rows."""
    block = F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int").alias("block")
    return stored(rows.select("*", block).groupBy("dim", "block").applyInArrow(_pack, ROW_SCHEMA), "index")


def search_top_k(vectors: DataFrame, is_query: Column, block_vectors: int = BLOCK_VECTORS, k: int = TOP_K) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best other rows of every query."""
    rows = stored(quantised(vectors), "quantised")
    n_blocks = max(1, -(-rows.count() // block_vectors))
    index = build_index(rows, n_blocks)
    queries = rows.filter(is_query).mapInArrow(_query_rows, ROW_SCHEMA).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).select(*index.columns)
    together = index.unionAll(queries).repartition(max(1, n_blocks), "dim", "block").sortWithinPartitions("dim", "block", "kind")
    local = together.mapInArrow(lambda batches: _stream(batches, k), FOUND_SCHEMA)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


OP4_SQL = """
WITH v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.row AS own, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.row <> b.row AND len(a.q) = len(b.q)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""
