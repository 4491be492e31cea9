"""Ranked lexical search over a length-stratified index.

Documents of equal length normaliser ``m`` form a stratum.  Within a stratum the impact of a
posting depends on its term frequency alone, so a term's postings are grouped by tf and
every impact is computed once per tf.  The highest tf of a term in a stratum bounds what it
can add there, and the sum of these bounds over an item's terms bounds every score in the
stratum: an item visits strata by descending bound and leaves out those whose bound is
below its k-th best score so far.

How it runs:

1. One pass over the texts counts terms per document and keeps, of terms that some item has, the
   postings (term, document, tf, document's length).
2. The number of documents and terms come from that table, the documents of each term by a partial
   aggregate.
3. Strata are cut into blocks of about ``BLOCK_DOCS`` documents, so that a length that a third of
   all documents have is many blocks, and each block is packed into one row.  The table of
   blocks is the index; it is written once and never shuffled again.
4. Every task streams its share of the blocks, some at a time, and answers all items of a chunk
   on them with the visiting rule above, carrying each item's best scores along.  Items
   come in chunks of bounded size, one pass over the index each.  Every task passes on k rows per item.

Scores are 64-bit integers; only a term's weight uses a logarithm, in doubles.

Defined cases: a null text has no terms, and a document without terms is not counted; an item
without terms has no rows; rows that repeat a document count and rank as documents of their
own, rows that repeat an item are answered each; a null doc_id ranks behind equal
scores; scores of 0 are left out; fewer documents than k give all of them; empty tables give no
rows; extra columns are not carried.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table

TOP_K = 10
#: Postings that a task passes on at once; documents of an index block (mean), and blocks and index bytes that a
#: task visits together.
OUT_ROWS = 1 << 17
BLOCK_DOCS, VISIT_BLOCKS, VISIT_BYTES = 4_096, 256, 16 << 20
#: Strata (two numbers each) that are broadcast; more are joined by a shuffle.
BROADCAST_STRATA = 100_000
#: Terms of the items that one pass over the index answers (mean).
CHUNK_TERMS = 1 << 18
#: Share of the length in the normaliser (percent), and the scales of weights and impacts.
LENGTH_PERCENT, WEIGHT_SCALE, IMPACT_SCALE, TF_SCALE, M_SCALE = 90, 1000, 1_000_000_000, 1000, 8
_NO_ID = np.iinfo(np.int64).max


def _translation() -> bytes:
    """Bytes of terms stay (A-Z lower-cased, all of other characters), the rest become blanks."""
    to = bytearray(b" " * 128) + bytearray(range(128, 256))
    for first, last in ((b"0", b"9"), (b"a", b"z")):
        for c in range(first[0], last[0] + 1):
            to[c] = c
    for c in range(ord("A"), ord("Z") + 1):
        to[c] = c + 32
    return bytes(to)


_TO = _translation()


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO).split()


# ------------------------------------------------------------------ postings and weights
POSTINGS_SCHEMA = "term string, row long, doc_id long, tf long, length long"


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document and term, and one of the empty term for every document with terms."""
    for b in batches:
        terms, tfs, lengths, sizes, begin = [], [], [], [], 0
        for i, text in enumerate(b.column("text")):
            words = terms_of(text.as_py())
            counts = Counter(words)
            if words:
                counts[b""] = 0
            terms.extend(counts)
            tfs.extend(counts.values())
            sizes.append(len(counts))
            lengths.append(len(words))
            if len(terms) >= OUT_ROWS or i + 1 == b.num_rows:
                at = pa.array(np.repeat(np.arange(begin, i + 1), sizes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms, pa.binary()).cast(pa.string()), b.column("row").take(at), b.column("doc_id").take(at),
                     pa.array(tfs, pa.int64()), pa.array(np.repeat(lengths, sizes).astype(np.int64))],
                    ["term", "row", "doc_id", "tf", "length"])
                terms, tfs, lengths, sizes, begin = [], [], [], [], i + 1


def item_terms(items: DataFrame, item_id: str = "item_id") -> DataFrame:
    """item (a number per row), item_id, term: the different terms of every item."""
    numbered = items.select(F.monotonically_increasing_id().alias("row"), F.col(item_id).alias("doc_id"), "text")
    return numbered.mapInArrow(_post, POSTINGS_SCHEMA.replace("doc_id long", f"doc_id {items.schema[item_id].dataType.simpleString()}")
                               ).filter("term != ''").select(F.col("row").alias("item"), F.col("doc_id").alias("item_id"), "term")


def postings_of(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Postings of the terms in ``vocabulary`` (column term), which the join may have spread by its size."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = vocabulary.select("term").unionAll(vocabulary.sparkSession.range(1).select(F.lit("").alias("term"))).distinct()
    return rows.mapInArrow(_post, POSTINGS_SCHEMA).join(wanted, "term", "left_semi")


def weight(documents: int, df: Column) -> Column:
    return F.floor(F.lit(float(WEIGHT_SCALE)) * F.log((F.lit(2.0) * documents + 2.0) / (F.lit(2.0) * df + 1.0))).cast("long")


# ------------------------------------------------------------------ the index
INDEX_SCHEMA = "m long, docs binary, terms array<string>, first array<int>, tfs binary, sizes binary, postings binary"


def _pack(key: tuple, group: pa.Table) -> pa.Table:
    """One block: its documents, and per term its groups of postings by descending tf."""
    term = group.column("term").combine_chunks().dictionary_encode()
    rows, at = np.unique(group.column("row").to_numpy(), return_index=True)
    ids = group.column("doc_id").fill_null(_NO_ID).to_numpy()[at]
    doc = np.searchsorted(rows, group.column("row").to_numpy())
    tf, code = group.column("tf").to_numpy(), term.indices.to_numpy()
    order = np.lexsort([doc, -tf, code])
    doc, tf, code = doc[order], tf[order], code[order]
    new = np.ones(len(order), bool)
    new[1:] = (code[1:] != code[:-1]) | (tf[1:] != tf[:-1])
    heads = np.flatnonzero(new)
    groups_of = code[heads]
    first = np.flatnonzero(np.append(True, groups_of[1:] != groups_of[:-1]))
    return pa.table({
        "m": pa.array([key[0].as_py()], pa.int64()), "docs": [ids.astype(np.int64).tobytes()],
        "terms": pa.array([term.dictionary.take(pa.array(groups_of[first])).to_pylist()], pa.list_(pa.string())),
        "first": pa.array([np.append(first, len(heads)).tolist()], pa.list_(pa.int32())),
        "tfs": [tf[heads].astype(np.int64).tobytes()],
        "sizes": [np.diff(np.append(heads, len(order))).astype(np.int64).tobytes()],
        "postings": [doc.astype(np.int32).tobytes()]})


class Index(NamedTuple):
    """The table of blocks, and the weights of the terms."""

    blocks: DataFrame
    weights: DataFrame


def build_index(docs: DataFrame, vocabulary: DataFrame, block_docs: int = BLOCK_DOCS) -> Index:
    """The stratified index of every document, for the terms in ``vocabulary``."""
    postings = stored(postings_of(docs, vocabulary), "postings")
    per_doc = F.col("term") == ""
    documents, all_terms = postings.filter(per_doc).agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    m = F.lit(100 - LENGTH_PERCENT) + F.expr(f"({LENGTH_PERCENT} * length * {documents}L) div {max(1, all_terms)}L")
    stratified = postings.filter(~per_doc).withColumn("m", m)
    weights = stratified.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", weight(documents, F.col("df")).alias("weight"))
    # blocks of a stratum: as many as its documents need, dealt by the document's number
    strata = stored(postings.filter(per_doc).withColumn("m", m).groupBy("m").agg(F.count(F.lit(1)).alias("docs")), "strata")
    if strata.count() <= BROADCAST_STRATA:
        strata = F.broadcast(strata)
    dealt = stratified.join(strata, "m").withColumn(
        "block", F.pmod(F.xxhash64("row"), F.ceil(F.col("docs") / block_docs)).cast("int"))
    # dealt by block, not by stratum: one length may be that of a third of all documents
    blocks = dealt.repartition("m", "block").groupBy("m", "block").applyInArrow(_pack, INDEX_SCHEMA)
    return Index(stored(blocks, "index"), stored(weights, "weights"))


# ------------------------------------------------------------------ visiting strata
class Items(NamedTuple):
    """A chunk of items: entries (term number, weight) lie item by item from ``first``."""

    numbers: np.ndarray
    term_number: dict[str, int]
    first: np.ndarray
    terms: np.ndarray
    weights: np.ndarray


def chunk_of(rows: list) -> Items:
    rows = sorted(rows, key=lambda r: r["item"])
    term_number: dict[str, int] = {}
    terms = np.array([term_number.setdefault(r["term"], len(term_number)) for r in rows], np.int64)
    item = np.array([r["item"] for r in rows], np.int64)
    numbers, first = np.unique(item, return_index=True)
    return Items(numbers, term_number, np.append(first, len(rows)), terms, np.array([r["weight"] for r in rows], np.int64))


class _Block:
    def __init__(self, row: dict, items: Items):
        self.ids = np.frombuffer(row["docs"], np.int64)
        tfs, sizes = np.frombuffer(row["tfs"], np.int64), np.frombuffer(row["sizes"], np.int64)
        impact = IMPACT_SCALE * tfs // (TF_SCALE * tfs + M_SCALE * row["m"])  # once per tf
        self.postings, self.impacts = np.frombuffer(row["postings"], np.int32), np.repeat(impact, sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        first = np.array(row["first"], np.int64)
        here = np.array([items.term_number.get(t, -1) for t in row["terms"]], np.int64)
        asked = here >= 0
        self.span = np.zeros((len(items.term_number), 2), np.int64)
        self.span[here[asked], 0], self.span[here[asked], 1] = ends[first[:-1]][asked], ends[first[1:]][asked]
        most = np.zeros(len(items.term_number), np.int64)
        most[here[asked]] = impact[first[:-1]][asked]  # a term's first group has its highest tf
        self.bounds = np.add.reduceat(items.weights * most[items.terms], items.first[:-1])

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.ids), np.int64)
        for (a, b), w in zip(self.span[terms].tolist(), weights.tolist(), strict=True):
            if b > a:
                out[self.postings[a:b]] += w * self.impacts[a:b]  # a document has a term once
        return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort([ids, -scores])[:k]
    return ids[order], scores[order]


class Visitor:
    """The best documents of every item of a chunk over the blocks of one task."""

    def __init__(self, items: Items, k: int):
        self.items, self.k = items, k
        none = np.empty(0, np.int64)
        self.found = [(none, none)] * len(items.numbers)
        self.visited = self.left_out = 0

    def visit(self, rows: list[dict]) -> None:
        blocks = [_Block(r, self.items) for r in rows]
        bounds = np.array([b.bounds for b in blocks])
        for i in range(len(self.items.numbers)):
            terms, weights = (x[self.items.first[i]:self.items.first[i + 1]] for x in (self.items.terms, self.items.weights))
            order = np.argsort(-bounds[:, i], kind="stable")
            for n, j in enumerate(order.tolist()):
                ids, scores = self.found[i]
                least = int(scores[-1]) if len(scores) == self.k else 1
                if bounds[j, i] < least:  # an equal score may still win by its id
                    self.left_out += len(order) - n
                    break
                self.visited += 1
                score = blocks[j].scores(terms, weights)
                at = np.flatnonzero(score >= least)
                if len(at):
                    self.found[i] = _best(np.append(ids, blocks[j].ids[at]), np.append(scores, score[at]), self.k)

    def results(self) -> pa.RecordBatch:
        sizes = [len(ids) for ids, _ in self.found]
        none = [np.empty(0, np.int64)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.items.numbers, sizes)), pa.array(np.concatenate([ids for ids, _ in self.found] or none)),
             pa.array(np.concatenate([s for _, s in self.found] or none))], ["item", "doc", "score"])


def _answer(blocks: DataFrame, items, k: int) -> DataFrame:
    """item, doc, score: k rows per item and task; ``items`` is a broadcast chunk (its fields)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        visitor = Visitor(Items(*items.value), k)
        held, size = [], 0
        for b in batches:
            for row in range(b.num_rows):
                held.append(b.slice(row, 1).to_pylist()[0])
                size += sum(len(held[-1][c]) for c in ("docs", "tfs", "sizes", "postings"))
                if len(held) >= VISIT_BLOCKS or size >= VISIT_BYTES:
                    visitor.visit(held)
                    held, size = [], 0
        if held:
            visitor.visit(held)
        yield visitor.results()

    return blocks.mapInArrow(run, "item long, doc long, score long")


def search(index: Index, asked: DataFrame, k: int = TOP_K, chunk_terms: int = CHUNK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of every item in ``asked`` (item, item_id, term)."""
    spark = asked.sparkSession
    entries = stored(asked.join(index.weights, "term"), "items")
    chunks = max(1, -(-entries.count() // chunk_terms))
    found: DataFrame | None = None
    for c in range(chunks):
        part = entries.filter(F.pmod(F.xxhash64("item"), F.lit(chunks)) == c) if chunks > 1 else entries
        rows = part.select("item", "term", "weight").collect()  # about chunk_terms rows
        if rows:
            own = _answer(index.blocks, spark.sparkContext.broadcast(tuple(chunk_of(rows))), k)
            found = own if found is None else found.unionAll(own)
    if found is None:
        found = spark.createDataFrame([], "item long, doc long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(entries.select("item", "item_id").distinct(), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"), "score")


def rank_documents(docs: DataFrame, items: DataFrame, item_id: str = "item_id", k: int = TOP_K,
                   block_docs: int = BLOCK_DOCS, chunk_terms: int = CHUNK_TERMS) -> DataFrame:
    """The ``k`` best documents for the text of every item."""
    asked = stored(item_terms(items, item_id), "asked")
    return search(build_index(docs, asked, block_docs), asked, k, chunk_terms)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
t AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM t GROUP BY ALL),
c AS (SELECT count(*) AS docs, sum(len(w)) AS terms FROM d WHERE len(w) > 0),
f AS (SELECT term, CAST(floor(1000 * ln((2.0 * docs + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term, docs),
b AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS w FROM benchmark),
q AS (SELECT DISTINCT i, item_id, unnest(w) AS term FROM b),
s AS (SELECT i, item_id, r, doc_id, CAST(sum(f.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // terms))))) AS BIGINT) AS score
      FROM q JOIN f USING (term) JOIN p USING (term), c GROUP BY ALL),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM k WHERE rank <= 10
"""
