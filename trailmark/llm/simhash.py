"""SimHash near-dedup with covering locality-sensitive hashing.

Fingerprints: whole text, A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``SHINGLE`` words (repeats included), XXH64 with seed 42; a bit is 1 if set in over half the
hashes.

Links (at most ``RADIUS`` differing bits) are found without a miss: bit ``i`` gets a
non-zero vector of ``RADIUS + 1`` bits, and each of the ``2^(RADIUS+1) - 1`` non-zero vectors
``v`` makes one mask, of the bits whose vector has an odd product with ``v``.  The
vectors of 3 differing bits span at most 3 of 4 dimensions, so some ``v`` is orthogonal to
them all: its mask leaves out every differing bit, and the pair collides there.  15 tables
of 34 or 35 bits each.

Copies collapse to distinct fingerprints first.  A bucket of up to ``BUCKET_CAP``
fingerprints is compared in blocks and gives a spanning set of its true links; a larger
bucket goes an exact, linear way: each fingerprint is listed under every variant at
distance 2 or less (in the bits the table leaves free); two fingerprints at distance 3 or
less share a variant at distance 1 or less from one of them, and linking all to
the smallest such one keeps every class whole.  Classes come from ``components``.

Defined cases: null and empty texts have fingerprint zero and are linked like any other;
texts under ``SHINGLE`` words are one shingle; repeated rows share a class; a null
doc_id gets the class of its fingerprint's documents; an empty table gives no rows;
extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, text_key
from .components import connected_components

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
BUCKET_CAP = 4_096
#: Shingle hashes whose bits are summed at once, and rows of a block of pairs.
_FLUSH, _PAIR_ROWS = 65_536, 256


# ------------------------------------------------------------------ fingerprints
def shingle_hashes(text: str | None, k: int = SHINGLE) -> list[int]:
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return []
    flat = b" ".join(words)
    if len(words) <= k:
        return [xxhash.xxh64_intdigest(flat, SEED)]
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    return [digest(flat[s:e - 1], SEED) for s, e in zip(ends, ends[k:])]


def _majority(counts: np.ndarray, n: int) -> int:
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(texts: list[str | None], k: int = SHINGLE) -> list[int]:
    """Fingerprint (unsigned) of each text; bits are summed for many texts at a time."""
    out = [0] * len(texts)
    held: list[int] = []
    who: list[tuple[int, int]] = []

    def flush() -> None:
        if who:
            bits = _bit_counts(np.array(held, np.uint64))
            starts = np.cumsum([0, *[n for _, n in who[:-1]]])
            for (i, n), counts in zip(who, np.add.reduceat(bits, starts, axis=0, dtype=np.int32), strict=True):
                out[i] = _majority(counts, n)
        held.clear()
        who.clear()

    for i, t in enumerate(texts):
        hashes = shingle_hashes(t, k)
        if len(hashes) > _FLUSH:
            all_of = np.array(hashes, np.uint64)
            counts = sum(_bit_counts(all_of[j:j + _FLUSH]).sum(axis=0, dtype=np.int64) for j in range(0, len(all_of), _FLUSH))
            out[i] = _majority(counts, len(hashes))
        elif hashes:
            held += hashes
            who.append((i, len(hashes)))
            if len(held) >= _FLUSH:
                flush()
    flush()
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = np.array(fingerprints(b.column(1).to_pylist()), np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(found)], ["doc_id", "row_key", "fp"])


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """doc_id, row_key (hash of the text), fp (the 64 bits as a signed long) of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("row_key")).mapInArrow(
        _fingerprint_batches, "doc_id long, row_key long, fp long")


# ------------------------------------------------------------------ covering masks
def covering_masks(bits: int = BITS, radius: int = RADIUS) -> list[int]:
    """The masks of the covering family: every pair within ``radius`` agrees under one of them."""
    size = 1 << (radius + 1)
    vector = [i % (size - 1) + 1 for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a[:, None] ^ b[None, :])


def _spanning_links(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of ``fps`` under distance <= radius (indices, larger first)."""
    parent = list(range(len(fps)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i in range(0, len(fps), _PAIR_ROWS):
        rows, cols = np.nonzero(_distances(fps[i:i + _PAIR_ROWS], fps) <= radius)
        rows = rows + i
        for x, y in zip(rows[cols < rows].tolist(), cols[cols < rows].tolist(), strict=True):
            a, b = root(x), root(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((x, y))
    return links


def _bucket_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        a, b = [], []
        for members in pdf["members"]:
            nodes = [m["node"] for m in members]
            for x, y in _spanning_links(np.array([m["fp"] for m in members], np.int64).view(np.uint64), RADIUS):
                a.append(nodes[x])
                b.append(nodes[y])
        yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _variants(masks: list[int]):
    """Per row of a large bucket: every variant at distance <= 2 in the table's free bits."""
    free = [[i for i in range(BITS) if not m >> i & 1] for m in masks]
    flips = [np.array([0, *[1 << i for i in f], *[1 << i | 1 << j for i, j in combinations(f, 2)]], np.uint64) for f in free]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for t, node, fp in zip(pdf["t"], pdf["node"], pdf["fp"].to_numpy(np.int64).view(np.uint64), strict=True):
                to = flips[t]
                yield pd.DataFrame({"t": np.int32(t), "variant": (fp ^ to).view(np.int64), "node": np.int64(node),
                                    "near": np.arange(len(to)) <= len(free[t])})

    return run


def links(distinct: DataFrame, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """``node, fp`` (distinct fingerprints) -> a, b: true links that keep every class whole."""
    masks = covering_masks()
    keyed = distinct.select("node", "fp", F.posexplode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("t", "mask")).select(
        "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "node", "fp")
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    live = keyed.join(sizes, ["t", "key"])
    small = (
        live.filter(F.col("m") <= bucket_cap).groupBy("t", "key")
        .agg(F.collect_list(F.struct("node", "fp")).alias("members")).select("members")
        .mapInPandas(_bucket_links, "a long, b long")
    )
    listed = live.filter(F.col("m") > bucket_cap).select("t", "node", "fp").mapInPandas(
        _variants(masks), "t int, variant long, node long, near boolean")
    hubs = listed.filter("near").groupBy("t", "variant").agg(F.min("node").alias("hub"))
    large = listed.join(hubs, ["t", "variant"]).filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    return small.unionAll(large)


def near_dedup(docs: DataFrame, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """doc_id, row_key, fp, component_id (smallest doc_id reachable), class (its smallest fingerprint) of every row."""
    rows = stored(fingerprint_rows(docs), "fingerprints")
    # the nodes are the fingerprints themselves, so a doc_id repeated under several texts joins nothing
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    nodes = distinct.select("fp", F.col("fp").alias("node"))
    classes = connected_components(links(nodes, bucket_cap))
    named = distinct.join(classes, distinct["fp"] == classes["node"], "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_fp = named.join(least, "component").select("fp", "component_id", F.col("component").alias("class"))
    return rows.join(by_fp, "fp").select("doc_id", "row_key", "fp", "component_id", "class")


def representatives(classes: DataFrame) -> DataFrame:
    """doc_id, row_key of one row per class: the smallest id (null last), then the smallest key."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))
    return classes.groupBy("class").agg(first.alias("r")).select("r.doc_id", "r.row_key")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
