"""Exact dedup with a minimal perfect hash over the historical distinct digests.

1. Every text becomes the SHA-256 of its normalised bytes (white space
   ``[\\x20\\x09-\\x0D]`` deleted), in Arrow batches; only digest, id and length move on.
2. The history's distinct digests are split into buckets by digest bits (uniform, so
   bounded) and each bucket gets a minimal perfect hash: keys fall into small
   groups, and each group searches a pilot that sends its keys to free slots of
   ``0..n-1``.  A slot holds the full digest and the winner's locator (code points, id).
3. New rows are pre-aggregated by digest and looked up bucket by bucket.  The slot's
   digest is compared byte by byte: a member joins the historical group, a nonmember
   (whose slot holds another digest) forms a group of its own.
4. The groups' winners go back to the rows by a join on the digest.

Nothing unbounded meets in a task: copies are counted map-side before the shuffle, and
buckets hold about ``BUCKET_KEYS`` distinct digests at any size.

Defined cases: a null text counts as empty; all rows that become empty are one group;
the row with the most code points in the original text wins, then the smallest
doc_id (rows that repeat the winner's doc_id are all kept; a null doc_id
ranks last); an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, text_key

#: Distinct digests of one perfect-hash bucket (mean), and keys of one pilot group.
BUCKET_KEYS = 512
GROUP_KEYS = 4
_WHITE = b" \t\n\x0b\x0c\r"
_PILOTS = 256


# ------------------------------------------------------------------ digests
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(1).to_pylist()
        chars = [len(t) if t else 0 for t in texts]
        digests = [hashlib.sha256((t or "").encode().translate(None, _WHITE)).digest() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(chars, pa.int64()), pa.array(digests, pa.binary()), b.column(2), b.column(3)],
            ["doc_id", "n_chars", "digest", "row_key", "historical"])


def digest_rows(docs: DataFrame, historical: Column) -> DataFrame:
    """doc_id, n_chars, digest, row_key (hash of the original text), historical of every row."""
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("row_key"),
                         F.coalesce(historical, F.lit(False)).alias("historical"))
    return picked.mapInArrow(_digests, "doc_id long, n_chars long, digest binary, row_key long, historical boolean")


def _groups(rows: DataFrame) -> DataFrame:
    """One row per digest: copies and the best locator (most code points, smallest id, null last)."""
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), best.alias("best")).select(
        "digest", "n", (-F.col("best.less")).alias("n_chars"), "best.doc_id", "best.row_key")


def _bucket(n_buckets: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(n_buckets)).cast("int")


# ------------------------------------------------------------------ minimal perfect hash
def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply), for pilots and slots."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _key_parts(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each 32-byte digest: for its group and for its slot."""
    words = np.ascontiguousarray(raw).view("<u8")
    return words[:, 1], words[:, 2]


def build_mph(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilots of a minimal perfect hash over distinct digests (n x 32 bytes), and each key's slot."""
    n = len(raw)
    groups = -(-n // GROUP_KEYS)
    to_group, to_slot = _key_parts(raw)
    group = (to_group % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(groups + 1))
    pilots, slots, free = np.zeros(groups, np.uint32), np.empty(n, np.int64), np.ones(n, bool)
    for g in np.argsort(-(starts[1:] - starts[:-1]), kind="stable"):
        keys = order[starts[g]:starts[g + 1]]
        if not len(keys):
            break
        for first in range(0, 1 << 26, _PILOTS):
            tried = _mix(np.arange(first, first + _PILOTS, dtype=np.uint64) + np.uint64(1))
            at = (_mix(to_slot[keys][None, :] ^ tried[:, None]) % np.uint64(n)).astype(np.int64)
            good = free[at].all(axis=1)
            if len(keys) > 1:
                by = np.sort(at, axis=1)
                good &= (by[:, 1:] != by[:, :-1]).all(axis=1)
            if good.any():
                k = int(np.argmax(good))
                pilots[g], slots[keys] = first + k, at[k]
                free[at[k]] = False
                break
        else:
            raise RuntimeError("no pilot found: digests are not distinct")
    return pilots, slots


def mph_slots(raw: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    """The slot each digest would have; any digest gets one, only members fill theirs."""
    to_group, to_slot = _key_parts(raw)
    tried = _mix(pilots[(to_group % np.uint64(len(pilots))).astype(np.int64)].astype(np.uint64) + np.uint64(1))
    return (_mix(to_slot ^ tried) % np.uint64(n)).astype(np.int64)


def _raw(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(d) for d in digests), np.uint8).reshape(-1, 32)


INDEX_SCHEMA = "bucket int, n int, pilots binary, digests binary, n_chars binary, doc_id binary, no_id binary, row_key binary, copies binary"


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    raw = _raw(pdf["digest"])
    pilots, slots = build_mph(raw)
    at = np.argsort(slots)
    ids = pdf["doc_id"].iloc[at]
    return pd.DataFrame({
        "bucket": [int(pdf["bucket"].iloc[0])], "n": [len(raw)], "pilots": [pilots.tobytes()],
        "digests": [raw[at].tobytes()], "n_chars": [pdf["n_chars"].to_numpy(np.int64)[at].tobytes()],
        "doc_id": [np.array([0 if pd.isna(x) else int(x) for x in ids], np.int64).tobytes()],
        "no_id": [ids.isna().to_numpy(bool).tobytes()],
        "row_key": [pdf["row_key"].to_numpy(np.int64)[at].tobytes()],
        "copies": [pdf["n"].to_numpy(np.int64)[at].tobytes()]})


def _keyed(groups: DataFrame, n_buckets: int) -> DataFrame:
    """With the bucket; ids as text, since pandas would turn a column with nulls into floats."""
    return groups.select(_bucket(n_buckets).alias("bucket"), "digest", "n", "n_chars",
                         F.col("doc_id").cast("string").alias("doc_id"), "row_key")


def build_index(groups: DataFrame, n_buckets: int) -> DataFrame:
    """One row per bucket: pilots, and per slot the full digest and the winner's locator."""
    return _keyed(groups, n_buckets).groupBy("bucket").applyInPandas(_build, INDEX_SCHEMA)


RESOLVED_SCHEMA = "digest binary, keep_id long, keep_key long, group_size long, in_history boolean"


def _resolve(index: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
    """All groups of a bucket: members merged into their slots, nonmembers on their own."""
    out: list[tuple] = []
    slots: dict[int, list] = {}
    if len(index):
        row = index.iloc[0]
        n = int(row["n"])
        held = np.frombuffer(row["digests"], np.uint8).reshape(n, 32)
        chars, ids, none, keys, copies = (np.frombuffer(row[c], t) for c, t in (
            ("n_chars", np.int64), ("doc_id", np.int64), ("no_id", bool), ("row_key", np.int64), ("copies", np.int64)))
        slots = {s: [(-int(chars[s]), bool(none[s]), int(ids[s]), int(keys[s])), int(copies[s])] for s in range(n)}
    if len(new):
        raw = _raw(new["digest"])
        if len(index):
            at = mph_slots(raw, np.frombuffer(row["pilots"], np.uint32), n)
            member = (held[at] == raw).all(axis=1)
        else:
            at, member = np.zeros(len(raw), np.int64), np.zeros(len(raw), bool)
        ids_new = [None if pd.isna(x) else int(x) for x in new["doc_id"]]
        for i, (c, d, key, k) in enumerate(zip(new["n_chars"], ids_new, new["row_key"], new["n"], strict=True)):
            mine = (-int(c), d is None, d or 0, int(key))
            if member[i]:
                slot = slots[int(at[i])]
                slot[0], slot[1] = min(slot[0], mine), slot[1] + int(k)
            else:
                out.append((raw[i].tobytes(), d, int(key), int(k), False))
    for s, (best, k) in slots.items():
        out.append((held[s].tobytes(), None if best[1] else best[2], best[3], k, True))
    return pd.DataFrame({"digest": [x[0] for x in out], "keep_id": pd.array([x[1] for x in out], "Int64"),
                         "keep_key": [x[2] for x in out], "group_size": [x[3] for x in out], "in_history": [x[4] for x in out]})


def exact_dedup(docs: DataFrame, historical: Column) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, winner, in_history, digest, row_key.

    ``winner`` also compares the text, for tables in which a doc_id repeats under other texts.

    ``historical`` marks the rows already ingested: their distinct digests make the index
    that the other rows are looked up in.
    """
    rows = stored(digest_rows(docs, historical), "digests")
    old, new = _groups(rows.filter("historical")), _groups(rows.filter("NOT historical"))
    # arrivals meet in the index's buckets, so the larger of both sides sizes them
    n = max(old.count(), new.count())
    n_buckets = max(1, -(-n // BUCKET_KEYS))
    index = build_index(old, n_buckets)
    resolved = index.groupBy("bucket").cogroup(_keyed(new, n_buckets).groupBy("bucket")).applyInPandas(_resolve, RESOLVED_SCHEMA)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return rows.join(resolved, "digest").select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"),
        (kept & (F.col("row_key") == F.col("keep_key"))).alias("winner"), "in_history", "digest", "row_key")


def earlier_half(doc_id: Column) -> Column:
    """The split of one table into history and arrivals: a hash bit of the id."""
    return F.pmod(F.xxhash64(doc_id), F.lit(2)) == 0


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup(docs, earlier_half(F.col("doc_id"))).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
g AS (SELECT h, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM d JOIN g USING (h)
"""
