"""Packing by non-negative least squares over a length histogram.

1. Each document is tokenised whole and closed with id 1.  It is cut into full windows of
   ``WINDOW`` ids, each a sequence of its own, and one rest.
2. The rests' histogram (at most ``WINDOW - 1`` counts, so bounded) goes to the driver.  Shallow
   combinations of lengths that fill a window exactly are enumerated: all pairs, triples
   and quadruples through a few anchor lengths.  Non-negative least squares
   (multiplicative updates) finds repeat counts whose use of lengths matches the
   histogram; they are rounded and cut to what is there, and the residual counts are
   packed greedily, longest first.
3. The plan says, per length and range of ranks, which sequence and offset a rest gets.
   It is at most a few entries per pattern (bounded by the window, not by the data) and
   is looked up by rank; ranks are numbered in blocks, so a length shared by a third of all
   rows is no hot group.

Tokens come from the byte-level BPE vocabulary in its rank file, whose ids equal those of
the same vocabulary in JSON form (tested), at four times the speed.  The strings of the JSON
form's added tokens (``<|endoftext|>``) get their own ids, as its tokenizer gives them.

Defined cases: a null or empty text is one piece of the closing id; repeated rows and null
ids are packed like any other; an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import number_within, stored, table

WINDOW, CLOSING_ID = 2048, 1
#: Ranks, and the same vocabulary in JSON form, which names the added tokens.
VOCABULARY, ADDED = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
#: Anchor lengths of triples and of quadruples, and update steps of the least squares.
TRIPLE_ANCHORS, QUAD_ANCHORS, STEPS = 24, 6, 150


# ------------------------------------------------------------------ tokens and pieces
def encoder(vocabulary: str = VOCABULARY, added: str = ADDED):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(public_tokenizers.path(added), encoding="utf-8") as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


#: A run of white space longer than this is split as the pattern splits it, without the pattern: its engine fails on
#: runs of about a million.  The class is the pattern's ``\\s`` (Unicode White_Space).
LONG_BLANKS = 4096
_LONG_RUN = re.compile(rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG_BLANKS},}}")


def ids_of(encoding, text: str) -> list[int]:
    """Ids of the whole text.

    The pattern takes a run of white space as one piece, but leaves its last character to what follows.  So a text
    is cut behind the text before a long run and before that last character; no match crosses either place.
    Text ends before an added token too.
    """
    encode, added = partial(encoding.encode, allowed_special="all"), tuple(encoding.special_tokens_set)
    out: list[int] = []
    at = 0
    for run in _LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) or text.startswith(added, run.end()) else run.end() - 1
        out += encode(text[at:run.start()])
        out += encoding._encode_single_piece(text[run.start():end])
        at = end
    return out + encode(text[at:])


PIECES_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _piecer(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(vocabulary)
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.array([*ids_of(encoding, text or ""), CLOSING_ID], "<u4")
                for start in range(0, len(ids), WINDOW):
                    piece = ids[start:start + WINDOW]
                    for c, v in zip(cols, (doc, start, len(piece), zlib.crc32(piece), len(ids)), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def cut(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_piecer(vocabulary), PIECES_SCHEMA)


# ------------------------------------------------------------------ the plan
def _anchors(hist: np.ndarray, k: int) -> list[int]:
    """Quantiles of the lengths: where most rows are."""
    total = np.cumsum(hist)
    if not total[-1]:
        return []
    return sorted(set(np.searchsorted(total, (np.arange(k) + 0.5) / k * total[-1]).tolist()))


def combinations_of(hist: np.ndarray) -> np.ndarray:
    """Rows of up to four lengths (0: none) that sum to the window and occur in ``hist``."""
    window = len(hist)
    there = np.flatnonzero(hist)
    found = [np.stack([there, window - there, 0 * there, 0 * there], 1)]
    for a in _anchors(hist, TRIPLE_ANCHORS):
        found.append(np.stack([there, window - a - there, 0 * there + a, 0 * there], 1))
    quads = _anchors(hist, QUAD_ANCHORS)
    for i, a in enumerate(quads):
        for b in quads[i:]:
            found.append(np.stack([there, window - a - b - there, 0 * there + a, 0 * there + b], 1))
    rows = np.concatenate(found)
    rows = rows[rows[:, 1] > 0]
    rows = rows[(hist[rows] > 0)[:, :2].all(axis=1)]
    return np.unique(-np.sort(-rows, axis=1), axis=0)


def repeat_counts(hist: np.ndarray, combos: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares by multiplicative updates: use of lengths against ``hist``."""
    h = hist.astype(float)
    h[0] = 0
    used = (combos > 0).astype(float)
    x = np.full(len(combos), max(h.sum(), 1.0) / max(1, 2 * len(combos)))
    goal = (h[combos] * used).sum(axis=1)
    for _ in range(steps):
        use = np.bincount(combos.ravel(), (x[:, None] * used).ravel(), len(h))
        x *= goal / np.maximum((use[combos] * used).sum(axis=1), 1e-12)
    return x


def plan_patterns(hist: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that use every rest exactly once; each sums to at most the window."""
    window, left = len(hist), hist.astype(np.int64).copy()
    left[0] = 0
    plan: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...], most: int) -> None:
        kinds = {n: lengths.count(n) for n in lengths}
        repeats = min(most, *(int(left[n]) // m for n, m in kinds.items()))
        if repeats > 0:
            for n, m in kinds.items():
                left[n] -= repeats * m
            plan.append((lengths, repeats))

    combos = combinations_of(left) if left.any() else np.zeros((0, 4), int)
    if len(combos):
        x = np.rint(repeat_counts(left, combos)).astype(np.int64)
        for i in np.argsort(-x, kind="stable"):
            if x[i] <= 0:
                break
            take(tuple(int(n) for n in combos[i] if n), int(x[i]))
    there = np.flatnonzero(left).tolist()
    while there:
        room, lengths, counts = window, [], {}
        while True:
            i = bisect_right(there, room) - 1
            while i >= 0 and counts.get(there[i], 0) >= left[there[i]]:
                i -= 1
            if i < 0:
                break
            n = there[i]
            lengths.append(n)
            counts[n] = counts.get(n, 0) + 1
            room -= n
        take(tuple(lengths), int(left.sum()))
        there = [n for n in there if left[n]]
    return plan


def plan_entries(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, first sequence, offset) ordered by length and rank; sequences used."""
    next_rank: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, repeats in plan:
        offset = 0
        for n in lengths:
            rows.append((n, next_rank.get(n, 0), sequence, offset))
            next_rank[n] = next_rank.get(n, 0) + repeats
            offset += n
        sequence += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 4), sequence


def _placer(entries: np.ndarray, sequences: int):
    shift = 1 << 48

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = entries[:, 0] * shift + entries[:, 1]
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            full = length == WINDOW
            at = np.searchsorted(keys, length * shift + rank, "right") - 1
            hit = entries[np.maximum(at, 0)] if len(entries) else np.zeros((len(length), 4), np.int64)
            seq = np.where(full, sequences + rank, hit[:, 2] + rank - hit[:, 1])
            offset = np.where(full, 0, hit[:, 3])
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(5)], pa.array(seq), pa.array(offset)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    pieces = stored(cut(docs, vocabulary), "pieces")
    hist = np.zeros(WINDOW, np.int64)
    for r in pieces.filter(F.col("length") < WINDOW).groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        hist[r["length"]] = r["n"]
    entries, sequences = plan_entries(plan_patterns(hist))
    ranked = number_within(pieces, ["length"], "rank")
    return ranked.mapInArrow(_placer(entries, sequences), PIECES_SCHEMA + ", sequence_id long, offset long")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
