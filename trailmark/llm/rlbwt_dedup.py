"""Repeated passages by a run-length compressed Burrows-Wheeler index.

A byte goes if a string of ``MATCH`` bytes that covers it also starts earlier (smaller doc_id,
or earlier in the same document).  So the question is, for every window of ``MATCH`` bytes,
whether it is the first of its kind.

1. Partitioning.  A window belongs to its minimizer: the smallest hash among its substrings
   of ``SEED`` bytes.  Equal windows have equal minimizers, so all windows of one
   minimizer can be decided together, and those of a minimizer that occurs once are
   first.  Neighbouring windows of one minimizer form a segment; only (minimizer, 128-bit hash of the
   segment, document, start, windows) is shuffled, no text.
2. A segment that occurs again as a whole is decided at once: all but its first occurrence
   repeat.  Inside a task this is done before the shuffle: only the first of its occurrences there goes to its
   minimizer, the others travel spread by document.  What is left are minimizers with several
   different segments, and segments that may repeat in themselves.
3. The bytes of those first occurrences meet in buckets.  Each bucket builds the
   run-compressed Burrows-Wheeler transform of its segments, with text positions
   sampled at the ends of runs and, at every run head, the length it shares with its
   predecessor.  Between samples both follow from the sample before: matching statistics
   are streamed over all positions from the samples alone.  Positions
   that share ``MATCH`` bytes or more with their predecessor are linked; of a chain of links the
   earliest position is the first of its kind, the others are marked.
4. The marks return to their documents, which cut the covered bytes.

A passage in a third of all documents adds one narrow row per occurrence, which is spread by document, and
one per task and batch that meet by minimizer, are streamed in sorted order and never gathered; it is
collapsed to one segment before any text moves.  Index buckets are bounded: a minimizer in more than ``MINIMIZER_CAP``
different segments goes another exact way, by 128-bit hashes of its windows,
whose copies are combined before the shuffle.

Defined cases: null is empty text; documents shorter than ``MATCH`` keep all bytes; identical
rows (same doc_id and text) count as one document and get equal results; other rows
that share a doc_id are ordered by a hash of their text; a null doc_id comes last; an
empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

#: Bytes of a match and of a minimizer.
MATCH, SEED = 100, 32
#: Windows of a segment at most, and bytes hashed at once.
SEGMENT_WINDOWS, PIECE_BYTES = 512, 1 << 18
#: Segment bytes of one index (mean).
INDEX_BYTES = 1 << 20
#: Different segments of a minimizer beyond which it takes the way by windows.
MINIMIZER_CAP = 16_384
_LAST = np.iinfo(np.int64).max
_MULTIPLIER = 0x9E3779B97F4A7C15


# ------------------------------------------------------------------ segments by minimizer
def seed_hashes(raw: np.ndarray, seed: int) -> np.ndarray:
    """Hash of every substring of ``seed`` bytes, by doubling: h(2n)[i] = h(n)[i] * B^n + h(n)[i+n]."""
    parts: list[tuple[int, np.ndarray]] = []  # (length, hashes) of the binary digits of seed
    h, n, power = raw.astype(np.uint64) + np.uint64(1), 1, _MULTIPLIER
    while True:
        if seed & n:
            parts.append((n, h))
        if 2 * n > seed:
            break
        h = h[:-n] * np.uint64(power) + h[n:] if len(h) > n else h[:0]
        n, power = 2 * n, power * power % (1 << 64)
    count = max(0, len(raw) - seed + 1)
    out, at = np.zeros(count, np.uint64), 0
    for length, hashes in reversed(parts):
        out = out * np.uint64(pow(_MULTIPLIER, length, 1 << 64)) + hashes[at:at + count]
        at += length
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n, m = 1, values
    while 2 * n <= width:
        m = np.minimum(m[:-n], m[n:])
        n *= 2
    rest = width - n
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def segments_of(raws: list[bytes], match: int = MATCH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Segments of many texts: (minimizer, segment's two hashes, text index, start, windows, may repeat in itself).

    A window that recurs inside its segment makes the text periodic around the bytes that all
    windows of a short segment share, so a seed from there occurs again to its right.
    """
    found: list[tuple[np.ndarray, ...]] = []
    hashes: list[bytes] = []
    inner: list[bool] = []
    held: list[bytes] = []
    places: list[tuple[int, int, int]] = []  # text, offset of the piece, windows
    size = 0

    def flush() -> None:
        nonlocal size
        if not places:
            return
        flat = b"".join(held)
        minima = window_minima(seed_hashes(np.frombuffer(flat, np.uint8), seed), match - seed + 1)
        counts = np.array([w for _, _, w in places])
        begin = np.concatenate([[0], np.cumsum([len(b) for b in held])[:-1]])
        piece = np.repeat(np.arange(len(places)), counts)
        inside = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
        m = minima[begin[piece] + inside]
        new = np.ones(len(m), bool)
        new[1:] = (m[1:] != m[:-1]) | (piece[1:] != piece[:-1])
        heads = np.flatnonzero(new)
        run = np.arange(len(m)) - np.repeat(heads, np.diff(np.append(heads, len(m))))
        heads = np.flatnonzero(run % SEGMENT_WINDOWS == 0)
        windows = np.diff(np.append(heads, len(m)))
        at = begin[piece[heads]] + inside[heads]
        digest = xxhash.xxh3_128_digest
        spans = list(zip(at.tolist(), windows.tolist(), strict=True))
        hashes.extend([digest(flat[a:a + w + match - 1]) for a, w in spans])
        inner.extend([w > match - seed + 1 or w > 1 and flat.find(flat[a + w - 1:a + w - 1 + seed], a + w, a + w + match - 1) >= 0
                      for a, w in spans])
        text, offset = (np.array([p[i] for p in places], np.int64)[piece[heads]] for i in (0, 1))
        found.append((m[heads], text, offset + inside[heads], windows))
        held.clear()
        places.clear()
        size = 0

    for i, raw in enumerate(raws):
        for base in range(0, len(raw) - match + 1, PIECE_BYTES):
            piece = raw[base:base + PIECE_BYTES + match - 1]
            held.append(piece)
            places.append((i, base, len(piece) - match + 1))
            size += len(piece)
            if size >= PIECE_BYTES:
                flush()
    flush()
    if not found:
        none = np.empty(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64).reshape(0, 2), none, none, none, none.astype(bool)
    m, text, start, windows = (np.concatenate(x) for x in zip(*found, strict=True))
    return m, np.frombuffer(b"".join(hashes), np.uint64).reshape(-1, 2), text, start, windows, np.array(inner, bool)


# ------------------------------------------------------------------ run-length index
def suffix_order(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions in suffix order; ``ends[i]`` is the position of the terminator that closes i's segment.

    Terminators sort below all bytes and among each other by position, so no two suffixes
    are equal.  Prefix doubling on ranks, from 7 packed bytes up.
    """
    n = len(codes)
    at = np.arange(n)
    room = ends - at  # bytes up to the terminator
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = key * 257 + np.where(room >= k, codes[np.minimum(at + k, n - 1)].astype(np.int64) + 1, 0)
    order = np.argsort(key, kind="stable")
    new = np.ones(n + 1, bool)  # whether a slot of the order begins a group of equal prefixes
    new[1:n] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new[:n], at, 0))
    length, longest = 7, int(room.max(initial=0)) + 1
    while length <= longest:
        slots = np.flatnonzero(~(new[:n] & new[1:]))  # of groups that are not yet single
        if not len(slots):
            break
        who = order[slots]
        behind = np.where(room[who] >= length, rank[np.minimum(who + length, n - 1)] + 1, 0)
        key = rank[who] * (n + 2) + behind
        by = np.argsort(key, kind="stable")
        who, key = who[by], key[by]
        order[slots] = who
        first = np.ones(len(slots), bool)
        first[1:] = key[1:] != key[:-1]
        new[slots] = first
        rank[who] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        length *= 2
    return order


class RunLengthIndex:
    """Run-compressed transform of a text of segments, with samples at run ends.

    ``heads``/``symbols`` are the runs; ``samples`` the text positions of run heads, ``before`` the
    positions of the run ends that precede them in suffix order, ``shared`` the bytes both
    have in common.  Samples are kept in text order.
    """

    def __init__(self, codes: np.ndarray, ends: np.ndarray):
        n = len(codes)
        order = suffix_order(codes, ends)
        transform = codes[order - 1]  # position 0 wraps to the last terminator
        new = np.ones(n, bool)
        new[1:] = transform[1:] != transform[:-1]
        new[1:] |= (transform[1:] == 0)  # terminators are all different symbols
        self.n, self.heads = n, np.flatnonzero(new)
        self.symbols = transform[self.heads]
        samples = order[self.heads]
        before = np.where(self.heads > 0, order[self.heads - 1], -1)
        by_text = np.argsort(samples)
        self.samples, self.before = samples[by_text], before[by_text]
        self.shared = shared_lengths(codes, ends, self.samples, self.before)

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For every text position its predecessor in suffix order (-1: none) and the bytes they share."""
        steps = np.diff(np.append(self.samples, self.n))
        away = np.arange(self.n) - np.repeat(self.samples, steps)
        before = np.repeat(self.before, steps)
        shared = np.maximum(np.repeat(self.shared, steps) - away, 0)
        return np.where(before < 0, -1, before + away), shared


def shared_lengths(codes: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes at ``a`` and ``b`` share, up to either terminator (b < 0: none)."""
    none = b < 0
    b = np.where(none, a, b)
    most = np.minimum(ends[a] - a, ends[b] - b)
    out = np.zeros(len(a), np.int64)
    live = np.flatnonzero(~none & (most > 0))
    while len(live):
        step = np.arange(16)
        reach = np.minimum(out[live][:, None] + step, most[live][:, None])
        x, y = a[live][:, None] + reach, b[live][:, None] + reach
        same = (codes[x] == codes[y]) & (reach < most[live][:, None])
        run = np.where(same.all(axis=1), 16, np.argmin(same, axis=1))
        out[live] += run
        live = live[run == 16]
    return out


def later_windows(segments: list[bytes], match: int = MATCH) -> np.ndarray:
    """Text positions (segments joined by one terminator each, in order) of windows that occur earlier."""
    lengths = np.array([len(s) for s in segments], np.int64)
    codes = np.zeros(int(lengths.sum()) + len(segments), np.uint16)
    ends = np.cumsum(lengths + 1) - 1
    body = np.ones(len(codes), bool)
    body[ends] = False
    codes[body] = np.frombuffer(b"".join(segments), np.uint8).astype(np.uint16) + 1
    before, shared = RunLengthIndex(codes, np.repeat(ends, lengths + 1)).matching_statistics()
    linked = np.flatnonzero(shared >= match)
    if not len(linked):
        return linked
    # chains of links lead to the smallest suffix of each kind: pointer doubling, then its earliest position
    members = np.union1d(linked, before[linked])
    to = np.arange(len(members))
    to[np.searchsorted(members, linked)] = np.searchsorted(members, before[linked])
    while True:
        further = to[to]
        if (further == to).all():
            break
        to = further
    first = np.full(len(members), len(codes))
    np.minimum.at(first, to, members)
    return members[first[to] != members]


# ------------------------------------------------------------------ tasks
SEGMENT_SCHEMA = ("deal long, minimizer long, segment long, segment2 long, doc long, twin int, start long, windows int, "
                  "inner boolean, repeated boolean")
#: Segments of one kind lie together and by place; those that repeat for sure come last.
SEGMENT_ORDER = ["repeated", "minimizer", "segment", "segment2", "doc", "twin", "start"]
DECIDED_SCHEMA = "minimizer long, doc long, twin int, start long, windows int, repeated boolean"
_MARKS = "doc long, twin int, start long, windows int"


def later_here(segment: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
    """Which segments (two hashes each) of a batch have an equal one at an earlier place in it."""
    order = np.argsort(segment[:, 0], kind="stable")
    again = np.zeros(len(segment) + 1, bool)
    again[1:-1] = segment[order[1:], 0] == segment[order[:-1], 0]
    some = order[again[:-1] | again[1:]]  # those whose first hash occurs again
    some = some[np.lexsort([*(p[some] for p in reversed(places)), segment[some, 1], segment[some, 0]])]
    later = np.zeros(len(segment), bool)
    later[some[1:]] = (segment[some[1:]] == segment[some[:-1]]).all(axis=1)
    return later


def _segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        m, h, text, start, windows, inner = segments_of([(t or "").encode() for t in b.column("text").to_pylist()])
        doc, twin = (b.column(c).to_numpy()[text] for c in ("doc", "twin"))
        later = later_here(h, [doc, twin, start])
        # a later one only needs to reach its document: it is dealt by place
        deal = np.where(later, (doc ^ start * 31) * np.int64(-7046029254386353131), m.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(deal), pa.array(m.view(np.int64)), *[pa.array(h[:, i].copy().view(np.int64)) for i in (0, 1)], pa.array(doc), pa.array(twin),
             pa.array(start), pa.array(windows.astype(np.int32)), pa.array(inner), pa.array(later)],
            [x.split()[0] for x in SEGMENT_SCHEMA.split(", ")])


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments that repeat as a whole, and the first ones that need their bytes compared.

    Streams rows in ``SEGMENT_ORDER``.  The first segment of a minimizer is
    held back until another one shows up, so memory does not depend on any group.
    """
    last: dict | None = None
    held: pa.RecordBatch | None = None
    names = ["minimizer", "doc", "twin", "start", "windows"]
    for b in batches:
        if not b.num_rows:
            continue
        cols = {c: b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names}

        def changes(c: str) -> np.ndarray:
            v = cols[c]  # noqa: B023
            out = np.ones(len(v), bool)
            out[1:] = v[1:] != v[:-1]
            out[0] = last is None or v[0] != last[c]  # noqa: B023
            return out

        known = cols["repeated"]
        by_minimizer = changes("repeated") | changes("minimizer")
        by_segment = by_minimizer | changes("segment") | changes("segment2")
        # the same place twice comes from identical rows: one document
        new_place = by_segment | changes("doc") | changes("twin") | changes("start")
        firsts = np.flatnonzero(by_segment & ~known)
        lead = by_minimizer[firsts]
        followed = np.append(~lead[1:], False)[:len(firsts)]
        compare = np.zeros(b.num_rows, bool)
        compare[firsts] = ~lead | followed | cols["inner"][firsts]
        parts = []
        if held is not None and len(firsts):
            if not lead[0]:
                parts.append((held, np.array([0]), np.array([False])))
            held = None
        if len(firsts) and lead[-1] and not compare[firsts[-1]]:
            held = b.slice(int(firsts[-1]), 1)
        out = np.flatnonzero(compare | (new_place & (known | ~by_segment)))
        parts.append((b, out, ~compare[out]))
        for rows, at, repeated in parts:
            taken = rows.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*[taken.column(c) for c in names], pa.array(repeated)], [*names, "repeated"])
        last = {c: cols[c][-1] for c in cols}


def _cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of a document's listed segments."""
    for b in batches:
        lists = b.column("places")
        sizes = np.diff(lists.offsets.to_numpy())
        places = lists.flatten()
        start, windows = (places.field(c).to_numpy() for c in ("start", "windows"))
        raws = [(t or "").encode() for t in b.column("text").to_pylist()]
        row = np.repeat(np.arange(len(raws)), sizes)
        data = [raws[r][s:s + w + MATCH - 1] for r, s, w in zip(row.tolist(), start.tolist(), windows.tolist(), strict=True)]
        at = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [places.field("minimizer"), b.column("doc").take(at), b.column("twin").take(at), pa.array(start),
             pa.array(data, pa.binary())], ["minimizer", "doc", "twin", "start", "data"])


def _index(group: pa.Table) -> pa.Table:
    """Windows of a bucket's segments that occur earlier, as runs."""
    cols = {c: group.column(c).to_numpy() for c in ("doc", "twin", "start")}
    order = np.lexsort([cols[c] for c in ("start", "twin", "doc")])
    cols = {c: v[order] for c, v in cols.items()}
    new = np.ones(len(order), bool)
    new[1:] = np.any([v[1:] != v[:-1] for v in cols.values()], axis=0)  # identical rows
    order, cols = order[new], {c: v[new] for c, v in cols.items()}
    data = group.column("data").to_pylist()
    segments = [data[i] for i in order]
    at = later_windows(segments)
    begin = np.cumsum([0, *[len(s) + 1 for s in segments[:-1]]])
    which = np.searchsorted(begin, at, "right") - 1
    head = np.ones(len(at), bool)
    head[1:] = (at[1:] != at[:-1] + 1) | (which[1:] != which[:-1])
    heads = np.flatnonzero(head)
    which, at = which[heads], at[heads]
    windows = np.diff(np.append(heads, len(head))).astype(np.int32)
    return pa.table({"doc": cols["doc"][which], "twin": cols["twin"][which],
                     "start": cols["start"][which] + at - begin[which], "windows": windows})


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the segments: a 128-bit hash of its bytes and its place."""
    for b in batches:
        starts = b.column("start").to_pylist()
        for i, data in enumerate(b.column("data").to_pylist()):
            n = len(data) - MATCH + 1
            hashes = [xxhash.xxh3_128_digest(data[j:j + MATCH]) for j in range(n)]
            at = pa.array(np.full(n, i))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.binary()), b.column("doc").take(at), b.column("twin").take(at), pa.array(starts[i] + np.arange(n))],
                ["hash", "doc", "twin", "start"])


def removed_spans(start: np.ndarray, windows: np.ndarray, match: int = MATCH) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [from, to) covered by marked windows."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], (start + windows + match - 1)[order]
    reach = np.maximum.accumulate(stop)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    return start[heads], reach[np.append(heads[1:], len(start)) - 1] if len(heads) else stop


RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column("places")
        n_bytes, n_removed, n_spans, digests = [], [], [], []
        for i, text in enumerate(b.column("text").to_pylist()):
            raw = (text or "").encode()
            n_bytes.append(len(raw))
            if not lists[i].is_valid:
                n_removed.append(0)
                n_spans.append(0)
                digests.append(hashlib.sha256(raw).hexdigest())
                continue
            places = lists[i].values
            a, z = removed_spans(places.field("start").to_numpy(), places.field("windows").to_numpy())
            kept, last = hashlib.sha256(), 0
            for x, y in zip(a.tolist(), z.tolist(), strict=True):
                kept.update(raw[last:x])
                last = y
            kept.update(raw[last:])
            n_removed.append(int((z - a).sum()))
            n_spans.append(len(a))
            digests.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)], pa.array(digests)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


# ------------------------------------------------------------------ operator
def _places(rows: DataFrame, *columns: str) -> DataFrame:
    """The listed places of each document; a list is at most as long as its text."""
    return rows.groupBy("doc", "twin").agg(F.collect_list(F.struct(*columns)).alias("places"))


def mark_repeats(texts: DataFrame) -> DataFrame:
    """``doc, twin, text`` -> doc, twin, start, windows: runs of windows that start earlier elsewhere."""
    segments = texts.mapInArrow(_segment_batches, SEGMENT_SCHEMA)
    in_order = segments.repartition("deal").sortWithinPartitions(*SEGMENT_ORDER)
    decided = stored(in_order.mapInArrow(_decide, DECIDED_SCHEMA), "segments")
    compare = decided.filter("NOT repeated")
    crowded = stored(compare.groupBy("minimizer").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > MINIMIZER_CAP).select("minimizer"), "crowded")
    index_bytes = compare.agg(F.sum(F.col("windows") + (MATCH - 1))).first()[0] or 0
    index_bucket = F.pmod(F.xxhash64("minimizer"), F.lit(max(1, -(-index_bytes // INDEX_BYTES))))
    # the listed segments with their bytes; the texts are joined once for both ways
    cut = stored(texts.join(_places(compare, "start", "windows", "minimizer"), ["doc", "twin"]).mapInArrow(
        _cut_segments, "minimizer long, doc long, twin int, start long, data binary"), "cut")
    some_crowded = not crowded.isEmpty()
    usual = cut.join(crowded, "minimizer", "left_anti") if some_crowded else cut
    marks = decided.filter("repeated").select("doc", "twin", "start", "windows").unionAll(
        usual.groupBy(index_bucket.alias("bucket")).applyInArrow(_index, _MARKS))
    if not some_crowded:
        return marks
    # a minimizer in very many different segments would be one bucket: its windows are dealt by their bytes
    windows = cut.join(crowded, "minimizer").mapInArrow(_windows, "hash binary, doc long, twin int, start long")
    windows = stored(windows, "windows")
    first = windows.groupBy("hash").agg(F.min(F.struct("doc", "twin", "start")).alias("first"))
    later = windows.join(first, "hash").filter(F.struct("doc", "twin", "start") != F.col("first"))
    return marks.unionAll(later.select("doc", "twin", "start", F.lit(1).alias("windows")))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("doc_id", F.lit(_LAST)).cast("long").alias("doc"),
                        _twin().alias("twin"), "text")
    marks = _places(mark_repeats(texts.select("doc", "twin", "text")), "start", "windows")
    return texts.join(marks, ["doc", "twin"], "left").select("doc_id", "text", "places").mapInArrow(_results, RESULT_SCHEMA)


def _twin() -> Column:
    """Tells rows that share a doc_id apart."""
    return F.pmod(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), F.lit(1 << 31)).cast("int")


def op8_rlbwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
