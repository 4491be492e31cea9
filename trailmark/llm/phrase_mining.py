"""Phrase collocations by dynamic itemset counting.

The corpus is dealt into ``SHARDS`` shards that are scanned in a cycle.  Words are counted from the
start; a longer phrase is active from the step after both its subphrases (all words but the
last, all but the first) have reached the threshold in what was counted so far, so lengths are
counted side by side in one scan.  A phrase is counted for one full cycle of shards from
the step in which it became active, and scanning ends when no active phrase has shards left.

What tasks need to know is in one byte array of fixed size: for a hash cell, the step from which a
phrase of that hash is frequent.  The later of the two subphrases' steps is the step in which a
phrase became active, so a scan knows which phrases to count in its shard, and that it
counted the others there before, without a table of phrases.  Cells only ever gain a step, so two
phrases that share one are at worst counted early: no count is lost or doubled.

Phrases are counted under 128-bit hashes chained from their words' (seeded by the language), so that the many
that stay rare are never spelled out.  Counts are combined inside the tasks and by Spark's partial aggregation,
added to the counts so far, and written once a step; phrases that completed their cycle below the
threshold leave that table.  No task holds a language, a phrase or a document's neighbours as a
group.  A count keeps the number of a text that holds its phrase; in the end each candidate is spelled
from that text.

Every candidate is cut in all places; its parts' counts come by joins (a part of a
frequent phrase is frequent).  Scores are exact decimals.

Defined cases: a null text is empty, a null lang is ``und`` (joined with rows of that name); repeated
rows count each time; texts of any length are read whole; phrases never cross a piece; an empty
table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import dropped, stored, table

#: Words of the longest phrase, occurrences that make a phrase frequent, shards of a cycle.
LONGEST, THRESHOLD, SHARDS = 4, 30, 3
#: Hash cells of the array of steps (bytes), and the largest bitmap piece that reaches the driver.
CELL_BITS, PIECE_BITS = 24, 16
#: Tokens that a task counts at once, and bytes that it splits into words at once.
BUFFER_TOKENS, CHUNK_BYTES = 1 << 20, 1 << 19
NEVER = 255
PER_LANG, DROP_PERCENT, SCALE = 2000, 80, 2_000_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

# Bytes that end a piece, and those between words.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_BREAK = 0xFF  # never in UTF-8
_BREAK_BYTE = b"."


def _translation() -> bytes:
    to = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        to[c] = c + 32
    for c in PIECE_ENDS:
        to[c] = _BREAK
    for c in BLANKS:
        to[c] = 32
    return bytes(to)


_TO = _translation()


# ------------------------------------------------------------------ words
def pieces_of(raw: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``CHUNK_BYTES``, cut between words."""
    at, last = 0, len(raw)
    while at < last:
        to = at + CHUNK_BYTES
        if to < last:  # a word stays whole
            ends = [i for i in (raw.find(b" ", to), raw.find(b"\n", to)) if i >= 0]
            to = min(ends) if ends else last
        yield raw[at:to]
        at = to


def tokens_of(raw: bytes) -> list[bytes]:
    """Lower-cased words in order, with a break between pieces (no other byte than a blank splits: line ends are breaks)."""
    return raw.translate(_TO).replace(b"\xff", b" \xff ").split()


#: Bytes of the longest word that is hashed in runs of eight bytes; the digest library takes longer ones, one by one.
LONG_WORD = 64
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_MIXERS = ((0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53), (0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(h: np.ndarray, first: int, second: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(first)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(second)
    return h ^ (h >> np.uint64(32))


def hashed(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and two 64-bit hashes (0, 0 for a break) of every token of ``tokens_of(raw)``.

    Eight bytes of all words are read at once, so a word of up to eight costs one step.
    """
    text = raw.translate(_TO)
    a = np.frombuffer(text, np.uint8)
    breaks = a == _BREAK
    inside = np.append((a != 32) & ~breaks, False)
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    starts = np.flatnonzero(begins | breaks)
    words = ~breaks[starts]
    sizes = np.zeros(len(starts), np.int64)
    sizes[words] = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1 - starts[words]
    eights = np.ndarray((len(a) + 1,), "<u8", text + bytes(8), strides=(1,))
    x, n = eights[starts] & _MASKS[np.minimum(sizes, 8)], sizes.astype(np.uint64)
    h = np.empty((2, len(starts)), np.uint64)
    for i, (seed, *mixers) in enumerate(_MIXERS):
        h[i] = _mixed(x ^ n * np.uint64(seed), *mixers)
    at, more = 8, np.flatnonzero(sizes > 8)
    while len(more) and at < LONG_WORD:
        x = eights[starts[more] + at] & _MASKS[np.minimum(sizes[more] - at, 8)]
        for i, (seed, *mixers) in enumerate(_MIXERS):
            h[i, more] = _mixed(h[i, more] * np.uint64(seed) + x, *mixers)
        at += 8
        more = more[sizes[more] > at]
    for i in more.tolist():
        whole = xxhash.xxh3_128_intdigest(text[starts[i]:starts[i] + sizes[i]])
        h[:, i] = whole >> 64, whole & 0xFFFFFFFFFFFFFFFF
    h[:, ~words] = 0
    return starts, h.T


def lang_seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode(), 1)


def cells_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Hash cell of a phrase from its chained hash."""
    h = hashes ^ (hashes >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(29))) >> np.uint64(64 - bits)).astype(np.int64)


def chained(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    return prefix * _MULTIPLIER + word


# ------------------------------------------------------------------ one scan
def groups(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One position and the size of every group of equal (key, check)."""

    def borders(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, c = key[order], check[order]
        heads = np.flatnonzero(np.append(len(order) > 0, (k[1:] != k[:-1]) | (c[1:] != c[:-1])))
        return heads, k[heads]

    order = np.argsort(key)
    heads, keys = borders(order)
    if (keys[1:] == keys[:-1]).any():  # phrases that share a key: order by the check too
        order = np.lexsort((check, key))
        heads, _ = borders(order)
    return order[heads], np.diff(np.append(heads, len(order)))


class Scan:
    """Counts of one step in one task: ``since[cell]`` is the step from which its phrases are frequent.

    Tokens of many texts are counted together; phrases never cross a break, and each text ends with one.
    """

    def __init__(self, since: np.ndarray, bits: int, step: int, shards: int, longest: int):
        self.since, self.bits, self.step, self.shards, self.longest = since, bits, step, shards, longest
        self.raws: list[bytes] = []  # not yet hashed, with (lang, row) of each
        self.owners: list[tuple[str, int]] = []
        self.raw_size = 0
        self.hashes: list[np.ndarray] = []
        self.runs: list[tuple[str, int, int]] = []  # lang, row, tokens
        self.size = 0

    def add(self, lang: str, row: int, text: str | None) -> Iterator[pa.RecordBatch]:
        if not text:
            return
        for piece in pieces_of(text.encode()):
            yield from self._put(lang, row, piece + b" ")
        yield from self._put(lang, row, _BREAK_BYTE)

    def _put(self, lang: str, row: int, raw: bytes) -> Iterator[pa.RecordBatch]:
        self.raws.append(raw)
        self.owners.append((lang, row))
        self.raw_size += len(raw)
        if self.raw_size >= CHUNK_BYTES:
            self._hash()
            if self.size >= BUFFER_TOKENS:
                # phrases that begin before the last few words; those begin the next buffer
                yield from self._count(self.longest - 1)

    def _hash(self) -> None:
        starts, pairs = hashed(b"".join(self.raws))
        ends = np.searchsorted(starts, np.cumsum([len(r) for r in self.raws]))
        sizes = np.diff(ends, prepend=0).tolist()
        self.hashes.append(pairs.T)
        self.runs += [(lang, row, n) for (lang, row), n in zip(self.owners, sizes, strict=True) if n]
        self.size += len(pairs)
        self.raws, self.owners, self.raw_size = [], [], 0

    def finish(self) -> Iterator[pa.RecordBatch]:
        self.raws += [_BREAK_BYTE] * self.longest
        self.owners += [("", 0)] * self.longest
        self._hash()
        yield from self._count(0)

    def _count(self, keep: int) -> Iterator[pa.RecordBatch]:
        pairs = np.concatenate(self.hashes, axis=1)
        starts = pairs.shape[1] - max(keep, self.longest - 1)
        if starts <= 0:
            return
        names = list(dict.fromkeys(lang for lang, _, _ in self.runs))
        number = {lang: i for i, lang in enumerate(names)}
        sizes = [n for *_, n in self.runs]
        lang, row = np.repeat([number[x] for x, _, _ in self.runs], sizes), np.repeat(np.array([r for _, r, _ in self.runs], np.int64), sizes)
        self.hashes, self.size = ([pairs[:, starts:].copy()], pairs.shape[1] - starts) if keep else ([], 0)
        self.runs = [(names[x], r, 1) for x, r in zip(lang[starts:].tolist(), row[starts:].tolist(), strict=True)] if keep else []
        there = (pairs[0] | pairs[1]) != 0
        seeds = np.array([lang_seed(x) for x in names], np.uint64)
        words, checks = pairs ^ seeds[lang]
        if self.step < self.shards:  # words are active from the start
            every = np.flatnonzero(there[:starts])
            yield self._counted(every, words[every], checks, 1, np.zeros(len(every), np.uint8), row)
            total = np.bincount(lang[every], minlength=len(names))
            some, none = np.flatnonzero(total), np.zeros(len(names), np.int64)
            yield _record(seeds[some].view(np.int64), none[some], 0, none[some], total[some], none[some])
        # at: where frequent phrases begin; ready: the steps from which they are, no earlier than they are active
        ready = np.where(there, self.since[cells_of(words, self.bits)], NEVER)
        at = np.flatnonzero(ready <= self.step)
        chain, ready = words[at], ready[at]
        for k in range(2, self.longest + 1):
            both = np.flatnonzero(at[1:] == at[:-1] + 1)
            opened = np.maximum(ready[both], ready[both + 1])
            at, chain = at[both], chained(chain[both], words[at[both] + (k - 1)])
            due = np.flatnonzero((opened > self.step - self.shards) & (at < starts))
            if len(due):
                yield self._counted(at[due], chain[due], checks, k, opened[due], row)
            if k < self.longest:
                ready = np.maximum(self.since[cells_of(chain, self.bits)], opened)
                frequent = np.flatnonzero(ready <= self.step)
                at, chain, ready = at[frequent], chain[frequent], ready[frequent]

    def _counted(self, at: np.ndarray, chain: np.ndarray, checks: np.ndarray, k: int, opened: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
        """The phrases of ``k`` words that begin at ``at``, with their counts and a text that holds them."""
        check = checks[at]
        for i in range(1, k):
            check = chained(check, checks[at + i])
        first, counts = groups(chain, check)
        return _record(chain[first].view(np.int64), check[first].view(np.int64), k, opened[first].astype(np.int64), counts, row[at[first]])


_KEY = ["key", "check", "words"]
COUNTS_SCHEMA = "key long, check long, words int, opened int, a long, row long"


def _record(key: np.ndarray, check: np.ndarray, k: int, opened: np.ndarray, a: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(check), pa.array(np.full(len(key), k, np.int32)), pa.array(opened.astype(np.int32)),
         pa.array(a.astype(np.int64)), pa.array(row)], [*_KEY, "opened", "a", "row"])


def scan_shard(shard: DataFrame, packed, bits: int, step: int, shards: int, longest: int) -> DataFrame:
    """Counts of the phrases that are due in this shard at this step; ``packed`` is a broadcast of the array of steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan(np.frombuffer(pa.decompress(packed.value, 1 << bits, "zstd"), np.uint8), bits, step, shards, longest)
        for b in batches:
            for lang, row, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                yield from scan.add(lang, row, text)
        yield from scan.finish()

    return shard.select("lang", "row", "text").mapInArrow(run, COUNTS_SCHEMA)


def spelled_in(lang: str, text: str, wanted: list[dict]) -> list[tuple[str, str, int, int]]:
    """(lang, phrase, words, a) of the listed phrases of a text."""
    raw = text.encode()
    lower, (starts, pairs) = raw.translate(_TO), hashed(raw)
    starts = np.append(starts, len(raw))
    there, seed = (pairs[:, 0] | pairs[:, 1]) != 0, np.uint64(lang_seed(lang))
    words, checks = pairs[:, 0] ^ seed, pairs[:, 1] ^ seed
    out = []
    chain, check, whole = words, checks, there
    for k in range(2, max(w["words"] for w in wanted) + 1):
        chain, check, whole = chained(chain[:-1], words[k - 1:]), chained(check[:-1], checks[k - 1:]), whole[:-1] & there[k - 1:]
        left = {(w["key"], w["check"]): w["a"] for w in wanted if w["words"] == k}
        keys = np.array([key for key, _ in left], np.int64).view(np.uint64)
        for i in np.flatnonzero(whole & np.isin(chain, keys)).tolist():
            a = left.pop((int(chain[i].view(np.int64)), int(check[i].view(np.int64))), None)
            if a is not None:  # a break behind the phrase begins where its last word ends
                out.append((lang, b" ".join(lower[starts[i]:starts[i + k]].split()).decode(), k, a))
    return out


def spell(corpus: DataFrame, candidates: DataFrame) -> DataFrame:
    """lang, phrase, words, a: every candidate (key, check, words, a, row) is read once, from the text it names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [x for lang, text, wanted in zip(*(b.column(c).to_pylist() for c in ("lang", "text", "wanted")), strict=True)
                    for x in spelled_in(lang, text, wanted)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int32(), pa.int64()))],
                ["lang", "phrase", "words", "a"])

    # a list is at most as long as its text
    wanted = candidates.groupBy("row").agg(F.collect_list(F.struct("key", "check", "words", "a")).alias("wanted"))
    return corpus.join(wanted, "row").select("lang", "text", "wanted").mapInArrow(run, "lang string, phrase string, words int, a long")


def _lang_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        seeds = np.array([lang_seed(x) for x in b.column(0).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(seeds)], ["lang", "key"])


# ------------------------------------------------------------------ newly frequent cells
def _phrase_cells(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        c = cells_of(b.column(0).to_numpy().view(np.uint64), bits)
        yield pa.RecordBatch.from_arrays([pa.array(c >> PIECE_BITS), pa.array((c & ((1 << PIECE_BITS) - 1)).astype(np.int32))], ["piece", "bit"])


def _bitmap(group: pa.Table) -> pa.Table:
    held = np.zeros(1 << PIECE_BITS, np.uint8)
    held[group.column("bit").to_numpy()] = 1
    return pa.table({"piece": group.column("piece").slice(0, 1), "bits": pa.array([np.packbits(held).tobytes()], pa.binary())})


def cells_with(phrases: DataFrame, bits: int) -> np.ndarray:
    """Whether each cell has one of the phrases (column key); at most 2^bits bits reach the driver."""
    cells = phrases.select("key").mapInArrow(lambda batches: _phrase_cells(batches, bits), "piece long, bit int").distinct()
    out = np.zeros(1 << bits, bool)
    for r in cells.groupBy("piece").applyInArrow(_bitmap, "piece long, bits binary").collect():
        at = r["piece"] << PIECE_BITS
        held = np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool)[:len(out) - at]
        out[at:at + len(held)] = held
    return out


# ------------------------------------------------------------------ operator
class Phrases(NamedTuple):
    """``counts``: key, check, words, a of every frequent phrase; ``candidates``: the longer ones with lang and phrase;
    ``totals``: lang, n (all word occurrences)."""

    counts: DataFrame
    candidates: DataFrame
    totals: DataFrame


def count_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS,
                  bits: int = CELL_BITS) -> Phrases:
    """Every phrase of up to ``longest`` words that occurs ``threshold`` times or more in a language."""
    spark = docs.sparkSession
    dealt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).alias("shard")
    corpus = stored(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.monotonically_increasing_id().alias("row"), "text", dealt)
                    .filter("text != ''"), "shards", "shard")
    since = np.full(1 << bits, NEVER, np.uint8)
    counts: DataFrame | None = None
    step = 0
    # a phrase opened in some step has shards left until a cycle later
    while step < shards or ((since != NEVER) & (since > step - shards)).any():
        if step >= NEVER - 1:
            raise RuntimeError("more steps than the array of steps can hold")
        packed = spark.sparkContext.broadcast(pa.compress(since.tobytes(), "zstd", asbytes=True))
        found = scan_shard(corpus.filter(F.col("shard") == step % shards), packed, bits, step, shards, longest)
        rows = found if counts is None else counts.unionAll(found)
        total = rows.groupBy(*_KEY).agg(F.min("opened").alias("opened"), F.sum("a").alias("a"), F.min("row").alias("row"))
        complete = F.col("opened") + (shards - 1) <= step
        before, counts = counts, stored(total.filter(~complete | (F.col("a") >= threshold) | (F.col("words") == 0)), f"counts-{step}")
        if before is not None:
            dropped(before)
        packed.unpersist()
        step += 1
        inner = counts.filter((F.col("a") >= threshold) & F.col("words").between(1, longest - 1))
        since[cells_with(inner, bits) & (since == NEVER)] = step
    frequent = counts.filter((F.col("a") >= threshold) & (F.col("words") > 0))
    candidates = stored(spell(corpus, frequent.filter("words > 1")), "spelled")
    langs = corpus.select("lang").distinct().mapInArrow(_lang_keys, "lang string, key long")
    totals = stored(langs.join(counts.filter("words = 0").select("key", F.col("a").alias("n")), "key").select("lang", "n"), "totals")
    dropped(corpus)
    return Phrases(frequent.select(*_KEY, "a"), candidates, totals)


CUTS_SCHEMA = ("lang string, phrase string, words int, a long, k int, left_key long, left_check long, left_words int, "
               "right_key long, right_check long, right_words int")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every candidate cut after its first k words, with the keys of both parts."""
    for b in batches:
        langs, phrases = (b.column(c).to_pylist() for c in ("lang", "phrase"))
        n = b.column("words").to_numpy().astype(np.int64)
        seeds = {x: lang_seed(x) for x in set(langs)}
        # all phrases in one text, a break behind each (there is none inside)
        pairs = hashed(b"".join(p.encode() + _BREAK_BYTE for p in phrases))[1].T
        hashes = pairs ^ np.repeat(np.array([seeds[x] for x in langs], np.uint64), n + 1)
        begin = np.cumsum(n + 1) - (n + 1)
        which = np.repeat(np.arange(len(n)), n - 1)
        k = np.arange(len(which)) - np.repeat(np.cumsum(n - 1) - (n - 1), n - 1) + 1
        parts = []
        for first, size in ((begin[which], k), (begin[which] + k, n[which] - k)):
            for of in hashes:
                key = of[first]
                for i in range(1, int(size.max(initial=0))):
                    longer = np.flatnonzero(size > i)
                    key[longer] = chained(key[longer], of[first[longer] + i])
                parts.append(pa.array(key.view(np.int64)))
            parts.append(pa.array(size.astype(np.int32)))
        kept = b.select(["lang", "phrase", "words", "a"]).take(pa.array(which))
        names = [x.split()[0] for x in CUTS_SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(k.astype(np.int32)), *parts], names)


def _side(counts: DataFrame, side: str, name: str) -> DataFrame:
    return counts.select(*[F.col(c).alias(f"{side}_{c}") for c in _KEY], F.col("a").alias(name))


def _part(first: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, n), " ")


def score_phrases(phrases: Phrases) -> DataFrame:
    """lang, phrase, words, a, l, r, score of every candidate at its lowest-scoring cut (ties: the earliest)."""
    joined = phrases.candidates.mapInArrow(_cut, CUTS_SCHEMA)
    for side, name in (("left", "l"), ("right", "r")):
        joined = joined.join(_side(phrases.counts, side, name), [f"{side}_{c}" for c in _KEY])
    scored = joined.withColumn("score", F.expr(
        f"cast((cast({SCALE} AS decimal(10,0)) * cast(a AS decimal(20,0))) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0))) AS long)"))
    best = scored.groupBy("lang", "phrase").agg(
        F.max("words").alias("words"), F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def without_covered(candidates: DataFrame, percent: int = DROP_PERCENT) -> DataFrame:
    """Drops candidates whose words lie inside a longer candidate that has at least ``percent`` of their count."""
    inner = candidates.filter("words > 2").select(
        "lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("n")).select(
        "*", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("n") + 1)).alias("at"))
    longer = inner.select("lang", _part(F.col("at"), F.col("n")).alias("phrase"), F.col("a").alias("longer")).groupBy(
        "lang", "phrase").agg(F.max("longer").alias("longer"))
    wide = "decimal(20,0)"
    covered = F.expr(f"cast(100 AS decimal(3,0)) * cast(longer AS {wide}) >= cast({percent} AS decimal(3,0)) * cast(a AS {wide})")
    return candidates.join(longer, ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False))).drop("longer")


def mine_phrases(docs: DataFrame, threshold: int = THRESHOLD, most: int = PER_LANG, **counting) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``most`` best phrases of every language."""
    phrases = count_phrases(docs, threshold, **counting)
    kept = without_covered(stored(score_phrases(phrases), "candidates"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.join(phrases.totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents"))


_GRAMS = " UNION ALL ".join(
    f"SELECT lang, {n} AS words, array_to_string(w[i:i + {n - 1}], ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {n - 2})) AS i FROM p WHERE len(w) >= {n})"
    for n in range(1, LONGEST + 1))
OP12_SQL = f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM t),
f AS (SELECT lang, words, phrase, count(*) AS a FROM ({_GRAMS}) GROUP BY ALL),
total AS (SELECT lang, sum(a) AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND a >= {THRESHOLD}),
cuts AS (SELECT lang, words, phrase, a, w, unnest(range(1, words)) AS k FROM c),
s AS (SELECT cuts.*, x.a AS l, y.a AS r, (CAST({SCALE} AS HUGEINT) * cuts.a) // (x.a + y.a) AS score FROM cuts
      JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[:k], ' ') AND x.words = k
      JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[k + 1:], ' ') AND y.words = cuts.words - k),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, words, a, w, unnest(range(2, words)) AS n FROM c),
longer AS (SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, max(a) AS a FROM
           (SELECT lang, a, w, n, unnest(range(1, words - n + 2)) AS i FROM inner_) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE coalesce(100 * longer.a < {DROP_PERCENT} * best.a, TRUE)),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= {PER_LANG}
"""
