"""Operators 5, 6 and 8 against brute force on small tables."""

import hashlib
from collections import Counter
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trailmark.llm import exact_dedup as exact
from trailmark.llm import rlbwt_dedup as rl
from trailmark.llm import simhash as sim
from trailmark.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, fp long, component string, doc string, twin string, places string"


def docs(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", 0, "x", "x", "x", "x") for i, t in rows], SCHEMA)


# ------------------------------------------------------------------ exact dedup
def exact_brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0))
    out = []
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[key])
        keep = None if best[1] else best[2]
        out.append((i, keep, len(groups[key]), i == keep, hashlib.sha256(key.encode()).hexdigest()))
    return out


EXACT_ROWS = [(1, "a b"), (2, "ab"), (3, "a\tb "), (4, None), (5, ""), (6, " \n"), (7, "é x"), (8, "éx"), (9, "x" * 100_000),
              (10, "x" * 50_000 + " " + "x" * 50_000), (11, "c"), (11, "c"), (None, "d"), (None, "e"), (12, "e"), (13, "ab  ")]


def test_exact_dedup_against_brute_force(spark):
    got = exact.exact_dedup(docs(spark, EXACT_ROWS), exact.earlier_half(F.col("doc_id"))).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest"))).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, exact_brute(EXACT_ROWS)))


@pytest.mark.parametrize("historical", ["true", "false", "doc_id > 6"])
def test_exact_dedup_does_not_depend_on_the_history(spark, historical):
    got = exact.exact_dedup(docs(spark, EXACT_ROWS), F.expr(historical)).select("doc_id", "keep_id", "group_size").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(r[:3]) for r in exact_brute(EXACT_ROWS))


@pytest.mark.parametrize("historical", ["true", "false", "doc_id % 100 = 0"])
def test_exact_dedup_buckets_hold_few_keys_of_either_side(spark, monkeypatch, historical):
    monkeypatch.setattr(exact, "BUCKET_KEYS", 50)
    sized, keyed = [], exact._keyed
    monkeypatch.setattr(exact, "_keyed", lambda groups, n: sized.append((groups, n)) or keyed(groups, n))
    rows = [(i, f"text {i % 1_000}") for i in range(2_000)]
    got = exact.exact_dedup(docs(spark, rows), F.expr(historical)).select("doc_id", "keep_id", "group_size").collect()
    assert sorted(map(tuple, got)) == [(i, i % 1_000, 2) for i in range(2_000)]
    assert len(sized) == 2
    for groups, n in sized:  # index and arrivals
        largest = keyed(groups, n).groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
        assert n == 20 and largest <= 2 * 50


def test_exact_dedup_of_an_empty_table(spark):
    assert exact.exact_dedup(docs(spark, []), exact.earlier_half(F.col("doc_id"))).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 64, 700])
def test_perfect_hash_is_minimal_and_separates_members(n):
    raw = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), np.uint8).reshape(-1, 32)
    pilots, slots = exact.build_mph(raw)
    assert sorted(slots) == list(range(n))
    assert (exact.mph_slots(raw, pilots, n) == slots).all()
    other = np.frombuffer(b"".join(hashlib.sha256(b"x%d" % i).digest() for i in range(50)), np.uint8).reshape(-1, 32)
    at = exact.mph_slots(other, pilots, n)
    held = np.empty_like(raw)
    held[slots] = raw
    assert not (held[at] == other).all(axis=1).any()


# ------------------------------------------------------------------ simhash
def fingerprint_brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 3 else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_brute(fps):
    """Smallest index reachable by links of 3 or fewer bits."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


TEXTS = [None, "", " \t", "One", "one", "ÉCOLE a B", "école a b", "a b c", "a  b\nc", "a b c d", "w " * 5_000, "  x y z q",
         *[f"the quick brown fox {i} jumps over the lazy dog and runs far away from here today" for i in range(4)]]


def test_fingerprints_against_brute_force():
    assert sim.fingerprints(TEXTS) == [fingerprint_brute(t) for t in TEXTS]


def test_fingerprints_of_long_texts_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(4_000))
    monkeypatch.setattr(sim, "_FLUSH", 500)
    assert sim.fingerprints([text, "a b c d", text]) == [fingerprint_brute(t) for t in (text, "a b c d", text)]


def test_covering_masks_cover_every_triple_of_bits():
    masks = sim.covering_masks()
    assert len(masks) == 15
    for i in range(64):
        for j in range(i, 64):
            for k in range(j, 64):
                assert any(not m & (1 << i | 1 << j | 1 << k) for m in masks)


@pytest.mark.parametrize("cap", [sim.BUCKET_CAP, 2])
def test_links_lose_no_class(spark, cap):
    """Chains of flips, so classes reach far beyond the radius; small caps go the variant way."""
    rng = np.random.default_rng(5)
    fps = [0, 7, 15]
    for _ in range(6):
        fp = int(rng.integers(0, 1 << 63))
        for _ in range(12):
            fps.append(fp)
            for b in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                fp ^= 1 << int(b)
    fps = sorted(set(fps))
    rows = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "node long, fp long")
    links = sim.links(rows, cap)
    for r in links.collect():
        assert (fps[r["a"]] ^ fps[r["b"]]).bit_count() <= 3
    label = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert [label.get(i, i) for i in range(len(fps))] == classes_brute(fps)


def test_near_dedup_of_odd_rows(spark):
    rows = [(10 + i, t) for i, t in enumerate(TEXTS)] + [(10, None), (None, "a b c"), (11, "zz yy xx ww vv")]
    fps = [fingerprint_brute(t) for _, t in rows]
    label = classes_brute(fps)
    expected = []
    for (i, _), f, k in zip(rows, fps, label, strict=True):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == k and rows[j][0] is not None]
        expected.append((i, f"{f:016x}", min(ids)))
    got = sim.near_dedup(docs(spark, rows)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert sim.near_dedup(docs(spark, [])).collect() == []


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(5, 5), (7, 9)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, 9: 7}


# ------------------------------------------------------------------ run-length index
def repeats_brute(rows, match):
    """rows: (order, bytes); whether each window of each text starts earlier."""
    seen, out = set(), {}
    for key, raw in sorted(set(rows)):
        marked = bytearray(len(raw))
        for i in range(len(raw) - match + 1):
            if raw[i:i + match] in seen:
                marked[i:i + match] = b"\1" * match
            seen.add(raw[i:i + match])
        out[key, raw] = bytes(marked)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=60), min_size=1, max_size=8))
def test_later_windows_against_brute_force(texts):
    segments = [t.encode() for t in texts]
    seen, expected, offset = set(), [], 0
    for s in segments:
        for i in range(len(s) - 8 + 1):
            if s[i:i + 8] in seen:
                expected.append(offset + i)
            seen.add(s[i:i + 8])
        offset += len(s) + 1
    assert rl.later_windows(segments, 8).tolist() == expected


def test_matching_statistics_follow_from_the_run_samples():
    codes = np.frombuffer(b"banana bandana banana", np.uint8).astype(np.uint16) + 1
    codes = np.append(codes, 0).astype(np.uint16)
    ends = np.full(len(codes), len(codes) - 1)
    index = rl.RunLengthIndex(codes, ends)
    assert len(index.heads) < len(codes)
    order = rl.suffix_order(codes, ends)
    text = codes.tolist()
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    before, shared = index.matching_statistics()
    for x, y in zip(order[1:], order[:-1], strict=True):
        common = 0
        while x + common < len(text) - 1 and y + common < len(text) - 1 and text[x + common] == text[y + common]:
            common += 1
        assert (before[x], shared[x]) == (y, common)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", max_size=300), max_size=4), st.integers(0, 3))
def test_segments_partition_the_windows(texts, extra):
    raws = [t.encode() for t in texts] + [b"ab" * 90] * extra
    m, h, text, start, windows, inner = rl.segments_of(raws, 20, 6)
    there = sorted((t, s + i) for t, s, w in zip(text, start, windows, strict=True) for i in range(w))
    assert there == [(i, j) for i, r in enumerate(raws) for j in range(len(r) - 19)]
    for t, s, w, x in zip(text, start, windows, inner, strict=True):
        inside = [raws[t][i:i + 20] for i in range(s, s + w)]
        assert x or len(set(inside)) == len(inside)


def repeat_rows():
    rng = np.random.default_rng(3)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta"]
    base = [" ".join(rng.choice(words, 60)) for _ in range(4)]
    rows = [(i, base[i % 4][int(rng.integers(0, 50)):] + " " + base[(i * 7) % 4][:150 + i]) for i in range(24)]
    rows += [(30, None), (31, ""), (32, "a" * 500), (33, "a" * 99), (34, "ab" * 200), (35, base[0]), (35, base[0]), (36, base[0]),
             (None, base[1]), (40, "x" * 20_000 + base[2] + "y" * 300), (41, base[2] * 3)]
    return rows


@pytest.mark.parametrize("cap", [rl.MINIMIZER_CAP, 1])
def test_remove_repeats_against_brute_force(spark, monkeypatch, cap):
    monkeypatch.setattr(rl, "MINIMIZER_CAP", cap)
    rows = repeat_rows()
    got = rl.remove_repeats(docs(spark, rows)).collect()
    marks = repeats_brute([((i is None, i or 0), (t or "").encode()) for i, t in rows], rl.MATCH)
    expected = []
    for i, t in rows:
        raw = (t or "").encode()
        m = marks[(i is None, i or 0), raw]
        kept = bytes(b for b, x in zip(raw, m, strict=True) if not x)
        spans = sum(1 for j, x in enumerate(m) if x and not (j and m[j - 1]))
        expected.append((i, len(raw), sum(m), spans, hashlib.sha256(kept).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert rl.remove_repeats(docs(spark, [])).collect() == []


def test_later_segments_of_a_batch():
    rng = np.random.default_rng(8)
    segment, places = rng.integers(0, 6, (300, 2)).astype(np.uint64), [rng.integers(0, 5, 300) for _ in range(3)]
    later = rl.later_here(segment, places)
    groups: dict = {}
    for i, key in enumerate(map(tuple, segment.tolist())):
        groups.setdefault(key, []).append((tuple(int(p[i]) for p in places), i))
    for members in groups.values():
        first = min(members)[0]
        assert sum(not later[i] for _, i in members) == 1 and all(p == first for p, i in members if not later[i])
    assert rl.later_here(segment[:0], [p[:0] for p in places]).tolist() == []


def test_a_hot_passage_meets_by_minimizer_once_per_batch():
    """Of a thousand copies in a batch only the first goes to its minimizer; the others are dealt by document."""
    passage = b"".join(b"%d some shared words " % i for i in range(40))
    texts = [f"doc {i} ".encode() + passage for i in range(1000)]
    batch = rl.pa.RecordBatch.from_pydict({"text": [t.decode() for t in texts], "doc": np.arange(1000), "twin": np.zeros(1000, np.int32)})
    rows = next(rl._segment_batches(iter([batch])))
    repeated = rows.column("repeated").to_numpy(zero_copy_only=False)
    per_deal = Counter(rows.column("deal").to_pylist())
    minimizers = Counter(rows.column("minimizer").to_pylist())
    assert repeated.mean() > 0.8 and max(minimizers.values()) >= 1000
    inside = Counter(m for m, r in zip(rows.column("minimizer").to_pylist(), repeated, strict=True) if not r)
    # only the two segments at the passage's border differ from copy to copy
    assert sum(n > 1 for n in inside.values()) <= 4 and max(per_deal.values()) <= max(inside.values())


def test_decisions_do_not_depend_on_batches():
    rng = np.random.default_rng(0)
    n = 400
    cols = {"minimizer": rng.integers(0, 60, n), "segment": rng.integers(0, 2, n), "doc": rng.integers(0, 9, n),
            "twin": np.zeros(n, np.int32), "start": rng.integers(0, 3, n), "windows": np.full(n, 5, np.int32)}
    order = np.lexsort([cols[c] for c in ("start", "doc", "segment", "minimizer")])
    cols = {c: v[order] for c, v in cols.items()}
    cols["inner"] = cols["minimizer"] % 7 == 0
    cols |= {"segment2": np.zeros(n, np.int64), "repeated": np.zeros(n, bool)}
    batch = rl.pa.RecordBatch.from_pydict(cols)
    expected = []
    seen, places = set(), set()
    kinds = {m: len(set(cols["segment"][cols["minimizer"] == m])) for m in set(cols["minimizer"].tolist())}
    for m, g, d, s, i in zip(*[cols[c].tolist() for c in ("minimizer", "segment", "doc", "start", "inner")], strict=True):
        if (m, g) not in seen:
            if kinds[m] > 1 or i:
                expected.append((m, d, s, False))
        elif (m, g, d, s) not in places:
            expected.append((m, d, s, True))
        seen.add((m, g))
        places.add((m, g, d, s))
    # rows that are known to repeat come last: each place once
    known = rl.pa.RecordBatch.from_pydict({c: np.array([v[k] for k in (5, 5, 9)]) for c, v in cols.items() if c != "repeated"} | {"repeated": np.ones(3, bool)})
    expected += [(cols["minimizer"][k], cols["doc"][k], cols["start"][k], True) for k in (5, 9)]
    batch = rl.pa.Table.from_batches([batch, known.select(batch.schema.names)]).combine_chunks().to_batches()[0]
    for size in (1, 3, 50, n + 3):
        parts = [batch.slice(i, size) for i in range(0, n + 3, size)]
        got = [(r["minimizer"], r["doc"], r["start"], r["repeated"]) for b in rl._decide(iter(parts)) for r in b.to_pylist()]
        assert sorted(got) == sorted(expected)


def test_remove_repeats_with_small_pieces(spark, monkeypatch):
    """Pieces, segments and buckets far below the production size change nothing."""
    raws = [(t or "").encode() for _, t in repeat_rows()]
    whole = rl.segments_of(raws)
    monkeypatch.setattr(rl, "PIECE_BYTES", 150)
    monkeypatch.setattr(rl, "SEGMENT_WINDOWS", 40)
    cut = rl.segments_of(raws)

    def by_window(found):
        return {(t, s + i): m for m, _, t, s, w, _ in zip(*found, strict=True) for i in range(w)}

    assert by_window(whole) == by_window(cut)
