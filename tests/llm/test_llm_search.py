"""Operator 11 against a brute-force score of every document."""

import math
import random
import re
from collections import Counter

import pytest

from trailmark.llm import lexical_search as lex

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower)


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n, total = len(held), sum(x for _, _, x in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in items:
        scores = []
        for doc, counts, length in held:
            m = 100 - 90 + (90 * length * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * counts[w]) // (1000 * counts[w] + 8 * m))
                        for w in set(terms(text)) if w in counts)
            if score > 0:
                scores.append((-score, math.inf if doc is None else doc))
        out += [(item, rank, None if d == math.inf else d, -s) for rank, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return out


def random_tables(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Éa", "ß", "the", "THE", "x1"]
    some = lambda n: " ".join(draw.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, some(draw.choice([5, 5, 5, 20, draw.randint(1, 120)])).replace(" ", draw.choice([" ", ", ", "\x00", " "]))) for i in range(300)]
    docs += [(None, "w59 w58 the"), (None, None), (300, ""), (301, "?! ."), (5, docs[5][1]), (5, docs[5][1]), (302, "the " * 30_000)]
    items = [(i, some(draw.randint(1, 12))) for i in range(25)] + [(90, None), (91, "zzz"), (3, "w1"), (3, "w2 w59"), (3, "w2 w59"), (None, "w3"), (92, " w1,W1\tw1 ")]
    return docs, items


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize(("seed", "block", "chunk"), [(1, 16_384, 1 << 18), (2, 7, 20), (3, 1, 1 << 18)])
def test_equals_brute_force(spark, monkeypatch, seed, block, chunk):
    docs, items = random_tables(seed)
    monkeypatch.setattr(lex, "VISIT_BLOCKS", 5)
    got = lex.rank_documents(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS), block_docs=block, chunk_terms=chunk)
    assert rows(got) == sorted(brute(docs, items), key=str)


def test_strata_below_the_bound_are_left_out():
    """One strong document in the first stratum visited; the others cannot reach it."""
    items = lex.chunk_of([{"item": 0, "term": "a", "weight": 10}, {"item": 0, "term": "b", "weight": 5}])
    visitor = lex.Visitor(items, 1)

    def block(m, docs):
        import pyarrow as pa

        flat = [(t, i, i, tf) for i, counts in docs for t, tf in counts.items()]
        group = pa.table({c: [r[k] for r in flat] for k, c in enumerate(("term", "row", "doc_id", "tf"))})
        return lex._pack((pa.scalar(m),), group).to_pylist()[0]

    visitor.visit([block(500, [(7, {"a": 1}), (8, {"b": 3})]), block(20, [(1, {"a": 5, "b": 5}), (2, {"a": 1})]), block(900, [(9, {"a": 1, "z": 4})])])
    assert (visitor.visited, visitor.left_out) == (1, 2)
    ids, scores = visitor.found[0]
    assert ids.tolist() == [1] and scores.tolist() == [15 * (5_000_000_000 // (5000 + 160))]


def test_equal_scores_go_to_the_smaller_id_across_blocks(spark):
    docs = [(i, "same words here") for i in range(200, 0, -1)] + [(i, "other text") for i in range(300, 400)]
    got = lex.rank_documents(spark.createDataFrame(docs, DOCS).repartition(7), spark.createDataFrame([(1, "same")], ITEMS), block_docs=8)
    assert [r["doc_id"] for r in got.orderBy("rank").collect()] == list(range(1, 11))


def test_odd_tables(spark):
    none, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a")], ITEMS)
    assert lex.rank_documents(none, items).collect() == []
    assert lex.rank_documents(spark.createDataFrame([(1, "a")], DOCS), items.limit(0)).collect() == []
    # every document holds the term: its weight is floor(1000 ln(4/3))
    wide = spark.createDataFrame([(1, "a", "x", 5)], DOCS + ", term string, row long")
    clash = spark.createDataFrame([("k", "A", 1, 2)], "item_id string, text string, item long, rank int")
    assert [tuple(r) for r in lex.rank_documents(wide, clash).collect()] == [("k", 1, 1, 287 * (1_000_000_000 // 1800))]
