"""Operators 1, 2, 4 and 10, and the pipeline."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from trailmark.llm import mixing, packing, registry, sharding, topk
from trailmark.llm.common import keep_rows, number_within, stored, text_key

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slot long, sequence_id long, rate double, __file string"
ROWS = [(i, f"text number {i} " * (i % 40)) for i in range(400)] + [(1, "text number 1 "), (None, None), (None, "n"), (500, ""), (501, "w " * 60_000)]


def docs(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "en", "s", 0, 0, 0, 0.0, "x") for i, t in rows], SCHEMA)


# ------------------------------------------------------------------ sharding
def test_shards_of_odd_rows(spark):
    got = sharding.shard_documents(docs(spark)).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in ROWS)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 8)
    assert set(slots) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r["doc_id"], r["shard"]) for r in got}) == len({i for i, _ in ROWS})
    assert sharding.shard_documents(docs(spark, [])).collect() == []


def test_shards_follow_their_weights_and_moves_stay_local(spark):
    ids = spark.range(20_000)
    tree = sharding.SHARDS_8
    heavier = tuple(x._replace(weight=3.0) if x.shard == 5 else x for x in tree)
    rows = ids.select(sharding.shard_of(F.col("id"), tree).alias("a"), sharding.shard_of(F.col("id"), heavier).alias("b"),
                      sharding.shard_of(F.col("id"), sharding.grown(tree)).alias("c")).collect()
    assert all(abs(n - 2_500) < 250 for n in Counter(r["a"] for r in rows).values())
    assert abs(Counter(r["b"] for r in rows)[5] - 6_000) < 400
    # region of shard 5 is 1 (shards 4-7): nothing moves inside region 0 or out of region 1
    assert all(r["b"] == r["a"] or r["b"] in (4, 5, 6, 7) for r in rows)
    assert all(r["a"] == r["b"] for r in rows if r["b"] < 4)
    assert all(r["c"] in (r["a"], 8) for r in rows) and abs(Counter(r["c"] for r in rows)[8] - 20_000 / 9) < 250


def shard_brute(key, tree):
    """Second implementation of the draws: XXH64 of the level's name, then of the id, seeded by it."""
    for level in ("region", "rack", "shard"):
        weights = defaultdict(float)
        for leaf in tree:
            weights[getattr(leaf, level)] += leaf.weight
        best = None
        for child, weight in weights.items():
            if weight <= 0:
                continue
            h = xxhash.xxh64_intdigest(f"{level}/{child}".encode(), seed=42)
            if key is not None:
                h = xxhash.xxh64_intdigest(int(key).to_bytes(8, "little", signed=True), seed=h)
            draw = (-math.log((h % (1 << 52) + 0.5) / (1 << 52)) / weight, child)
            best = min(best, draw) if best else draw
        tree = [leaf for leaf in tree if getattr(leaf, level) == best[1]]
    return best[1]


def test_shards_equal_a_second_implementation_of_the_draws(spark):
    keys = [None, 0, -1, -(1 << 63), (1 << 63) - 1, *range(1, 400), *range(10**12, 10**12 + 50)]
    rows = spark.createDataFrame([(k,) for k in keys], "doc_id long")
    uneven = tuple(sharding.Leaf(s // 4, s // 2, s, w) for s, w in enumerate([1, 2, 0.5, 3, 1, 1, 0, 4]))
    for tree in (sharding.SHARDS_8, sharding.grown(sharding.SHARDS_8), uneven):
        got = rows.select("doc_id", sharding.shard_of(F.col("doc_id"), tree).alias("shard")).collect()
        assert {r["doc_id"]: r["shard"] for r in got} == {k: shard_brute(k, tree) for k in keys}
    odd = sharding.shard_documents(docs(spark)).collect()
    assert all((r["shard"], r["grown_shard"]) == (shard_brute(r["doc_id"], sharding.SHARDS_8), shard_brute(r["doc_id"], sharding.grown(sharding.SHARDS_8))) for r in odd)


def test_a_tree_needs_weight():
    with pytest.raises(ValueError, match="positive"):
        sharding.shard_of(None, (sharding.Leaf(0, 0, 0, 0.0),))


def test_numbers_are_gapless_for_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr("trailmark.llm.common.BLOCK_ROWS", 64)
    rows = spark.range(2_000).select(F.expr("if(id % 3 = 0, id, null)").alias("k"), "id").withColumn("k", F.col("k") % 5)
    got = number_within(stored(rows, "t"), ["k"], "n").collect()
    by = defaultdict(list)
    for r in got:
        by[r["k"]].append(r["n"])
    assert len(got) == 2_000 and all(sorted(v) == list(range(len(v))) for v in by.values())


def test_keep_rows_takes_one_of_each(spark):
    d = docs(spark, [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, None)])
    winners = d.filter("text IS NULL OR text IN ('a', 'c')").select("doc_id", text_key().alias("row_key"))
    assert sorted((repr(r["doc_id"]), repr(r["text"])) for r in keep_rows(d, winners).collect()) == [("1", "'a'"), ("2", "None"), ("None", "'c'")]


# ------------------------------------------------------------------ top-k
def topk_brute(rows, k=5):
    held = []
    for i, v in rows:
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        held.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for n, (i, q) in enumerate(held):
        if i is not None and i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, p, strict=True)), j is None, j or 0) for m, (j, p) in enumerate(held)
                            if m != n and len(p) == len(q))[:k]
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(scores)]
    return sorted(out, key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int, score long")


@pytest.mark.parametrize("block", [topk.BLOCK_VECTORS, 150, 20])
def test_topk_against_brute_force(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.3, 8).astype(np.float32).tolist()) for i in range(700)]
    rows += [(700, None), (701, [0.1, None] + [0.0] * 6), (702, [float("nan")] * 8), (703, [float("inf")] * 8), (704, []), (750, []),
             (705, [0.5] * 3), (800, [0.5] * 3), (50, rows[50][1]), (None, [0.1] * 8), (706, rows[0][1]), (707, rows[0][1]),
             (850, [0.0] * 8), (900, [1e6] * 8)]
    rows += [(100, rows[3][1]), (150, rows[150][1]), (3, rows[3][1]), (None, rows[50][1])]  # ids that repeat, and none
    got = topk.search_top_k(vectors(spark, rows).repartition(3), F.col("vec_id") % topk.QUERY_EVERY == 0, block).collect()
    assert sorted(map(tuple, got), key=str) == topk_brute(rows)


def test_topk_equals_its_sql_where_ids_repeat(spark, tmp_path):
    import duckdb

    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(0, 0.3, 6).astype(np.float32).tolist()) for i in rng.integers(0, 200, 500)] + [(None, [0.5] * 6), (50, None)]
    vectors(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    got = sorted(map(tuple, topk.op4_topk(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(con.sql(topk.OP4_SQL).fetchall(), key=str) and len(got) > 25


def test_the_index_is_shuffled_once_whatever_the_number_of_queries(spark):
    rng = np.random.default_rng(6)
    table = vectors(spark, [(i, rng.normal(0, 0.3, 16).astype(np.float32).tolist()) for i in range(600)])

    def index_rows(every):
        rows = stored(topk.quantised(table), "q")
        index = topk.build_index(rows, 4)
        plan = topk.search_top_k(table, F.col("vec_id") % every == 0, 150)._jdf.queryExecution().optimizedPlan().toString()
        return index.count(), sum(index.select(F.sum(F.length("q") + F.length("impact_order"))).first()), plan.count("Generate explode")

    # the queries alone are multiplied (one Generate), the index is one row per block
    assert index_rows(50) == index_rows(2) == (4, 600 * 16 * (4 + 2), 1)


def test_topk_bounds_hold_while_pruning():
    rng = np.random.default_rng(2)
    center = rng.normal(0, 1, (12, 24))
    v = np.floor(256 * (center[rng.integers(0, 12, 3_000)] + rng.normal(0, 0.2, (3_000, 24)))).astype(np.int64)
    ids = np.arange(3_000)
    block = topk.BlockIndex(ids, ids, v, np.argsort(v, axis=0, kind="stable").T.astype(np.int32))
    pruned = 0
    for i in range(0, 3_000, 50):
        allowed = ids != i
        pruned += len(block._members(v[i], allowed, 5)) < 2_999
        at, scores = block.top(v[i], i, 5)
        every = v @ v[i]
        order = np.lexsort((ids[allowed], -every[allowed]))[:5]
        assert ids[at].tolist() == ids[allowed][order].tolist() and scores.tolist() == every[allowed][order].tolist()
    assert pruned > 50  # the proof ends the search early on clustered vectors


def test_topk_of_an_empty_table(spark):
    assert topk.search_top_k(vectors(spark, []), F.col("vec_id") % 50 == 0).collect() == []


# ------------------------------------------------------------------ packing
def check_packed(rows, texts):
    """Every id in exactly one piece; sequences gapless and within the window."""
    encoding = packing.encoder()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    expected = Counter()
    for i, t in texts:
        ids = np.array([*packing.ids_of(encoding, t or ""), 1], "<u4")
        for s in range(0, len(ids), packing.WINDOW):
            p = ids[s:s + packing.WINDOW]
            expected[i, s, len(p), zlib.crc32(p.tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == expected
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.WINDOW
    return sum(packing.WINDOW for _ in by_seq), sum(r["length"] for r in rows)


def test_pack_odd_rows(spark):
    check_packed(packing.pack(docs(spark)).collect(), ROWS)
    assert packing.pack(docs(spark, [])).collect() == []


def test_pack_documents_with_little_padding(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").collect()]
    room, used = check_packed(packing.op10_packing(spark, SF.replace("0.001", "0.01")).collect(), texts)
    assert used >= 0.98 * room


def test_ids_equal_those_of_the_json_vocabulary():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    encode = packing.encoder().encode_ordinary
    rng = np.random.default_rng(0)
    texts = ["", " ", "a b  c\n\n d'll", "<|endoftext|> x", "日本語 текст 😀", "\x00\x7f", "don't   stop\t\r\n", "١٢٣ ½ ǅ"]
    texts += ["".join(chr(c) for c in rng.integers(32, 0x2FFF, 200)) for _ in range(50)]
    for text in texts:
        assert encode(text) == t.encode(text, add_special_tokens=False).ids


def test_pieces_have_the_ids_of_the_json_tokenizer_as_it_is(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n  y", "<|endoftext", "<|endoftext|> " * 3_000, " plain  text ", ""]
    got = {(r["doc_id"], r["start"]): (r["length"], r["ids_crc32"], r["doc_tokens"]) for r in packing.cut(docs(spark, list(enumerate(texts)))).collect()}
    expected = {}
    for i, text in enumerate(texts):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 1], "<u4")
        for s in range(0, len(ids), packing.WINDOW):
            p = ids[s:s + packing.WINDOW]
            expected[i, s] = (len(p), zlib.crc32(p.tobytes()), len(ids))
    assert got == expected


def test_very_long_white_space_has_the_ids_of_the_json_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoding, rng = packing.encoder(), np.random.default_rng(3)
    blanks = list(" \t\n\r\x0b\x0c\x85\xa0\u2003\u3000")
    mixed = "".join(rng.choice(blanks, 2_000_000))
    long = packing.LONG_BLANKS
    texts = [" " * 2_000_000, "\n" * 2_000_000, mixed, "a" + " " * 1_500_000 + "b", "a\n" + "\n" * 1_200_000 + " b's", "x <|endoftext|>" + mixed[:9_000] + "'ll"]
    texts += [f"a{b * n}{end}" for b in (" ", "\n", " \n") for n in (long // 2, long - 1, long, long + 1) for end in ("", "b", "'s", "!", "\x1c", "<|endoftext|>")]
    texts += ["\x1c" * 6_000, "x" * 1_500_000, (" " * long + "w") * 3 + "\n" * long]
    for text in texts:
        assert packing.ids_of(encoding, text) == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_rest_once(seed):
    rng = np.random.default_rng(seed)
    hist = np.zeros(packing.WINDOW, np.int64)
    lengths = np.minimum(rng.geometric(0.004, [50, 5_000, 100_000, 3][seed]), packing.WINDOW - 1)
    np.add.at(hist, lengths, 1)
    plan = packing.plan_patterns(hist)
    used = np.zeros_like(hist)
    for combo, repeats in plan:
        assert 0 < sum(combo) <= packing.WINDOW
        for n in combo:
            used[n] += repeats
    assert (used == hist).all()
    entries, sequences = packing.plan_entries(plan)
    assert sequences == sum(r for _, r in plan) and sequences * packing.WINDOW >= (hist * np.arange(len(hist))).sum()


def test_least_squares_meets_the_histogram():
    hist = np.zeros(packing.WINDOW, np.int64)
    hist[[500, 1_548, 1_000, 1_048]] = [40, 40, 7, 7]
    combos = packing.combinations_of(hist)
    x = packing.repeat_counts(hist, combos)
    assert sorted((tuple(n for n in c if n), round(v)) for c, v in zip(combos.tolist(), x, strict=True) if round(v)) == [
        ((1_048, 1_000), 7), ((1_548, 500), 40)]


# ------------------------------------------------------------------ mixing
def labelled_docs(spark, n=1_500):
    rng = np.random.default_rng(0)
    words = {"high": "plain good prose words here".split(), "low": "junk %% ## spam".split(), "toxic": "bad worse worst".split()}
    common = "the of and to in is it as".split()
    rows, labels = [], []
    for i in range(n):
        k = str(rng.choice(["high", "low", "toxic"], p=[0.7, 0.2, 0.1]))
        rows.append((i, " ".join(rng.choice(common + words[k], int(rng.integers(5, 60))))))
        if i % 2:
            labels.append((i, k))
    rows += [(5_000, None), (5_001, ""), (5_002, "word " * 50_000), (3, rows[3][1]), (None, "good prose")]
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, domain string"), rows


def test_rates_meet_the_targets(spark):
    d, labels, rows = labelled_docs(spark)
    targets = {"high": 0.5, "low": 0.4, "toxic": 0.1}
    got = mixing.fitted_rates(d, labels, targets).collect()
    assert len(got) == len(rows)
    tokens = np.array([r["__mix_tokens"] for r in got], float)
    p = np.array([r["__mix_p"] for r in got])
    rate = np.array([r["__mix_rate"] for r in got])
    assert Counter(tokens.tolist()) == Counter(float(len((t or "").split())) for _, t in rows)
    assert np.allclose(p.sum(axis=1), 1) and (rate >= 0).all()
    assert np.allclose((tokens * rate) @ p / tokens.sum(), [0.5, 0.4, 0.1], atol=1e-4)
    # the same projected steps in numpy
    steps, _ = mixing.fit_steps(spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p, strict=True)],
                                                      "__mix_tokens long, __mix_p array<double>"), targets, sorted(targets))
    brute = np.ones(len(tokens))
    for change in steps:
        brute = np.maximum(0, brute - p @ np.array(change))
    assert np.allclose(brute, rate, atol=1e-6)
    copies = np.array([r["__mix_copies"] for r in got])
    assert ((copies >= np.floor(rate)) & (copies <= np.ceil(rate))).all()


def test_projection_keeps_rates_above_zero(spark):
    p = [[0.99, 0.01], [0.02, 0.98], [0.5, 0.5]] * 40
    rows = stored(spark.createDataFrame([(100, x) for x in p], "__mix_tokens long, __mix_p array<double>"), "p")
    steps, totals = mixing.fit_steps(rows, {"a": 0.97, "b": 0.03}, ["a", "b"])
    rate = rows.withColumn("r", mixing.rate_after(steps)).agg(F.min("r"), F.max("r")).first()
    assert rate[0] == 0.0 and rate[1] > 1 and abs(totals[0] / sum(totals) - 0.97) < 1e-3


def fitted(spark, p, targets, tokens=100):
    rows = stored(spark.createDataFrame([(tokens, x) for x in p], "__mix_tokens long, __mix_p array<double>"), "p")
    steps, totals = mixing.fit_steps(rows, targets, sorted(targets))
    rate = np.ones(len(p))
    for change in steps:
        rate = np.maximum(0, rate - np.array(p) @ np.array(change))
    return rate, np.array(totals) / (tokens * len(p)), steps


def test_targets_out_of_reach_get_the_least_squares(spark):
    p = np.random.default_rng(0).dirichlet((1, 20, 3), 2_000).tolist()
    goal = np.array([0.8, 0.12, 0.08])
    with pytest.warns(UserWarning, match="out of reach"):
        rate, reached, steps = fitted(spark, p, {"high": 0.8, "low": 0.12, "toxic": 0.08})
    assert np.allclose((rate @ np.array(p)) / len(p), reached, atol=1e-6)
    # duality: no rates have a squared misfit that is smaller by more than twice the gap
    misfit = reached - goal
    gap = reached @ misfit - min(0.0, (np.array(p) @ misfit).min()) * 3**0.5 * np.linalg.norm(goal)
    assert misfit @ misfit > 0.1 and 0 <= gap <= 0.02 * (misfit @ misfit)
    brute, misfits = np.ones(len(p)), []
    for change in steps:
        misfits.append(np.linalg.norm(brute @ np.array(p) / len(p) - goal))
        brute = np.maximum(0, brute - np.array(p) @ np.array(change))
    assert misfits == sorted(misfits, reverse=True)  # every step lowers the misfit


def test_targets_barely_in_reach_are_met(spark):
    p = np.random.default_rng(1).dirichlet((1, 1, 1), 2_000).tolist()
    rate, reached, _ = fitted(spark, p, {"high": 0.96, "low": 0.02, "toxic": 0.02})
    assert np.allclose(reached, [0.96, 0.02, 0.02], atol=1e-4) and (rate >= 0).all()


def test_a_fit_that_hits_the_step_limit_raises(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    with pytest.raises(RuntimeError, match="no fit after 1 steps"):
        fitted(spark, np.random.default_rng(0).dirichlet((1, 20, 3), 200).tolist(), {"high": 0.8, "low": 0.12, "toxic": 0.08})


def test_mixing_without_labels_and_rows(spark):
    d, labels, _ = labelled_docs(spark, 20)
    got = mixing.fitted_rates(d, labels.limit(0), {"a": 1.0, "b": 1.0}).collect()
    assert len(got) == 25 and all(r["__mix_p"] == [0.5, 0.5] and abs(r["__mix_rate"] - 1) < 1e-9 for r in got)
    assert mixing.mixed_documents(d.limit(0), labels).collect() == []
    assert mixing.mixed_documents(d, labels.limit(0)).columns == d.columns


def test_classifier_is_right_on_rows_it_has_not_seen(spark):
    sf = SF.replace("0.001", "0.1")
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    labels = mixing.domain_of_labels(spark.read.parquet(f"{sf}/labels.parquet")).withColumn("test", F.expr("pmod(hash(doc_id), 4) = 0"))
    domains = sorted(mixing.TARGETS)
    classifier = mixing.fit_classifier(documents, labels.filter("NOT test").drop("test"), domains)
    rows = mixing.with_posteriors(documents.join(labels.filter("test"), "doc_id"), classifier).select("domain", "__mix_p").collect()
    right = sum(domains[int(np.argmax(r["__mix_p"]))] == r["domain"] for r in rows)
    assert right >= 0.9 * len(rows)


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10_000, None, "en", "s", 0), (10_001, "12 34 !", "en", "s", 0), (10_002, "", None, None, None)], source.schema)
    first = source.orderBy("doc_id").first()
    copies = spark.createDataFrame([(20_000, first["text"] + "\n", "en", "s", 0), (first["doc_id"], first["text"], "en", "s", 0)], source.schema)
    blank = " ".join(r["text"] for r in source.filter("lang = 'en'").orderBy("doc_id").limit(9).collect())
    blanks = spark.createDataFrame([(20_002, blank[:4_000] + " " * 1_100_000 + "\n" * 1_100_000 + blank[4_000:], "en", "s", 0)], source.schema)
    documents = source.unionByName(extra).unionByName(copies).unionByName(blanks)
    before = documents
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, before, SF), name)
        kept[name] = after
        if name != "packing":
            assert after.columns == source.columns
        before = after
    ids = {n: [r["doc_id"] for r in df.collect()] for n, df in kept.items()}
    assert 20_002 in ids["near_dedup"]
    assert not {10_000, 10_001, 10_002} & set(ids["language_id"]) and len(ids["language_id"]) >= 0.99 * (source.count() + 2)
    texts = ["".join(r["text"].split()) for r in kept["exact_dedup"].collect()]
    assert len(texts) == len(set(texts)) and 20_000 in ids["exact_dedup"] and first["doc_id"] not in ids["exact_dedup"]
    assert len(set(ids["near_dedup"])) == len(ids["near_dedup"]) <= len(texts)
    assert set(ids["mixing"]) <= set(ids["near_dedup"]) and set(ids["packing"]) == set(ids["mixing"])
    mixed = [(r["doc_id"], r["text"]) for r in kept["mixing"].collect()]
    check_packed(kept["packing"].collect(), mixed)


def test_pipeline_on_an_empty_table(spark):
    before = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        before = stored(stage(spark, before, SF), name)
    assert before.collect() == []


def test_every_operator_is_registered():
    names = list(registry.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert set(registry.oracles()) <= set(names)


def test_workers_need_neither_the_folder_nor_a_path(tmp_path):
    """The entry is loaded by its file from another folder; tasks of several operators run."""
    import os
    import subprocess
    import sys

    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = f"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry", {here + "/__spark_entry__.py"!r})
entry = importlib.util.module_from_spec(spec)
sys.modules["entry"] = entry
spec.loader.exec_module(entry)
from trailmark.session import build_session
spark = build_session("local[4]", shuffle_partitions=4, extra={{"spark.checkpoint.dir": {str(tmp_path)!r}}})
for name in ("op4_topk", "op9_html_extraction", "op11_lexical_search", "op13_secret_scan"):
    print("rows", entry.queries()[name](spark, {SF!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.count("rows") == 4
    assert os.listdir(f"{tmp_path}/trailmark") == []  # the scratch tables went with the process

