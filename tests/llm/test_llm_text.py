"""Operators 3, 7 and 9."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.llm import chat_format as chat
from trailmark.llm import html_extract as html
from trailmark.llm import language_id as lang

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ language ID
WORDS = {"xx": "lorem ipsum dolor sit amet consectetur adipiscing elit sed", "yy": "kala maja puu vesi tuli taevas meri koer kass"}


def language_rows():
    rows = []
    for i in range(300):
        k = "xx" if i % 2 else "yy"
        words = WORDS[k].split()
        rows.append((i, k, " ".join(words[(i * j + j * j) % len(words)] for j in range(5 + i % 20))))
    return rows


def test_language_id_on_odd_rows(spark):
    schema = "doc_id long, lang string, text string, score string, lang_pred string"
    odd = [(1000, None, None), (1001, "xx", ""), (1002, "yy", "123 %%% !"), (1003, None, "LOREM IPSUM"), (1004, None, (WORDS["yy"] + " ") * 8_000),
           (None, "yy", "maja puu"), (1005, "yy", "maja puu"), (1005, "yy", "maja puu")]
    rows = spark.createDataFrame([(*r, "x", "x") for r in language_rows() + odd], schema)
    got = lang.predict_language(rows, lang.learn(rows)).collect()
    assert len(got) == 308
    by = {r["doc_id"]: r for r in got}
    for i in (1000, 1001, 1002):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["accepted"]) == ("und", 0.0, False)
    assert by[1003]["lang_pred"] == "xx" and by[1004]["lang_pred"] == by[1005]["lang_pred"] == by[None]["lang_pred"] == "yy"
    assert all(0 <= r["score"] <= 1 for r in got)
    assert all(by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in by if i is not None)
    truth = {i: k for i, k, _ in language_rows()}
    assert all(by[i]["lang_pred"] == truth[i] for i in truth)
    kept = lang.accepted_documents(rows, lang.learn(rows))
    assert kept.columns == rows.columns and kept.filter("doc_id IN (1000, 1001, 1002)").count() == 0


def test_language_id_learns_only_from_its_rows(spark):
    rows = spark.createDataFrame(language_rows(), "doc_id long, lang string, text string")
    changed = rows.withColumn("text", F.when(lang.held_out(F.col("doc_id")), F.lit("zzz")).otherwise(F.col("text"))).withColumn(
        "lang", F.when(lang.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert lang.learn(rows) == lang.learn(changed)
    assert set(lang.learn(rows)) == {"xx", "yy"}


def test_language_id_without_training_rows(spark):
    rows = spark.createDataFrame([(1, None, "abc")], "doc_id long, lang string, text string")
    assert lang.learn(rows) == {}
    assert [tuple(r) for r in lang.predict_language(rows, {}).select("lang_pred", "score").collect()] == [("und", 0.0)]
    assert lang.predict_language(rows.limit(0), {}).collect() == []
    assert lang._Encoder({"xx": b"lorem ipsum dolor"}).predict("abc") == ("xx", 1.0)


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = lang.predict_language(docs, lang.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, everything, accepted = got.agg(F.sum(F.expr("int(lang = lang_pred)")), F.count(F.lit(1)), F.sum(F.expr("int(accepted)"))).first()
    assert right >= 0.97 * everything and accepted >= 0.99 * everything


def test_short_texts_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    short = docs.filter("length(text) < 60").select("doc_id", "lang", "text")
    got = lang.predict_language(short, lang.learn(docs)).join(short.drop("text"), "doc_id").filter("held_out").collect()
    assert len(got) > 20 and sum(r["lang"] == r["lang_pred"] and r["accepted"] for r in got) >= 0.9 * len(got)


def test_noise_and_other_languages_are_rejected_and_clean_documents_stay(spark):
    rng = np.random.default_rng(0)
    noise = ["".join(rng.choice(list("0123456789 .%#!"), n)) + "x" for n in (20, 60, 200, 900) for _ in range(10)]
    noise += ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz   "), n)) for n in (20, 60, 200, 900) for _ in range(10)]
    other = ["Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
             "Minden emberi lény szabadon születik és egyenlő méltósága és joga van.",
             "Все люди рождаются свободными и равными в своем достоинстве и правах.",
             "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。"]
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang", "text")
    encoder = lang._Encoder(lang.learn(docs))
    assert sum(encoder.judge(t)[2] for t in noise) <= 0.05 * len(noise)
    assert not any(encoder.judge(t)[2] for t in other)
    clean = docs.filter(lang.held_out(F.col("doc_id")) & (F.length("text") > 0)).limit(500).collect()
    assert sum(encoder.judge(r["text"])[2] for r in clean) >= 0.99 * len(clean)


def plain_choice(dictionaries, text):
    """Second implementation of sizes and choice, with a fresh compressor for every part."""
    import zstandard

    raw, sizes = text.lower().encode(), {}
    words = raw.split()
    picked = range(len(words)) if len(words) <= 40 else [k * len(words) // 40 for k in range(40)]
    parts = [raw[i:i + 512] for i in range(0, len(raw), 512)] + [b" ".join(words[max(0, i - 1):i + 2]) for i in picked]
    for name, content in dictionaries.items():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        sizes[name] = sum(len(zstandard.ZstdCompressor(level=6, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
                              .compress(p + bytes(256))) for p in parts)
    first, second = sorted(sizes.items(), key=lambda x: (x[1], x[0]))[:2]
    return first[0], (second[1] - first[1]) / second[1], second[1] - first[1] >= 0.5 * second[1] ** 0.5


def test_sizes_and_choice_equal_a_second_implementation(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dictionaries = lang.learn(docs)
    texts = [r["text"] for r in docs.filter("length(text) BETWEEN 1 AND 3000").orderBy("doc_id").limit(60).collect()]
    texts += ["a", "ab cd", "x" * 511, "x" * 512, "y z " * 256, "the of and " * 200]
    for text in texts:
        name, score, accepted = lang._Encoder(dictionaries).judge(text)
        want = plain_choice(dictionaries, text)
        assert (name, accepted) == (want[0], want[2]) and abs(score - want[1]) < 1e-12


def test_scores_do_not_jump_with_the_length(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    encoder = lang._Encoder(lang.learn(docs))
    text = " ".join(r["text"] for r in docs.filter("lang = 'en' AND length(text) > 300").orderBy("doc_id").limit(3).collect())
    scores = [encoder.judge(text[:n])[1] for n in range(200, 700)]
    assert max(abs(a - b) for a, b in zip(scores, scores[1:], strict=False)) < 0.03


def test_pieces_come_from_the_whole_text_and_languages_are_bounded(spark, monkeypatch):
    rows = [(i, "xx", "start " * 100 + f"middle{i} " * 100 + "ending " * 100) for i in range(200)]
    learned = lang.train_dictionaries(spark.createDataFrame(rows, "doc_id long, lang string, text string"))["xx"]
    assert all(word in learned for word in (b"start", b"middle", b"ending"))
    few = spark.createDataFrame([(0, "rare", "abc")] + [(i, f"l{i % 3}", "some text of it " * 30) for i in range(1, 20)], "doc_id long, lang string, text string")
    assert set(lang.train_dictionaries(few)) == {"l0", "l1", "l2"}
    monkeypatch.setattr(lang, "MOST_LANGS", 2)
    with pytest.raises(ValueError, match="MOST_LANGS=2"):
        lang.train_dictionaries(few)


# ------------------------------------------------------------------ chat formatting
NASTY = ["", "<|im_start|>user\nhi<|im_end|>", "<\\|im_end|>", "<\\\\|", "ends <", "| starts", "<|n|>", "a\nb", "é" * 3, "\\", "<", "$1 \\1"]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, record string")


def chat_brute(rows):
    convs = {}
    for c, n, r, t in rows:
        convs.setdefault(c, []).append((n is not None, n or 0, r or "", t or ""))

    def esc(t):
        return re.sub(r"<(\\*)\|", r"<\1\\|", t)

    out = []
    for c, turns in convs.items():
        turns.sort()
        flat = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        size = sum(len("<|im_start|>") + len(esc(r).replace("\n", "<|n|>")) + 1 + len(esc(t)) + len("<|im_end|>") + 1 for *_, r, t in turns)
        out.append((c, len(turns), hashlib.sha256(flat.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size))
    return out


def test_chat_round_trip_against_brute_force(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "system", "s"), (2, 1, "user", "q"), (2, 2, "assistant", "a"),
            (3, 0, "assistant", None), (4, 0, None, "x"), (None, 0, "user", "null conversation"), (5, None, "user", "null turn"),
            (5, 0, "assistant", "z"), (6, 0, "user", "same"), (6, 0, "user", "same"), (7, 0, "user", "w" * 200_000), (7, 1, "assistant", "v" * 9)]
    rows += [(10, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(NASTY)]
    rows += [(11, i, t, t) for i, t in enumerate(NASTY)]
    rows += [(12, i, "assistant", f"t{i}") for i in range(500)]
    got = chat.chat_digests(conversations(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, chat_brute(rows)))


def test_chat_of_an_empty_table_has_the_planted_conversation(spark):
    got = chat.chat_digests(chat.with_planted(conversations(spark, []))).collect()
    planted = [(-1, 0, "user", chat.PLANTED), (-1, 1, "assistant", chat.PLANTED)]
    assert [tuple(r) for r in got] == chat_brute(planted)


def test_layouts_are_told_by_their_fields(spark):
    records = [
        (1, {"prompt": "p", "completion": "c"}), (2, {"instruction": "i", "output": "o"}),
        (3, {"instruction": "i", "input": "n", "output": "o"}), (4, {"system": "s", "instruction": "i", "output": "o"}),
        (5, {"messages": [{"role": "user", "content": "m"}]}), (6, {"messages": []}),
        (7, {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}),
        (8, {"prompt": "only"}), (9, {}),
    ]
    df = spark.createDataFrame(records, chat.T.StructType([chat.T.StructField("conv_id", chat.T.LongType()),
                                                           chat.T.StructField("record", chat.RECORD_TYPE)]))
    got = {r["conv_id"]: (r["layout"], [tuple(t) for t in r["turns"]]) for r in chat.canonical_turns(df).collect()}
    assert got == {
        1: ("prompt", [("user", "p"), ("assistant", "c")]), 2: ("instruction", [("user", "i"), ("assistant", "o")]),
        3: ("instruction_input", [("user", "i"), ("user", "n"), ("assistant", "o")]),
        4: ("system_instruction", [("system", "s"), ("user", "i"), ("assistant", "o")]),
        5: ("messages", [("user", "m")]), 6: ("no_messages", []), 7: ("conversations", [("user", "h"), ("assistant", "g")]),
        8: ("prompt", [("user", "only"), ("assistant", "")]), 9: (None, [])}


def records(spark, rows, kind=None):
    return spark.createDataFrame(rows, chat.T.StructType([chat.T.StructField("conv_id", chat.T.LongType()), chat.T.StructField("record", kind or chat.RECORD_TYPE)]))


def turns_by_id(df):
    return {r["conv_id"]: (r["layout"], [tuple(t) for t in r["turns"]]) for r in df.collect()}


def test_null_texts_and_all_fields_lose_no_turn(spark):
    rows = [(1, {"prompt": "p", "completion": None}), (2, {"prompt": None, "completion": "c"}), (3, {"messages": [{"role": "user", "content": None}, {"role": None, "content": None}]}),
            (4, {"messages": [{"role": None, "content": None}]}), (5, {"system": "s", "instruction": "i", "input": "n", "output": "o"}),
            (6, {"system": "s", "prompt": "p", "completion": "c"}), (7, {"instruction": "i"}), (8, {"output": "o"}), (9, {"instruction": "i", "input": "n"}),
            (10, {"conversations": [{"from": "human", "value": None}]}), (11, {"prompt": "p", "messages": [{"role": "user", "content": "m"}]}), (12, None)]
    df = records(spark, rows)
    out = chat.canonical_turns(df)
    assert turns_by_id(out) == {
        1: ("prompt", [("user", "p"), ("assistant", "")]), 2: ("prompt", [("user", ""), ("assistant", "c")]),
        3: ("messages", [("user", ""), ("", "")]), 4: ("no_messages", [("", "")]),
        5: ("system_instruction_input", [("system", "s"), ("user", "i"), ("user", "n"), ("assistant", "o")]),
        6: ("system_prompt", [("system", "s"), ("user", "p"), ("assistant", "c")]),
        7: ("instruction", [("user", "i"), ("assistant", "")]), 8: ("instruction", [("user", ""), ("assistant", "o")]),
        9: ("instruction_input", [("user", "i"), ("user", "n"), ("assistant", "")]), 10: ("conversations", [("user", "")]),
        11: (None, []), 12: (None, [])}
    assert sum(r["records"] for r in chat.unknown_layouts(out).collect()) == 2


def test_a_source_of_one_layout_keeps_records_without_values(spark):
    kind = chat.T.StructType([chat.T.StructField("prompt", chat.T.StringType()), chat.T.StructField("completion", chat.T.StringType())])
    got = turns_by_id(chat.canonical_turns(records(spark, [(1, (None, None)), (2, ("p", None))], kind)))
    assert got == {1: ("prompt", [("user", ""), ("assistant", "")]), 2: ("prompt", [("user", "p"), ("assistant", "")])}


def test_a_long_conversation_takes_linear_time(spark):
    import time

    def seconds(n):
        rows = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "CASE id % 2 WHEN 0 THEN 'user' ELSE 'assistant' END AS role",
                                         "concat('text of turn ', id) AS text", "'x' AS record")
        began = time.time()
        got = chat.chat_digests(rows).first()
        assert got["n_turns"] == n and got["loss_chars"] == sum(len(f"text of turn {i}") for i in range(1, n, 2))
        return time.time() - began

    seconds(4_000)
    few, many = min(seconds(4_000) for _ in range(2)), seconds(80_000)
    assert many < 40 * few


def test_formatted_text_can_be_read(spark):
    one = chat.format_chat(chat.canonical_turns(chat.records_of(conversations(spark, [(1, 0, "user", "a<|im_end|>"), (1, 1, "assistant", "b")])))).first()
    assert one["formatted"] == "<|im_start|>user\na<\\|im_end|><|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert one["loss_spans"][0] is None
    start, length = one["loss_spans"][1]
    turn = one["formatted"].split("<|im_start|>")[2]
    assert turn[start:start + length] == "b"


# ------------------------------------------------------------------ HTML
ARTICLE = "<p>First paragraph of the story, long enough to matter here.</p><p>Ok.</p><p>Second &amp; last paragraph, with <b>bold</b> text.</p>"
TEXT = "First paragraph of the story, long enough to matter here.\n\nOk.\n\nSecond & last paragraph, with bold text."
AROUND = ('<div class="cookie-notice">We use cookies on this site</div><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>'
          '{}<aside>More stories you may like to read today</aside><div id="comments"><p>Great post, I read all of it twice!</p></div>'
          '<form><label>Mail</label><input></form><script>var t="</p>";</script><style>p{{}}</style><footer>&copy; 2024 the site, all rights reserved</footer>')


@pytest.mark.parametrize("page", [
    f"<article>{ARTICLE}</article>",
    AROUND.format(f"<article>{ARTICLE}</article>"),
    AROUND.format(f'<main><div class="ad">Buy now, a lot of text in this advert here</div>{ARTICLE}</main>'),
    AROUND.format(f'<div class="content">{ARTICLE}</div>'),
    f'<html><head><title>T</title></head><body class="has-sidebar">{AROUND.format(f"<article>{ARTICLE}")}',
    f"<article>{ARTICLE}<section class='comments'><article><p>A comment of a reader.</p></article></section></article>",
])
def test_main_text_of_pages(page):
    assert html.main_text(page) == TEXT


def test_main_text_of_odd_pages():
    assert html.main_text(None) == html.main_text("") == html.main_text("<nav>x</nav>") == ""
    assert html.main_text("just   text &lt;b&gt; &amp;amp;") == "just text <b> &amp;"
    assert html.main_text("<article><h1>T</h1>a<br>b&nbsp;c<p>d<p>e<![if x]>f</article>") == "T\n\na b c\n\nd\n\nef"
    assert len(html.main_text("<article><p>" + "word " * 100_000 + "</p></article>")) == 499_999
    assert html.main_text("<article><p>a</p></div></p></span><p>b</p>") == "a\n\nb"
    assert html.main_text("<article><div class=ad>Buy<p>a</p><p>b</p></article>") == "Buy\n\na\n\nb"
    assert html.main_text("<div class=comments><p>all there is</p></div><nav>menu</nav>") == "all there is"


PROSE = "A sentence of the body that goes on for a while, as prose does. " * 4


def test_a_minority_of_declared_text_does_not_hide_the_body():
    body = [f"{PROSE}{i}" for i in range(12)]
    teasers = "".join(f"<article class=card><h3>Teaser {i}</h3><p>A line about it.</p></article>" for i in range(3))
    page = f'<div class="content">{"".join(f"<p>{x}</p>" for x in body)}</div><nav>menu</nav>{teasers}'
    got = html.main_text(page).split("\n\n")
    assert got[:12] == body
    # a declared article with most of the text still sets the boundaries
    page = f'<div>Words of the site before it</div><article><h1>T</h1>{"".join(f"<p>{x}</p>" for x in body)}</article><div>{PROSE}</div>'
    assert html.main_text(page).split("\n\n") == ["T", *body]


def test_short_lines_and_a_late_paragraph_are_kept_whatever_the_longest_run():
    lines = [PROSE * 12 + str(i) for i in range(5)] + [f"Line {i} of sixty characters, as in dialogue or in a list item." for i in range(10)]
    lines += ["A paragraph that is wholly a link to somewhere else", PROSE * 6 + "end", "Said one.", "Said two.", "Said three.", "The end."]
    around = '<div class=menu>{0}</div>'.format("".join(f"<a href=/{i}>link {i}</a>" for i in range(9)))
    marked = [f"<p><a href=x>{x}</a></p>" if "wholly a link" in x else f"<p>{x}</p>" for x in lines]
    for body in ("".join(marked), "".join(marked[:8]) + "<div class=ad><p>Buy this now</p></div>" + "".join(marked[8:])):
        assert html.main_text(f"{around}<div id=text>{body}</div><footer>All rights</footer>") == "\n\n".join(lines).replace("  ", " ")


def test_extract_pages_carries_ids(spark):
    rows = [(1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (None, None, None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(repr, (tuple(r) for r in html.extract_pages(pages).collect())))
    assert got == sorted(map(repr, [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)]))
    assert html.extract_pages(pages.limit(0)).collect() == []


# ------------------------------------------------------------------ HTML: windows decide, in linear time
def plain_text(lines):
    """Second implementation of weights, windows and points, line by line."""
    chars = [w for _, w, _ in lines]
    declared = [bool(main and text) for text, _, main in lines]
    inside = sum(c for c, d in zip(chars, declared, strict=True) if d)
    weight = [c * 8 if d else 0 for c, d in zip(chars, declared, strict=True)] if inside * 2 > sum(chars) else chars
    if not any(weight):
        return ""
    at = lambda i: weight[i] if 0 <= i < len(weight) else 0
    window = [at(i) + at(i - 1) + at(i - 2) for i in range(len(weight) + 2)]  # by its last line
    high = [i for i, s in enumerate(window) if s > 86] or [i for i, s in enumerate(window) if s]
    surge = max(0, high[0] - 2)
    dive = next((i for i in range(high[-1], len(window)) if window[i] == 0), len(weight))
    inside = [i for i in range(surge, min(dive, len(weight))) if weight[i]]
    return "\n\n".join(text for text, _, _ in lines[inside[0]:inside[-1] + 1] if text)


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_the_windows_decide_every_given_page(spark, sf):
    pages = [r["html"] for r in spark.read.parquet(f"/root/testdata/sf{sf}/pages.parquet").select("html").collect()]
    differ = 0
    for page in pages:
        differ += html.main_text(page) != (plain_text(html.lines_of(page)) or plain_text(html.lines_of(page, False)))
    assert differ == 0


def test_random_lines_equal_the_plain_windows():
    draw = np.random.default_rng(5)
    for _ in range(400):
        n = int(draw.integers(1, 30))
        lines = [("x" * int(k), int(k) if draw.random() < 0.9 else 0, bool(draw.random() < 0.4)) for k in draw.choice([0, 0, 3, 20, 60, 200], n)]
        weights = html.line_weights(lines)
        if weights.any():
            first, end = html.points(weights, html.WINDOW, html.THRESHOLD)
            assert "\n\n".join(t for t, _, _ in lines[first:end] if t) == plain_text(lines)


@pytest.mark.parametrize("page", [
    "<div>" * 200_000 + "</section>" * 100_000 + "text " * 30,
    "<header>" + "<b>x" * 250_000 + "</header><p>" + "text " * 30,
    "<div>" + "<i>" * 300_000 + "</b>" * 250_000 + "text " * 30,
    "<b><div>" * 100_000 + "</b>" * 200_000 + "text " * 30,
    "<ul>" + "<li><a href=x>y</a>" * 100_000 + "</ul><p>" + "text " * 30,
    "<p>" * 300_000 + "</p>" * 250_000 + "text " * 30,
])
def test_two_megabytes_of_broken_elements_take_seconds(page):
    import time

    began = time.thread_time()
    assert "text text" in html.main_text(page)
    assert time.thread_time() - began < 20
