import random

import pytest
from pyspark.sql import functions as F

import brute
from conftest import T0, ev, events_df
from trailmark.operators import (
    arrival_fragments,
    prepare_events,
    preview_user_paths,
    preview_user_paths_of,
    user_path_chunks,
    user_path_fragments,
    user_paths,
)
from trailmark.schema import EVENT_COLUMNS, EVENT_SCHEMA
from trailmark.sources import decode_events, read_events
from trailmark.streaming import ARRIVAL_PATHS, DeltaStore, run_pipeline


def _paths(df):
    return {r.userId: tuple(r.path) for r in df.collect()}


def test_defaults_empty_pages_and_consecutive_repeats(spark):
    rows = [
        ev(timestamp=T0, pageUrl="A"),
        ev(timestamp=T0 + 1, pageUrl=""),  # P9: empty page dropped, so A, '', A -> A
        ev(timestamp=T0 + 2, pageUrl="A"),
        ev(timestamp=T0 + 3, pageUrl=None),
        ev(timestamp=T0 + 4, pageUrl="B"),
        ev(timestamp=T0 + 5, pageUrl="A"),
        ev(timestamp=T0 + 5, pageUrl="A"),
        ev(userId=None, timestamp=T0, pageUrl="X"),  # user '?'
        ev(userId="", timestamp=T0 + 1, pageUrl="Y"),
        ev(userId="nopages", timestamp=T0, pageUrl=""),  # no page at all: no row
    ]
    got = _paths(user_paths(prepare_events(events_df(spark, rows))))
    assert got == {"u1": ("A", "B", "A"), "?": ("X", "Y")}


def test_order_is_millis_then_page(spark):
    rows = [ev(timestamp=T0 + 5, pageUrl="b"), ev(timestamp=T0 + 5, pageUrl="a"), ev(timestamp=T0 + 1, pageUrl="c")]
    got = _paths(user_paths(prepare_events(events_df(spark, rows))))
    assert got == {"u1": ("c", "a", "b")}


@pytest.mark.parametrize("seed,chunk_ms", [(11, 60_000), (12, 1), (13, 3_600_000)])
def test_random_against_brute_force(spark, seed, chunk_ms):
    rnd = random.Random(seed)
    rows, plain = [], []
    t = T0
    for _ in range(1200):
        u = "hot" if rnd.random() < 0.4 else rnd.choice(["u1", "u2", None, ""])
        t += rnd.choice([0, 1, 10, 1000, 59_999, 60_000, 600_000])
        p = rnd.choice(["a", "b", "b", "c", "", None])
        ms = t if rnd.random() > 0.03 else None
        rows.append(ev(userId=u, timestamp=ms, pageUrl=p))
        plain.append((u, ms, p))
    rnd.shuffle(rows)
    got = _paths(user_paths(prepare_events(events_df(spark, rows)), chunk_ms=chunk_ms))
    assert got == brute.user_paths(plain)


def test_preview(spark):
    rows = [ev(userId=f"u{i}", timestamp=T0 + j, pageUrl=f"p{j}") for i in range(8) for j in range(3)]
    got = [(r.userId, r.path_text) for r in preview_user_paths(user_paths(prepare_events(events_df(spark, rows)))).collect()]
    assert got == [(f"u{i}", "p0 -> p1 -> p2") for i in range(5)]


def test_pieces_of_a_path_make_the_path_and_previews_agree(spark):
    rnd = random.Random(3)
    rows = [ev(userId=rnd.choice(["u1", "u2", None, "", "z"]), timestamp=rnd.choice([None, T0 + rnd.randint(0, 600_000)]),
               pageUrl=rnd.choice(["a", "b", "", None])) for _ in range(500)]
    events = prepare_events(events_df(spark, rows))
    whole = _paths(user_paths(events))
    pieces = {}
    for r in sorted(user_path_chunks(user_path_fragments(events)).collect(), key=lambda r: (r.no_time, r.chunk or 0)):
        pieces.setdefault(r.userId, []).extend(r.pages)
    assert {u: tuple(p) for u, p in pieces.items()} == whole
    assert [tuple(r) for r in preview_user_paths_of(events, 3).collect()] == [tuple(r) for r in preview_user_paths(user_paths(events), 3).collect()]


# --------------------------------------------------------------------------- order of arrival
def _records(spark, rows):
    """(partition, offset, user, page) as records of a topic."""
    events = spark.createDataFrame(
        [(p, o, *ev(userId=u, pageUrl=page, timestamp=T0 - (o or 0))) for p, o, u, page in rows],
        "partition int, offset long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields))
    return events.select(F.to_json(F.struct(*EVENT_COLUMNS)).cast("binary").alias("value"), "partition", "offset")


def _by_arrival(rows):
    """Brute force: distinct positions in order, rows without one last (by page), repeats collapsed."""
    paths = {}
    for p, o, u, page in sorted(set(rows), key=lambda r: (r[0] is None or r[1] is None, (r[0] or 0, r[1] or 0) if None not in r[:2] else (r[1] is not None, r[1] or 0), r[3] or "")):
        path = paths.setdefault(u or "?", [])
        if page and (not path or path[-1] != page):
            path.append(page)
    return {u: tuple(p) for u, p in paths.items() if p}


def test_paths_in_the_order_of_the_topic(spark):
    rnd = random.Random(5)
    rows = [(rnd.randrange(3) if rnd.random() < 0.97 else None, i if rnd.random() < 0.97 else None, "hot" if i % 3 == 0 else rnd.choice(["u1", "u2", None, ""]),
             rnd.choice(["a", "b", "c", "", None])) for i in range(1_500)]
    rows += rows[::7]  # records that are read twice
    events = prepare_events(decode_events(_records(spark, rows), with_position=True))
    want = _by_arrival(rows)
    for size in (1, 7, 64, 10**6):
        assert _paths(user_paths(events, order="arrival", chunk_offsets=size)) == want
    pieces = {}
    for r in sorted(user_path_chunks(arrival_fragments(events, 16), 3).collect(), key=lambda r: (r.lane, r.chunk)):
        pieces.setdefault(r.userId, []).extend(r.pages)
    assert {u: tuple(p) for u, p in pieces.items()} == want
    assert user_paths(events.limit(0), order="arrival").collect() == []


def test_order_of_arrival_needs_positions(spark, tmp_dir):
    plain = prepare_events(events_df(spark, [ev()]))
    with pytest.raises(ValueError, match="arrivalPartition, arrivalOffset"):
        user_paths(plain, order="arrival")
    with pytest.raises(ValueError, match="order must be"):
        user_paths(plain, order="random")
    with pytest.raises(ValueError, match="have no position"):
        read_events(spark, "files", with_position=True, input_path=tmp_dir)
    for bad in ({"all_time": True}, {}):
        with pytest.raises(ValueError, match="needs all_time='deltas' or the report"):
            run_pipeline(spark, "kafka", tmp_dir, tmp_dir, path_order="arrival", **bad)
    with pytest.raises(ValueError, match="path_order must be"):
        run_pipeline(spark, "kafka", tmp_dir, tmp_dir, path_order="page", all_time="deltas")


def test_store_of_paths_in_the_order_of_the_topic(spark, tmp_dir):
    """Records of one partition come in order; a batch that is read again adds nothing."""
    rnd = random.Random(6)
    rows = [(i % 2, i // 2, rnd.choice(["u1", "u2"]), rnd.choice(["a", "b"])) for i in range(200)]
    store = DeltaStore(spark, f"{tmp_dir}/store", ARRIVAL_PATHS, 2)
    for batch in range(4):
        part = rows[batch * 50 : batch * 50 + 50] + rows[max(0, batch * 50 - 9) : batch * 50]
        store.append(prepare_events(decode_events(_records(spark, part), with_position=True)), batch, "q")
        assert _paths(store.read()) == _by_arrival(rows[: batch * 50 + 50])
