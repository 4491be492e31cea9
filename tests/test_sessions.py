import random

import pytest
from pyspark.sql import functions as F

import brute
from conftest import MIN, T0, ev, events_df
from trailmark.operators import prepare_events, session_paths


def _collect(df):
    return {
        (r.userId, r.s, r.e, tuple(r.path))
        for r in df.select("userId", F.unix_seconds("sessionStart").alias("s"),
                           F.unix_seconds("sessionEnd").alias("e"), "path").collect()
    }


def _both(spark, rows, gap_minutes):
    events = prepare_events(events_df(spark, rows))
    a = _collect(session_paths(events, gap_minutes, strategy="chunked"))
    b = _collect(session_paths(events, gap_minutes, strategy="session_window"))
    return a, b


def test_exact_gap_merges_and_gap_plus_one_splits(spark):
    # Events exactly one gap apart merge; one second more splits
    rows = [ev(timestamp=T0), ev(timestamp=T0 + 2 * MIN, pageUrl="p2"), ev(timestamp=T0 + 4 * MIN + 1000, pageUrl="p3")]
    a, b = _both(spark, rows, 2)
    s0 = T0 // 1000
    assert a == b == {("u1", s0, s0 + 240, ("p1", "p2")), ("u1", s0 + 241, s0 + 361, ("p3",))}


def test_null_user_all_types_repeats_and_order_within_second(spark):
    rows = [
        ev(userId=None, timestamp=T0, pageUrl="z"),  # R8: NULL user is its own key
        ev(userId=None, timestamp=T0 + 1000, pageUrl="a"),
        ev(timestamp=T0 + 500, eventType="click", pageUrl="b"),  # R10: same second as next two
        ev(timestamp=T0 + 100, eventType="error", pageUrl=None),  # NULL page sorts first
        ev(timestamp=T0 + 900, eventType="scroll", pageUrl="a"),
        ev(timestamp=T0 + 2000, pageUrl="a"),
        ev(timestamp=T0 + 2000, pageUrl="a"),  # R9: repeats kept
        ev(timestamp=None, pageUrl="lost"),  # R6: no time
    ]
    a, b = _both(spark, rows, 30)
    s0 = T0 // 1000
    assert a == b == {
        (None, s0, s0 + 1 + 1800, ("z", "a")),
        ("u1", s0, s0 + 2 + 1800, (None, "a", "b", "a", "a")),
    }


def test_session_spanning_many_chunks(spark):
    # one event a minute for 3 hours with a 2-minute gap: one session over 90 chunks
    rows = [ev(timestamp=T0 + i * MIN, pageUrl=f"p{i % 3}") for i in range(180)]
    rows.append(ev(timestamp=T0 + 179 * MIN + 2 * MIN + 1000, pageUrl="late"))  # gap + 1 s: new session
    a, b = _both(spark, rows, 2)
    assert a == b
    assert len(a) == 2
    assert max(len(x[3]) for x in a) == 180


def test_gap_must_be_positive(spark):
    events = prepare_events(events_df(spark, [ev()]))
    for bad in (0, -5, 0.001):
        with pytest.raises(ValueError):
            session_paths(events, bad)
    with pytest.raises(ValueError):
        session_paths(events, 30, strategy="nope")


@pytest.mark.parametrize("seed,gap", [(1, 2), (2, 30), (3, 1), (4, 7)])
def test_random_against_brute_force(spark, seed, gap):
    rnd = random.Random(seed)
    rows, plain = [], []
    users = [None, "", "hot", "u1", "u2", "u3"]
    t = T0 - 3600_000  # include times before the epoch-aligned chunk edge
    for _ in range(1500):
        u = "hot" if rnd.random() < 0.35 else rnd.choice(users)  # one key holds a third of the rows
        t += rnd.choice([0, 0, 1, 999, 1000, gap * 60_000, gap * 60_000 + 1000, rnd.randint(0, 3 * gap * 60_000)])
        p = rnd.choice(["a", "b", "c", None])
        ms = t if rnd.random() > 0.02 else None
        rows.append(ev(userId=u, timestamp=ms, pageUrl=p, eventType=rnd.choice(["view", "click", "error"])))
        plain.append((u, ms, p))
    rnd.shuffle(rows)  # arrival order must not matter
    a, b = _both(spark, rows, gap)
    assert a == b == brute.sessions(plain, gap * 60)


def test_negative_times(spark):
    rows = [ev(timestamp=-1500, pageUrl="a"), ev(timestamp=-500, pageUrl="b"), ev(timestamp=200_000, pageUrl="c")]
    a, b = _both(spark, rows, 2)
    assert a == b == brute.sessions([("u1", -1500, "a"), ("u1", -500, "b"), ("u1", 200_000, "c")], 120)


@pytest.mark.parametrize("strategy", ["chunked", "session_window"])
def test_path_order_by_milliseconds(spark, strategy):
    rows = [ev(timestamp=T0 + ms, pageUrl=p) for ms, p in [(900, "a"), (100, "c"), (100, "b"), (100, None), (100, "b"), (1500, "a"), (1200, "z")]]
    events = prepare_events(events_df(spark, rows))
    by = {o: [list(r.path) for r in session_paths(events, 1, strategy=strategy, order=o).collect()] for o in ("seconds", "millis")}
    assert by["millis"] == [[None, "b", "b", "c", "a", "z", "a"]]
    assert by["seconds"] == [[None, "a", "b", "b", "c", "a", "z"]]
    with pytest.raises(ValueError, match="order"):
        session_paths(events, 1, order="page")
