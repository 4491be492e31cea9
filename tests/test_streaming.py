import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import MIN, T0, ev, events_df
from trailmark.operators import (
    click_heatmap,
    click_heatmap_total,
    error_counts,
    prepare_events,
    session_paths,
    user_paths,
    with_event_watermark,
)
from trailmark.plans.contract import ERRORS_SINK_SCHEMA, HEATMAP_SINK_SCHEMA, PATHS_SINK_SCHEMA
from trailmark.sources import read_events_files, write_events_json
from trailmark.streaming import (
    read_latest_snapshot,
    run_pipeline,
    start_heatmap_snapshots,
    start_parquet_sink,
    start_path_snapshots,
    start_update_parquet_sink,
)
from trailmark.streaming.snapshots import HEATMAP_SNAPSHOT_SCHEMA, PATH_SNAPSHOT_SCHEMA

NOW = {"availableNow": True}


def _write_files(spark, base, batches):
    """One JSON file per batch, modification times in batch order."""
    os.makedirs(base, exist_ok=True)
    for i, rows in enumerate(batches):
        tmp = f"{base}_tmp{i}"
        write_events_json(events_df(spark, rows).coalesce(1), tmp)
        part = [f for f in os.listdir(tmp) if f.endswith(".json")][0]
        dst = f"{base}/batch{i:03d}.json"
        os.rename(f"{tmp}/{part}", dst)
        os.utime(dst, (time.time() - 1000 + i, time.time() - 1000 + i))


def _stream(spark, base, max_files=None):
    return prepare_events(read_events_files(spark, base, streaming=True, max_files_per_trigger=max_files))


def _run(q):
    q.awaitTermination()
    assert q.exception() is None


def _minute(m, **kw):
    return ev(timestamp=T0 + int(m * MIN), **kw)


def test_append_emits_windows_closed_by_the_click_watermark(spark, tmp_dir):
    # rule 2: the click filter sits below the watermark, so views do not move it
    rows = [_minute(1, eventType="click", x=1, y=1), _minute(11, eventType="click", x=1, y=1),
            _minute(60, eventType="view")]
    _write_files(spark, f"{tmp_dir}/in", [rows])
    heat = click_heatmap(with_event_watermark(_stream(spark, f"{tmp_dir}/in"), 2))
    _run(start_parquet_sink(heat, f"{tmp_dir}/heat", f"{tmp_dir}/chk_heat", trigger=NOW))
    assert spark.read.schema(HEATMAP_SINK_SCHEMA).parquet(f"{tmp_dir}/heat").count() == 0  # watermark 00:09
    sess = session_paths(with_event_watermark(_stream(spark, f"{tmp_dir}/in"), 2), 2)
    _run(start_parquet_sink(sess, f"{tmp_dir}/sess", f"{tmp_dir}/chk_sess", trigger=NOW))
    got = sorted(r.sessionEnd.minute for r in spark.read.schema(PATHS_SINK_SCHEMA).parquet(f"{tmp_dir}/sess").collect())
    assert got == [3, 13]  # watermark 00:58 closes both, not the one ending 01:02


def test_window_end_equal_to_watermark_is_emitted(spark, tmp_dir):
    # rule 1: emitted exactly when end <= max(eventTime) - delay
    rows = [_minute(1, eventType="click", x=1, y=1), _minute(12, eventType="click", x=1, y=1)]
    _write_files(spark, f"{tmp_dir}/in", [rows])
    heat = click_heatmap(with_event_watermark(_stream(spark, f"{tmp_dir}/in"), 2))
    _run(start_parquet_sink(heat, f"{tmp_dir}/out", f"{tmp_dir}/chk", trigger=NOW))
    got = [(r.window.start, r["count"]) for r in spark.read.schema(HEATMAP_SINK_SCHEMA).parquet(f"{tmp_dir}/out").collect()]
    assert got == [(dt.datetime(2024, 1, 1, 0, 0), 1)]


def _heat_run(spark, base, tag):
    heat = click_heatmap(with_event_watermark(_stream(spark, f"{base}/in", max_files=1), 2))
    _run(start_parquet_sink(heat, f"{base}/out{tag}", f"{base}/chk{tag}", trigger=NOW))
    return sorted((r.window.start.minute, r["count"])
                  for r in spark.read.schema(HEATMAP_SINK_SCHEMA).parquet(f"{base}/out{tag}").collect())


def test_late_drop_lags_one_batch(spark, tmp_dir):
    # rule 3: batch N drops late rows against the watermark set before batch N-1
    click = dict(eventType="click", x=1, y=1)
    _write_files(spark, f"{tmp_dir}/a/in", [[_minute(30, **click)],  # watermark -> 00:28
                                           [_minute(1, **click), _minute(45, **click)]])  # 00:01 still kept
    assert _heat_run(spark, f"{tmp_dir}/a", "") == [(0, 1), (30, 1)]
    _write_files(spark, f"{tmp_dir}/b/in", [[_minute(30, **click)], [_minute(31, **click)],
                                           [_minute(1, **click), _minute(45, **click)]])  # 00:01 dropped
    assert _heat_run(spark, f"{tmp_dir}/b", "") == [(30, 2)]
    assert _heat_run(spark, f"{tmp_dir}/b", "") == [(30, 2)]  # rule 5: same checkpoint, no new rows


def test_late_event_merges_two_sessions(spark, tmp_dir):
    # 1.0 and 4.5 min are two sessions with gap 2 until 3.0 arrives
    batches = [
        [_minute(1.0, pageUrl="a"), _minute(4.5, pageUrl="c")],
        [_minute(3.0, pageUrl="b")],
        [_minute(30, userId="other", pageUrl="z")],
    ]
    _write_files(spark, f"{tmp_dir}/in", batches)
    sess = session_paths(with_event_watermark(_stream(spark, f"{tmp_dir}/in", max_files=1), 2), 2)
    _run(start_parquet_sink(sess, f"{tmp_dir}/out", f"{tmp_dir}/chk", trigger=NOW))
    got = [(r.userId, r.sessionStart, r.sessionEnd, list(r.path))
           for r in spark.read.schema(PATHS_SINK_SCHEMA).parquet(f"{tmp_dir}/out").collect()]
    assert got == [("u1", dt.datetime(2024, 1, 1, 0, 1), dt.datetime(2024, 1, 1, 0, 6, 30), ["a", "b", "c"])]


def test_update_mode_errors_latest_row_per_key(spark, tmp_dir):
    batches = [[_minute(1, eventType="error", pageUrl="p")],
               [_minute(2, eventType="error", pageUrl="p"), _minute(3, eventType="error", pageUrl="q")]]
    _write_files(spark, f"{tmp_dir}/in", batches)
    errs = error_counts(with_event_watermark(_stream(spark, f"{tmp_dir}/in", max_files=1), 30))
    _run(start_update_parquet_sink(errs, f"{tmp_dir}/out", f"{tmp_dir}/chk", trigger=NOW))
    rows = spark.read.schema(ERRORS_SINK_SCHEMA).parquet(f"{tmp_dir}/out")
    assert sorted((r.batch_id, r.pageUrl, r["count"]) for r in rows.collect()) == [(0, "p", 1), (1, "p", 2), (1, "q", 1)]
    latest = rows.groupBy("window", "pageUrl").agg(F.max("count").alias("count"))
    assert sorted((r.pageUrl, r["count"]) for r in latest.collect()) == [("p", 2), ("q", 1)]


def test_snapshots_are_cumulative_and_equal_batch_results(spark, tmp_dir):
    b1 = [_minute(1, pageUrl="a", eventType="click", x=10, y=10), _minute(2, pageUrl="b"),
          _minute(2, userId=None, pageUrl="a")]
    b2 = [_minute(3, pageUrl="b", eventType="click", x=10, y=60), _minute(4, pageUrl="a"), _minute(5, pageUrl="")]
    _write_files(spark, f"{tmp_dir}/in", [b1, b2])
    _run(start_path_snapshots(_stream(spark, f"{tmp_dir}/in", max_files=1), f"{tmp_dir}/paths", f"{tmp_dir}/c1",
                              trigger=NOW))
    _run(start_heatmap_snapshots(_stream(spark, f"{tmp_dir}/in", max_files=1), f"{tmp_dir}/heat", f"{tmp_dir}/c2",
                                 trigger=NOW))
    assert sorted(os.listdir(f"{tmp_dir}/paths")) == ["snapshot_id=0", "snapshot_id=1"]
    batch = prepare_events(events_df(spark, b1 + b2))
    snap = {r.userId: list(r.path) for r in read_latest_snapshot(spark, f"{tmp_dir}/paths", PATH_SNAPSHOT_SCHEMA).collect()}
    assert snap == {r.userId: list(r.path) for r in user_paths(batch).collect()} == {"u1": ["a", "b", "a"], "?": ["a"]}
    heat = sorted(map(tuple, read_latest_snapshot(spark, f"{tmp_dir}/heat", HEATMAP_SNAPSHOT_SCHEMA).collect()))
    assert heat == sorted(map(tuple, click_heatmap_total(batch).collect()))


def test_pipeline_runs_three_queries(spark, tmp_dir):
    rows = [_minute(m, eventType=t, pageUrl="p", x=5, y=5) for m, t in [(1, "click"), (2, "error"), (3, "view")]]
    rows.append(_minute(120, eventType="click", x=5, y=5))
    rows.append(_minute(120, eventType="error"))
    _write_files(spark, f"{tmp_dir}/in", [rows])
    qs = run_pipeline(spark, "files", f"{tmp_dir}/out", f"{tmp_dir}/chk", session_timeout_minutes=2, trigger=NOW,
                      sinks={"errors": "parquet_updates"}, input_path=f"{tmp_dir}/in")
    assert set(qs) == {"heatmap", "paths", "errors"}
    for q in qs.values():
        _run(q)
    assert spark.read.schema(HEATMAP_SINK_SCHEMA).parquet(f"{tmp_dir}/out/heatmap").count() == 1
    assert spark.read.schema(PATHS_SINK_SCHEMA).parquet(f"{tmp_dir}/out/paths").count() == 1
    assert spark.read.schema(ERRORS_SINK_SCHEMA).parquet(f"{tmp_dir}/out/errors").count() == 2


def test_stream_equals_batch_when_delay_covers_the_data(spark, tmp_dir):
    # SURVEY §5.5: with one far-future click every earlier window closes
    import random

    rnd = random.Random(5)
    rows = [_minute(rnd.uniform(0, 300), eventType=rnd.choice(["click", "view", "error"]),
                    pageUrl=rnd.choice(["a", "b", None]), x=rnd.randint(-99, 400), y=rnd.randint(0, 300))
            for _ in range(300)]
    future = _minute(24 * 60, eventType="click", x=0, y=0)
    _write_files(spark, f"{tmp_dir}/in", [rows + [future]])
    heat = click_heatmap(with_event_watermark(_stream(spark, f"{tmp_dir}/in"), 30))
    _run(start_parquet_sink(heat, f"{tmp_dir}/out", f"{tmp_dir}/chk", trigger=NOW))
    streamed = sorted(map(tuple, spark.read.schema(HEATMAP_SINK_SCHEMA).parquet(f"{tmp_dir}/out").collect()), key=str)
    batch = sorted(map(tuple, click_heatmap(prepare_events(events_df(spark, rows))).collect()), key=str)
    assert streamed == batch


def test_console_variant_runs(spark, tmp_dir):
    rows = [_minute(1, eventType="click", x=5, y=5), _minute(2, eventType="error"), _minute(90, eventType="view")]
    _write_files(spark, f"{tmp_dir}/in", [rows])
    qs = run_pipeline(spark, "files", f"{tmp_dir}/out", f"{tmp_dir}/chk", session_timeout_minutes=2, trigger=NOW,
                      sinks={"heatmap": "console", "paths": "console", "errors": "console"},
                      input_path=f"{tmp_dir}/in")
    for q in qs.values():
        _run(q)
    assert not os.path.exists(f"{tmp_dir}/out/heatmap")


def test_command_line_job_finite_run(spark, tmp_dir):
    from trailmark.cli import main

    rows = [_minute(1, eventType="click", x=5, y=5), _minute(2, eventType="error"), _minute(90, eventType="click", x=5, y=5)]
    _write_files(spark, f"{tmp_dir}/in", [rows])
    main([f"--inputPath={tmp_dir}/in", f"--outputPath={tmp_dir}/out", f"--checkpointPath={tmp_dir}/chk",
          "--sessionTimeoutMinutes=2", "--trigger=availableNow", "--maxFilesPerTrigger=1", "ignored"])
    assert spark.read.schema(HEATMAP_SINK_SCHEMA).parquet(f"{tmp_dir}/out/heatmap").count() == 1
    assert spark.read.schema(PATHS_SINK_SCHEMA).parquet(f"{tmp_dir}/out/paths").count() == 1
    assert sorted(os.listdir(f"{tmp_dir}/chk")) == ["errors", "heatmap", "paths"]


def test_latest_snapshot_of_nothing_is_empty(spark, tmp_dir):
    df = read_latest_snapshot(spark, f"{tmp_dir}/none", PATH_SNAPSHOT_SCHEMA)
    assert df.count() == 0 and df.columns == ["userId", "path"]


def test_bounded_state_path_fragments_equal_batch_paths(spark, tmp_dir):
    from trailmark.streaming import read_fragment_paths, start_path_fragments

    b1 = [_minute(1, pageUrl="a"), _minute(1.5, pageUrl="a"), _minute(2, pageUrl="b"),
          _minute(2, userId=None, pageUrl="x"), _minute(3, pageUrl="")]
    b2 = [_minute(4, pageUrl="b"), _minute(5, pageUrl="a"), _minute(5.1, userId="u2", pageUrl="z")]
    far = [_minute(600, userId="closer", pageUrl="q")]  # moves the watermark past everything above
    _write_files(spark, f"{tmp_dir}/in", [b1, b2, far])
    _run(start_path_fragments(_stream(spark, f"{tmp_dir}/in", max_files=1), f"{tmp_dir}/frag", f"{tmp_dir}/chk",
                              session_timeout_minutes=2, trigger=NOW))
    got = {r.userId: list(r.path) for r in read_fragment_paths(spark, f"{tmp_dir}/frag").collect()}
    batch = {r.userId: list(r.path) for r in user_paths(prepare_events(events_df(spark, b1 + b2))).collect()}
    assert got == batch == {"u1": ["a", "b", "a"], "?": ["x"], "u2": ["z"]}


def test_spread_state_sessions_equal_batch_sessions(spark, tmp_dir):
    import random

    from trailmark.streaming.sessions import query_watermark, read_stream_sessions, start_session_cells

    rnd = random.Random(21)
    rows, t = [], 0.0
    for _ in range(400):
        t += rnd.choice([0, 0.01, 0.5, 1.5, 2.0, 3.0])  # minutes: exact-gap and longer pauses included
        rows.append(_minute(t, userId=rnd.choice(["hot", "hot", "u1", None]), pageUrl=rnd.choice(["a", "b", None])))
    rows.insert(200, ev(timestamp=None, userId="hot", pageUrl="no-time"))  # dropped, and never a state key
    batches = [rows[:150], rows[150:300], rows[300:]]
    _write_files(spark, f"{tmp_dir}/in", batches)
    q = start_session_cells(_stream(spark, f"{tmp_dir}/in", max_files=1), f"{tmp_dir}/cells", f"{tmp_dir}/chk",
                            gap_minutes=2, trigger=NOW)
    _run(q)
    until = query_watermark(q)
    got = sorted(((r.userId, r.sessionStart, r.sessionEnd, tuple(r.path))
                 for r in read_stream_sessions(spark, f"{tmp_dir}/cells", until, 2).collect()), key=str)
    limit = dt.datetime.fromisoformat(until.replace("Z", ""))
    batch = sorted(((r.userId, r.sessionStart, r.sessionEnd, tuple(r.path))
                   for r in session_paths(prepare_events(events_df(spark, rows)), 2).collect()
                   if r.sessionEnd <= limit), key=str)
    assert got == batch and len(got) > 5
    # a windowed read returns exactly the final sessions that start at or after `since`
    since = sorted(b[1] for b in batch)[len(batch) // 2] - dt.timedelta(seconds=30)
    part = sorted(((r.userId, r.sessionStart, r.sessionEnd, tuple(r.path)) for r in read_stream_sessions(
        spark, f"{tmp_dir}/cells", until, since=since.isoformat() + "Z").collect()), key=str)
    assert part == [b for b in batch if b[1] >= since] and 0 < len(part) < len(batch)


def test_pipeline_with_session_cells(spark, tmp_dir):
    from trailmark.streaming import query_watermark, read_stream_sessions

    rows = [_minute(m, pageUrl=p) for m, p in [(1, "a"), (2, "b"), (10, "c"), (60, "d")]]
    _write_files(spark, f"{tmp_dir}/in", [rows])
    qs = run_pipeline(spark, "files", f"{tmp_dir}/out", f"{tmp_dir}/chk", session_timeout_minutes=2, trigger=NOW,
                      sinks={"errors": "parquet_updates"}, session_state="cells", input_path=f"{tmp_dir}/in")
    for q in qs.values():
        _run(q)
    got = [(r.sessionStart.minute, list(r.path)) for r in
           read_stream_sessions(spark, f"{tmp_dir}/out/paths", query_watermark(qs["paths"]), 2).orderBy("sessionStart").collect()]
    assert got == [(1, ["a", "b"]), (10, ["c"])]


def test_fixture_in_four_time_ordered_files(spark, tmp_dir):
    # SURVEY §5.2: the same rows as one batch, fed as 4 time-ordered files
    from trailmark.sources import web_events

    smoke = "/root/testdata/sf0.001"
    if not os.path.exists(f"{smoke}/events.parquet"):
        pytest.skip("no test data")
    web = web_events(spark, smoke)
    cuts = web.approxQuantile("timestamp", [0.25, 0.5, 0.75], 0.0)
    bounds = [None, *cuts, None]
    os.makedirs(f"{tmp_dir}/in")
    for i in range(4):
        part = web
        if bounds[i] is not None:
            part = part.filter(F.col("timestamp") > bounds[i])
        if bounds[i + 1] is not None:
            part = part.filter(F.col("timestamp") <= bounds[i + 1])
        tmp = f"{tmp_dir}/part{i}"
        write_events_json(part.coalesce(1), tmp)
        name = [f for f in os.listdir(tmp) if f.endswith(".json")][0]
        os.rename(f"{tmp}/{name}", f"{tmp_dir}/in/batch{i}.json")
        os.utime(f"{tmp_dir}/in/batch{i}.json", (time.time() - 100 + i, time.time() - 100 + i))
    stream = session_paths(with_event_watermark(_stream(spark, f"{tmp_dir}/in", max_files=1), 30), 30)
    _run(start_parquet_sink(stream, f"{tmp_dir}/out", f"{tmp_dir}/chk", trigger=NOW))
    got = sorted(map(tuple, spark.read.schema(PATHS_SINK_SCHEMA).parquet(f"{tmp_dir}/out")
                     .selectExpr("userId", "sessionStart", "sessionEnd", "array_join(path, '|', '<null>')").collect()), key=str)
    events = prepare_events(web)
    limit = events.agg(F.max("eventTime")).first()[0] - dt.timedelta(minutes=30)
    batch = sorted(map(tuple, session_paths(events, 30).filter(F.col("sessionEnd") <= F.lit(limit))
                       .selectExpr("userId", "sessionStart", "sessionEnd", "array_join(path, '|', '<null>')").collect()), key=str)
    assert got == batch and len(got) > 50


# --------------------------------------------------------------------------- spread-state sessions
def _rows(df):
    return sorted(((r.userId, r.sessionStart, r.sessionEnd, tuple(r.path)) for r in df.collect()), key=str)


LATE = [
    [_minute(40, userId="other", pageUrl="o")],  # watermark 00:30 with gap and delay 10
    [_minute(41, userId="other", pageUrl="o")],
    [_minute(25, userId="inside", pageUrl="late")],  # 00:25 + gap is after the watermark: kept
    [_minute(15, userId="outside", pageUrl="late")],  # 00:15 + gap is before it: dropped
    [_minute(300, userId="closer", pageUrl="z")],
]


def _cells(spark, tmp_dir, name="cells", gap=10):
    from trailmark.streaming import start_session_cells

    q = start_session_cells(_stream(spark, f"{tmp_dir}/in", max_files=1), f"{tmp_dir}/{name}", f"{tmp_dir}/chk_{name}", gap, trigger=NOW)
    _run(q)
    return q


def test_spread_state_keeps_the_late_rows_that_session_window_keeps(spark, tmp_dir):
    from trailmark.streaming import query_watermark, read_stream_sessions

    _write_files(spark, f"{tmp_dir}/in", LATE)
    sess = session_paths(with_event_watermark(_stream(spark, f"{tmp_dir}/in", max_files=1), 10), 10)
    _run(start_parquet_sink(sess, f"{tmp_dir}/sess", f"{tmp_dir}/chk", trigger=NOW))
    per_user = _rows(spark.read.schema(PATHS_SINK_SCHEMA).parquet(f"{tmp_dir}/sess"))
    q = _cells(spark, tmp_dir)
    assert _rows(read_stream_sessions(spark, f"{tmp_dir}/cells", query_watermark(q))) == per_user
    assert [r[0] for r in per_user] == ["inside", "other"]


def test_a_late_row_extends_an_emitted_session_only_in_the_spread_plan(spark, tmp_dir):
    # the difference that remains: session_window has emitted [00:10, 00:20) and starts a second session
    from trailmark.streaming import query_watermark, read_stream_sessions

    batches = [[_minute(10, pageUrl="a")], [_minute(35, userId="other", pageUrl="o")], [_minute(36, userId="other", pageUrl="o")],
               [_minute(18, pageUrl="b")], [_minute(300, userId="closer", pageUrl="z")]]
    _write_files(spark, f"{tmp_dir}/in", batches)
    sess = session_paths(with_event_watermark(_stream(spark, f"{tmp_dir}/in", max_files=1), 10), 10)
    _run(start_parquet_sink(sess, f"{tmp_dir}/sess", f"{tmp_dir}/chk", trigger=NOW))
    per_user = [r for r in _rows(spark.read.schema(PATHS_SINK_SCHEMA).parquet(f"{tmp_dir}/sess")) if r[0] == "u1"]
    spread = [r for r in _rows(read_stream_sessions(spark, f"{tmp_dir}/cells", query_watermark(_cells(spark, tmp_dir)))) if r[0] == "u1"]
    assert [r[3] for r in per_user] == [("a",), ("b",)] and [r[3] for r in spread] == [("a", "b")]


def test_cells_know_their_gap(spark, tmp_dir):
    from trailmark.streaming import query_watermark, read_stream_sessions, start_session_cells

    _write_files(spark, f"{tmp_dir}/in", LATE)
    until = query_watermark(_cells(spark, tmp_dir))
    with pytest.raises(ValueError, match="gap of 600 s"):
        read_stream_sessions(spark, f"{tmp_dir}/cells", until, 2)
    with pytest.raises(ValueError, match="gap of 600 s"):
        start_session_cells(_stream(spark, f"{tmp_dir}/in"), f"{tmp_dir}/cells", f"{tmp_dir}/chk2", 2)
    with pytest.raises(ValueError, match="no stored gap"):
        read_stream_sessions(spark, f"{tmp_dir}/nothing", until)


def test_cells_do_not_depend_on_the_session_zone(spark, tmp_dir):
    from trailmark.streaming import query_watermark, read_stream_sessions

    _write_files(spark, f"{tmp_dir}/in", LATE)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        until = query_watermark(_cells(spark, tmp_dir))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    whole = _rows(read_stream_sessions(spark, f"{tmp_dir}/cells", until))
    assert len(whole) == 2
    assert _rows(read_stream_sessions(spark, f"{tmp_dir}/cells", until, since="2024-01-01T00:20:00+00:00")) == whole
    assert _rows(read_stream_sessions(spark, f"{tmp_dir}/cells", until, since="2023-12-31T16:20:00-08:00")) == whole
    with pytest.raises(ValueError, match="zone"):
        read_stream_sessions(spark, f"{tmp_dir}/cells", until, since="2024-01-01T00:20:00")


def test_watermark_after_a_restart(spark, tmp_dir):
    from trailmark.streaming import checkpoint_watermark, query_watermark, read_stream_sessions, write_stream_sessions

    _write_files(spark, f"{tmp_dir}/in", LATE)
    until = query_watermark(_cells(spark, tmp_dir))
    again = _cells(spark, tmp_dir)  # nothing new
    with pytest.raises(ValueError, match="checkpoint_watermark"):
        query_watermark(again)
    with pytest.raises(ValueError, match="until"):
        read_stream_sessions(spark, f"{tmp_dir}/cells", None)
    stored = checkpoint_watermark(spark, f"{tmp_dir}/chk_cells")
    assert dt.datetime.fromisoformat(stored) == dt.datetime.fromisoformat(until)
    write_stream_sessions(spark, f"{tmp_dir}/cells", stored, f"{tmp_dir}/final")
    assert _rows(spark.read.schema(PATHS_SINK_SCHEMA).parquet(f"{tmp_dir}/final")) == _rows(read_stream_sessions(spark, f"{tmp_dir}/cells", until))


# --------------------------------------------------------------------------- job
def test_unknown_or_useless_sinks_are_errors(spark, tmp_dir):
    with pytest.raises(ValueError, match="unknown sink 'json'"):
        run_pipeline(spark, sinks={"errors": "json"}, input_path=f"{tmp_dir}/in")
    with pytest.raises(ValueError, match="leave its sink out"):
        run_pipeline(spark, sinks={"paths": "parquet"}, session_state="spread", input_path=f"{tmp_dir}/in")


def test_job_keeps_errors_and_writes_all_time_snapshots(spark, tmp_dir):
    from trailmark.cli import main

    rows = [_minute(1, eventType="click", x=5, y=5), _minute(2, eventType="error"), ev(timestamp=10**18), _minute(90, pageUrl="b")]
    _write_files(spark, f"{tmp_dir}/in", [rows])
    main([f"--inputPath={tmp_dir}/in", f"--outputPath={tmp_dir}/out", f"--checkpointPath={tmp_dir}/chk", "--trigger=availableNow", "--allTime"])
    assert spark.read.schema(ERRORS_SINK_SCHEMA).parquet(f"{tmp_dir}/out/errors").count() == 1
    assert read_latest_snapshot(spark, f"{tmp_dir}/out/all_heatmap", HEATMAP_SNAPSHOT_SCHEMA).count() == 1
    assert [list(r.path) for r in read_latest_snapshot(spark, f"{tmp_dir}/out/all_paths", PATH_SNAPSHOT_SCHEMA).collect()] == [["p1", "b", "p1"]]


def test_rejected_event_times_are_counted(spark, tmp_dir):
    _write_files(spark, f"{tmp_dir}/in", [[_minute(1), ev(timestamp=10**18), ev(timestamp=None), ev(timestamp=-10**17)]])
    qs = run_pipeline(spark, "files", f"{tmp_dir}/out", f"{tmp_dir}/chk", trigger=NOW, input_path=f"{tmp_dir}/in")
    for q in qs.values():
        _run(q)
    assert sum(p["observedMetrics"]["event_time"]["rejected"] for p in qs["paths"].recentProgress if p["observedMetrics"]) == 2


def test_a_failure_before_the_wait_is_raised(spark, tmp_dir):
    from trailmark.streaming import await_any

    def fail(batch, batch_id):
        raise RuntimeError("broken sink")

    _write_files(spark, f"{tmp_dir}/in", [[_minute(1)]])
    bad = _stream(spark, f"{tmp_dir}/in").writeStream.foreachBatch(fail).option("checkpointLocation", f"{tmp_dir}/c1").start()
    good = _stream(spark, f"{tmp_dir}/in").writeStream.format("noop").option("checkpointLocation", f"{tmp_dir}/c2").start()
    while bad.isActive:
        time.sleep(0.1)
    with pytest.raises(Exception, match="broken sink"):
        await_any({"bad": bad, "good": good}, 0.1)
    assert not good.isActive


def test_a_half_written_snapshot_is_passed_over(spark, tmp_dir):
    from trailmark.streaming import latest_snapshot_id

    _write_files(spark, f"{tmp_dir}/in", [[_minute(1, pageUrl="a")]])
    _run(start_path_snapshots(_stream(spark, f"{tmp_dir}/in"), f"{tmp_dir}/snap", f"{tmp_dir}/chk", trigger=NOW))
    os.makedirs(f"{tmp_dir}/snap/snapshot_id=7")
    with open(f"{tmp_dir}/snap/snapshot_id=7/part-0.json", "w") as f:
        f.write('{"userId": "half", "path": []}')
    assert latest_snapshot_id(spark, f"{tmp_dir}/snap") == 0
    assert [r.userId for r in read_latest_snapshot(spark, f"{tmp_dir}/snap", PATH_SNAPSHOT_SCHEMA).collect()] == ["u1"]
