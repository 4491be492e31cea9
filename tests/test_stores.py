"""Stores of deltas, open sessions and the quarantine: results, crashes, replays and what readers open."""

import datetime as dt
import os
import re

import pytest

from conftest import MIN, T0, ev, events_df
from test_streaming import LATE, _minute, _rows, _run, _stream, _write_files
from trailmark.operators import click_heatmap_total, prepare_events, session_paths, user_path_chunks, user_path_fragments, user_paths, with_event_watermark
from trailmark.plans.contract import PATHS_SINK_SCHEMA
from trailmark.sources.quarantine import bad_records, check_records, count_reasons, good_events
from trailmark.streaming import HEATMAP, PATHS, DeltaStore, read_session_batches, report, run_pipeline, session_log, start_open_sessions, start_parquet_sink
from trailmark.streaming import deltas as deltas_module
from trailmark.streaming import open_sessions as open_module
from trailmark.streaming.deltas import start_delta_store

NOW = {"availableNow": True}


def _events(spark, batch):
    rows = [_minute(batch * 3 + i, userId=f"u{i % 3}", eventType=("click", "error", "view")[i % 3], pageUrl=f"p{(batch + i) % 4}", x=i * 30, y=batch)
            for i in range(7)] + [_minute(1, userId="u0", pageUrl="late"), _minute(1, userId="u0", pageUrl="late")]
    return prepare_events(events_df(spark, rows))


def _cells(df):
    return sorted(map(tuple, df.collect()), key=str)


def _paths(df):
    return sorted((r["userId"], tuple(r["path"])) for r in df.collect())


# --------------------------------------------------------------------------- deltas
@pytest.mark.parametrize("fanout", [2, 3])
def test_store_equals_the_batch_result_after_every_batch(spark, tmp_dir, fanout):
    heat, paths = (DeltaStore(spark, f"{tmp_dir}/{k.name}", k, fanout) for k in (HEATMAP, PATHS))
    seen = None
    for batch in range(5):
        events = _events(spark, batch)
        seen = events if seen is None else seen.unionAll(events)
        for store in (heat, paths):
            version = store.append(events, batch, "q")
            # a logarithmic number of segments: fewer than fanout per level
            assert all(sum(s.level == level for s in version.segments) < fanout for level in range(9))
            assert [s.first_batch for s in version.segments] == sorted(s.first_batch for s in version.segments)
        assert _cells(heat.read()) == _cells(click_heatmap_total(seen))
        assert _paths(paths.read()) == _paths(user_paths(seen))
    live = {s.segment for s in heat.version().segments}
    kept = {s.segment for n in heat.versions() for s in heat.version(n).segments}
    assert live <= kept == set(heat._listed("segments")) and len(heat.versions()) <= deltas_module.KEEP_VERSIONS


def test_a_second_read_opens_only_what_changed(spark, tmp_dir):
    writer, reader = (DeltaStore(spark, f"{tmp_dir}/s", HEATMAP, 4) for _ in range(2))
    assert reader.read().collect() == [] and reader.version().number == -1
    for batch in range(3):
        writer.append(_events(spark, batch), batch)
    opened = []
    rows = reader._rows
    reader._rows = lambda segments: opened.extend(s.segment for s in segments) or rows(segments)
    reader.read().collect()
    assert len(opened) == 3
    reader.read().collect()
    assert len(opened) == 3
    writer.append(_events(spark, 3), 3)  # the level is full: one segment of four batches
    reader.read().collect()
    assert opened[3:] == [s.segment for s in writer.version().segments] and len(opened) == 4
    writer.append(_events(spark, 4), 4)
    assert _cells(reader.read()) == _cells(writer.read()) and len(opened) == 5
    assert _cells(writer.changes(3)) == _cells(click_heatmap_total(_events(spark, 4)))
    with pytest.raises(ValueError, match="have been merged"):
        writer.changes(1)


def test_replayed_batches_and_crashes_change_nothing(spark, tmp_dir, monkeypatch):
    store = DeltaStore(spark, f"{tmp_dir}/s", HEATMAP, 2)
    store.append(_events(spark, 0), 0, "q")
    once = _cells(store.read())
    assert store.append(_events(spark, 0), 0, "q").number == 0 and _cells(store.read()) == once  # committed before
    real = DeltaStore._commit
    for name in ("before", "while merging"):
        calls = []

        def failing(self, version, name=name, calls=calls):
            calls.append(version)
            if len(calls) == (1 if name == "before" else 2):
                raise RuntimeError("crash")
            real(self, version)

        monkeypatch.setattr(DeltaStore, "_commit", failing)
        batch = 1 if name == "before" else 3
        with pytest.raises(RuntimeError, match="crash"):
            for b in ([1] if name == "before" else [2, 3]):
                store.append(_events(spark, b), b, "q")
        monkeypatch.setattr(DeltaStore, "_commit", real)
        store.append(_events(spark, batch), batch, "q")
        whole = _events(spark, 0)
        for b in range(1, batch + 1):
            whole = whole.unionAll(_events(spark, b))
        assert _cells(DeltaStore(spark, f"{tmp_dir}/s", HEATMAP).read()) == _cells(click_heatmap_total(whole))
    with pytest.raises(ValueError, match="a new checkpoint needs a new store"):
        store.append(_events(spark, 0), 9, "another")
    with pytest.raises(ValueError, match="fanout"):
        DeltaStore(spark, tmp_dir, HEATMAP, 1)


def test_stream_keeps_no_state_and_a_new_checkpoint_is_an_error(spark, tmp_dir):
    _write_files(spark, f"{tmp_dir}/in", [[_minute(m, pageUrl=f"p{m % 2}") for m in range(i, i + 4)] for i in range(5)])
    q = start_delta_store(_stream(spark, f"{tmp_dir}/in", max_files=1), f"{tmp_dir}/s", f"{tmp_dir}/chk", PATHS, trigger=NOW)
    _run(q)
    assert all(not p["stateOperators"] for p in q.recentProgress)
    want = user_paths(prepare_events(spark.read.schema(events_df(spark, []).schema).json(f"{tmp_dir}/in")))
    assert _paths(DeltaStore(spark, f"{tmp_dir}/s", PATHS).read()) == _paths(want)
    other = start_delta_store(_stream(spark, f"{tmp_dir}/in"), f"{tmp_dir}/s", f"{tmp_dir}/chk2", PATHS, trigger=NOW)
    with pytest.raises(Exception, match="a new checkpoint needs a new store"):
        other.awaitTermination()


def test_report_of_the_job(spark, tmp_dir, capsys):
    rows = [_minute(1, eventType="click", x=5, y=5), _minute(2, eventType="click", x=9, y=9), _minute(2, eventType="error", pageUrl="e"), _minute(3, pageUrl="b")]
    _write_files(spark, f"{tmp_dir}/in", [rows])
    qs = run_pipeline(spark, "files", f"{tmp_dir}/out", f"{tmp_dir}/chk", trigger=NOW, report=True, all_time="deltas", input_path=f"{tmp_dir}/in")
    for q in qs.values():
        _run(q)
    got = report(spark, f"{tmp_dir}/out/all_time")
    assert [tuple(r) for r in got["heatmap"].collect()] == [("p1", "#e", 0, 0, 2)]
    assert [tuple(r) for r in got["errors"].collect()] == [("e", 1)]
    assert [tuple(r) for r in got["paths"].collect()] == [("u1", "p1 -> e -> p1 -> b")]
    assert "heatmap after batch 0" in capsys.readouterr().out
    assert _paths(DeltaStore(spark, f"{tmp_dir}/out/all_paths", PATHS).read()) == [("u1", ("p1", "e", "p1", "b"))]


# --------------------------------------------------------------------------- two-level scan
def test_no_window_holds_pages_and_ranges_change_nothing(spark):
    rows = [ev(userId="hot" if i % 3 == 0 else f"u{i % 5}", timestamp=None if i % 50 == 0 else T0 + i * 7_001, pageUrl=f"p{i // 4 % 3}") for i in range(900)]
    fragments = user_path_fragments(prepare_events(events_df(spark, rows)))
    whole = _paths(user_paths(prepare_events(events_df(spark, rows))))
    for range_chunks in (1, 2, 7, 100_000):
        pieces: dict = {}
        for r in sorted(user_path_chunks(fragments, range_chunks).collect(), key=lambda r: (r.no_time, r.chunk or 0)):
            pieces.setdefault(r.userId, []).extend(r.pages)
        assert sorted((u, tuple(p)) for u, p in pieces.items()) == whole
    lines = user_path_chunks(fragments)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Window [" in line]
    # what a window sorts: first and last page, never the pages
    assert len(below) >= 2 and all(re.search(r"(?:\[|, )pages#\d+(?:,|\])", line) is None for line in below)
    assert any("last_page" in line for line in below)


# --------------------------------------------------------------------------- open sessions
def _per_user(spark, tmp_dir, gap):
    sess = session_paths(with_event_watermark(_stream(spark, f"{tmp_dir}/in", max_files=1), gap), gap)
    _run(start_parquet_sink(sess, f"{tmp_dir}/sess", f"{tmp_dir}/chk", trigger=NOW))
    return _rows(spark.read.schema(PATHS_SINK_SCHEMA).parquet(f"{tmp_dir}/sess"))


def _open(spark, tmp_dir, gap, name="open", max_files=1):
    _run(start_open_sessions(_stream(spark, f"{tmp_dir}/in", max_files=max_files), f"{tmp_dir}/{name}", f"{tmp_dir}/chk_{name}", gap, trigger=NOW))
    return _rows(read_session_batches(spark, f"{tmp_dir}/{name}", f"{tmp_dir}/chk_{name}"))


def test_open_sessions_equal_session_window_with_late_rows(spark, tmp_dir):
    again = [[_minute(10, pageUrl="a")], [_minute(35, userId="other", pageUrl="o")], [_minute(36, userId="other", pageUrl="o")],
             [_minute(18, pageUrl="b")], [_minute(300, userId="closer", pageUrl="z"), ev(timestamp=None), _minute(301, userId=None, pageUrl=None)],
             [_minute(600, userId="closer", pageUrl="z")]]
    for i, batches in enumerate((LATE, again)):
        base = f"{tmp_dir}/{i}"
        os.makedirs(base)
        _write_files(spark, f"{base}/in", batches)
        assert _open(spark, base, 10) == _per_user(spark, base, 10)
    log = {r["batch"]: r for r in session_log(spark, f"{tmp_dir}/1/chk_open").collect()}
    assert log[4]["untimed"] == 1 and sum(r["late"] for r in log.values()) == 0
    assert sum(r["late"] for r in session_log(spark, f"{tmp_dir}/0/chk_open").collect()) == 1
    assert log[5]["watermark"] == dt.datetime(2024, 1, 1, 9, 50)


def test_open_sessions_are_out_with_the_batch_that_closes_them(spark, tmp_dir):
    _write_files(spark, f"{tmp_dir}/in", [[_minute(1, pageUrl="a")], [_minute(3, pageUrl="b")], [_minute(8, userId="x")], [_minute(90, userId="y")]])
    _open(spark, tmp_dir, 2)
    out = [r["batch_id"] for r in spark.read.schema("userId string, batch_id long").parquet(f"{tmp_dir}/open").filter("userId = 'u1'").collect()]
    assert out == [2]  # [1, 5) is closed by minute 8 less the delay of 2


def test_a_crash_between_write_and_commit_repeats_no_session(spark, tmp_dir, monkeypatch):
    _write_files(spark, f"{tmp_dir}/in", [[_minute(m, userId=f"u{m % 2}", pageUrl=f"p{m}") for m in range(b * 20, b * 20 + 9)] for b in range(4)])
    want = _open(spark, tmp_dir, 3, "whole")
    real, calls = open_module.OpenSessions._write_open, []

    def failing(self, pool, closed, batch):
        real(self, pool, closed, batch)
        calls.append(batch)
        if calls.count(2) == 1 and batch == 2:
            raise RuntimeError("crash")

    monkeypatch.setattr(open_module.OpenSessions, "_write_open", failing)
    with pytest.raises(Exception, match="crash"):
        _open(spark, tmp_dir, 3, "crashed")
    done = read_session_batches(spark, f"{tmp_dir}/crashed", f"{tmp_dir}/chk_crashed")
    assert set(_rows(done)) < set(want)  # the sessions written without a commit are not seen
    assert _open(spark, tmp_dir, 3, "crashed") == want and calls.count(2) == 2


def test_open_state_is_bounded_and_its_gap_is_fixed(spark, tmp_dir):
    _write_files(spark, f"{tmp_dir}/in", [[_minute(b * 30 + m / 10, pageUrl=f"p{m}") for m in range(40)] for b in range(5)])
    _open(spark, tmp_dir, 2)
    state = f"{tmp_dir}/chk_open/open_sessions"
    assert sorted(os.listdir(f"{state}/open")) == ["batch=3", "batch=4"] and os.listdir(f"{state}/pool") == []
    assert spark.read.parquet(f"{state}/open/batch=4").count() == 40
    with pytest.raises(ValueError, match="a gap of 120 s"):
        open_module.OpenSessions(spark, f"{tmp_dir}/open", f"{tmp_dir}/chk_open", 5).advance(_events(spark, 1), 5)
    with pytest.raises(ValueError, match="no batch 8"):
        open_module.OpenSessions(spark, f"{tmp_dir}/open", f"{tmp_dir}/chk_open", 2).advance(_events(spark, 1), 9)
    assert read_session_batches(spark, f"{tmp_dir}/none", f"{tmp_dir}/none").collect() == []


def test_spread_job_ends_in_session_rows(spark, tmp_dir):
    from trailmark.cli import main

    _write_files(spark, f"{tmp_dir}/in", [[_minute(m, pageUrl=p) for m, p in [(1, "a"), (2, "b"), (10, "c"), (60, "d")]]])
    main([f"--inputPath={tmp_dir}/in", f"--outputPath={tmp_dir}/out", f"--checkpointPath={tmp_dir}/chk", "--sessionTimeoutMinutes=2",
          "--trigger=availableNow", "--sessionState=spread", "--quarantine"])
    got = read_session_batches(spark, f"{tmp_dir}/out/paths", f"{tmp_dir}/chk/paths").orderBy("sessionStart").collect()
    assert [(r.sessionStart.minute, list(r.path)) for r in got] == [(1, ["a", "b"]), (10, ["c"])]


# --------------------------------------------------------------------------- quarantine and arrival
RECORDS = ['{"userId":"u1","timestamp":1732000000000,"eventType":view"}', "not json", "", '{"userId":"u"}', '{"userId":"a","timestamp":1,"x":12.5}',
           '{"userId":"b","timestamp":1,"x":"12"}', '{"userId":"c","timestamp":1,"x":99999999999,"y":null}', '{"userId":"d","timestamp":"1732000000000"}',
           '{"userId":"e","timestamp":2,"extra":1,"meta":{"a": 1}}', "[1]", '"text"', "12", "null", None, "{}", '{"userId":"u9","timesta']


def test_reasons_of_records(spark):
    records = spark.createDataFrame([(r, 1) for r in RECORDS], "value string, data int")
    checked = check_records(records).collect()
    reasons = {r["value"]: r["reasons"] for r in checked}
    none = ["not a JSON object"]
    for bad in (RECORDS[0], "not json", "", "[1]", '"text"', "12", "null", None, RECORDS[-1]):
        assert reasons[bad] == none, bad
    assert reasons['{"userId":"u"}'] == reasons["{}"] == reasons[RECORDS[8]] == []
    assert reasons[RECORDS[4]] == reasons[RECORDS[5]] == reasons[RECORDS[6]] == ["x: not a int"]
    assert reasons[RECORDS[7]] == ["timestamp: not a bigint"]
    good = good_events(check_records(records)).collect()
    assert sorted(str(r["userId"]) for r in good) == ["None", "a", "b", "c", "d", "e", "u"]
    assert {r["reason"]: r["records"] for r in count_reasons(check_records(records)).collect()} == {
        "not a JSON object": 9, "x: not a int": 3, "timestamp: not a bigint": 1}
    assert bad_records(check_records(records)).count() == 13
    empty = check_records(records.limit(0))
    assert good_events(empty).collect() == bad_records(empty).collect() == count_reasons(empty).collect() == []


def test_each_record_is_parsed_once_for_each_schema(spark, tmp_dir):
    path = f"{tmp_dir}/records"
    spark.createDataFrame([(r,) for r in RECORDS], "value string").write.parquet(path)
    for result in (count_reasons, bad_records, good_events):
        checked = check_records(spark.read.parquet(path))
        plan = result(checked)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 2, result.__name__


def test_a_row_a_year_ahead_moves_no_watermark(spark, tmp_dir):
    from trailmark.streaming import rejected_so_far

    now = int(dt.datetime.now().timestamp() * 1000)
    rows = [ev(timestamp=now - 300 * MIN, pageUrl="a"), ev(timestamp=now + 365 * 24 * 60 * MIN, pageUrl="ahead")]
    _write_files(spark, f"{tmp_dir}/in", [rows, [ev(timestamp=now - 250 * MIN, pageUrl="b")], [ev(timestamp=now - 100 * MIN, pageUrl="c")]])
    with open(f"{tmp_dir}/in/batch001.json", "a") as f:
        f.write('{"userId":"u1","timesta\n')
    between = os.stat(f"{tmp_dir}/in/batch000.json").st_mtime + 0.5  # the order of the files stays
    os.utime(f"{tmp_dir}/in/batch001.json", (between, between))
    qs = run_pipeline(spark, "files", f"{tmp_dir}/out", f"{tmp_dir}/chk", 2, trigger=NOW, session_state="spread", quarantine=True,
                      max_lead_minutes=60, max_files_per_trigger=1, input_path=f"{tmp_dir}/in")
    for q in qs.values():
        _run(q)
    got = read_session_batches(spark, f"{tmp_dir}/out/paths", f"{tmp_dir}/chk/paths").orderBy("sessionStart").collect()
    assert [list(r.path) for r in got] == [["a"], ["b"]]
    counted = rejected_so_far(qs)
    assert (counted["rejected"], counted["malformed"], counted["bad"], counted["read"]) == (1, 1, 1, 5)
    assert [r["record"] for r in spark.read.parquet(f"{tmp_dir}/out/quarantine").collect()] == ['{"userId":"u1","timesta']


def test_arrival_of_records(spark):
    from trailmark.sources.kafka import decode_events

    rows = spark.sql("SELECT cast('{\"userId\":\"u\",\"timestamp\":1704067200000}' AS binary) AS value, timestamp'2024-01-01 00:00:30' AS timestamp")
    events = decode_events(rows, with_arrival=True)
    assert [r["eventTime"] is None for lead in (0, -1, 5) for r in prepare_events(events, max_lead_minutes=lead).collect()] == [False, True, False]
