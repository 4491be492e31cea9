"""The table with one row per key: merges, sealed days, crashes, replays and what stays on disk."""

import datetime as dt
import random

import pytest

from trailmark.streaming import UpsertTable
from trailmark.streaming import upserts as upserts_module

DDL = "window struct<start:timestamp,end:timestamp>, pageUrl string, count long"
DAY0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def _rows(spark, rows):
    """(minute since the first day, page, count) with windows of five minutes."""
    at = [(DAY0 + dt.timedelta(minutes=m), p, n) for m, p, n in rows]
    return spark.createDataFrame([((t, t + dt.timedelta(minutes=5)), p, n) for t, p, n in at], DDL)


def _read(df):
    got = df.selectExpr("(unix_seconds(window.start) - 1704067200) div 60 AS minute", "pageUrl", "count").collect()
    out = {(r["minute"], r["pageUrl"]): r["count"] for r in got}
    assert len(out) == len(got), "a key repeats"
    return out


def _table(spark, tmp_dir):
    return UpsertTable(spark, f"{tmp_dir}/table", _rows(spark, []).schema)


def test_latest_row_per_key_and_only_touched_days_are_written(spark, tmp_dir):
    rnd, table, want, moved = random.Random(4), _table(spark, tmp_dir), {}, {}
    assert _read(table.read()) == {} and table.version().batch == -1
    for batch in range(6):
        days = [batch, batch + 1] if batch % 3 else []  # every third batch is empty
        fresh = {(day * 1440 + rnd.choice([0, 5, 1435]), rnd.choice(["a", "b", None])): batch * 10 + rnd.randrange(5) for day in days for _ in range(4)}
        want |= fresh
        version = table.append(_rows(spark, [(m, p, n) for (m, p), n in fresh.items()]), batch, "q", DAY0.timestamp() + batch * 86_400)
        assert _read(table.read()) == want
        touched = {f"2024-01-{m // 1440 + 1:02d}" for m, _ in fresh}
        assert {d for d, where in version.days.items() if where.batch == batch} == touched
        # sealed: a whole day past the end of the day
        assert {d for d, where in version.days.items() if where.sealed} == {d for d in version.days if int(d[-2:]) + 1 <= batch}
        assert all(version.days[d].batch == b for d, b in moved.items())
        moved = {d: where.batch for d, where in version.days.items() if where.sealed}
        opened = {k: n for k, n in want.items() if f"2024-01-{k[0] // 1440 + 1:02d}" not in moved}
        assert _read(table.read(open_only=True)) == opened
    assert _read(table.read(days=["2024-01-02"])) == {k: n for k, n in want.items() if k[0] // 1440 == 1}
    assert len(table.versions()) == upserts_module.KEEP_VERSIONS
    kept = {(where.batch, d) for n in table.versions() for d, where in table.version(n).days.items()}
    there = {(int(b[6:]), d[4:]) for b in table._listed("rows") if b.startswith("batch=") for d in table._listed(f"rows/{b}") if d.startswith("day=")}
    assert there == kept and table._listed("fresh") == []


def test_replays_and_crashes_change_nothing(spark, tmp_dir, monkeypatch):
    table = _table(spark, tmp_dir)
    table.append(_rows(spark, [(0, "a", 1), (5, "a", 1)]), 0, "q")
    commit = UpsertTable._commit

    def failing(self, version):
        raise OSError("lost")

    monkeypatch.setattr(UpsertTable, "_commit", failing)
    with pytest.raises(OSError):
        table.append(_rows(spark, [(0, "a", 2), (10, None, 7)]), 1, "q")
    monkeypatch.setattr(UpsertTable, "_commit", commit)
    assert _read(table.read()) == {(0, "a"): 1, (5, "a"): 1}
    for _ in range(2):  # the replay after the crash, and one of a committed batch
        table.append(_rows(spark, [(0, "a", 2), (10, None, 7)]), 1, "q")
        assert _read(table.read()) == {(0, "a"): 2, (5, "a"): 1, (10, None): 7}
    assert _read(table.read(version=0)) == {(0, "a"): 1, (5, "a"): 1}
    # a count may fall: the later batch wins; inside a batch the greatest
    table.append(_rows(spark, [(0, "a", 1), (5, "a", 3), (5, "a", 4)]), 2, "q")
    assert _read(table.read()) == {(0, "a"): 1, (5, "a"): 4, (10, None): 7}


def test_what_a_table_refuses(spark, tmp_dir):
    table = _table(spark, tmp_dir)
    table.append(_rows(spark, [(0, "a", 1)]), 0, "q", DAY0.timestamp() + 2 * 86_400)
    with pytest.raises(ValueError, match="sealed days: 2024-01-01"):
        table.append(_rows(spark, [(5, "a", 1)]), 1, "q")
    with pytest.raises(ValueError, match="belongs to the streaming query q"):
        table.append(_rows(spark, []), 1, "other")
    with pytest.raises(ValueError, match="no version 9"):
        table.read(version=9)
    with pytest.raises(ValueError, match="key 'window'"):
        UpsertTable(spark, tmp_dir, _rows(spark, []).schema, keys=["pageUrl"])
