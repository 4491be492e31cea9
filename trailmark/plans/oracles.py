"""DuckDB SQL for each contract key, over the driver's raw ``events`` table.

``WEB`` maps the table to web events exactly as ``sources.tables`` does; the
result columns carry the same names as the Spark side.  Timestamps are naive
UTC, paths are published as text (``|`` between pages, ``<null>`` for NULL).
"""

from __future__ import annotations

WEB = """
WITH raw AS (SELECT *, cast(json_extract_string(props, '$.k') AS int) k FROM events),
web AS (SELECT CASE WHEN k IS NULL OR k <> 98 THEN 'u' || user_id END AS userId,
  CASE WHEN event_id % 101 <> 7 THEN 1704067200000 + (epoch_us(ts) // 1000 - 1704067200000) // 30 END AS "timestamp",
  event_type AS eventType,
  CASE WHEN k = 99 THEN NULL ELSE 'https://site.example/p' || (k % 5) END AS pageUrl,
  '' AS referrer,
  CASE event_id % 23 WHEN 5 THEN NULL WHEN 6 THEN '' ELSE '#e' || (event_id % 2) END AS element,
  CASE WHEN event_type = 'click' AND event_id % 29 <> 3 THEN cast(floor(value) AS int) % 200 - 60 END AS x,
  CASE WHEN event_type = 'click' THEN cast((event_id * 37) % 150 AS int) - 40 END AS y,
  CASE user_id % 3 WHEN 0 THEN 1280 WHEN 1 THEN 1440 ELSE 1920 END AS screenWidth,
  CASE user_id % 3 WHEN 0 THEN 800 WHEN 1 THEN 900 ELSE 1080 END AS screenHeight,
  props AS meta
  FROM raw),
ev AS (SELECT *, make_timestamp(("timestamp" // 1000) * 1000000) AS eventTime FROM web),
fx AS (SELECT coalesce(nullif(userId, ''), '?') AS userId, "timestamp", eventTime,
  coalesce(eventType, '') AS eventType, coalesce(pageUrl, '') AS pageUrl,
  coalesce(nullif(element, ''), 'body') AS element, coalesce(x, 0) AS x, coalesce(y, 0) AS y FROM ev)
"""


def _path_text(col: str) -> str:
    return f"array_to_string(list_transform({col}, lambda z: coalesce(z, '<null>')), '|')"


def _heatmap_10m() -> str:
    return WEB + """
SELECT time_bucket(INTERVAL 10 MINUTE, eventTime, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL 10 MINUTE, eventTime, TIMESTAMP '1970-01-01') + INTERVAL 10 MINUTE AS window_end,
  pageUrl, element, cast(trunc(x / 50) AS int) * 50 AS xBucket, cast(trunc(y / 50) AS int) * 50 AS yBucket,
  count(*) AS "count"
FROM ev WHERE eventType = 'click' AND eventTime IS NOT NULL GROUP BY ALL
"""


def _errors_5m() -> str:
    return WEB + """
SELECT time_bucket(INTERVAL 5 MINUTE, eventTime, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL 5 MINUTE, eventTime, TIMESTAMP '1970-01-01') + INTERVAL 5 MINUTE AS window_end,
  pageUrl, count(*) AS "count"
FROM ev WHERE eventType = 'error' AND eventTime IS NOT NULL GROUP BY ALL
"""


def _session_paths(gap_minutes: int, where: str = "") -> str:
    return WEB + f""",
b AS (SELECT *, CASE WHEN eventTime - lag(eventTime) OVER (PARTITION BY userId ORDER BY eventTime)
                     <= INTERVAL {gap_minutes} MINUTE THEN 0 ELSE 1 END AS nb
      FROM ev WHERE eventTime IS NOT NULL),
sx AS (SELECT *, sum(nb) OVER (PARTITION BY userId ORDER BY eventTime ROWS UNBOUNDED PRECEDING) AS sid FROM b),
s AS (SELECT userId, min(eventTime) AS sessionStart, max(eventTime) + INTERVAL {gap_minutes} MINUTE AS sessionEnd,
        list(pageUrl ORDER BY eventTime, pageUrl NULLS FIRST) AS path
      FROM sx GROUP BY userId, sid)
SELECT userId, sessionStart, sessionEnd, {_path_text('path')} AS path_text FROM s {where}
"""


def _event_time() -> str:
    return WEB + """
SELECT userId, "timestamp", eventType, pageUrl, referrer, element, x, y, screenWidth, screenHeight, meta, eventTime
FROM ev
"""


def _events_only() -> str:
    return WEB + """
SELECT userId, "timestamp", eventType, pageUrl, referrer, element, x, y, screenWidth, screenHeight, meta FROM web
"""


_HEATMAP_TOTAL = """
SELECT pageUrl, element, cast(trunc(x / 50) AS int) * 50 AS xBucket, cast(trunc(y / 50) AS int) * 50 AS yBucket,
  count(*) AS "count"
FROM fx WHERE eventType = 'click' GROUP BY ALL
"""

_USER_PATHS = """,
o AS (SELECT *, lag(pageUrl) OVER (PARTITION BY userId ORDER BY "timestamp", pageUrl) AS pv
      FROM fx WHERE pageUrl <> ''),
p AS (SELECT userId, list(pageUrl ORDER BY "timestamp", pageUrl) AS path
      FROM o WHERE pv IS NULL OR pv <> pageUrl GROUP BY userId)
"""


# Late arrivals: batch of a row (event time plus its own delay, six hours a batch), and for each
# batch the latest event time of the batches before it, over the rows that move the watermark.
def _arrived(where: str) -> str:
    web = WEB.replace("props AS meta\n  FROM raw)", "props AS meta, greatest(0, least(3, ((epoch_us(ts) // 1000 - 1704067200000) // 30"
                      " + event_id % 97 * 60000) // 21600000)) AS batch\n  FROM raw)")
    return web + f""",
av AS (SELECT * FROM ev WHERE eventTime IS NOT NULL AND {where}),
tops AS (SELECT batch, max(eventTime) AS top FROM av GROUP BY batch),
seen AS (SELECT b.batch, (SELECT max(top) FROM tops t WHERE t.batch < b.batch) AS before FROM tops b)"""


def _session_late() -> str:
    # a row is late once its time is at or before the cells' watermark (30 minutes delay and one gap)
    return _arrived("true") + f""",
kept AS (SELECT av.* FROM av JOIN seen USING (batch) WHERE before IS NULL OR eventTime > before - INTERVAL 60 MINUTE),
b AS (SELECT *, CASE WHEN eventTime - lag(eventTime) OVER (PARTITION BY userId ORDER BY eventTime)
                     <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS nb FROM kept),
sx AS (SELECT *, sum(nb) OVER (PARTITION BY userId ORDER BY eventTime ROWS UNBOUNDED PRECEDING) AS sid FROM b),
s AS (SELECT userId, min(eventTime) AS sessionStart, max(eventTime) + INTERVAL 30 MINUTE AS sessionEnd,
        list(pageUrl ORDER BY eventTime, pageUrl NULLS FIRST) AS path FROM sx GROUP BY userId, sid)
SELECT userId, sessionStart, sessionEnd, {_path_text('path')} AS path_text FROM s
WHERE sessionEnd <= (SELECT max(top) FROM tops) - INTERVAL 60 MINUTE
"""


_ERRORS_KEPT = """,
w AS (SELECT av.*, time_bucket(INTERVAL 5 MINUTE, eventTime, TIMESTAMP '1970-01-01') AS window_start, before
      FROM av JOIN seen USING (batch)),
kept AS (SELECT * FROM w WHERE before IS NULL OR window_start + INTERVAL 5 MINUTE > before - INTERVAL 30 MINUTE),
per AS (SELECT batch, window_start, pageUrl, count(*) AS n FROM kept GROUP BY ALL)
"""


def _errors_late() -> str:
    # a row is late once its window ends at or before the watermark; only errors move it
    return _arrived("eventType = 'error'") + _ERRORS_KEPT + """
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, pageUrl,
  cast(sum(n) OVER (PARTITION BY window_start, pageUrl ORDER BY batch) AS BIGINT) AS "count"
FROM per
"""


def _errors_upsert_late() -> str:
    return _arrived("eventType = 'error'") + _ERRORS_KEPT + """
SELECT after_batch, window_start, window_start + INTERVAL 5 MINUTE AS window_end, pageUrl, cast(sum(n) AS BIGINT) AS "count"
FROM per JOIN (SELECT unnest([0, 1, 2, 3]) AS after_batch) ON batch <= after_batch GROUP BY after_batch, window_start, pageUrl
"""


def _open_sessions_late() -> str:
    """Four batches: rows that are late under the watermark of the batches before go, the rest joins the open
    rows; sessions that end at or before the new watermark come out, the others stay open."""
    sql = _arrived("true") + """,
marks AS (SELECT b AS batch, (SELECT max(top) FROM tops WHERE tops.batch < b) - INTERVAL 30 MINUTE AS before,
    (SELECT max(top) FROM tops WHERE tops.batch <= b) - INTERVAL 30 MINUTE AS mark FROM (SELECT unnest([0, 1, 2, 3]) AS b))"""
    for b in range(4):
        opened = f"UNION ALL SELECT userId, eventTime, pageUrl FROM t{b - 1} WHERE NOT final" if b else ""
        sql += f""",
p{b} AS (SELECT userId, eventTime, pageUrl FROM av JOIN marks USING (batch)
         WHERE batch = {b} AND (before IS NULL OR eventTime + INTERVAL 30 MINUTE > before) {opened}),
n{b} AS (SELECT *, CASE WHEN eventTime - lag(eventTime) OVER (PARTITION BY userId ORDER BY eventTime)
         <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS nb FROM p{b}),
i{b} AS (SELECT *, sum(nb) OVER (PARTITION BY userId ORDER BY eventTime ROWS UNBOUNDED PRECEDING) AS sid FROM n{b}),
t{b} AS (SELECT *, coalesce(max(eventTime) OVER (PARTITION BY userId, sid) + INTERVAL 30 MINUTE
         <= (SELECT mark FROM marks WHERE batch = {b}), false) AS final FROM i{b})"""
    rows = " UNION ALL ".join(f"SELECT {b} AS batch, userId, sid, eventTime, pageUrl FROM t{b} WHERE final" for b in range(4))
    return sql + f""",
s AS (SELECT userId, min(eventTime) AS sessionStart, max(eventTime) + INTERVAL 30 MINUTE AS sessionEnd,
        list(pageUrl ORDER BY eventTime, pageUrl NULLS FIRST) AS path FROM ({rows}) GROUP BY batch, userId, sid)
SELECT userId, sessionStart, sessionEnd, {_path_text('path')} AS path_text FROM s
"""


def _after_each_batch(result: str) -> str:
    """All rows that have arrived after each of the four batches, late or not."""
    return _arrived("true") + """,
fb AS (SELECT batch, coalesce(nullif(userId, ''), '?') AS userId, "timestamp", coalesce(eventType, '') AS eventType,
  coalesce(pageUrl, '') AS pageUrl, coalesce(nullif(element, ''), 'body') AS element, coalesce(x, 0) AS x, coalesce(y, 0) AS y FROM ev),
fa AS (SELECT after_batch, fb.* FROM fb JOIN (SELECT unnest([0, 1, 2, 3]) AS after_batch) ON batch <= after_batch)""" + result


_DELTA_HEATMAP = """
SELECT after_batch, pageUrl, element, cast(trunc(x / 50) AS int) * 50 AS xBucket, cast(trunc(y / 50) AS int) * 50 AS yBucket,
  count(*) AS "count"
FROM fa WHERE eventType = 'click' GROUP BY ALL
"""
_DELTA_PATHS = """,
o AS (SELECT *, lag(pageUrl) OVER (PARTITION BY after_batch, userId ORDER BY "timestamp", pageUrl) AS pv FROM fa WHERE pageUrl <> ''),
p AS (SELECT after_batch, userId, list(pageUrl ORDER BY "timestamp", pageUrl) AS path
      FROM o WHERE pv IS NULL OR pv <> pageUrl GROUP BY ALL)
SELECT after_batch, userId, """

# a third of the rows belong to one user
HOT = WEB.replace("SELECT CASE WHEN k IS NULL OR k <> 98 THEN 'u' || user_id END AS userId",
                  "SELECT CASE WHEN event_id % 3 = 0 THEN 'u_hot' WHEN k IS NULL OR k <> 98 THEN 'u' || user_id END AS userId")

# positions in a topic of four partitions: a permutation of event_id inside blocks of a prime
_ARRIVAL_PATHS = WEB.replace("props AS meta\n  FROM raw)", "props AS meta, user_id % 4 AS part, event_id // 1000003 * 1000003 + event_id * 7919 % 1000003 AS pos\n"
                             "  FROM raw)").replace("coalesce(y, 0) AS y FROM ev)", "coalesce(y, 0) AS y, part, pos FROM ev)") + """,
o AS (SELECT *, lag(pageUrl) OVER (PARTITION BY userId ORDER BY part, pos) AS pv FROM fx WHERE pageUrl <> ''),
p AS (SELECT userId, list(pageUrl ORDER BY part, pos) AS path FROM o WHERE pv IS NULL OR pv <> pageUrl GROUP BY userId)
"""

# planted damage: a record cut off, one that is no object, one with bad fields
_DAMAGE = WEB.replace("props AS meta\n  FROM raw)", "props AS meta, event_id, user_id, CASE WHEN event_id % 41 = 1 THEN 'cut'"
                      " WHEN event_id % 43 = 2 THEN 'none' WHEN event_id % 47 = 3 THEN 'fields' END AS damage\n  FROM raw)")
_BAD = _DAMAGE + """,
bad AS (SELECT CASE damage WHEN 'cut' THEN '{"userId":"u' || user_id || '","timestamp":' WHEN 'none' THEN '"event ' || event_id || '"'
    ELSE '{"userId":"u' || user_id || '","timestamp":"t' || event_id || '","eventType":"view","x":"wide"}' END AS record,
  CASE WHEN damage = 'fields' THEN 'timestamp: not a bigint; x: not a int' ELSE 'not a JSON object' END AS reasons FROM web WHERE damage IS NOT NULL)
"""
_GOOD = _DAMAGE + """
SELECT CASE WHEN damage IS NULL THEN userId ELSE 'u' || user_id END AS userId, CASE WHEN damage IS NULL THEN "timestamp" END AS "timestamp",
  CASE WHEN damage IS NULL THEN eventType ELSE 'view' END AS eventType, """ + ", ".join(
    f"CASE WHEN damage IS NULL THEN {c} END AS {c}" for c in ("pageUrl", "referrer", "element", "x", "y", "screenWidth", "screenHeight", "meta")) + """
FROM web WHERE damage IS NULL OR damage = 'fields'
"""


def oracles() -> dict[str, str]:
    return {
        "event_time": _event_time(),
        "heatmap_10m": _heatmap_10m(),
        "errors_5m": _errors_5m(),
        "session_paths_30m": _session_paths(30),
        "session_paths_2m": _session_paths(2),
        "heatmap_total": WEB + _HEATMAP_TOTAL,
        "heatmap_top10": WEB + _HEATMAP_TOTAL
        + ' ORDER BY "count" DESC, pageUrl, element, xBucket, yBucket LIMIT 10',
        "error_totals": WEB + "SELECT pageUrl, count(*) AS \"count\" FROM fx WHERE eventType = 'error' GROUP BY 1",
        "user_paths": WEB + _USER_PATHS + f"SELECT userId, {_path_text('path')} AS path_text FROM p",
        "user_paths_preview": WEB + _USER_PATHS
        + "SELECT userId, array_to_string(path, ' -> ') AS path_text FROM p ORDER BY userId LIMIT 5",
        "jsonl_source": _events_only(),
        "kafka_codec": _events_only(),
        # Streaming, append: a window is emitted once end <= watermark, and the
        # watermark is max(eventTime) - 30 min over the rows that reach it (clicks
        # only for the heatmap: the filter sits below the watermark).
        "stream_heatmap_append": "SELECT * FROM (" + _heatmap_10m() + ") h WHERE window_end <= "
        "(SELECT max(make_timestamp(((1704067200000 + (epoch_us(ts) // 1000 - 1704067200000) // 30) // 1000)"
        " * 1000000)) FROM events WHERE event_type = 'click' AND event_id % 101 <> 7) - INTERVAL 30 MINUTE",
        "stream_paths_append": _session_paths(30, "WHERE sessionEnd <= (SELECT max(eventTime) FROM ev) - INTERVAL 30 MINUTE"),
        # The spread-state plan: its watermark is one gap behind the job's.
        "stream_session_cells": _session_paths(
            30, "WHERE sessionEnd <= (SELECT max(eventTime) FROM ev) - INTERVAL 60 MINUTE"),
        "stream_errors_update": _errors_5m(),
        "stream_session_late": _session_late(),
        "stream_errors_late": _errors_late(),
        "stream_errors_upsert_late": _errors_upsert_late(),
        "stream_session_window_late": _open_sessions_late(),
        "stream_open_sessions_late": _open_sessions_late(),
        "delta_heatmap_late": _after_each_batch(_DELTA_HEATMAP),
        "delta_paths_late": _after_each_batch(_DELTA_PATHS + f"{_path_text('path')} AS path_text FROM p"),
        "user_paths_hot": HOT + _USER_PATHS + f"SELECT userId, {_path_text('path')} AS path_text FROM p",
        "user_paths_arrival": _ARRIVAL_PATHS + f"SELECT userId, {_path_text('path')} AS path_text FROM p",
        "session_paths_hot": _session_paths(30).replace(WEB, HOT),
        "quarantine_good": _GOOD,
        "quarantine_bad": _BAD + "SELECT record, reasons FROM bad",
        "quarantine_counts": _BAD + "SELECT unnest(string_split(reasons, '; ')) AS reason, count(*) AS records FROM bad GROUP BY 1",
        "snapshot_paths": WEB + _USER_PATHS + f"SELECT userId, {_path_text('path')} AS path_text FROM p",
        "snapshot_heatmap": WEB + _HEATMAP_TOTAL,
        # Bounded-state paths: only minutes closed by the watermark, which moves with
        # the rows that keep a page (the page filter sits below the watermark).
        "stream_user_paths": WEB + """,
o AS (SELECT *, lag(pageUrl) OVER (PARTITION BY userId ORDER BY "timestamp", pageUrl) AS pv
      FROM fx WHERE pageUrl <> '' AND time_bucket(INTERVAL 1 MINUTE, eventTime, TIMESTAMP '1970-01-01')
        + INTERVAL 1 MINUTE <= (SELECT max(eventTime) FROM fx WHERE pageUrl <> '') - INTERVAL 30 MINUTE),
p AS (SELECT userId, list(pageUrl ORDER BY "timestamp", pageUrl) AS path
      FROM o WHERE pv IS NULL OR pv <> pageUrl GROUP BY userId)
""" + f"SELECT userId, {_path_text('path')} AS path_text FROM p",
    }
