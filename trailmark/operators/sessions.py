"""Session paths (A2): per user and session, the ordered list of pages.

A session is a maximal run of one user's events in which consecutive event times
(whole seconds) are at most ``gap`` apart; it spans ``[first event, last event + gap)``.
The path holds every event's page (all event types, repeats and NULL pages kept),
ordered by (event second, page, NULL first).

Two plans give the same rows:

* ``"session_window"`` -- Spark's ``session_window``.  Required for streaming (it is
  the stateful merging-sessions operator) but in batch it sorts all events of one
  user in one task, so a user holding a third of the data is one task.
* ``"chunked"`` (batch default) -- a skew-safe composition.  Rows are first
  combined map-side to distinct (user, second, page) counts.  Time is cut into
  chunks one gap long; a chunk never contains a session break, so sessions are
  found on one row per (user, chunk) -- a window whose size per user is
  bounded by time span / gap, never by event count -- and joined back.  No step
  sorts a user's events in one task; only the final (user, session) aggregate
  holds a whole path, which is the result row itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import field_of
from ..schema import DEFAULT_SESSION_GAP_MINUTES, EVENT_TIME


def _gap_seconds(gap_minutes: float) -> int:
    if gap_minutes is None or gap_minutes <= 0:
        # The reference silently produces no session at all for a gap <= 0.
        raise ValueError(f"session gap must be positive, got {gap_minutes!r} minutes")
    gap_s = int(round(gap_minutes * 60))
    if gap_s < 1:  # event times are whole seconds
        raise ValueError(f"session gap must be at least one second, got {gap_minutes!r} minutes")
    return gap_s


def _gap_text(gap_minutes: float) -> str:
    return f"{_gap_seconds(gap_minutes)} seconds"


def session_paths(
    events: DataFrame,
    gap_minutes: float = DEFAULT_SESSION_GAP_MINUTES,
    strategy: str = "auto",
    order: str = "seconds",
) -> DataFrame:
    """A2 + O1 + P6 + P7: ``userId, sessionStart, sessionEnd, path array<string>``.

    ``order="millis"`` orders a path by the event's milliseconds, then page, instead of by its
    whole second, then page.
    """
    gap_s = _gap_seconds(gap_minutes)
    if order not in ("seconds", "millis"):
        raise ValueError(f"unknown path order {order!r} (expected seconds|millis)")
    if strategy == "auto":
        strategy = "session_window" if events.isStreaming else "chunked"
    if strategy == "session_window":
        return _with_session_window(events, gap_minutes, order)
    if strategy == "chunked":
        if events.isStreaming:
            raise ValueError("the chunked plan is batch-only; streaming uses session_window")
        return _chunked(events, gap_s, order)
    raise ValueError(f"unknown session strategy {strategy!r} (expected auto|chunked|session_window)")


def _with_session_window(events: DataFrame, gap_minutes: float, order: str) -> DataFrame:
    at = EVENT_TIME if order == "seconds" else "timestamp"
    pages = F.sort_array(F.collect_list(F.struct(F.col(at), F.col("pageUrl"))))
    return (
        events.groupBy("userId", F.session_window(EVENT_TIME, _gap_text(gap_minutes)).alias("session_window"))
        .agg(pages.alias("pages"))
        .select(
            "userId",
            F.col("session_window.start").alias("sessionStart"),
            F.col("session_window.end").alias("sessionEnd"),
            field_of("pages", "pageUrl").alias("path"),
        )
    )


# Step by step:
# 1. cells:  combine duplicates map-side, one row per (user, second, page).  A
#    burst of identical events costs one row from here on.  NULL userId is a key
#    of its own, carried as the non-NULL pair (uk, un) so joins and hash
#    partitioning line up; chunk is coalesced so no NULL filter is inferred.
# 2. chunked: one row per (user, chunk) with its cells; a chunk is one gap long, so its list
#    is bounded by the gap, not by the user.  Two seconds of one chunk are less than a
#    gap apart, so a chunk never holds a session break; a chunk continues the
#    session before it iff the previous chunk is the adjacent one and its last
#    second is <= gap away.  Both branches below read this very aggregate (first and last
#    second are taken from the list), so its scan and its shuffle run once and are
#    reused (ReusedExchange).
# 3. starts: session start of a chunk = first second of the latest chunk (up to
#    this one) that does not continue its predecessor.  Rows per user in this
#    window are bounded by the user's time span / gap, not by its event count.
# 4. every chunk gets its session start through a shuffled hash join on (user, chunk),
#    the partitioning that step 2 left: `starts` grows with the data, so it is never
#    broadcast, and a broadcast would also let the join inherit the per-user partitioning of the
#    window and skip the exchange below, putting a hot user's sessions in one task.
#    Then one row per session (exchange on user and session start), with
#    the path in (second, page NULL first) order and counts expanded again (only
#    sessions that had duplicates pay for the expansion).
_CELLS_SQL = """
SELECT uk, un, s, o, pageUrl, count(1) AS n
FROM (SELECT coalesce(userId, '') AS uk, userId IS NULL AS un, unix_seconds(eventTime) AS s, o, pageUrl
      FROM {events} WHERE eventTime IS NOT NULL)
GROUP BY uk, un, s, o, pageUrl
"""

_SESSIONS_SQL = """
WITH cells AS (SELECT uk, un, s, o, pageUrl, n, coalesce(floor(s / {gap}), 0) AS chunk FROM {cells}),
chunked AS (
  SELECT uk, un, chunk, sort_array(collect_list(struct(s, o, pageUrl, n))) AS cells FROM cells GROUP BY uk, un, chunk),
linked AS (
  SELECT uk, un, chunk, first_s,
    coalesce(lag(chunk) OVER w = chunk - 1 AND first_s - lag(last_s) OVER w <= {gap}, false) AS continues
  FROM (SELECT uk, un, chunk, cells[0].s AS first_s, element_at(cells, -1).s AS last_s FROM chunked)
  WINDOW w AS (PARTITION BY uk, un ORDER BY chunk)),
starts AS (
  SELECT uk, un, chunk, last(CASE WHEN NOT continues THEN first_s END, true) OVER (
    PARTITION BY uk, un ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS start_s
  FROM linked)
SELECT CASE WHEN NOT un THEN uk END AS userId,
  timestamp_seconds(start_s) AS sessionStart,
  timestamp_seconds(element_at(cells, -1).s + {gap}) AS sessionEnd,
  CASE WHEN NOT exists(cells, x -> x.n > 1) THEN transform(cells, x -> x.pageUrl)
       ELSE flatten(transform(cells, x -> array_repeat(x.pageUrl, cast(x.n AS int)))) END AS path
FROM (
  SELECT /*+ SHUFFLE_HASH(starts) */ uk, un, start_s, flatten(transform(
    sort_array(collect_list(struct(chunk, cells))), x -> x.cells)) AS cells
  FROM chunked JOIN starts USING (uk, un, chunk)
  GROUP BY uk, un, start_s)
"""


def session_cells(events: DataFrame, order: str = "seconds") -> DataFrame:
    """Step 1 (batch): ``uk, un, s, o, pageUrl, n`` -- distinct (user, second, page) counts.

    ``o`` orders pages inside a second: 0, or the event's milliseconds.
    """
    inside = F.lit(0).cast("long") if order == "seconds" else F.col("timestamp")
    cols = events.select("userId", EVENT_TIME, "pageUrl", inside.alias("o"))
    return events.sparkSession.sql(_CELLS_SQL, events=cols)


def sessions_from_cells(cells: DataFrame, gap_minutes: float = DEFAULT_SESSION_GAP_MINUTES) -> DataFrame:
    """Steps 2-4 on (user, second, page) counts: ``userId, sessionStart, sessionEnd, path``.

    ``cells`` may come from ``session_cells`` or from the streaming cell table
    (``streaming.sessions``); it needs ``uk, un, s, pageUrl, n``; the
    chunks follow from the gap given here, not from the one a writer used.
    """
    if "o" not in cells.columns:
        cells = cells.withColumn("o", F.lit(0).cast("long"))
    return cells.sparkSession.sql(_SESSIONS_SQL, cells=cells, gap=_gap_seconds(gap_minutes))


def _chunked(events: DataFrame, gap_s: int, order: str) -> DataFrame:
    gap_minutes = gap_s / 60
    return sessions_from_cells(session_cells(events, order), gap_minutes)
