"""All-time page path per user (A6) and its preview.

After the missing-field defaults (P8) and without empty pages (P9), a user's path
is the sequence of pages ordered by (``timestamp`` ms, page), with consecutive
repeats collapsed (P10).  No session and no time limit.  With ``order="arrival"`` the sequence is that of
the records in their topic instead: by (``arrivalPartition``, ``arrivalOffset``).  Records keyed by user lie in one
partition, so this is the order in which they were published; a user spread over partitions has them one
after the other.  A record that is read twice counts once.  Rows without a position come last.

Plan (batch and streaming share step 1):

1. ``user_path_fragments`` -- one row per (user, time chunk) holding the distinct
   (timestamp, page) pairs of that chunk (``collect_set``: duplicates are combined
   map-side).  A user that holds a third of all rows is spread over its chunks.
   ``arrival_fragments`` does the same with ranges of offsets; its ``lane`` is the partition.
2. ``user_path_chunks`` -- sort and de-duplicate inside each fragment, and once more at
   the borders, against the last page of the user's fragment before it.  Collapsing
   consecutive repeats composes, so this equals a global ordered scan.  The borders come from a
   scan in two levels (ranges of chunks, then one row per range), so no task orders a user's pages.
3. ``assemble_user_paths`` -- the pieces of a user as one array (a wrapper: only the
   collapsed result of each user is held in one task).

In streaming, step 1 is the stateful aggregate (``complete`` mode) and step 2 runs
per micro-batch in ``foreachBatch`` (see ``streaming.snapshots``); the
bounded-state variant keys step 1 by event-time minute, appends fragments once the
watermark closes them, and runs step 2 on that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import render_path
from ..schema import ARRIVAL_OFFSET, ARRIVAL_PARTITION, MISSING_USER, PREVIEW_USERS

DEFAULT_CHUNK_MS = 60_000
#: Offsets of a chunk under ``order="arrival"``: the most cells a fragment can hold.
CHUNK_OFFSETS = 16_384
ORDERS = ("time", "arrival")
#: The lane after all partitions, of rows without a position.
NO_PARTITION = 2**31 - 1
#: Chunks of a range: what one group of the ordered scan holds at most (a day of minutes).
RANGE_CHUNKS = 1_440


# Step 1: distinct (timestamp, page) pairs per (user, chunk), after the defaults
# (user '?', page '') and without empty pages.
_FRAGMENTS_SQL = """
SELECT userId, floor(timestamp / {chunk_ms}) AS chunk, collect_set(struct(timestamp, pageUrl)) AS cells
FROM (SELECT coalesce(nullif(userId, ''), '?') AS userId, timestamp, pageUrl FROM {events}
      WHERE coalesce(pageUrl, '') <> '')
GROUP BY 1, 2
"""

# The same by position: rows without one share a lane (and a chunk) of their own after the others.
_ARRIVAL_SQL = """
SELECT userId, lane, CASE WHEN lane = {no_partition} THEN 0 ELSE floor(position / {chunk_offsets}) END AS chunk,
  collect_set(struct(position, pageUrl)) AS cells
FROM (SELECT coalesce(nullif(userId, ''), '?') AS userId, pageUrl, arrivalOffset AS position,
        CASE WHEN arrivalOffset IS NULL THEN {no_partition} ELSE coalesce(arrivalPartition, {no_partition}) END AS lane
      FROM {events} WHERE coalesce(pageUrl, '') <> '')
GROUP BY 1, 2, 3
"""

# Step 2: a fragment is known by (user, lane, chunk), in this order.  By time, lane 0 holds the chunks
# and lane 1 the events without time, which go last; inside a fragment timestamps are all NULL or
# all set, so a plain struct sort gives (timestamp, page) order.  By arrival, a lane is a partition.
# Repeats are collapsed in each fragment, and a fragment loses its
# first page where the fragment before it ended on the same.
#
# Which fragments lose it is found on thin rows (first and last page) by a scan in two levels:
# inside ranges of chunks, and over one row per range (the page it ends on) per user.  The
# pages themselves are in no window; the fragments to shorten go back to them by a join on the
# key they are spread by.  `get` returns NULL for index -1; pages are never NULL here.
_CHUNKS_SQL = """
WITH sorted AS (
  SELECT userId, lane, chunk, transform(sort_array(cells), c -> c.pageUrl) AS pages FROM {fragments}),
frags AS (
  SELECT userId, lane, chunk,
    filter(pages, (p, i) -> i = 0 OR NOT p <=> get(pages, i - 1)) AS pages
  FROM sorted),
ends AS (
  SELECT userId, lane, chunk, floor(chunk / {range_chunks}) AS part, pages[0] AS first_page, element_at(pages, -1) AS last_page
  FROM frags),
inside AS (
  SELECT userId, lane, part, chunk, first_page,
    lag(last_page) OVER (PARTITION BY userId, lane, part ORDER BY chunk) AS before
  FROM ends),
parts AS (SELECT userId, lane, part, max_by(last_page, chunk) AS last_page FROM ends GROUP BY userId, lane, part),
entered AS (
  SELECT userId, lane, part, lag(last_page) OVER (PARTITION BY userId ORDER BY lane, part) AS before FROM parts),
shorter AS (
  SELECT /*+ SHUFFLE_HASH(e) */ i.userId, i.lane, i.chunk FROM inside i JOIN entered e USING (userId, lane, part)
  WHERE i.first_page = coalesce(i.before, e.before))
SELECT /*+ SHUFFLE_HASH(s) */ f.userId, f.lane, f.chunk,
  CASE WHEN s.chunk IS NULL THEN f.pages ELSE slice(f.pages, 2, size(f.pages)) END AS pages
FROM frags f LEFT JOIN shorter s ON f.userId = s.userId AND f.lane = s.lane AND f.chunk = s.chunk
"""

# Step 3 in two levels as well: pieces are sorted inside their range, then one array per range.
_ASSEMBLE_SQL = """
SELECT userId, flatten(transform(sort_array(collect_list(struct(lane, part, pages))), f -> f.pages)) AS path
FROM (
  SELECT userId, lane, floor(chunk / {range_chunks}) AS part,
    flatten(transform(sort_array(collect_list(struct(chunk, pages))), f -> f.pages)) AS pages
  FROM {chunks} GROUP BY 1, 2, 3)
GROUP BY userId
"""


def user_path_fragments(events: DataFrame, chunk_ms: int = DEFAULT_CHUNK_MS) -> DataFrame:
    """Step 1: ``userId, chunk, cells array<struct<timestamp,pageUrl>>`` (unsorted set)."""
    cols = events.select("userId", "timestamp", "pageUrl")
    return events.sparkSession.sql(_FRAGMENTS_SQL, events=cols, chunk_ms=int(chunk_ms))


def arrival_fragments(events: DataFrame, chunk_offsets: int = CHUNK_OFFSETS) -> DataFrame:
    """Step 1 by position: ``userId, lane, chunk, cells array<struct<position,pageUrl>>`` (unsorted set).

    Duplicates of a record share its position and count once.  Rows without a position are one fragment per user.
    """
    missing = [c for c in (ARRIVAL_PARTITION, ARRIVAL_OFFSET) if c not in events.columns]
    if missing:
        raise ValueError(f"the order of arrival needs {', '.join(missing)}: read the events with_position")
    cols = events.select("userId", "pageUrl", ARRIVAL_PARTITION, ARRIVAL_OFFSET)
    return events.sparkSession.sql(_ARRIVAL_SQL, events=cols, chunk_offsets=int(chunk_offsets), no_partition=NO_PARTITION)


def _pieces(fragments: DataFrame, range_chunks: int) -> DataFrame:
    """``userId, lane, chunk, pages`` of the fragments of either order."""
    if "lane" not in fragments.columns:
        fragments = fragments.selectExpr("userId", "cast(chunk IS NULL AS int) AS lane", "coalesce(chunk, 0) AS chunk", "cells")
    return fragments.sparkSession.sql(_CHUNKS_SQL, fragments=fragments, range_chunks=int(range_chunks))


def user_path_chunks(fragments: DataFrame, range_chunks: int = RANGE_CHUNKS) -> DataFrame:
    """Step 2: ``userId, no_time, chunk, pages`` -- a path in pieces, one row per (user, chunk).

    The pieces of a user in order (timed chunks first) are its path.  No window holds pages: the
    one inside a range holds two pages a chunk, the one per user one row per range.  Fragments by arrival give
    ``userId, lane, chunk, pages``, in the order of lane and chunk.
    """
    pieces = _pieces(fragments, range_chunks)
    if "lane" in fragments.columns:
        return pieces
    return pieces.selectExpr("userId", "lane = 1 AS no_time", "CASE WHEN lane = 0 THEN chunk END AS chunk", "pages")


def assemble_user_paths(fragments: DataFrame, range_chunks: int = RANGE_CHUNKS) -> DataFrame:
    """Step 3: ``userId, path array<string>``: one row, and so one task, per user.

    For users whose whole path fits a row; ``user_path_chunks`` has no such limit.
    """
    return fragments.sparkSession.sql(_ASSEMBLE_SQL, chunks=_pieces(fragments, range_chunks), range_chunks=int(range_chunks))


def user_paths(events: DataFrame, chunk_ms: int = DEFAULT_CHUNK_MS, order: str = "time", chunk_offsets: int = CHUNK_OFFSETS) -> DataFrame:
    """A6 (batch): ``userId, path``; users with at least one page.  ``order`` is ``time`` or ``arrival``."""
    if order not in ORDERS:
        raise ValueError(f"order must be one of {', '.join(ORDERS)}, got {order!r}")
    fragments = arrival_fragments(events, chunk_offsets) if order == "arrival" else user_path_fragments(events, chunk_ms)
    return assemble_user_paths(fragments)


def preview_user_paths_of(events: DataFrame, n: int = PREVIEW_USERS, chunk_ms: int = DEFAULT_CHUNK_MS) -> DataFrame:
    """O4 + O5 from events: the first ``n`` users by id that have a page; only their paths are built.

    The ids come first (a distinct and a top-``n``); the ``n`` chosen ids -- a size bounded by ``n`` --
    are broadcast back to filter the events below the path aggregates.
    """
    user = F.coalesce(F.nullif(F.col("userId"), F.lit("")), F.lit(MISSING_USER))
    visits = events.filter(F.coalesce(F.col("pageUrl"), F.lit("")) != "")
    first = visits.select(user.alias("chosen")).distinct().orderBy("chosen").limit(n)
    chosen = visits.join(F.broadcast(first), user == F.col("chosen"), "left_semi")
    paths = user_paths(chosen, chunk_ms)
    return paths.select("userId", render_path("path").alias("path_text")).orderBy("userId")


def preview_user_paths(paths: DataFrame, n: int = PREVIEW_USERS) -> DataFrame:
    """O4 + O5: the first ``n`` users by id with the path rendered ``a -> b -> c``.

    The top-``n`` runs on the ids alone, so only ``n`` ids per partition reach the
    final merge (not ``n`` whole paths per partition); the ``n`` chosen ids -- a
    size bounded by ``n`` -- are broadcast back to pick their paths.
    """
    first = paths.select("userId").orderBy(F.asc_nulls_first("userId")).limit(n)
    chosen = paths.join(F.broadcast(first), on="userId", how="left_semi")
    return chosen.select("userId", render_path("path").alias("path_text")).orderBy(F.asc_nulls_first("userId"))
