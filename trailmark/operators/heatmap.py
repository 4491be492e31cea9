"""Click heatmaps: windowed (A1), all-time (A4) and top cells (O2).

Counts are combined map-side (partial aggregate) before the shuffle, so a hot
page or cell costs one row per map task, not one row per click.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import bucket
from ..schema import BUCKET_SIZE, EVENT_TIME, HEATMAP_KEYS, HEATMAP_WINDOW, TOP_HEATMAP_CELLS
from .events import fill_event_defaults, only_clicks


def _bucketed(clicks: DataFrame, size: int) -> DataFrame:
    return clicks.withColumns({"xBucket": bucket("x", size), "yBucket": bucket("y", size)})


def click_heatmap(events: DataFrame, window: str = HEATMAP_WINDOW, bucket_size: int = BUCKET_SIZE) -> DataFrame:
    """A1: clicks per (tumbling window, page, element, x bucket, y bucket).

    Output: ``window struct<start,end>, pageUrl, element, xBucket, yBucket, count``.
    NULL keys form their own groups; NULL event time drops the row (``window``).
    """
    return (
        _bucketed(only_clicks(events), bucket_size)
        .groupBy(F.window(EVENT_TIME, window).alias("window"), *HEATMAP_KEYS)
        .count()
    )


def click_heatmap_total(events: DataFrame, bucket_size: int = BUCKET_SIZE) -> DataFrame:
    """A4: all-time click counts per cell, after the missing-field defaults.

    The click filter runs first (the default type '' is never 'click'), so it
    reaches the scan as a pushed filter.
    """
    return _bucketed(fill_event_defaults(only_clicks(events)), bucket_size).groupBy(*HEATMAP_KEYS).count()


def top_heatmap(heat: DataFrame, k: int = TOP_HEATMAP_CELLS) -> DataFrame:
    """O2: the ``k`` busiest cells; ties broken on the cell key.

    ``orderBy + limit`` plans as TakeOrderedAndProject: a per-partition top-k and
    one small merge, never a full sort.
    """
    keys = [c for c in heat.columns if c != "count"]
    return heat.orderBy(F.desc("count"), *[F.asc_nulls_first(c) for c in keys]).limit(k)
