"""Error counts: windowed per page (A3), all-time per page (A5), ordering (O3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ERROR_WINDOW, EVENT_TIME
from .events import fill_event_defaults, only_errors


def error_counts(events: DataFrame, window: str = ERROR_WINDOW) -> DataFrame:
    """A3: ``window struct<start,end>, pageUrl, count`` over error events."""
    return only_errors(events).groupBy(F.window(EVENT_TIME, window).alias("window"), "pageUrl").count()


def error_totals(events: DataFrame) -> DataFrame:
    """A5: all-time errors per page, after the missing-field defaults.

    Filtered before the defaults (the default type '' is never 'error'), so the
    filter is pushed into the scan.
    """
    return fill_event_defaults(only_errors(events)).groupBy("pageUrl").count()


def errors_by_count(totals: DataFrame) -> DataFrame:
    """O3: most errors first, page as tie-break."""
    return totals.orderBy(F.desc("count"), F.asc_nulls_first("pageUrl"))
