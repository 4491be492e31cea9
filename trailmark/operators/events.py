"""Event preparation: event time, fixed projection, watermark, filters, defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.defaults import DEFAULTS, or_default
from ..functions.time import event_time
from ..schema import ARRIVAL_OFFSET, ARRIVAL_PARTITION, CLICK, DEFAULT_SESSION_GAP_MINUTES, ERROR, EVENT_COLUMNS, EVENT_TIME


def with_event_time(df: DataFrame, max_event_time: str | None = None, max_lead_minutes: float | None = None) -> DataFrame:
    """Add ``eventTime`` (whole seconds) from epoch-ms ``timestamp``.

    ``max_lead_minutes`` (needs ``arrivalTime``, see ``read_events(with_arrival=True)``) gives no event time to rows
    further ahead of their arrival, so no clock that is wrong moves a watermark.
    """
    return df.withColumn(EVENT_TIME, event_time("timestamp", max_event_time, max_lead_minutes))


def project_events(df: DataFrame) -> DataFrame:
    """The 11 event fields plus ``eventTime``, in fixed order; then the source position, where it was read."""
    position = [c for c in (ARRIVAL_PARTITION, ARRIVAL_OFFSET) if c in df.columns]
    return df.select(*EVENT_COLUMNS, EVENT_TIME, *position)


def prepare_events(raw: DataFrame, max_event_time: str | None = None, max_lead_minutes: float | None = None) -> DataFrame:
    """P1 + P2 on raw events (batch or streaming)."""
    return project_events(with_event_time(raw, max_event_time, max_lead_minutes))


def watermark_delay(session_timeout_minutes: int = DEFAULT_SESSION_GAP_MINUTES) -> str:
    """The delay is ``max(1, timeout)`` minutes, shared by all queries."""
    return f"{max(1, int(session_timeout_minutes))} minutes"


def with_event_watermark(events: DataFrame, session_timeout_minutes: int = DEFAULT_SESSION_GAP_MINUTES) -> DataFrame:
    """Event-time watermark on ``eventTime``."""
    return events.withWatermark(EVENT_TIME, watermark_delay(session_timeout_minutes))


def only_clicks(events: DataFrame) -> DataFrame:
    """Exact, case-sensitive ``eventType = 'click'`` (NULL excluded)."""
    return events.filter(F.col("eventType") == F.lit(CLICK))


def only_errors(events: DataFrame) -> DataFrame:
    """``eventType = 'error'``."""
    return events.filter(F.col("eventType") == F.lit(ERROR))


def fill_event_defaults(df: DataFrame) -> DataFrame:
    """NULL or empty fields get the all-time defaults (user '?', element 'body', ...)."""
    present = [c for c in DEFAULTS if c in df.columns]
    return df.withColumns({c: or_default(c, DEFAULTS[c]) for c in present})
