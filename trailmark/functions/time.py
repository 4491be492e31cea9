"""Event-time derivation (epoch milliseconds -> TIMESTAMP in whole seconds)."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ARRIVAL_TIME, EVENT_TIME

# The instants 0001-01-01T00:00:00Z and 9999-12-31T23:59:59.999Z in epoch ms.
MIN_EVENT_MILLIS = -62135596800000
MAX_EVENT_MILLIS = 253402300799999


def event_time(millis: str = "timestamp", max_event_time: str | None = None, max_lead_minutes: float | None = None) -> Column:
    """``eventTime`` of an event, from the name of its epoch-ms column.

    Milliseconds are cut toward zero to whole seconds (-1500 ms -> -1 s), as the
    reference's ``from_unixtime(timestamp / 1000)`` does under UTC, but without the
    detour through a local-time string, so the result does not depend on the
    session time zone.  Values outside years 1..9999 give NULL instead of failing
    the query; ``max_event_time`` (ISO text, UTC unless it names a zone) optionally nulls
    anything later, so one absurd value cannot push a watermark past all real data.
    ``max_lead_minutes`` nulls what lies further ahead of the row's own ``arrivalTime`` (the source's
    metadata), a bound that moves with the stream.  ``rejected_event_times`` counts the rows that this turns into NULL.
    """
    ms = f"`{millis}`"
    ok = f"{ms} BETWEEN {MIN_EVENT_MILLIS} AND {MAX_EVENT_MILLIS}"
    ts = f"timestamp_seconds({ms} div 1000)"
    if max_event_time is not None:
        ok += f" AND {ms} div 1000 <= {_epoch_seconds(max_event_time)}"
    if max_lead_minutes is not None:
        ok += f" AND {ms} <= unix_millis({ARRIVAL_TIME}) + {int(60_000 * max_lead_minutes)}"
    return F.expr(f"CASE WHEN {ok} THEN {ts} END")


def _epoch_seconds(text: str) -> int:
    when = dt.datetime.fromisoformat(text)
    return math.floor((when if when.tzinfo else when.replace(tzinfo=dt.UTC)).timestamp())


def rejected_event_times(millis: str = "timestamp") -> Column:
    """Aggregate: rows whose time is given but gave no event time."""
    return F.count(F.when(F.col(millis).isNotNull() & F.col(EVENT_TIME).isNull(), 1)).alias("rejected")
