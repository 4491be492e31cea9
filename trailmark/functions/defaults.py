"""Defaults for missing fields, used by the all-time (non-windowed) results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (
    MISSING_COORDINATE,
    MISSING_ELEMENT,
    MISSING_EVENT_TYPE,
    MISSING_PAGE,
    MISSING_USER,
)


def or_default(c: str, default) -> Column:
    """NULL or empty string counts as missing and becomes ``default``."""
    v = F.col(c)
    if isinstance(default, str):
        return F.coalesce(F.nullif(v, F.lit("")), F.lit(default))
    return F.coalesce(v, F.lit(default))


DEFAULTS = {
    "userId": MISSING_USER,
    "eventType": MISSING_EVENT_TYPE,
    "pageUrl": MISSING_PAGE,
    "element": MISSING_ELEMENT,
    "x": MISSING_COORDINATE,
    "y": MISSING_COORDINATE,
}
