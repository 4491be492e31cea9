"""Pixel-grid bucketing of click coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import BUCKET_SIZE


def bucket(c: str | Column, size: int = BUCKET_SIZE) -> Column:
    """``cast(c / size as int) * size``: truncation toward zero, so -49..49 -> 0.

    NULL stays NULL.  ``floor`` would be wrong here (-1 -> -50).
    """
    c = F.col(c) if isinstance(c, str) else c
    return (c / F.lit(size)).cast("int") * F.lit(size)
