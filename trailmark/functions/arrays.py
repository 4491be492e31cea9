"""Array helpers for page paths (JVM-side higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import PATH_SEPARATOR


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field_of(arr: str | Column, name: str) -> Column:
    """Project one field out of an array of structs: ``transform(a, s -> s.name)``."""
    return F.transform(_col(arr), lambda s: s[name])


def render_path(arr: str | Column, sep: str = PATH_SEPARATOR, null_text: str | None = None) -> Column:
    """``a -> b -> c``; NULL elements are skipped unless ``null_text`` is given."""
    if null_text is None:
        return F.array_join(_col(arr), sep)
    return F.array_join(_col(arr), sep, null_text)
