"""Column-level building blocks (pure ``pyspark.sql.functions`` expressions)."""

from .arrays import field_of, render_path
from .buckets import bucket
from .defaults import DEFAULTS, or_default
from .time import event_time

__all__ = ["DEFAULTS", "bucket", "event_time", "field_of", "or_default", "render_path"]
