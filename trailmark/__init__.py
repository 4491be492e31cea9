"""trailmark: web-event journey analytics on Spark (heatmaps, session paths, errors)."""

from .schema import EVENT_COLUMNS, EVENT_SCHEMA

__all__ = ["EVENT_COLUMNS", "EVENT_SCHEMA"]
