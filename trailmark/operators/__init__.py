"""Plain ``DataFrame -> DataFrame`` operators; no action inside, batch or streaming."""

from .errors import error_counts, error_totals, errors_by_count
from .events import (
    fill_event_defaults,
    only_clicks,
    only_errors,
    prepare_events,
    project_events,
    watermark_delay,
    with_event_time,
    with_event_watermark,
)
from .heatmap import click_heatmap, click_heatmap_total, top_heatmap
from .sessions import session_paths
from .user_paths import (
    arrival_fragments,
    assemble_user_paths,
    preview_user_paths,
    preview_user_paths_of,
    user_path_chunks,
    user_path_fragments,
    user_paths,
)

__all__ = [
    "arrival_fragments",
    "assemble_user_paths",
    "click_heatmap",
    "click_heatmap_total",
    "error_counts",
    "error_totals",
    "errors_by_count",
    "fill_event_defaults",
    "only_clicks",
    "only_errors",
    "prepare_events",
    "preview_user_paths",
    "preview_user_paths_of",
    "project_events",
    "session_paths",
    "top_heatmap",
    "user_path_fragments",
    "user_path_chunks",
    "user_paths",
    "watermark_delay",
    "with_event_time",
    "with_event_watermark",
]
