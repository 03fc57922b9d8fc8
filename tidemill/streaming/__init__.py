from .ingest import (
    drain_merge,
    drain_to_files,
    drain_updates,
    latest_updates,
    stream_aggregate,
    stream_deduplicate,
    stream_files,
    with_event_time,
)

__all__ = [
    "drain_merge",
    "drain_to_files",
    "drain_updates",
    "latest_updates",
    "stream_aggregate",
    "stream_deduplicate",
    "stream_files",
    "with_event_time",
]
