"""A table as a stream of messages, and event-time work on streams."""

from facetable.streaming.changes import fixed_start, read_changes, read_file_changes
from facetable.streaming.events import from_events, run_for, to_events, write_events
from facetable.streaming.windows import (
    first_seen,
    interval_join,
    late_rows,
    session_totals,
    window_totals,
)

__all__ = [
    "first_seen",
    "fixed_start",
    "from_events",
    "interval_join",
    "late_rows",
    "read_changes",
    "read_file_changes",
    "run_for",
    "session_totals",
    "to_events",
    "window_totals",
    "write_events",
]
