"""Sinks: topics (Kafka or folders), dimension changelog, raw landing, console."""

from shoplake.sinks.dims import append_changelog, compact, current_table, ensure_tables, newest_snapshot, read_current, read_dims
from shoplake.sinks.landing import write_landing
from shoplake.sinks.topics import (
    start_console,
    start_topic_stream,
    write_dynamic_topics,
    write_topic,
)

__all__ = [
    "append_changelog", "compact", "current_table", "ensure_tables", "newest_snapshot", "read_current", "read_dims",
    "write_landing", "start_console", "start_topic_stream", "write_dynamic_topics", "write_topic",
]
