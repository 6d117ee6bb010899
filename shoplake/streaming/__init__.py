"""Structured Streaming forms of the warehouse jobs and their stateful processors."""

from shoplake.streaming.jobs import (
    LateRows,
    await_job,
    bounce_parts_stream,
    bounce_stream,
    compact_dims,
    order_wide_stream,
    read_dim_current,
    repaired_log_stream,
    repaired_parts_stream,
    malformed_rows,
    start_bounce,
    start_db_detail,
    start_job,
    start_landing,
    start_landing_and_publish,
    start_log_detail,
    start_quarantine,
    start_to_parquet,
    start_unique_visitor,
    unique_visitor_stream,
)
from shoplake.streaming.processors import (
    BounceBuckets,
    BouncePairs,
    ClosedWindow,
    ClosedWindowFrames,
    FirstOfDevice,
    UniqueVisitor,
)

__all__ = [
    "LateRows", "await_job", "bounce_parts_stream", "bounce_stream", "malformed_rows", "start_bounce", "start_landing_and_publish", "start_quarantine",
    "start_unique_visitor", "compact_dims", "start_job", "order_wide_stream", "read_dim_current",
    "repaired_log_stream", "repaired_parts_stream", "start_db_detail", "start_landing", "start_log_detail",
    "start_to_parquet", "unique_visitor_stream",
    "BounceBuckets", "BouncePairs", "ClosedWindow", "ClosedWindowFrames", "FirstOfDevice", "UniqueVisitor",
]
