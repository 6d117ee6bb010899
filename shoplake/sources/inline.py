"""Inline page rows, the original's hand-written bounce fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: the five inline page rows of the bounce demo -------------
INLINE_PAGE_LINES = [
    '{"common":{"mid":"101"},"page":{"page_id":"home"},"ts":10000}',
    '{"common":{"mid":"101"},"page":{"page_id":"home"},"ts":11000}',
    '{"common":{"mid":"102"},"page":{"page_id":"home"},"ts":12000}',
    '{"common":{"mid":"102"},"page":{"page_id":"good_list","last_page_id":"home"},"ts":14000}',
    '{"common":{"mid":"102"},"page":{"page_id":"good_list","last_page_id":"detail"},"ts":50000}',
]


def inline_topic(spark: SparkSession, lines: list[str] | None = None) -> DataFrame:
    """Text rows as a raw topic ``(value, seq)``; seq is the list position."""
    lines = INLINE_PAGE_LINES if lines is None else lines
    return spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, seq bigint")
