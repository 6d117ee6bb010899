"""Sources: topics (Kafka or files), driver tables, config table, inline rows."""

from shoplake.sources.adapters import (
    change_lines,
    log_lines,
    order_detail_lines,
    order_info_lines,
)
from shoplake.sources.config_source import (
    changelog_config_loader,
    config_frame,
    config_latest,
    keep_additions,
    read_config,
)
from shoplake.sources.inline import INLINE_PAGE_LINES, inline_topic
from shoplake.sources.tables import read_table, read_tables
from shoplake.sources.topics import read_topic, read_topics

__all__ = [
    "change_lines", "log_lines", "order_detail_lines", "order_info_lines",
    "changelog_config_loader", "config_frame", "config_latest", "keep_additions", "read_config",
    "INLINE_PAGE_LINES", "inline_topic", "read_table", "read_tables",
    "read_topic", "read_topics",
]
