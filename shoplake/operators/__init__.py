"""Batch operators of the warehouse layers (DataFrame in, DataFrame out)."""

from shoplake.operators.bounce import REENTRY, STRICT, bounces, next_within
from shoplake.operators.cdc import (
    clean_changes,
    dim_rows,
    route_changes,
    split_routes,
    strip_bootstrap,
    topic_records,
    topic_rows,
)
from shoplake.operators.landing import landing_day_of_arrival, landing_day_of_event, with_landing_day
from shoplake.operators.latest import earliest_per_key, flag_first_per_key, latest_per_key
from shoplake.operators.log_split import (
    detail_json,
    display_rows,
    log_keys,
    malformed_log_rows,
    page_keys,
    page_rows,
    parse_log_topic,
    split_log,
    start_rows,
)
from shoplake.operators.order_wide import (
    add_dim,
    enrich_dims,
    interval_join,
    parse_order_detail,
    parse_order_info,
    province_dim,
    with_event_time,
)
from shoplake.operators.upsert import current_rows, table_schemas, upsert_rows
from shoplake.operators.visitors import repair_new_visitor, unique_visitors

__all__ = [
    "REENTRY", "STRICT", "bounces", "next_within",
    "clean_changes", "dim_rows", "route_changes", "split_routes", "strip_bootstrap",
    "topic_records", "topic_rows",
    "landing_day_of_arrival", "landing_day_of_event", "with_landing_day",
    "earliest_per_key", "flag_first_per_key", "latest_per_key",
    "detail_json", "display_rows", "log_keys", "malformed_log_rows", "page_keys", "page_rows",
    "parse_log_topic", "split_log", "start_rows",
    "add_dim", "enrich_dims", "interval_join", "parse_order_detail", "parse_order_info",
    "province_dim", "with_event_time",
    "current_rows", "table_schemas", "upsert_rows",
    "repair_new_visitor", "unique_visitors",
]
