"""Registered queries: each reads the driver tables at ``sf_dir``, runs one
warehouse job in batch form and returns typed columns.

Every query derives its input from the tables through the adapters in
``shoplake.sources.adapters`` (projections that produce the raw topic text),
then runs the same operators a streaming job runs. Results are typed columns,
not JSON text, so they compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.functions.maps import double_of, long_of, text_of
from shoplake.operators import bounce as bnc
from shoplake.operators import cdc, log_split, order_wide, upsert, visitors
from shoplake.operators.landing import landing_day_of_event
from shoplake.plans.dimensions import STORED_OUTPUT, direct_dims, stored_dims
from shoplake.plans.routing import routing_config
from shoplake.session import scratch_dir
from shoplake.sinks.landing import write_landing
from shoplake.sources import adapters
from shoplake.sources.tables import read_table

# --- fixed values of the re-aimed queries (scaled for the test data) --------
BOUNCE_GAP_TEST_MS = 6 * 3600 * 1000      # events have no same-device gap under 5 s
ORDER_JOIN_TEST_MS = 30 * 86400 * 1000    # ship dates lie weeks from order dates


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def repaired_log(spark: SparkSession, sf_dir: str, fields: tuple[str, ...], kind: str | None = None) -> DataFrame:
    """ods_log -> parsed -> new-visitor flag repaired (the log job's first half); ``kind`` keeps only records it can use."""
    raw = adapters.log_lines(_events(spark, sf_dir))
    log = log_split.keyed_records(raw, fields)
    log = log_split.of_kind(log, kind) if kind else log
    return visitors.repair_new_visitor(log, log_split.log_keys(raw), typed=log_split.typed_records)


START_FIELDS = ("common", "start", "ts")
PAGE_FIELDS = ("common", "start", "page", "ts")


def _kind(v, path: str):
    """JSON type at ``path`` of a published record; null when it is absent or null."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, path, "variant")), "^[A-Z]+", 0)


def published_log(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The published text of one detail topic, read back: known and unknown fields with their JSON types."""
    raw = adapters.log_lines(_events(spark, sf_dir), rich=True)
    log = visitors.repair_new_visitor(log_split.parse_log_topic(raw), log_split.log_keys(raw))
    text = log_split.detail_json(log_split.split_log(log)[kind], kind)
    at = "$" if kind == log_split.DISPLAY else "$.common"
    v = F.parse_json("value")
    rows = text.select(
        "seq",
        F.try_variant_get(v, f"{at}.is_new", "string").alias("is_new"),
        F.try_variant_get(v, f"{at}.geo.lat", "double").alias("lat"),
        *[_kind(v, f"{at}.{f}").alias(f"{f}_kind") for f in ("mid", "vc", "geo")],
        F.contains("value", F.lit('null')).alias("has_null"),
        *[_kind(v, p).alias(n) for n, p in PUBLISHED_KINDS[kind].items()],
    )
    return rows


PUBLISHED_KINDS = {
    log_split.START: {"ts_kind": "$.ts", "start_kind": "$.start", "time_kind": "$.start.loading_time", "err_kind": "$.err", "code_kind": "$.err.code", "msg_kind": "$.err.msg", "actions_kind": "$.actions"},
    log_split.PAGE: {"ts_kind": "$.ts", "during_kind": "$.page.during_time", "order_kind": "$.displays[0].order", "item_kind": "$.displays[0].item", "err_kind": "$.err", "code_kind": "$.err.code", "msg_kind": "$.err.msg", "actions_kind": "$.actions"},
    log_split.DISPLAY: {"ts_kind": "$.ts", "during_kind": "$.during_time", "order_kind": "$.order", "item_kind": "$.item"},
}


def q_published_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published_log(spark, sf_dir, log_split.START)


def q_published_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published_log(spark, sf_dir, log_split.PAGE)


def q_published_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published_log(spark, sf_dir, log_split.DISPLAY)


def q_published_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed change records as published, read back with their JSON types."""
    text = cdc.topic_records(cdc.topic_rows(routed_changes(spark, sf_dir)))
    v = F.parse_json("value")
    return text.select(
        "topic", "seq",
        F.try_variant_get(v, "$.event_id", "bigint").alias("event_id"),
        F.try_variant_get(v, "$.value", "double").alias("value"),
        *[(_kind(v, f"$.{f}") != "STRING").alias(f"{f}_is_number") for f in ("event_id", "user_id", "value")],
    )


def _common_cols() -> list:
    return [
        F.col("seq"),
        F.col("mid"),
        text_of("common", "is_new").alias("is_new"),
    ]


def q_log_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = log_split.start_rows(repaired_log(spark, sf_dir, START_FIELDS, log_split.START))
    return s.select(
        *_common_cols(),
        F.try_variant_get("start", "$.entry", "string").alias("start_entry"),
        F.try_variant_get("start", "$.loading_time", "bigint").alias("loading_time"),
        F.col("ts"),
    )


def q_log_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = log_split.page_rows(repaired_log(spark, sf_dir, (*PAGE_FIELDS, "displays"), log_split.PAGE))
    return p.select(
        *_common_cols(),
        text_of("page", "page_id").alias("page_id"),
        text_of("page", "last_page_id").alias("last_page_id"),
        long_of("page", "during_time").alias("during_time"),
        F.when(F.col("displays").isNull(), F.lit(0)).otherwise(F.size("displays")).alias("n_displays"),
        F.col("ts"),
    )


def q_log_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = log_split.display_rows(repaired_log(spark, sf_dir, (*PAGE_FIELDS, "displays"), log_split.DISPLAY))
    m = F.col("display")
    return d.select(
        F.col("seq"),
        F.col("pos").alias("display_pos"),
        text_of(m, "mid").alias("mid"),
        text_of(m, "is_new").alias("is_new"),
        text_of(m, "page_id").alias("page_id"),
        text_of(m, "last_page_id").alias("last_page_id"),
        text_of(m, "display_type").alias("display_type"),
        text_of(m, "item").alias("item"),
        long_of(m, "order").cast("int").alias("display_order"),
        long_of(m, "during_time").alias("during_time"),
        long_of(m, "ts").alias("ts"),
    )


def q_new_visitor_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = repaired_log(spark, sf_dir, ("common", "ts"))
    return log.select("seq", "mid", "ts", text_of("common", "is_new").alias("is_new"))


def q_unique_visitor_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reduced to one row per device and day first; only those are flagged."""
    raw = adapters.log_lines(_events(spark, sf_dir))
    uv = visitors.unique_visitors(log_split.page_rows(log_split.parse_log_topic(raw, PAGE_FIELDS)))
    uv = visitors.repair_new_visitor(uv, log_split.log_keys(raw))
    return uv.select(
        "mid", "visit_date", "seq", "ts",
        text_of("page", "page_id").alias("page_id"),
        text_of("page", "last_page_id").alias("last_page_id"),
        text_of("common", "is_new").alias("is_new"),
    )


def _bounce(spark: SparkSession, sf_dir: str, variant: str) -> DataFrame:
    raw = adapters.log_lines(_events(spark, sf_dir))
    pages = log_split.page_rows(log_split.parse_log_topic(raw, PAGE_FIELDS))
    b = bnc.bounces(pages, BOUNCE_GAP_TEST_MS, variant, key_rows=log_split.page_keys(raw))
    return b.select("seq", "mid", "ts", text_of("page", "page_id").alias("page_id"))


def q_bounce_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bounce(spark, sf_dir, bnc.STRICT)


def q_bounce_reentry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bounce(spark, sf_dir, bnc.REENTRY)


def clean_change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.clean_changes(adapters.change_lines(_events(spark, sf_dir)))


def routed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.route_changes(clean_change_rows(spark, sf_dir), routing_config(spark))


def q_cdc_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = clean_change_rows(spark, sf_dir)
    d = F.col("data")
    return c.select(
        "seq",
        F.col("table").alias("table_name"),
        F.col("type").alias("op_type"),
        long_of(d, "event_id").alias("event_id"),
        long_of(d, "user_id").alias("user_id"),
        double_of(d, "value").alias("value"),
        text_of(d, "props").alias("props"),
    )


def q_cdc_route_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = cdc.topic_rows(routed_changes(spark, sf_dir))
    d = F.col("data")
    return t.select(
        F.col("sink_table").alias("topic"),
        "seq",
        long_of(d, "event_id").alias("event_id"),
        long_of(d, "user_id").alias("user_id"),
        double_of(d, "value").alias("value"),
    )


def q_cdc_route_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each change with the route in force at its position; routes change midway."""
    routed = cdc.route_changes_as_of(clean_change_rows(spark, sf_dir), adapters.config_changes(_events(spark, sf_dir)))
    return route_versions(routed)


def route_versions(routed: DataFrame) -> DataFrame:
    d = F.col("data")
    return routed.where(F.col("sink_type").isin("kafka", "hbase")).select(
        "seq", "config_seq", "sink_type", "sink_table", F.col("source_table").alias("table_name"),
        long_of(d, "event_id").alias("event_id"), long_of(d, "user_id").alias("user_id"), double_of(d, "value").alias("value"),
    )


def q_cdc_route_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = upsert.upsert_rows(cdc.dim_rows(routed_changes(spark, sf_dir)))
    d = F.col("data")
    return u.select(
        "sink_table",
        "seq",
        F.element_at("pk", 1).cast("bigint").alias("pk"),
        d["user_id"].cast("bigint").alias("user_id"),
        d["value"].cast("double").alias("value"),
    )


def q_dim_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur = upsert.current_rows(upsert.upsert_rows(cdc.dim_rows(routed_changes(spark, sf_dir))))
    d = F.col("data")
    return cur.select(
        "sink_table",
        d["user_id"].cast("bigint").alias("user_id"),
        d["value"].cast("double").alias("value"),
        "seq",
    )


def q_dim_table_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.table_schemas(cdc.dim_rows(routed_changes(spark, sf_dir)))


def wide_rows(spark: SparkSession, sf_dir: str, window_ms: int = ORDER_JOIN_TEST_MS) -> DataFrame:
    orders = order_wide.parse_order_info(adapters.order_info_lines(read_table(spark, sf_dir, "orders")))
    details = order_wide.parse_order_detail(adapters.order_detail_lines(read_table(spark, sf_dir, "lineitem")))
    return order_wide.interval_join(
        order_wide.with_event_time(orders), order_wide.with_event_time(details), -window_ms, window_ms
    )


WIDE_OUTPUT = [
    "detail_id", "order_id", "sku_id", "sku_name", "order_price", "sku_num",
    "split_activity_amount", "split_coupon_amount", "split_total_amount",
    "province_id", "order_status", "user_id", "total_amount",
    "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
    "feight_fee", "create_time", "create_date", "create_hour",
    "split_feight_fee", "expire_time", "operate_time",
]
DIM_OUTPUT = [
    "province_name", "province_area", "user_name", "user_segment",
    "spu_name", "tm_name", "category3_name",
]


def _typed(df: DataFrame, names: list[str]) -> DataFrame:
    """Money as double for cross-engine comparison."""
    out = []
    for n in names:
        t = df.schema[n].dataType.typeName()
        out.append(F.col(n).cast("double").alias(n) if t == "decimal" else F.col(n))
    return df.select(*out)


def q_order_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(wide_rows(spark, sf_dir), WIDE_OUTPUT)


def q_order_wide_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = order_wide.enrich_dims(wide_rows(spark, sf_dir), direct_dims(spark, sf_dir))
    return _typed(out, WIDE_OUTPUT + DIM_OUTPUT)


def q_order_wide_six_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows with the six dimensions, joined to the tables that the upsert sink keeps."""
    out = order_wide.enrich_dims(wide_rows(spark, sf_dir), stored_dims(spark, sf_dir))
    return out.select("detail_id", "order_id", "user_id", "sku_id", *STORED_OUTPUT)


def q_raw_landing_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the raw log as daily text folders (day of the event stands in for
    the arrival day), then read the landed lines back and summarize per day."""
    raw = adapters.log_lines(_events(spark, sf_dir))
    path = scratch_dir(spark, "landing")
    write_landing(raw, path, landing_day_of_event("value"))
    landed = spark.read.text(path)
    ts = F.get_json_object("value", "$.ts").cast("bigint")
    return landed.groupBy("landing_date").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    ).select(F.col("landing_date").cast("string").alias("landing_date"), "n_lines", "first_ts", "last_ts")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "log_start": q_log_start,
    "log_page": q_log_page,
    "log_display": q_log_display,
    "published_start": q_published_start,
    "published_page": q_published_page,
    "published_display": q_published_display,
    "published_topic": q_published_topic,
    "new_visitor_repair": q_new_visitor_repair,
    "unique_visitor_daily": q_unique_visitor_daily,
    "bounce_strict": q_bounce_strict,
    "bounce_reentry": q_bounce_reentry,
    "cdc_clean": q_cdc_clean,
    "cdc_route_topic": q_cdc_route_topic,
    "cdc_route_versions": q_cdc_route_versions,
    "cdc_route_dim": q_cdc_route_dim,
    "dim_upsert_latest": q_dim_upsert_latest,
    "dim_table_schema": q_dim_table_schema,
    "order_interval_join": q_order_interval_join,
    "order_wide_dims": q_order_wide_dims,
    "order_wide_six_dims": q_order_wide_six_dims,
    "raw_landing_daily": q_raw_landing_daily,
}
