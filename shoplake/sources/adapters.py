"""Re-aim the driver's tables as the warehouse's raw topics.

Each adapter is a plain projection of one table into ``(value, seq)`` rows,
``value`` being the JSON text the original topic would carry and ``seq`` its
position (used only to break ties). Being projections, they scale with the
table and add no shuffle.

Rules (also written out in README.md):

* app log over ``events``: ``mid = user_id``; ``start`` present iff
  ``event_type = 'signup'``, else ``page`` with ``page_id = event_type`` and
  ``last_page_id = event_type`` except for ``view`` (an entry, no last page);
  ``displays`` has ``k % 4`` items (absent when 0), ``k`` from ``props``;
  ``ts`` in epoch ms; ``seq = event_id``.
* change records over ``events``: ``table = event_type``; ``type`` by
  ``event_id % 5``; ``data`` holds the row's other columns.
* order_info over ``orders``; order_detail over ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.functions.jsonio import to_json_compact
from shoplake.functions.timefmt import ms_of_timestamp
from shoplake.schemas import MONEY
from shoplake.settings import DATETIME_FORMAT

# --- fixed values of the adapters ------------------------------------------
DISPLAY_TYPES = ["activity", "promotion", "query", "recommend"]
CHANGE_TYPES_BY_MOD5 = ["bootstrap-insert", "insert", "update", "delete", "bootstrap-start"]
DATABASE_NAME = "shop"
PROVINCE_COUNT = 25
SECONDS_PER_DAY = 86_400


def _props_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def log_lines(events: DataFrame, rich: bool = False) -> DataFrame:
    """events -> ods_log records ``(value, seq)``.

    ``rich`` adds what the job does not know: a top-level object ``err`` and
    array ``actions``, a nested object and a number in ``common``; absent
    fields are written as JSON nulls.
    """
    events = events.withColumn("_k", _props_k())  # read from the text once, not at each use
    k = F.col("_k")
    n_disp = k % 4
    signup = F.col("event_type") == "signup"
    common = [
        F.col("user_id").cast("string").alias("mid"),
        F.when(signup, "1").otherwise("0").alias("is_new"),
    ]
    other = []
    if rich:
        common += [k.alias("vc"), F.struct((k + F.lit(0.5)).alias("lat"), F.lit("n").alias("zone")).alias("geo"), F.lit(None).cast("string").alias("gone")]
        other = [F.struct(k.alias("code"), F.lit("7").alias("msg")).alias("err"), F.array(k, k + 1).alias("actions")]
    common = F.struct(*common)
    start = F.when(signup, F.struct(F.lit("icon").alias("entry"), k.alias("loading_time")))
    page = F.when(~signup, F.struct(
        F.col("event_type").alias("page_id"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("last_page_id"),
        k.alias("during_time"),
    ))
    types = F.array(*[F.lit(t) for t in DISPLAY_TYPES])
    displays = F.when(n_disp > 0, F.transform(
        F.sequence(F.lit(1), n_disp),
        lambda i: F.struct(
            F.element_at(types, ((k + i) % 4) + 1).alias("display_type"),
            (k * 10 + i).cast("string").alias("item"),
            i.alias("order"),
        ),
    ))
    record = F.struct(
        common.alias("common"), start.alias("start"), page.alias("page"),
        displays.alias("displays"), ms_of_timestamp("ts").alias("ts"), *other,
    )
    text = F.to_json(record, {"ignoreNullFields": "false"}) if rich else to_json_compact(record)
    return events.select(text.alias("value"), F.col("event_id").alias("seq"))


def change_lines(events: DataFrame) -> DataFrame:
    """events -> ods_db change records ``(value, seq)``."""
    kinds = F.array(*[F.lit(t) for t in CHANGE_TYPES_BY_MOD5])
    ctype = F.element_at(kinds, (F.col("event_id") % 5 + 1).cast("int"))
    data = F.when(ctype != "bootstrap-start", F.struct(
        "event_id", "user_id", "value", "props"))
    record = F.struct(
        F.lit(DATABASE_NAME).alias("database"),
        F.col("event_type").alias("table"),
        ctype.alias("type"),
        ms_of_timestamp("ts").alias("ts"),
        data.alias("data"),
    )
    return events.select(to_json_compact(record).alias("value"), F.col("event_id").alias("seq"))


CONFIG_EVERY = 40


def config_changes(events: DataFrame) -> DataFrame:
    """events -> changes of the routing config on the positions of ``change_lines``: columns of the config, ``op``, ``seq``.

    Every ``CONFIG_EVERY``-th event changes the route of its own table: an
    insert, the two images of an update and a delete in turn.
    """
    n = (F.col("event_id") / CONFIG_EVERY).cast("bigint")
    ops = F.array(*[F.lit(o) for o in ("insert", "update_before", "update_after", "delete")])
    return events.where(F.col("event_id") % CONFIG_EVERY == 0).select(
        F.col("event_type").alias("source_table"),
        F.when(F.floor(n / 4) % 2 == 0, F.lit("insert")).otherwise(F.lit("update")).alias("operate_type"),
        F.when(n % 3 == 0, F.lit("hbase")).otherwise(F.lit("kafka")).alias("sink_type"),
        F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("sink_table"),
        F.when(n % 2 == 0, F.lit("event_id,user_id,value")).otherwise(F.lit("event_id,value")).alias("sink_columns"),
        F.lit("event_id").alias("sink_pk"),
        F.lit(None).cast("string").alias("sink_extend"),
        F.element_at(ops, (n % 4 + 1).cast("int")).alias("op"),
        F.col("event_id").alias("seq"),
    )


def insert_lines(rows: DataFrame, table: str, seq: Column, data: dict[str, Column]) -> DataFrame:
    """Any table -> ods_db insert records ``(value, seq)`` of change table ``table``."""
    record = F.struct(
        F.lit(DATABASE_NAME).alias("database"), F.lit(table).alias("table"), F.lit("insert").alias("type"),
        F.struct(*[c.alias(n) for n, c in data.items()]).alias("data"),
    )
    return rows.select(to_json_compact(record).alias("value"), seq.cast("bigint").alias("seq"))


def _shifted_datetime_text(ts_col: str, seconds: Column) -> Column:
    ms = ms_of_timestamp(ts_col) + seconds * 1000
    return F.date_format(F.timestamp_millis(ms), DATETIME_FORMAT)


def order_info_lines(orders: DataFrame) -> DataFrame:
    """orders -> dwd_order_info records ``(value, seq)``."""
    zero = F.lit(0).cast(MONEY)
    price = F.col("o_totalprice").cast(MONEY)
    record = F.struct(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderkey") % PROVINCE_COUNT).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        price.alias("total_amount"),
        zero.alias("activity_reduce_amount"),
        zero.alias("coupon_reduce_amount"),
        price.alias("original_total_amount"),
        zero.alias("feight_fee"),
        _shifted_datetime_text("o_orderdate", F.col("o_orderkey") % SECONDS_PER_DAY).alias("create_time"),
    )
    return orders.select(to_json_compact(record).alias("value"), F.col("o_orderkey").alias("seq"))


def order_detail_lines(lineitem: DataFrame) -> DataFrame:
    """lineitem -> dwd_order_detail records ``(value, seq)``."""
    detail_id = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    record = F.struct(
        detail_id.alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").cast(MONEY).alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.concat(F.lit("sku-"), F.col("l_partkey").cast("string")).alias("sku_name"),
        _shifted_datetime_text("l_shipdate", F.col("l_partkey") % SECONDS_PER_DAY).alias("create_time"),
        F.col("l_extendedprice").cast(MONEY).alias("split_total_amount"),
        F.col("l_discount").cast(MONEY).alias("split_activity_amount"),
        F.col("l_tax").cast(MONEY).alias("split_coupon_amount"),
    )
    return lineitem.select(to_json_compact(record).alias("value"), detail_id.alias("seq"))
