"""Schemas of the records that flow between the layers.

Dynamic records (app logs, change records) keep their objects as
``map<string,variant>``: every key survives with its JSON type, nested objects
stay objects, and values are typed on access with ``functions.maps``. Fixed
records (orders, config) get explicit types.
"""

from pyspark.sql import types as T

# Raw topic record: one text per message plus its position in the topic.
RAW_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("seq", T.LongType()),
])

# A JSON object whose fields keep their JSON types.
RECORD_DDL = "map<string,variant>"

# App log line (ods_log) after parsing: field -> type, in record order.
LOG_FIELDS = {
    "common": "map<string,variant>",
    "start": "variant",
    "page": "map<string,variant>",
    "displays": "array<map<string,variant>>",
    "ts": "bigint",
}

# Change record (ods_db) after parsing.
CHANGE_DDL = "database string, `table` string, type string, ts bigint, data map<string,variant>"
# The same record's values as text, each as it is written (a dimension table's cells).
CHANGE_TEXT_DDL = "data map<string,string>"

# Routing config row (the table_process table); all text.
TABLE_PROCESS_SCHEMA = T.StructType([
    T.StructField(c, T.StringType())
    for c in (
        "source_table", "operate_type", "sink_type", "sink_table",
        "sink_columns", "sink_pk", "sink_extend",
    )
])
TABLE_PROCESS_COLUMNS = [f.name for f in TABLE_PROCESS_SCHEMA.fields]

# Money has no declared scale in the source beans; two decimals are used.
MONEY = T.DecimalType(16, 2)

ORDER_INFO_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("province_id", T.LongType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("total_amount", MONEY),
    T.StructField("activity_reduce_amount", MONEY),
    T.StructField("coupon_reduce_amount", MONEY),
    T.StructField("original_total_amount", MONEY),
    T.StructField("feight_fee", MONEY),
    T.StructField("expire_time", T.StringType()),
    T.StructField("create_time", T.StringType()),
    T.StructField("operate_time", T.StringType()),
])

ORDER_DETAIL_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("sku_id", T.LongType()),
    T.StructField("order_price", MONEY),
    T.StructField("sku_num", T.LongType()),
    T.StructField("sku_name", T.StringType()),
    T.StructField("create_time", T.StringType()),
    T.StructField("split_total_amount", MONEY),
    T.StructField("split_activity_amount", MONEY),
    T.StructField("split_coupon_amount", MONEY),
])

# Columns of the wide row filled from the order, then from the detail.
WIDE_FROM_ORDER = [
    ("order_id", "id"), ("order_status", "order_status"),
    ("create_time", "create_time"), ("create_date", "create_date"),
    ("create_hour", "create_hour"),
    ("activity_reduce_amount", "activity_reduce_amount"),
    ("coupon_reduce_amount", "coupon_reduce_amount"),
    ("original_total_amount", "original_total_amount"),
    ("feight_fee", "feight_fee"), ("total_amount", "total_amount"),
    ("province_id", "province_id"), ("user_id", "user_id"),
]
WIDE_FROM_DETAIL = [
    ("detail_id", "id"), ("sku_id", "sku_id"), ("sku_name", "sku_name"),
    ("order_price", "order_price"), ("sku_num", "sku_num"),
    ("split_activity_amount", "split_activity_amount"),
    ("split_coupon_amount", "split_coupon_amount"),
    ("split_total_amount", "split_total_amount"),
]
# Declared on the wide row but never filled by the merge.
WIDE_NEVER_FILLED = [
    ("split_feight_fee", MONEY), ("expire_time", T.StringType()),
    ("operate_time", T.StringType()),
]
