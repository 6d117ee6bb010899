"""The routing config used with the ``events`` change records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplake.sources.config_source import config_frame

# --- fixed values: routing config rows ---------------------------------------
# (source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend)
ROUTING_ROWS = [
    ("purchase", "insert", "kafka", "dwd_purchase", "event_id,user_id,value", None, None),
    ("purchase", "update", "kafka", "dwd_purchase_upd", "event_id,value", None, None),
    ("signup", "insert", "hbase", "dim_user", "user_id,value", "user_id", None),
    ("signup", "update", "hbase", "dim_user", "user_id,value", "user_id", None),
    ("view", "insert", "other", "x", "event_id", None, None),
]


def routing_config(spark: SparkSession) -> DataFrame:
    return config_frame(spark, ROUTING_ROWS)
