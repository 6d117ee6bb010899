"""Dimensions of the wide order rows over the test tables.

``DIRECT`` joins the tables as they are. ``STORED`` are the six dimensions of
the original, kept by the upsert sink: their change records are routed,
written to the changelog, and read back as text tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.operators import cdc, upsert
from shoplake.operators.order_wide import Dim
from shoplake.session import scratch_dir
from shoplake.sinks import dims as dim_sink
from shoplake.sources import adapters
from shoplake.sources.config_source import config_frame
from shoplake.sources.tables import read_table

PROVINCE = Dim("province", "province_id", {"province_name": "name", "province_area": "area"})
USER = Dim("customer", "user_id", {"user_name": "c_name", "user_segment": "c_mktsegment"}, "c_custkey")
SKU = Dim("part", "sku_id", {"spu_name": "p_name", "tm_name": "p_brand", "category3_name": "p_type"}, "p_partkey")

# --- fixed values: the six stored dimensions and their routing rows -----------
STORED = [
    Dim("dim_base_province", "province_id", {"province_name": "name", "province_area": "area"}),
    Dim("dim_user_info", "user_id", {"user_name": "name", "user_segment": "segment"}),
    Dim("dim_sku_info", "sku_id", {"spu_id": "spu_id", "tm_id": "tm_id", "category3_id": "category3_id"}),
    Dim("dim_spu_info", "spu_id", {"spu_name": "spu_name"}),
    Dim("dim_base_trademark", "tm_id", {"tm_name": "tm_name"}),
    Dim("dim_base_category3", "category3_id", {"category3_name": "name"}),
]
STORED_ROUTES = [
    ("base_province", "insert", "hbase", "dim_base_province", "id,name,area", "id", None),
    ("user_info", "insert", "hbase", "dim_user_info", "id,name,segment", "id", None),
    ("sku_info", "insert", "hbase", "dim_sku_info", "id,spu_id,tm_id,category3_id", "id", None),
    ("spu_info", "insert", "hbase", "dim_spu_info", "id,spu_name", "id", None),
    ("base_trademark", "insert", "hbase", "dim_base_trademark", "id,tm_name", "id", None),
    ("base_category3", "insert", "hbase", "dim_base_category3", "id,name", "id", None),
]
STORED_OUTPUT = [c for d in STORED for c in d.columns]


def province_dim(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Province dimension: a nation with its region's name as the area."""
    r = region.select(F.col("r_regionkey"), F.col("r_name"))
    return nation.join(r, nation["n_regionkey"] == r["r_regionkey"], "left").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("r_name").alias("area")
    )


def direct_dims(spark: SparkSession, sf_dir: str) -> list[tuple[Dim, DataFrame]]:
    t = lambda name: read_table(spark, sf_dir, name)
    return [(PROVINCE, province_dim(t("nation"), t("region"))), (USER, t("customer")), (SKU, t("part"))]


def dimension_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of the six dimension tables. One market segment's customers are left out,
    and a product family (``spu``) changes with each of its parts, the last one wins."""
    t = lambda name: read_table(spark, sf_dir, name)
    part, key = t("part"), F.col("p_partkey")
    category = F.length("p_type") * 256 + F.ascii("p_type")
    sources = [
        ("base_province", province_dim(t("nation"), t("region")), F.col("id"), {"id": F.col("id"), "name": F.col("name"), "area": F.col("area")}),
        ("user_info", t("customer").where("c_mktsegment <> 'BUILDING'"), F.col("c_custkey"),
         {"id": F.col("c_custkey"), "name": F.col("c_name"), "segment": F.col("c_mktsegment")}),
        ("sku_info", part, key, {"id": key, "spu_id": key % 500, "tm_id": key % 100, "category3_id": category}),
        ("spu_info", part, key, {"id": key % 500, "spu_name": F.col("p_name")}),
        ("base_trademark", t("supplier"), F.col("s_suppkey"), {"id": F.col("s_suppkey"), "tm_name": F.col("s_name")}),
        ("base_category3", part, key, {"id": category, "name": F.col("p_type")}),
    ]
    out = None
    for name, rows, seq, data in sources:
        lines = adapters.insert_lines(rows, name, seq, data)
        out = lines if out is None else out.unionByName(lines)
    return out


def stored_dims(spark: SparkSession, sf_dir: str) -> list[tuple[Dim, DataFrame]]:
    """The six dimensions as the upsert sink keeps them."""
    root = scratch_dir(spark, "dimensions")
    rows = cdc.dim_rows(cdc.route_changes(cdc.clean_changes(dimension_changes(spark, sf_dir)), config_frame(spark, STORED_ROUTES)))
    dim_sink.ensure_tables(spark, rows, root)
    dim_sink.append_changelog(upsert.upsert_rows(rows), root, 0)
    return dim_sink.read_dims(spark, root, STORED)
