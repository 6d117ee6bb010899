"""Dimension tables kept as an append-only changelog plus compaction.

There is no upsert-capable table format in this repository, so an upsert is
an append of ``(sink_table, pk, seq, data)`` rows; the current table folds
them per ``(sink_table, pk)`` and column (``operators.upsert.current_rows``).
``compact`` writes the folded rows as a snapshot: a read opens the newest
snapshot and the batches after it. A table is created (empty, every column
text) the first time a row for it arrives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.operators import upsert
from shoplake.operators.order_wide import Dim


TABLE_PARTS = 16  # folders of a batch of the changelog


def table_part(sink_table) -> Column:
    return F.pmod(F.xxhash64(sink_table), F.lit(TABLE_PARTS)).cast("int")


def list_tables(spark: SparkSession, root: str) -> DataFrame:
    """Every created table: ``sink_table, columns`` (in order, all text)."""
    ddl = "sink_table string, columns array<string>"
    try:
        return spark.read.schema(ddl).parquet(f"{root.rstrip('/')}/tables")
    except AnalysisException:
        return spark.createDataFrame([], ddl)


def ensure_tables(spark: SparkSession, dim_rows: DataFrame, root: str) -> None:
    """List every target table first seen in ``dim_rows``, one row a table, by its first row's config."""
    cols = F.sort_array(F.collect_list(F.struct("position", "column_name")))
    firsts = upsert.table_schemas(dim_rows).groupBy("sink_table").agg(F.transform(cols, lambda c: c["column_name"]).alias("columns"))
    fresh = firsts.join(list_tables(spark, root), "sink_table", "left_anti")
    if not fresh.isEmpty():
        fresh.write.mode("append").parquet(f"{root.rstrip('/')}/tables")


def append_changelog(upserts: DataFrame, root: str, batch_id: int | None = None) -> None:
    """Append upsert rows; with ``batch_id`` the write is idempotent per batch."""
    base = f"{root.rstrip('/')}/dim_changelog"
    rows = upserts.withColumn("table_part", table_part("sink_table"))
    if batch_id is None:
        rows.write.mode("append").partitionBy("table_part").parquet(base)
    else:
        rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
            .partitionBy("table_part").parquet(f"{base}/batch={batch_id}")


ROW = ["sink_table", "pk", "seq", "data", "sink_columns", "sink_pk"]


def newest_snapshot(spark: SparkSession, root: str) -> int | None:
    """The last batch of the newest snapshot; null when there is none."""
    try:
        return spark.read.parquet(f"{root.rstrip('/')}/dim_snapshot").select(F.max("upto")).first()[0]
    except AnalysisException:
        return None


def _of_table(rows: DataFrame, sink_table: str | None) -> DataFrame:
    if sink_table is None:
        return rows
    return rows.where((F.col("table_part") == table_part(F.lit(sink_table))) & (F.col("sink_table") == sink_table))


def read_current(spark: SparkSession, root: str, sink_table: str | None = None) -> DataFrame:
    """The stored rows, of one table if it is named: the newest snapshot and the batches after it. A later micro-batch wins over ``seq``:
    positions of different topic partitions say nothing about which row came first."""
    base = root.rstrip("/")
    log = _of_table(spark.read.parquet(f"{base}/dim_changelog"), sink_table)
    if "batch_id" not in log.columns:
        return upsert.current_rows(log.select(*ROW))
    upto = newest_snapshot(spark, base)
    if upto is not None:
        snapshot = _of_table(spark.read.parquet(f"{base}/dim_snapshot/upto={upto}"), sink_table)
        log = log.where(F.col("batch") > upto).select(*ROW, "batch_id").unionByName(snapshot.select(*ROW, "batch_id"))
    return upsert.current_rows(log.select(*ROW, "batch_id"), ["batch_id", "seq"])


def compact(spark: SparkSession, root: str) -> int | None:
    """Fold all batches written so far into a new snapshot; returns its last batch.

    A snapshot row is an upsert of all its columns, ranked at that batch.
    """
    base = root.rstrip("/")
    log = spark.read.parquet(f"{base}/dim_changelog")
    if "batch" not in log.columns:
        raise ValueError("only a changelog written by batches can be compacted")
    upto = log.select(F.max("batch")).first()[0]
    if upto is not None and upto != newest_snapshot(spark, base):
        rows = read_current(spark, base).withColumn("sink_columns", F.array_join(F.map_keys("data"), ","))
        rows = rows.withColumn("batch_id", F.lit(upto)).withColumn("table_part", table_part("sink_table"))
        rows.write.mode("overwrite").partitionBy("table_part").parquet(f"{base}/dim_snapshot/upto={upto}")
    return upto


def read_dims(spark: SparkSession, root: str, specs: Sequence[Dim]) -> list[tuple[Dim, DataFrame]]:
    """The stored tables of the given dimensions, for ``order_wide.enrich_dims``."""
    return [(d, current_table(spark, root, d.table)) for d in specs]


def current_table(spark: SparkSession, root: str, sink_table: str) -> DataFrame:
    """One dimension table as columns: its configured columns, all text."""
    table = list_tables(spark, root).where(F.col("sink_table") == sink_table).first()
    if table is None:
        raise ValueError(f"no table {sink_table!r} under {root}")
    cur = read_current(spark, root, sink_table)
    return cur.select(*[F.col("data")[c].alias(c) for c in table.columns])
