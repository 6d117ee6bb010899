"""The routing config table (``table_process``): snapshot and change forms.

The original reads it through a CDC connector as a retract stream and keeps
only the additions, so a deleted config row stays active. Two forms:

* ``read_config``: a snapshot read (JDBC / parquet / a DataFrame), re-read per
  micro-batch by the streaming DB job. A re-read table forgets deleted rows;
  this is the one documented difference from the change form.
* ``config_latest``: fold a change stream (``op`` in insert / update_before /
  update_after / delete, ``seq`` ordering) exactly like the original.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.operators.latest import latest_per_key
from shoplake.schemas import TABLE_PROCESS_COLUMNS, TABLE_PROCESS_SCHEMA

CONFIG_KEY = ["source_table", "operate_type"]
ADDITION_OPS = ("insert", "update_after")


def read_config(
    spark: SparkSession,
    *,
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
    df: DataFrame | None = None,
) -> DataFrame:
    """Snapshot of the config table with the seven text columns."""
    if df is not None:
        src = df
    elif jdbc is not None:
        src = spark.read.format("jdbc").options(**jdbc).load()  # options from the caller only
    elif path is not None:
        src = spark.read.parquet(path)
    else:
        raise ValueError("path, jdbc or df is required")
    return src.select(*[F.col(c).cast("string").alias(c) for c in TABLE_PROCESS_COLUMNS])


def keep_additions(changes: DataFrame, op_col: str = "op") -> DataFrame:
    """Drop deletes and before-images of a change stream (retract filter)."""
    return changes.where(F.col(op_col).isin(*ADDITION_OPS))


def config_latest(changes: DataFrame, op_col: str = "op", seq_col: str = "seq") -> DataFrame:
    """Current config per (source_table, operate_type): the last addition wins."""
    adds = keep_additions(changes, op_col)
    return latest_per_key(adds, CONFIG_KEY, seq_col).select(*TABLE_PROCESS_COLUMNS)


def changelog_config_loader(spark: SparkSession, path: str, op_col: str = "op", seq_col: str = "seq"):
    """A config loader for ``start_db_detail`` that re-reads a folder of
    config change records (columns of the config + ``op`` + ``seq``) and
    folds it each micro-batch: the change form, so deleted rows stay active."""

    def load() -> DataFrame:
        return config_latest(spark.read.parquet(path), op_col, seq_col)

    return load


def config_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Config rows given inline (tests, small deployments)."""
    return spark.createDataFrame(rows, TABLE_PROCESS_SCHEMA)
