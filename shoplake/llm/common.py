"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, bound: int, *cols: str) -> DataFrame:
    """Distinct values of ``cols``, at most ``bound``, the first by hash.

    Rows are cut by a hash threshold that follows the number of distinct values
    before they meet, so what is gathered stays near ``bound`` values at any input size.
    """
    mark = F.xxhash64(F.lit(17), *cols)
    n = df.select(F.approx_count_distinct(mark)).first()[0]
    share = min(1.0, 4 * bound / max(1, n))
    some = df.select(*cols) if share == 1.0 else df.select(*cols).where(mark < F.lit(int(-(1 << 63) + share * (1 << 64))))
    return some.distinct().orderBy(mark, *cols).limit(bound)


def strip_ascii_space(col: Column) -> Column:
    """Deletes every character of ``[\\x20\\x09-\\x0D]``."""
    for ch in " \n\t\r\x0b\x0c":
        col = F.replace(col, F.lit(ch), F.lit(""))
    return col


def fresh(base: str, taken: list[str]) -> str:
    """A column name that does not clash with ``taken`` (case-insensitive, as Spark resolves names)."""
    low = {c.lower() for c in taken}
    name = base
    while name.lower() in low:
        name = f"_{name}"
    return name
