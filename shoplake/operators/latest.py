"""First / last row per key, written to survive a hot key.

``flag_first_per_key`` orders by one decimal made of the order columns: hash
aggregation updates it in place, where a struct would sort every input row.

All three helpers are aggregations with a map-side partial step, so a key
that holds a third of all rows costs one partial row per map task at the
final step, never one task holding the whole group. ``flag_first_per_key``
then joins back on ``(key, order columns)``, which is close to unique and
spreads the hot key evenly over the join's partitions. That join hashes the
one row per key and does not sort the others; both sides are shuffled, so the
work after it does not hang on how few splits the input file has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row_struct(df: DataFrame, exclude: tuple[str, ...] = ()) -> Column:
    return F.struct(*[F.col(c) for c in df.columns if c not in exclude])


def latest_per_key(df: DataFrame, keys: list[str], seq_col: str = "seq") -> DataFrame:
    """The row with the greatest ``seq`` per key (upsert semantics)."""
    agg = df.groupBy(*keys).agg(F.max_by(_row_struct(df, tuple(keys)), F.col(seq_col)).alias("_last"))
    return agg.select(*keys, "_last.*")


def earliest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """The row with the least ``order_cols`` (lexicographic) per key."""
    order = F.struct(*[F.col(c) for c in order_cols])
    agg = df.groupBy(*keys).agg(F.min_by(_row_struct(df, tuple(keys)), order).alias("_first"))
    return agg.select(*keys, "_first.*")


def flag_first_per_key(
    df: DataFrame,
    keys: list[str],
    order_cols: list[str],
    flag: str = "is_first",
    key_rows: DataFrame | None = None,
) -> DataFrame:
    """Every row of ``df`` plus a boolean: is it its key's least row?

    ``order_cols`` must identify a row within its key (end with ``seq``).
    ``key_rows`` may give the same rows projected to ``keys + order_cols``
    from a cheaper read (e.g. a narrow parse of the same text); by default
    they come from ``df``.
    """
    src = key_rows if key_rows is not None else df
    order = _order_code(order_cols)
    firsts = src.groupBy(*keys).agg(F.min(order).alias("_order")).withColumn(flag, F.lit(True))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a given number: few bytes a row may still be much work
    rows = df.withColumn("_order", order).repartition(parts, *keys, "_order")
    joined = rows.join(firsts.hint("shuffle_hash"), on=[*keys, "_order"], how="left")
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).select(*df.columns, flag)


def _order_code(order_cols: list[str]) -> Column:
    """Bigint columns as one decimal in lexicographic order.

    Two columns at most; the first within +-5e18 (event times are), the second any bigint.
    """
    if len(order_cols) > 2:
        raise ValueError("at most two order columns")
    code = F.col(order_cols[0]).cast("decimal(19,0)")
    if len(order_cols) == 2:
        step = F.lit("18446744073709551616").cast("decimal(20,0)")
        code = (code * step + F.col(order_cols[1]).cast("decimal(20,0)")).cast("decimal(38,0)")
    return code
