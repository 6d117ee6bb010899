"""Bounced visits: a two-row pattern per device in event-time order.

* ``strict`` (entry -> non-entry, timeouts are the result): an entry bounces
  when no row of its device follows within the limit. If the next row comes
  within the limit the pattern ends either way: a non-entry completes it, an
  entry breaks it and the first entry is lost.
* ``reentry`` (entry -> entry, matches and timeouts): an entry bounces when no
  row follows within the limit, or the next row is itself an entry.

The limit is exclusive: a next row exactly ``gap_ms`` later times the entry
out. Only the *strict next* row matters, so the batch form needs each row's
successor within ``gap_ms`` -- see ``next_within``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplake.functions.maps import text_of
from shoplake.functions.predicates import is_entry
from shoplake.settings import BOUNCE_BUCKET_MS, BOUNCE_GAP_MS

STRICT, REENTRY = "strict", "reentry"


def next_within(
    df: DataFrame,
    key: str,
    gap_ms: int,
    carry: list[str],
    head_rows: DataFrame | None = None,
    bucket_ms: int = BOUNCE_BUCKET_MS,
) -> DataFrame:
    """Add the strict successor of each row (same ``key``, ``(ts, seq)`` order)
    as ``next_ts``, ``next_seq`` and ``next_<c>``, or nulls when the
    successor is absent or ``gap_ms`` or more later.

    Distributed without a per-key sort: time is cut into buckets of width
    ``bucket_ms``, or ``gap_ms`` where that is less. ``lead`` runs over
    (key, bucket) windows, and the last row of a bucket takes the first row of
    the next bucket that has one, through an equi-join on (key, bucket). With
    width ``gap_ms`` only bucket + 1 can be within the limit. Else the first
    rows, one per key and bucket, find their own successors by this function,
    in buckets as wide as the limit. A hot device is spread over its buckets
    whatever the limit is.

    The first row of each bucket comes from a partial-aggregating ``min``;
    ``head_rows`` may supply ``key, ts, seq, *carry`` from a cheaper read of
    the same rows (a narrow parse), otherwise ``df`` is used.
    """
    nxt_cols = ["ts", "seq", *carry]
    width = min(bucket_ms, gap_ms)
    bucket = F.floor(F.col("ts") / F.lit(width)).cast("bigint")
    w = Window.partitionBy(key, "_b").orderBy("ts", "seq")
    x = df.withColumn("_b", bucket)
    for c in nxt_cols:
        x = x.withColumn(f"_l_{c}", F.lead(c).over(w))
    src = (head_rows if head_rows is not None else df).withColumn("_b", bucket)
    heads = src.groupBy(key, "_b").agg(F.min(F.struct(*[F.col(c) for c in nxt_cols])).alias("_h"))
    if width == gap_ms:
        heads = heads.select(key, (F.col("_b") - 1).alias("_b"), *[F.col(f"_h.{c}").alias(f"_h_{c}") for c in nxt_cols])
    else:
        reach = gap_ms + width  # a bucket's last row is up to a width later than its first
        heads = next_within(heads.select(key, F.col("_b").alias("_own"), "_h.*"), key, reach, carry, bucket_ms=reach)
        heads = heads.select(key, F.col("_own").alias("_b"), *[F.col(f"next_{c}").alias(f"_h_{c}") for c in nxt_cols])
    y = x.join(heads, on=[key, "_b"], how="left")
    in_bucket = F.col("_l_ts").isNotNull()
    out = y
    for c in nxt_cols:
        out = out.withColumn(f"next_{c}", F.when(in_bucket, F.col(f"_l_{c}")).otherwise(F.col(f"_h_{c}")))
    within = F.col("next_ts").isNotNull() & ((F.col("next_ts") - F.col("ts")) < F.lit(gap_ms))
    for c in nxt_cols:
        out = out.withColumn(f"next_{c}", F.when(within, F.col(f"next_{c}")))
    drop = ["_b", *[f"_l_{c}" for c in nxt_cols], *[f"_h_{c}" for c in nxt_cols]]
    return out.drop(*drop)


def bounces(
    pages: DataFrame,
    gap_ms: int = BOUNCE_GAP_MS,
    variant: str = REENTRY,
    key_rows: DataFrame | None = None,
) -> DataFrame:
    """Bounced entry rows of a page stream (``mid, ts, seq, page`` columns).

    ``key_rows`` (``mid, ts, seq, is_entry`` of the same rows, e.g. from
    ``log_split.page_keys``) spares the bucket-head step a full parse.
    """
    if variant not in (STRICT, REENTRY):
        raise ValueError(f"variant must be {STRICT!r} or {REENTRY!r}")
    rows = pages.withColumn("_entry", is_entry(text_of("page", "last_page_id")))
    heads = key_rows.withColumnRenamed("is_entry", "_entry") if key_rows is not None else None
    nx = next_within(rows, "mid", gap_ms, carry=["_entry"], head_rows=heads)
    timed_out = F.col("next_ts").isNull()
    cond = timed_out if variant == STRICT else (timed_out | F.col("next__entry"))
    return nx.where(F.col("_entry") & cond).select(*pages.columns)
