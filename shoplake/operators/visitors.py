"""New-visitor repair and daily unique visitors (batch forms).

Both rank a device's rows by ``(ts, seq)``: ``ts`` is event time, ``seq``
the arrival position that decides ties (the first arrival wins a tie).
The streaming forms, which see rows window by window, are in
``shoplake.streaming.processors`` and give the same rows when nothing is late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.functions.maps import put
from shoplake.functions.timefmt import day_of_ms
from shoplake.operators.latest import earliest_per_key, flag_first_per_key


def repair_new_visitor(
    log: DataFrame,
    key_rows: DataFrame | None = None,
    typed: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Set ``common.is_new``: "1" on a device's first row ever, "0" elsewhere.

    The incoming flag is never read. Skew-safe: a partial aggregate finds each
    device's first ``(ts, seq)``; the join back is keyed on ``(mid, ts, seq)``.
    ``key_rows`` (``mid, ts, seq``) may come from ``log_keys`` over the raw
    text, so the aggregate side does not build the full parsed record.
    ``typed`` runs after the join, on rows that are still narrow in it.
    """
    flagged = flag_first_per_key(log, ["mid"], ["ts", "seq"], flag="_first", key_rows=key_rows)
    flagged = typed(flagged) if typed else flagged
    is_new = F.when(F.col("_first"), F.lit("1")).otherwise(F.lit("0"))
    return flagged.withColumn("common", put("common", "is_new", is_new)).drop("_first")


def unique_visitors(pages: DataFrame) -> DataFrame:
    """The earliest page row per (device, day); adds ``visit_date``.

    One partial-aggregating ``min_by`` over (mid, day): no window sort, and a
    hot device is combined map-side before the shuffle.
    """
    with_day = pages.withColumn("visit_date", day_of_ms("ts"))
    return earliest_per_key(with_day, ["mid", "visit_date"], ["ts", "seq"])
