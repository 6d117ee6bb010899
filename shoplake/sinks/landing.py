"""Raw landing sink: daily folders of raw text lines (see streaming.jobs.start_landing)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shoplake.operators.landing import with_landing_day


def write_landing(raw: DataFrame, path: str, day=None) -> None:
    """Batch form: append raw lines under ``landing_date=<day>`` folders.

    Rows are rebalanced by day first, so files follow the data's size, not
    tasks x days; AQE cuts a large day into several files.
    """
    rows = with_landing_day(raw, day).select("value", "landing_date")
    rows.hint("rebalance", "landing_date").write.mode("append").partitionBy("landing_date").text(path)
