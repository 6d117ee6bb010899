"""Raw log landing: keep every raw line, split into daily folders.

The original collector appends each line to a daily rolling file and also
publishes it to the log topic. Here the landing is a partitioned text write
(see ``shoplake.sinks.landing``); this module only decides the day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.functions.timefmt import day_of_ms


def landing_day_of_event(value: str = "value") -> Column:
    """Day of the record's own ``ts`` (for replays of old data)."""
    return day_of_ms(F.get_json_object(F.col(value), "$.ts").cast("bigint"))


def landing_day_of_arrival() -> Column:
    """Day the line arrives (the original's rule): processing date."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd")


def with_landing_day(raw: DataFrame, day: Column | None = None) -> DataFrame:
    return raw.withColumn("landing_date", day if day is not None else landing_day_of_arrival())
