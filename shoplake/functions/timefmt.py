"""Event-time conversions. All follow the session time zone (UTC in tests)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoplake.settings import DATETIME_FORMAT, DAY_FORMAT


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ms_of_timestamp(ts: Column | str) -> Column:
    """timestamp / timestamp_ntz -> epoch milliseconds."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def timestamp_of_ms(ms: Column | str) -> Column:
    return F.timestamp_millis(_c(ms))


def day_of_ms(ms: Column | str) -> Column:
    """Epoch ms -> ``yyyy-MM-dd`` text of its day."""
    return F.date_format(F.timestamp_millis(_c(ms)), DAY_FORMAT)


def ms_of_datetime_text(text: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> epoch milliseconds; null when malformed
    (also under ANSI mode), so the caller can drop the row."""
    return F.unix_millis(F.try_to_timestamp(_c(text), F.lit(DATETIME_FORMAT)))
