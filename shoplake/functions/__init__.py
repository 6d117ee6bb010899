"""Column expressions used by the operators (all JVM-side built-ins)."""

from shoplake.functions.jsonio import is_object, parse_once, to_json_compact
from shoplake.functions.maps import double_of, keep_keys, long_of, overlay, put, stringify_values, text_of, without_nulls
from shoplake.functions.predicates import is_entry, is_non_entry, present
from shoplake.functions.timefmt import (
    day_of_ms,
    ms_of_datetime_text,
    ms_of_timestamp,
    timestamp_of_ms,
)

__all__ = [
    "is_object", "parse_once", "to_json_compact",
    "double_of", "keep_keys", "long_of", "overlay", "put", "stringify_values", "text_of", "without_nulls",
    "is_entry", "is_non_entry", "present",
    "day_of_ms", "ms_of_datetime_text", "ms_of_timestamp", "timestamp_of_ms",
]
