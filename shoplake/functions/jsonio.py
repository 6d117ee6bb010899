"""JSON text <-> columns.

Parsing uses ``from_json`` with a fixed DDL, so it stays inside codegen and
needs no inference pass. Malformed text yields an all-null struct (PERMISSIVE
mode); callers decide whether to quarantine or fail.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplake.schemas import RECORD_DDL


def is_object(value: Column | str = "value") -> Column:
    """The text is one JSON object."""
    return F.from_json(F.col(value) if isinstance(value, str) else value, RECORD_DDL).isNotNull()


def to_json_compact(c: Column | str) -> Column:
    """Serialize a struct or map to JSON text, leaving out null entries."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_json(c, {"ignoreNullFields": "true"})


def last_wins(m: Column) -> Column:
    """A parsed map may repeat a key; as in a struct parse, its last value counts."""
    keys = F.map_keys(m)
    last = F.filter(F.map_entries(m), lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.map_from_entries(last)).otherwise(m)


def computed_once(df: DataFrame, *cols: Column | str) -> DataFrame:
    """``df.select(*cols)`` behind a generator, so that a later filter does not compute the columns again."""
    return df.select(F.inline(F.array(F.struct(*cols))))


def parse_once(
    df: DataFrame,
    schema: StructType | str,
    value: Column | str = "value",
    keep: tuple[str, ...] = ("seq",),
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Parse JSON text into top-level columns, evaluating ``from_json`` once.

    Catalyst pushes filters through projections by inlining aliases, so a
    later filter on several parsed fields would repeat the parse per field.
    Wrapping the parsed struct in a one-element ``inline`` makes it a
    generator output: filters stay above it and each text is parsed once.
    A map schema gives one column, ``record``.
    """
    v = F.col(value) if isinstance(value, str) else value
    parsed = F.from_json(v, schema, {"mode": mode})
    if str(schema).startswith("map<"):  # bound by a one-element transform, so the text is parsed once
        parsed = F.element_at(F.transform(F.array(parsed), last_wins), 1)
    row = F.struct(*[F.col(k) for k in keep], parsed.alias("_r"))
    fields = F.col("_r").alias("record") if str(schema).startswith("map<") else "_r.*"
    return df.select(F.inline(F.array(row))).select(*keep, fields)
