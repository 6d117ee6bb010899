"""Map operations on dynamic records (``map<string,variant>``, or ``map<string,string>`` for cells)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text_of(m: Column | str, key: str) -> Column:
    """``m[key]`` as text (an object or array as its JSON); null when absent or JSON null."""
    return F.try_variant_get(_c(m)[key], "$", "string")


def long_of(m: Column | str, key: str) -> Column:
    """``m[key]`` as bigint; null when it is no number."""
    return F.try_variant_get(_c(m)[key], "$", "bigint")


def double_of(m: Column | str, key: str) -> Column:
    return F.try_variant_get(_c(m)[key], "$", "double")


def known(v: Column) -> Column:
    """The variant, or null for a JSON null."""
    return F.when(~F.is_variant_null(v), v)


def without_nulls(m: Column | str) -> Column:
    """Entries that are neither null nor JSON null."""
    return F.map_filter(_c(m), lambda _, v: v.isNotNull() & ~F.is_variant_null(v))


def overlay(*maps: Column | str, values: str = "variant") -> Column:
    """Merge maps left to right; on a shared key the later map wins.

    ``values`` is the maps' value type. Null maps count as empty. Independent of ``spark.sql.mapKeyDedupPolicy``:
    keys of the later map are removed from the earlier result before
    concatenation, so no duplicate key ever reaches ``map_concat``.
    """
    empty = F.create_map().cast(f"map<string,{values}>")
    out = F.coalesce(_c(maps[0]), empty)
    for m in maps[1:]:
        nxt = F.coalesce(_c(m), empty)
        keys = F.map_keys(nxt)
        out = F.map_concat(F.map_filter(out, lambda k, v: ~F.array_contains(keys, k)), nxt)
    return out


def put(m: Column | str, key: str, value: Column) -> Column:
    """``m[key] := value``; the key moves to the end."""
    rest = F.map_filter(F.coalesce(_c(m), F.create_map().cast("map<string,variant>")), lambda k, _: k != key)
    return F.map_concat(rest, F.create_map(F.lit(key), value.cast("variant")))


def keep_keys(m: Column | str, csv_columns: Column | str) -> Column:
    """Keep only keys listed in a comma-separated text (no trimming)."""
    wanted = F.split(_c(csv_columns), ",")
    return F.map_filter(_c(m), lambda k, v: F.array_contains(wanted, k))


def stringify_values(m: Column | str) -> Column:
    """Every value as text, null stays null (a dimension's cells already are)."""
    return F.transform_values(_c(m), lambda k, v: v.cast("string"))
