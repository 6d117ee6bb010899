"""App log detail: parse, split into start / page / display rows.

Split rule: a record with ``start`` goes to start only. Otherwise it goes to
page when ``page`` is present, and *also* yields one display row per element
of ``displays``. A display row is the display object overlaid with ``ts``,
then all ``common`` keys, then all ``page`` keys (later wins).

All three outputs are filters / an explode over one parsed frame: no shuffle.

Values keep their JSON types, and top-level fields this module does not know
(or of a type it does not expect) pass through in ``extra``. Published text
leaves out nulls of the record and of its ``common``, ``page`` and display
objects; objects nested deeper stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.functions.jsonio import computed_once, is_object, parse_once
from shoplake.functions.maps import known, overlay, without_nulls
from shoplake.functions.predicates import is_entry
from shoplake.schemas import LOG_FIELDS, RECORD_DDL

START, PAGE, DISPLAY = "start", "page", "display"


def parse_log_topic(raw: DataFrame, fields: tuple[str, ...] | None = None) -> DataFrame:
    """``(value, seq)`` -> ``common, start, page, displays, ts, seq, mid``.

    Without ``fields`` the whole record is kept: ``extra`` holds every other
    field. ``fields`` limits the parse to the record fields a job reads
    (``common`` and ``ts`` are always parsed). The text is parsed only once.
    Rows without ``ts`` or ``common.mid`` (malformed text included) are
    dropped here; ``malformed_log_rows`` returns them for quarantine.
    """
    return parse_records(raw, fields)


def parse_records(raw: DataFrame, fields: tuple[str, ...] | None = None, keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """As ``parse_log_topic``, with the columns ``keep`` of ``raw``."""
    if fields is not None:
        return typed_records(keyed_records(raw, fields, keep))
    src = parse_once(raw, RECORD_DDL, keep=keep)
    field = lambda name: F.col("record")[name]
    src = src.where(_has_keys(field))
    cols = {n: _field(field(n), n) for n in LOG_FIELDS}
    out = [c.alias(n) for n, c in cols.items()]
    typed = F.array(*[F.when(c.isNotNull(), F.lit(n)) for n, c in cols.items()])
    # bound by a one-element transform, so it is not computed again for every key
    rest = F.transform(F.array(F.array_compact(typed)), lambda t: F.map_filter("record", lambda k, _: ~F.array_contains(t, k)))
    return src.select(*keep, *out, F.element_at(rest, 1).alias("extra"), _mid(field).alias("mid"))


def keyed_records(raw: DataFrame, fields: tuple[str, ...], keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """``parse_records`` before its fields get their types: each but ``ts`` is one variant.

    A variant moves through a shuffle in a fraction of the bytes of the map or
    array of maps it becomes: join here, then call ``typed_records``.
    """
    names = [n for n in LOG_FIELDS if n in {*fields, "common", "ts"}]
    src = parse_once(raw, ", ".join(f"{n} variant" for n in names), keep=keep)
    cols = [_field(F.col(n), n).alias(n) if n == "ts" else F.col(n) for n in names]
    src = computed_once(src, *keep, *cols, _mid(F.col).alias("mid"))
    return src.where(F.col("ts").isNotNull() & F.col("mid").isNotNull())


def typed_records(records: DataFrame) -> DataFrame:
    """``keyed_records`` (and any further columns) with every field in its type."""
    typed = [n for n in LOG_FIELDS if n != "ts"]
    return computed_once(records, *[_field(F.col(n), n).alias(n) if n in typed else F.col(n) for n in records.columns])


def of_kind(records: DataFrame, kind: str) -> DataFrame:
    """Those of ``keyed_records`` that can give rows of ``kind``; the rest goes before a join."""
    start, body = known(F.col("start")), {PAGE: "page", DISPLAY: "displays"}
    return records.where(start.isNotNull() if kind == START else start.isNull() & known(F.col(body[kind])).isNotNull())


def _field(value: Column, name: str) -> Column:
    return known(value) if LOG_FIELDS[name] == "variant" else F.try_variant_get(value, "$", LOG_FIELDS[name])


def _mid(field: Callable[[str], Column]) -> Column:
    return F.try_variant_get(field("common"), "$.mid", "string")


def _has_keys(field: Callable[[str], Column]) -> Column:
    return _field(field("ts"), "ts").isNotNull() & _mid(field).isNotNull()


LOG_KEY_DDL = "common variant, ts variant"


def log_keys(raw: DataFrame, keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """``(value, seq)`` -> ``mid, ts`` and the columns ``keep``, with a narrow parse.

    Same row set as ``parse_log_topic``; the parser skips every other field.
    """
    k = parse_once(raw, LOG_KEY_DDL, keep=keep)
    k = computed_once(k, _mid(F.col).alias("mid"), _field(F.col("ts"), "ts").alias("ts"), *keep)
    return k.where(F.col("ts").isNotNull() & F.col("mid").isNotNull())


PAGE_KEY_DDL = "common variant, start variant, page variant, ts variant"


def page_keys(raw: DataFrame, keep: tuple[str, ...] = ("seq",), with_flag: bool = False) -> DataFrame:
    """``(value, seq)`` -> ``mid, ts``, the columns ``keep`` and ``is_entry`` of the page rows, narrow parse.

    Same row set as ``page_rows(parse_log_topic(raw))``. ``with_flag`` adds ``is_new``.
    """
    k = parse_once(raw, PAGE_KEY_DDL, keep=keep).where(_has_keys(F.col))
    k = k.where(known(F.col("start")).isNull() & _field(F.col("page"), "page").isNotNull())
    entry = is_entry(F.try_variant_get("page", "$.last_page_id", "string"))
    flag = [F.try_variant_get("common", "$.is_new", "string").alias("is_new")] if with_flag else []
    return k.select(_mid(F.col).alias("mid"), _field(F.col("ts"), "ts").alias("ts"), *keep, entry.alias("is_entry"), *flag)


def malformed_log_rows(raw: DataFrame) -> DataFrame:
    """Rows that ``parse_log_topic`` drops: no JSON object, or no device or time."""
    r = parse_once(raw, LOG_KEY_DDL, keep=("value", "seq"))
    return r.where(~is_object("value") | ~_has_keys(F.col)).select("value", "seq")


def malformed_page_rows(raw: DataFrame) -> DataFrame:
    """Rows of a page topic that ``page_keys`` drops."""
    r = parse_once(raw, PAGE_KEY_DDL, keep=("value", "seq"))
    page = known(F.col("start")).isNull() & _field(F.col("page"), "page").isNotNull()
    return r.where(~is_object("value") | ~_has_keys(F.col) | ~page).select("value", "seq")


def start_rows(log: DataFrame) -> DataFrame:
    return log.where(F.col("start").isNotNull())


def page_rows(log: DataFrame) -> DataFrame:
    return log.where(F.col("start").isNull() & F.col("page").isNotNull())


def display_rows(log: DataFrame) -> DataFrame:
    """One flat map per display element, plus the parent's ``seq`` and position.

    What a record lays over its displays is merged once, before they are exploded.
    """
    src = log.where(F.col("start").isNull() & F.col("displays").isNotNull())
    over = overlay(F.create_map(F.lit("ts"), F.col("ts").cast("variant")), "common", "page")
    ex = src.select("seq", "displays", over.alias("over")).select("seq", "over", F.posexplode("displays").alias("pos", "d"))
    return ex.select("seq", "pos", overlay("d", "over").alias("display"))


def split_log(log: DataFrame) -> dict[str, DataFrame]:
    """The three detail streams, by name."""
    return {START: start_rows(log), PAGE: page_rows(log), DISPLAY: display_rows(log)}


def detail_json(df: DataFrame, kind: str) -> DataFrame:
    """Serialize a detail stream to its topic text, ``extra`` fields included; null entries are left out."""
    if kind == DISPLAY:
        return df.select(F.to_json(without_nulls("display")).alias("value"), "seq")
    parts = {
        "common": F.to_variant_object(without_nulls("common")),
        "start": F.col("start"),
        "page": F.to_variant_object(without_nulls("page")),
        "displays": F.to_variant_object(F.transform("displays", without_nulls)),
        "ts": F.col("ts").cast("variant"),
    }
    record = F.create_map(*[x for n, c in parts.items() if n in df.columns for x in (F.lit(n), c)])
    if "extra" in df.columns:
        record = overlay("extra", without_nulls(record))
    return df.select(F.to_json(without_nulls(record)).alias("value"), "seq")
