"""Database change records: clean, route by the config table, split by sink.

Flow: strip the bootstrap prefix on the raw text -> parse -> keep inserts and
updates with a non-empty ``data`` -> inner join with the config on
(table, type) -> keep only the configured columns -> split by ``sink_type``
(kafka: topic rows, hbase: dimension rows, anything else: dropped).

The config table is small, so it is broadcast, by a hint, and the change stream is not shuffled:
by its own estimate of parsed text the planner may broadcast the changes instead. A change
stream of the config is joined as of each change's position instead, both sides shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplake.functions.jsonio import is_object, parse_once
from shoplake.functions.maps import keep_keys, without_nulls
from shoplake.schemas import CHANGE_DDL, CHANGE_TEXT_DDL, TABLE_PROCESS_COLUMNS
from shoplake.sources.config_source import keep_additions
from shoplake.settings import BOOTSTRAP_PREFIX, KEPT_CHANGE_TYPES, SINK_TO_HBASE, SINK_TO_KAFKA


POSITION_BUCKETS = 1024  # any value gives the same rows


def strip_bootstrap(value: str = "value"):
    """Remove every ``bootstrap-`` in the whole text, before parsing.

    Faithful to the original: it also edits values that contain the text.
    """
    return F.regexp_replace(F.col(value), F.lit(BOOTSTRAP_PREFIX), F.lit(""))


def clean_changes(raw: DataFrame) -> DataFrame:
    """``(value, seq)`` -> ``seq, value, database, table, type, ts, data`` of kept rows (``value``: the stripped text)."""
    r = parse_once(raw.withColumn("value", strip_bootstrap("value")), CHANGE_DDL, keep=("seq", "value"))
    keep = (
        F.col("database").isNotNull()
        & F.col("table").isNotNull()
        & F.col("type").isin(*KEPT_CHANGE_TYPES)
        & F.col("data").isNotNull()
        & (F.size("data") > 0)
    )
    return r.where(keep)


def malformed_changes(raw: DataFrame) -> DataFrame:
    """Rows whose text is no JSON object (others that ``clean_changes`` drops are left out by rule)."""
    return raw.where(~F.coalesce(is_object(strip_bootstrap("value")), F.lit(False))).select("value", "seq")


def one_per_key(config: DataFrame) -> DataFrame:
    """One config row per (``source_table``, ``operate_type``)."""
    rest = [c for c in TABLE_PROCESS_COLUMNS if c not in ("source_table", "operate_type")]
    top = config.groupBy("source_table", "operate_type").agg(F.max(F.struct(*rest)).alias("_row"))
    return top.select("source_table", "operate_type", "_row.*").select(*TABLE_PROCESS_COLUMNS)


def route_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Attach each change's config row; unmatched changes are dropped.

    ``seq``, ``value`` and ``data`` go on; ``data`` keeps only the keys in
    ``sink_columns``. Config rows that repeat a key count
    once, so a change is never doubled: of a snapshot, which has no order, the
    greatest row by its columns.
    """
    tp = one_per_key(config)
    cond = (changes["table"] == tp["source_table"]) & (changes["type"] == tp["operate_type"])
    joined = changes.join(F.broadcast(tp), cond, "inner")
    return joined.select(
        "seq",
        "value",
        keep_keys("data", "sink_columns").alias("data"),
        *[tp[c] for c in TABLE_PROCESS_COLUMNS],
    )


def route_changes_as_of(changes: DataFrame, config_changes: DataFrame, buckets: int = POSITION_BUCKETS) -> DataFrame:
    """Attach to each change the config row that was in force at its position.

    ``config_changes`` has the config columns, ``op`` and ``seq``, on the same positions
    as the changes; a config row is in force from its own position on,
    until the next addition of its key. A deleted row stays in force. The columns are those of
    ``route_changes`` and ``config_seq``, the position of the row used. A replayed
    change always meets the same row.

    Positions are cut into ``buckets`` spans; a version is copied to those that
    it reaches, a change is in one, and they meet on (table, type, span). So a table with
    any share of the changes spreads over tasks, and a version meets only its neighbours.
    """
    key = Window.partitionBy("source_table", "operate_type").orderBy("config_seq")
    v = keep_additions(config_changes).withColumnRenamed("seq", "config_seq").withColumn("_until", F.lead("config_seq").over(key))
    low, high = changes.agg(F.min("seq"), F.max("seq")).first()
    if low is None:
        low = high = 0
    span = max(1, -(-(high - low + 1) // buckets))

    def bucket(position):
        return F.floor((position - F.lit(low)) / F.lit(span)).cast("bigint")

    first = F.greatest(bucket(F.col("config_seq")), F.lit(0).cast("bigint"))
    last = F.least(F.coalesce(bucket(F.col("_until") - 1), bucket(F.lit(high))), bucket(F.lit(high)))
    v = v.where(first <= last).withColumn("_bucket", F.explode(F.sequence(first, last)))
    c = changes.withColumn("_at", bucket(F.col("seq")))
    in_force = (c["seq"] >= v["config_seq"]) & (v["_until"].isNull() | (c["seq"] < v["_until"]))
    cond = (c["table"] == v["source_table"]) & (c["type"] == v["operate_type"]) & (c["_at"] == v["_bucket"]) & in_force
    return c.join(v.hint("merge"), cond, "inner").select(
        "seq", "value", keep_keys("data", "sink_columns").alias("data"), *[v[x] for x in TABLE_PROCESS_COLUMNS], "config_seq")


def topic_rows(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("sink_type") == SINK_TO_KAFKA).drop("value")


def dim_rows(routed: DataFrame) -> DataFrame:
    """Rows for dimension tables. Cells are text as written in the record (``3.0`` stays ``3.0``),
    so these rows, the fewer ones, are parsed again for it."""
    rows = routed.where(F.col("sink_type") == SINK_TO_HBASE)
    cells = F.from_json("value", CHANGE_TEXT_DDL)["data"]
    return rows.withColumn("data", keep_keys(cells, "sink_columns")).drop("value")


def split_routes(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows for topics, rows for dimension tables)."""
    return topic_rows(routed), dim_rows(routed)


def topic_records(rows: DataFrame) -> DataFrame:
    """Topic-sink form: ``topic`` = the config's ``sink_table``, ``value`` = data JSON, JSON types kept, without null fields."""
    return rows.select(F.col("sink_table").alias("topic"), F.to_json(without_nulls("data")).alias("value"), "seq")
