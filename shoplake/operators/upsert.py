"""Dimension tables kept by upsert: key extraction, latest row, table schema.

An upsert sets the columns its config row lists (absent ones to null); other
columns keep what is stored. All values are text. The key is the config's
``sink_pk`` (comma list allowed), ``id`` when null.

The last upsert is a partial-aggregating ``max_by`` per key and list of columns, so a
hot key never gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.functions.maps import stringify_values
from shoplake.operators.latest import earliest_per_key
from shoplake.settings import DEFAULT_DIM_PK


def pk_columns():
    return F.split(F.coalesce(F.col("sink_pk"), F.lit(DEFAULT_DIM_PK)), ",")


def upsert_rows(dim_rows: DataFrame) -> DataFrame:
    """Routed dimension rows -> ``sink_table, pk, seq, data`` (all text)."""
    data = stringify_values("data")
    pk = F.transform(pk_columns(), lambda k: F.col("data")[k])
    return dim_rows.select(
        "sink_table", pk.alias("pk"), "seq", data.alias("data"), "sink_columns", "sink_pk",
    )


def current_rows(upserts: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The stored table: per (sink_table, pk) and column, the value of the last upsert that lists the column.

    ``order`` names the columns that rank upserts, ``seq`` by default. The last upsert per key and
    list of columns is found first; of a key's lists, as few as its config rows, the later ones lie over the earlier.
    """
    cells = F.transform(F.array_distinct(F.split("sink_columns", ",")), lambda c: F.struct(c.alias("column"), F.col("data")[c].alias("value")))
    row = F.struct(F.struct(*(order or ["seq"])).alias("rank"), "sink_columns", "seq", "sink_pk", cells.alias("cells"))
    lists = upserts.where("sink_columns is not null").groupBy("sink_table", "pk", "sink_columns").agg(F.max_by(row, row["rank"]).alias("_row"))
    rows = lists.groupBy("sink_table", "pk").agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
    rows = rows.withColumn("_last", F.element_at("_rows", -1)).withColumn("_cells", F.flatten(F.col("_rows.cells")))
    columns = F.col("_cells.column")
    newest = F.filter("_cells", lambda e, i: ~F.array_contains(F.slice(columns, i + 2, F.size(columns)), e["column"]))
    return rows.select("sink_table", "pk", "_last.seq", F.map_from_entries(newest).alias("data"), "_last.sink_columns", "_last.sink_pk")


def table_schemas(dim_rows: DataFrame) -> DataFrame:
    """Table created by the first row of each target table: one row per column.

    Columns: ``sink_table, position, column_name, data_type, is_pk, extend``.
    All columns are text; the key is ``sink_pk`` or ``id``.
    """
    first = earliest_per_key(
        dim_rows.select("sink_table", "seq", "sink_columns", "sink_pk", "sink_extend"),
        ["sink_table"], ["seq"],
    )
    cols = first.select(
        "sink_table", "sink_pk", "sink_extend",
        F.posexplode(F.split("sink_columns", ",")).alias("position", "column_name"),
    )
    return cols.select(
        "sink_table",
        "position",
        "column_name",
        F.lit("string").alias("data_type"),
        F.array_contains(pk_columns(), F.col("column_name")).alias("is_pk"),
        F.coalesce(F.col("sink_extend"), F.lit("")).alias("extend"),
    )
