"""Exact dedup by content-defined chunk recipes.

Every normalised text is cut into chunks at places its own characters decide.
A chunk travels once: distinct chunks meet by hash, and a hash that stands for
more than one text is found there and refined, so a chunk identifier is
verified against the chunk's characters. From then on a document is its
*recipe*, the ordered list of identifiers (about 8 bytes per 700 characters),
and two documents are equal exactly when their recipes are. Long documents
are moved once, in pieces, and never compared or sorted whole.

Null and edge cases: a null text counts as empty; empty texts have the empty
recipe and form one group. A null ``doc_id`` loses every tie and its row is
kept only when its whole group has none. Rows that repeat both ``doc_id`` and
length of the keeper are all ``kept``. Extra input columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import strip_ascii_space, text_or_empty, written

MIN_CHUNK, MAX_CHUNK = 512, 4096
#: A cut follows an ASCII character with code = 3 mod 16 and then one with code = 8 mod 16.
CUT_PAIR = "[#3CScs][(8HXhx]"
_NO_ID = "10000000000000000000"  # stands for a null doc_id, past every bigint
_STEP = "100000000000000000000"


def chunks_of(norm: Column, min_chars: int = MIN_CHUNK, max_chars: int = MAX_CHUNK) -> Column:
    """Content-defined chunks: at least ``min_chars`` up to the first cut pair, at most ``max_chars``."""
    pattern = f"(?s).{{{min_chars},{max_chars - 2}}}?{CUT_PAIR}|.{{1,{max_chars}}}"
    return F.regexp_extract_all(norm, F.lit(pattern), F.lit(0))


def _key(chunk: Column, key_bits: int) -> Column:
    h = F.xxhash64(chunk)
    return h if key_bits == 64 else h.bitwiseAND(F.lit((1 << key_bits) - 1).cast("bigint"))


def recipes(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """``doc_id, n_chars, text_sha256, recipe``: the recipe holds verified chunk identifiers, two numbers each.

    ``key_bits`` below 64 forces hash clashes, for tests of the refinement.
    """
    norm = docs.select("doc_id", F.length(text_or_empty()).alias("n_chars"), strip_ascii_space(text_or_empty()).alias("norm"))
    cut = norm.select("doc_id", "n_chars", F.sha2("norm", 256).alias("text_sha256"), chunks_of(F.col("norm")).alias("chunks"))
    raw = written(
        cut.select("doc_id", "n_chars", "text_sha256", F.transform("chunks", lambda c: _key(c, key_bits)).alias("keys")),
        "recipes",
    )
    pieces = cut.select(F.explode("chunks").alias("chunk")).select(_key(F.col("chunk"), key_bits).alias("key"), "chunk").distinct()
    # a key that stands for several texts: each text but the first gets its own rank
    clashing = written(pieces.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "clashing-keys")
    if clashing.isEmpty():
        return raw.select("doc_id", "n_chars", "text_sha256", F.col("keys").alias("recipe"))
    ranked = pieces.join(clashing, "key", "left_semi").withColumn(
        "rank", F.dense_rank().over(Window.partitionBy("key").orderBy("chunk")).cast("bigint")
    )
    ranked = written(ranked, "clashing-chunks")
    texts = raw.select("text_sha256", F.explode(F.array_distinct("keys")).alias("key")).join(clashing, "key", "left_semi").select("text_sha256").distinct()
    exact = (
        cut.join(texts, "text_sha256", "left_semi")
        .dropDuplicates(["text_sha256"])
        .select("text_sha256", F.posexplode("chunks").alias("pos", "chunk"))
        .withColumn("key", _key(F.col("chunk"), key_bits))
        .join(ranked, ["key", "chunk"], "left")
        .groupBy("text_sha256")
        .agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("rank", F.lit(0)).alias("rank")))).alias("ranks"))
    )
    return raw.join(exact, "text_sha256", "left").select(
        "doc_id", "n_chars", "text_sha256",
        F.concat("keys", F.coalesce(F.transform("ranks", lambda r: r["rank"]), F.array().cast("array<bigint>"))).alias("recipe"),
    )


def exact_dedup(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, n_chunks``.

    Of equal texts the one with the most original characters, then the
    smallest ``doc_id``, stays. The order is one decimal, so the grouping is
    a hash aggregation with a partial step: a hot group costs one row per
    task. The join back has one row per recipe on one side, so AQE can split
    a hot recipe.
    """
    r = recipes(docs, key_bits)
    step, none = F.lit(_STEP).cast("decimal(21,0)"), F.lit(_NO_ID).cast("decimal(20,0)")
    order = (F.col("n_chars").cast("decimal(10,0)") * step - F.coalesce(F.col("doc_id").cast("decimal(20,0)"), none)).cast("decimal(38,0)")
    groups = (
        r.select("recipe", "n_chars", order.alias("o"))
        .groupBy("recipe")
        .agg(F.max("n_chars").alias("most"), F.max("o").alias("o"), F.count(F.lit(1)).alias("group_size"))
    )
    least = (F.col("most").cast("decimal(10,0)") * step - F.col("o")).cast("decimal(20,0)")
    groups = groups.select("recipe", "most", "group_size", F.when(least != none, least).cast("bigint").alias("keep_id"))
    return r.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("most"))).alias("kept"),
        "text_sha256", F.size("recipe").alias("n_chunks"),
    )
