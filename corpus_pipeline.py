"""Cleaning a corpus for training: reject toxic texts, drop copies and near copies, cut benchmark passages, pack.

Each stage takes ``(spark, docs, sf_dir)``; its result is written and read
back before the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm.common import fresh, strip_ascii_space, table, text_or_empty, written
from shoplake.llm.decontam import RESULT, find_leaks
from shoplake.llm.exact_dedup import exact_dedup
from shoplake.llm.packing import pack_documents
from shoplake.llm.simhash import near_duplicates
from shoplake.llm.toxicity import score_toxicity

#: The toxicity stage learns from rows, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def _one_row(docs: DataFrame, chosen: DataFrame, mark: str) -> DataFrame:
    """The rows of ``docs`` that ``chosen (mark, keep_id)`` names, one for each of its rows.

    ``mark`` identifies a text, so ids that are null or repeat do no harm.
    """
    c = chosen.select(F.col(mark).alias("_m"), "keep_id")
    hit = docs.join(c, (docs[mark] == c["_m"]) & docs["doc_id"].eqNullSafe(c["keep_id"]), "left_semi")
    return hit.dropDuplicates([mark, "doc_id"])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the reject mark go.

    A row goes exactly when its own text is rejected, also without id or with another row's id.
    """
    mark = fresh("text_mark", docs.columns)
    marked = docs.withColumn(mark, F.sha2(text_or_empty(), 256))
    scored = score_toxicity(marked, table(spark, sf_dir, "labels"), keep=mark)
    rejected = written(scored.where("predicted = 1").select(F.col("doc_id").alias("_id"), F.col("kept").alias("_m")).distinct(), "rejected")
    own = (marked[mark] == rejected["_m"]) & marked["doc_id"].eqNullSafe(rejected["_id"])
    return marked.join(rejected, own, "left_anti").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    mark = fresh("text_mark", docs.columns)
    kept = exact_dedup(docs).where("kept").select(F.col("text_sha256").alias(mark), "keep_id").distinct()
    # of rows that repeat the keeper's id, the one with the most characters
    marked = docs.withColumn(mark, F.sha2(strip_ascii_space(text_or_empty()), 256))
    return _one_row(marked, kept, mark).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one that names it."""
    mark = fresh("text_mark", docs.columns)
    marked = docs.withColumn(mark, F.sha2(text_or_empty(), 256))
    near = near_duplicates(marked.select("doc_id", mark, "text"))
    named = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = near.where(named).groupBy("root").agg(F.min(mark).alias(mark), F.first("component_id").alias("keep_id"))
    return _one_row(marked, kept.select(mark, "keep_id"), mark).select(*docs.columns)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; clean documents stay as they are."""
    return find_leaks(docs, table(spark, sf_dir, "benchmark"), cut=True).drop(*RESULT).select(*docs.columns)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in windows of tokens."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", cut_benchmark),
    ("packing", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
