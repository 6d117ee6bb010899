"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplake.llm.common import table
from shoplake.llm.decontam import leak_digests
from shoplake.llm.exact_dedup import exact_dedup
from shoplake.llm.licences import licence_scan
from shoplake.llm.metric_tree import top_k
from shoplake.llm.packing import pack_documents
from shoplake.llm.pii import pii_digests
from shoplake.llm.prefix_trie import prefix_trie
from shoplake.llm.sharding import shard_digests
from shoplake.llm.simhash import component_digests
from shoplake.llm.suffix_dedup import remove_repeats
from shoplake.llm.toxicity import score_toxicity
from shoplake.llm.warc import archive_pages
from shoplake.llm.whitening import whiten


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("n_chunks")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digests(table(spark, sf_dir, "documents"))


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("evidence")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digests(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return component_digests(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_metric_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_warc,
        op3_suffix_dedup,
        op4_sharding,
        op5_licence_scan,
        op6_benchmark_decontamination,
        op7_toxicity,
        op8_pii,
        op9_simhash,
        op10_packing,
        op11_whitening,
        op12_prefix_trie,
        op13_metric_tree,
    )
}

ORACLE_SQL = {
    "op1_exact_dedup": r"""
        with t as (
          select doc_id, length(coalesce(text, '')) as n,
                 sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
          from documents
        )
        select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size,
               doc_id = first_value(doc_id) over w as kept, text_sha256
        from t
        window w as (partition by text_sha256 order by n desc, doc_id)
    """,
    "op2_warc": """
        with p as (
          select page_id, encode(coalesce(html, '')) as b from pages
        ), q as (
          select page_id, octet_length(b) as payload_bytes, sha1(b) as payload_digest,
                 max(page_id) over (partition by b) as winner from p
        )
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 1000 and page_id <> winner then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 1000 and page_id <> winner then winner end as refers_to
        from q
    """,
    "op13_metric_tree": """
        with v as (
          select vec_id, list_transform(embedding, lambda c: cast(floor(256 * cast(c as double)) as bigint)) as x
          from embeddings
          where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
        ), s as (
          select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.x, c.x) as bigint) as score
          from v q join v c on q.vec_id <> c.vec_id
          where q.vec_id % 50 = 0
        )
        select query_id, cast(row_number() over w as integer) as rank, vec_id, score
        from s
        window w as (partition by query_id order by score desc, vec_id)
        qualify rank <= 5
    """,
}
