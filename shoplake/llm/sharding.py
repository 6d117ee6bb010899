"""Sharding by a two-pass external shuffle.

Pass one scatters records uniformly, by a seeded hash of the whole record,
into as many buckets as keep one bucket small enough for memory. Pass two
orders each bucket by a Fisher-Yates permutation (Spark's seeded ``shuffle``
of the bucket's index list) and writes it. Bucket after bucket the records
then have places 0 .. N-1 of a random order of everything; shard ``s`` takes
places ``floor(s*N/k)`` up to ``floor((s+1)*N/k)``, so counts are at most one
apart and a bucket touches one or two shards, which keeps files few.

Only the permutation of a bucket (8 bytes per record) is held whole; records
are sorted with spilling and moved once. Each bucket's permutation depends on
(seed, bucket) alone, so a task that is run again gives the same places.

Null and edge cases: a null text has size 1 and CRC 0; null ids are ordinary
values; rows that are equal in every column share a bucket and take its
places in any order; extra columns are written along; columns of the input
with one of the result's names are kept out of the shard files. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from shoplake.llm.common import fresh
from shoplake.session import scratch_dir

SHARDS = 16
BUCKET_BYTES = 64 << 20
SEED = 20260401
OWN = ("shard", "slot")


def shuffle_to_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED, text: str = "text",
) -> DataFrame:
    """Writes ``docs`` as Parquet under ``path/shard=<s>`` and returns the written rows with ``shard, slot``.

    Row law: shard counts differ by one at most.
    """
    keep = [c for c in docs.columns if c.lower() not in OWN]
    docs = docs.select(*keep)
    bucket, mark, idx, place, before, perm, n_rows = (fresh(n, keep) for n in ("bucket", "mark", "idx", "place", "before", "perm", "n_rows"))
    size = F.coalesce(F.octet_length(text), F.lit(0)) + 1
    n, total = docs.select(F.count(F.lit(1)), F.sum(size.cast("bigint"))).first()
    buckets = max(1, -(-(total or 0) // bucket_bytes))
    hashable = [f.name for f in docs.schema.fields if not isinstance(f.dataType, MapType)]
    marked = docs.withColumn(mark, F.xxhash64(F.lit(seed), *hashable))
    marked = marked.withColumn(bucket, F.pmod(mark, F.lit(buckets)).cast("int"))
    counts = marked.groupBy(bucket).agg(F.count(F.lit(1)).alias(n_rows))
    # one row per bucket: total bytes / bucket_bytes rows in one window
    sums = F.sum(n_rows).over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    perms = (
        counts.withColumn(before, F.coalesce(sums, F.lit(0)))
        .repartitionById(buckets, F.col(bucket))  # partition = bucket, so the seed of a permutation is seed + bucket
        .select(F.col(bucket), before, F.shuffle(F.sequence(F.lit(1).cast("bigint"), F.col(n_rows)), F.lit(seed)).alias(perm))
    )
    numbered = marked.withColumn(idx, F.row_number().over(Window.partitionBy(bucket).orderBy(mark)))
    p = (F.col(before) + F.element_at(perm, F.col(idx))).alias(place)  # 1 .. N
    placed = numbered.join(perms, bucket).select(*keep, p)
    big = F.lit(n).cast("decimal(20,0)")
    shard = F.floor((F.col(place).cast("decimal(20,0)") * shards - 1) / big) if n else F.lit(0)
    out = placed.withColumn("shard", shard.cast("int"))
    first = F.floor(F.col("shard").cast("decimal(10,0)") * big / shards).cast("bigint")
    out = out.withColumn("slot", (F.col(place) - 1 - first).cast("bigint")).drop(place)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


def shard_digests(docs: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Shards ``docs`` and returns one row per document, derived from the written shard files."""
    path = scratch_dir(docs.sparkSession, "shards")
    written = shuffle_to_shards(docs, path, shards, bucket_bytes)
    body = F.coalesce(F.col("text"), F.lit(""))
    return written.select(
        "doc_id",
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard"),
        F.col("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
