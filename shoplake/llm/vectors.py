"""Embedding rows as integer vectors, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scaled entries at or beyond this take no part, like non-finite ones: sums and products would leave the long type.
LIMIT = float(1 << 40)


def scaled_entries(vector: Column, factor: float, limit: float = LIMIT) -> Column:
    """``floor(factor * c)`` of each entry as an array of longs; null for a vector that is null or holds a null, non-finite or too large entry."""
    v = F.transform(vector, lambda c: c.cast("double") * F.lit(factor))
    sound = F.forall(v, lambda c: F.coalesce(F.abs(c) < F.lit(limit), F.lit(False)) & ~F.isnan(c))
    return F.when(vector.isNotNull() & sound, F.transform(v, lambda c: F.floor(c).cast("bigint")))


def usable(embeddings: DataFrame, factor: float, add: int = 0, limit: float = LIMIT) -> DataFrame:
    """``vec_id, x`` of every row that takes part; a row shorter than the longest counts as filled up with zeros."""
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled_entries(F.col("embedding"), factor, limit).alias("x")).where("x is not null")
    size = rows.select(F.max(F.size("x"))).first()[0] or 0
    x = F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(size) - F.size("x")))
    return rows.withColumn("x", F.transform(x, lambda c: c + F.lit(add).cast("bigint")) if add else x)


def matrix(column: pa.Array, dtype=np.int64) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
