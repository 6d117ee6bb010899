"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import written


def _mark(links: DataFrame) -> tuple[int, int]:
    return tuple(links.select(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)``; the root is the least node of the component.

    Each round links every node to the least node it knows, first over its
    larger neighbours, then over its smaller ones; rounds grow with the
    logarithm of the longest chain. A round is written to the shared folder,
    so lineage stays short and a lost executor costs at most one round. The
    minimum per node has a partial step, and the join back has one row per
    node on one side, so a hub is split by AQE. No links reach the driver:
    rounds end when count and checksum of the links stay the same.
    """
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        # large star: neighbours above a node move to the least of its neighbourhood
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours move to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = _mark(links)
        if now == mark:
            break
        mark = now
    pairs = links.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())
