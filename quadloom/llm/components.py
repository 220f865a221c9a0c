"""Connected components of an edge table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadloom.llm.common import checkpointed


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``u`` and the smallest vertex ``v`` of its component, for every vertex that isn't the smallest.

    ``edges`` has columns u and v of one type that sorts. A round joins all
    larger neighbours of a vertex, then all smaller ones, to the smallest; it
    ends when the edges are stars, after a number of rounds that grows with
    the logarithm of the number of vertices. Each round is written, so no
    lineage grows. The neighbours of one vertex are never in one list: minima
    are combined before the shuffle, and Spark may divide a hot vertex in the
    joins. Null vertices and loops are left out; no edges give no rows.
    """
    real = edges.where("u <> v")
    now = checkpointed(real.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before, signature = None, _signature(now)
    while signature != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (
            both.join(least, F.col("u") == F.col("k"))
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(least, F.col("u") == F.col("k"))
        now = checkpointed(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v")))
            .distinct()
        )
        before, signature = signature, _signature(now)
    return now
