"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum (combined before the shuffle) and a join, and its result is written to
the shared folder. The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.frames import stored


def _tidy(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return _tidy(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    near = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _tidy(near.unionByName(least.select("a", F.col("m").alias("b"))))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) for each id in the columns ``a`` and ``b`` of ``links`` that is not its own component's least."""
    edges = stored(_tidy(links), "links")
    before = _state(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
