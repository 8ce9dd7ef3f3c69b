"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulbook.llm.common import skew_join, written

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    both = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(both)).first())


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    larger = both.filter(F.col("b") > F.col("a"))
    return skew_join(larger, least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = skew_join(edges, least, ["a"]).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), root being the smallest node of its component.

    Null ends, loops and repeated links are ignored; a node without links does not occur. Each round
    is a few shuffles of the links, written to the shared folder; the number of rounds grows with the
    logarithm of the longest path. Minima are combined before the shuffle and the joins can be split, so
    a node with very many links is no hot spot.
    """
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    edges = written(links.filter("a <> b").select(*ends).distinct(), "links")
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        edges = written(_small(_large(edges)), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components: no end after {MAX_ROUNDS} rounds")
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
