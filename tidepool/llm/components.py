"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _to_least(both: DataFrame) -> DataFrame:
    """Each (u, v) with the least node next to u, or u itself. The aggregate combines before its shuffle;
    the join leaves a node with very many links to the skew handling of adaptive execution."""
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    return both.join(least, both["u"] == least["w"]).select("u", "v", F.least("u", "m").alias("m"))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) of every node with a link; component is the least node that can be reached.

    Links are undirected; repeats, self links and links with a null end are let be. No links: an empty
    table. All state stays in Spark: a step is one combined aggregate, one join and one distinct, its result
    is checkpointed in the shared folder, and only a count and a checksum come to the driver. The edges
    end as stars around the least nodes, after a number of steps logarithmic in the longest path.
    """
    a, b = F.col(src), F.col(dst)
    e = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    e = cut_lineage(e)
    before = _state(e)
    while before[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # large star: neighbours above u go to the least neighbour of u
        large = _to_least(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # small star: u and its neighbours below go to the least of them (here b < a always)
        small = _to_least(large.select(F.col("a").alias("u"), F.col("b").alias("v")))
        e = small.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
        e = cut_lineage(e.where("a != b").distinct())
        now = _state(e)
        if now == before:
            break
        before = now
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
