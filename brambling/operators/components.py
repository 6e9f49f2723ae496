"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brambling.runtime import cut, discard


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """One row (node, component) per node of an edge; component is the smallest node that can be reached.

    Nulls: edges with a null end are no edges; an edge from a node to itself makes it a node. Each round shuffles edges by
    node with minima taken before the shuffle; no neighbour list is ever collected. Rounds grow with the logarithm of the
    longest path. Every round is written to the shared folder and the one before it removed. Both sides of a round's joins are shuffled on the
    node, so that adaptive execution splits the partitions of nodes with very many neighbours (spark.sql.adaptive.skewJoin). An
    empty input gives an empty result.
    """
    e = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull()).distinct()
    e = cut(e, "edges")
    nodes = _both(e).select(F.col("u").alias("node")).distinct()
    cur = e.where("u <> v")
    seen = None
    for _ in range(max_rounds):
        both = _both(cur).distinct()
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select("u", F.col("v"), "m")
        before = cur
        cur = cut(small.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct(), "stars")
        state = cur.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        discard(before)
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"no fixpoint after {max_rounds} rounds")
    return nodes.join(cur.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
