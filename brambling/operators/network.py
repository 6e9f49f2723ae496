"""Co-occurrence networks: edges, nodes, paths and a layout."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brambling.runtime import attach, cut, discard

ALL = "ALL"


def edges(bridge: DataFrame, group: str, node: str, layers: Sequence[str] = (), chunk: int = 256) -> DataFrame:
    """(layer, source, target, weight): groups shared by two nodes, source < target, over all (`ALL`) and by layer column.

    Null nodes and groups are left out; repeated rows count once. Nodes of a group of more than `chunk` are dealt into cells, and
    the self-join meets cell by cell, so that one group's pairs are spread over tasks.
    """
    x = bridge.select(F.col(group).alias("g"), F.col(node).alias("n"), *layers).where("g IS NOT NULL AND n IS NOT NULL")
    tags = F.array(F.lit(ALL), *[F.col(c) for c in layers])
    x = cut(x.select("g", "n", F.explode(F.array_distinct(tags)).alias("layer")).where("layer IS NOT NULL").distinct(), "bridge")
    sizes = x.groupBy("layer", "g").agg(F.count("*").alias("k")).where("k > 1")
    dealt = attach(x, sizes, ["layer", "g"], "k", x.count(), ["n"]).withColumn("cells", F.ceil(F.col("k") / chunk).cast("int"))
    dealt = dealt.withColumn("c", F.pmod(F.xxhash64("n"), F.col("cells")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    left = dealt.select("layer", "g", F.col("n").alias("source"), "c", every.alias("d"))
    right = dealt.select("layer", "g", F.col("n").alias("target"), F.col("c").alias("d"), every.alias("c"))
    return left.join(right, ["layer", "g", "c", "d"]).where("source < target").groupBy("layer", "source", "target").agg(F.count("*").alias("weight"))


def both_ends(e: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("source").alias("node_id"), F.col("target").alias("other")), F.struct(F.col("target").alias("node_id"), F.col("source").alias("other")))
    return e.select("layer", "weight", F.explode(ends).alias("x")).select("layer", "x.*", "weight")


def nodes(bridge: DataFrame, group: str, node: str, e: DataFrame, cap: int | None = None) -> DataFrame:
    """(node_id, degree, weighted_degree, n_publications): neighbours, sum of weights and groups of every node.

    cap: keep the nodes of highest weighted degree (ties by id); the weighted degree stays that of the full network, the degree
    counts neighbours kept.
    """
    e = e.where(F.col("layer") == ALL)
    count = bridge.select(F.col(group).alias("g"), F.col(node).alias("node_id")).where("g IS NOT NULL AND node_id IS NOT NULL").distinct().groupBy("node_id").agg(F.count("*").alias("n_publications"))
    ends = both_ends(e)
    per = ends.groupBy("node_id").agg(F.count("*").alias("degree"), F.sum("weight").cast("bigint").alias("weighted_degree"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    full = count.join(per, "node_id", "left").select("node_id", zero("degree"), zero("weighted_degree"), "n_publications")
    if cap is None:
        return full
    kept = full.orderBy(F.desc("weighted_degree"), "node_id").limit(cap)
    ids = kept.select("node_id")
    inside = ends.join(ids, "node_id").join(ids.select(F.col("node_id").alias("other")), "other").groupBy("node_id").agg(F.count("*").alias("d"))
    return kept.drop("degree").join(inside, "node_id", "left").select("node_id", F.coalesce("d", F.lit(0)).cast("bigint").alias("degree"), "weighted_degree", "n_publications")


def edge_id() -> F.Column:
    return F.concat_ws("::", "layer", "source", "target")


def paths(e: DataFrame, coords: DataFrame) -> DataFrame:
    """Two rows per edge between placed nodes: edge_id, layer, node_id, x, y."""
    at = coords.select("node_id", "x", "y")
    placed = e.join(at.select(F.col("node_id").alias("source")), "source", "left_semi").join(at.select(F.col("node_id").alias("target")), "target", "left_semi")
    ends = placed.select(edge_id().alias("edge_id"), "layer", F.explode(F.array("source", "target")).alias("node_id"))
    return ends.join(at, "node_id").select("edge_id", "layer", "node_id", "x", "y")


def spring(names: list[str], pairs: list[tuple[str, str, float]], rounds: int = 120, seed: int = 11) -> dict[str, tuple[float, float]]:
    """Force-directed places in [0, 1] on both axes; the same input gives the same places."""
    names = sorted(names)
    n = len(names)
    if n == 0:
        return {}
    at = {v: i for i, v in enumerate(names)}
    pos = np.random.default_rng(seed).random((n, 2))
    w = np.zeros((n, n))
    for a, b, x in pairs:
        w[at[a], at[b]] = w[at[b], at[a]] = np.log1p(x)
    ideal = 1 / np.sqrt(n)
    for r in range(rounds):
        d = pos[:, None] - pos[None]
        dist = np.maximum(np.linalg.norm(d, axis=2), 1e-6)
        push = (ideal**2 / dist**2)[..., None] * d
        pull = (w * dist / ideal)[..., None] * d * 0.05
        step = (push - pull).sum(1)
        size = np.maximum(np.linalg.norm(step, axis=1, keepdims=True), 1e-9)
        pos += step / size * np.minimum(size, 0.1 * (1 - r / rounds))
    lo, hi = pos.min(0), pos.max(0)
    pos = np.where(hi > lo, (pos - lo) / np.where(hi > lo, hi - lo, 1), 0.5)
    return {v: (round(float(x), 6), round(float(y), 6)) for v, (x, y) in zip(names, pos, strict=True)}


def layout(kept: DataFrame, e: DataFrame, max_nodes: int = 5_000, rounds: int = 3) -> DataFrame:
    """(node_id, x, y) of the nodes of `kept`, placed by the `ALL` edges among them.

    Up to `max_nodes` nodes are placed by springs, which look at all of them at once, in one task. Of more, those of highest weighted degree
    (ties by id) are; the others follow from them, all tasks taking part: each goes to the mean of its placed neighbours by
    weight, in up to `rounds` rounds, a little aside by a hash of its id; what no path of that length ties to a placed node lies where the
    hash says. All places are in [0, 1].
    """
    ids = cut(kept.select("node_id"), "kept")
    every = e.where(F.col("layer") == ALL).join(ids.select(F.col("node_id").alias("source")), "source", "left_semi").join(ids.select(F.col("node_id").alias("target")), "target", "left_semi")
    if ids.count() <= max_nodes:
        return _springs(ids, every)
    ends = cut(both_ends(every), "ends")
    weights = ids.join(ends.groupBy("node_id").agg(F.sum("weight").alias("w")), "node_id", "left")
    core = cut(weights.orderBy(F.desc_nulls_last("w"), "node_id").limit(max_nodes).select("node_id"), "core")
    sides = [core.select(F.col("node_id").alias(c)) for c in ("source", "target")]
    placed = cut(_springs(core, every.join(F.broadcast(sides[0]), "source", "left_semi").join(F.broadcast(sides[1]), "target", "left_semi")), "placed")
    spot = lambda salt: F.pmod(F.xxhash64(F.lit(salt), "node_id"), F.lit(2**20)) / F.lit(float(2**20))
    for _ in range(rounds):
        open_ = ends.join(placed.select("node_id"), "node_id", "left_anti").join(placed.select(F.col("node_id").alias("other"), "x", "y"), "other")
        mean = open_.groupBy("node_id").agg(*[(F.sum(F.col(c) * F.col("weight")) / F.sum("weight")).alias(c) for c in "xy"])
        aside = lambda c: F.round(0.98 * F.col(c) + 0.02 * spot(c), 6).alias(c)
        before, placed = placed, cut(placed.unionByName(mean.select("node_id", aside("x"), aside("y"))), "placed")
        discard(before)
    rest = ids.join(placed.select("node_id"), "node_id", "left_anti").select("node_id", *[F.round(spot(c), 6).alias(c) for c in "xy"])
    return placed.unionByName(rest)


def _springs(ids: DataFrame, inside: DataFrame) -> DataFrame:
    rows = ids.select(F.lit(0).alias("one"), F.col("node_id").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(0.0).alias("w"))
    rows = rows.unionByName(inside.select(F.lit(0).alias("one"), F.col("source").alias("a"), F.col("target").alias("b"), F.col("weight").cast("double").alias("w")))

    def place(df: pd.DataFrame) -> pd.DataFrame:
        alone = df[df["b"].isna()]
        pairs = sorted(df[df["b"].notna()][["a", "b", "w"]].itertuples(index=False, name=None))
        got = spring(alone["a"].tolist(), pairs)
        return pd.DataFrame([(k, x, y) for k, (x, y) in got.items()], columns=["node_id", "x", "y"])

    return rows.groupBy("one").applyInPandas(place, "node_id string, x double, y double")
