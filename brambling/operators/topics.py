"""Clusters of texts within domains, their terms, and a map of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brambling.functions.text import tokens
from brambling.operators import kmeans
from brambling.runtime import cut, discard


def term_weights(texts: DataFrame, group: str, key: str, text: str) -> DataFrame:
    """(group, term, tf, df, weight): class TF-IDF. tf counts a term in the group, df the groups with it; weight = tf * ln(1 + groups / df)."""
    t = texts.select(group, F.explode(tokens(F.col(text))).alias("term"))
    tf = t.groupBy(group, "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    n = texts.select(group).distinct().count()
    return tf.join(df, "term").withColumn("weight", F.round(F.col("tf") * F.log(1 + F.lit(float(n)) / F.col("df")), 6))


def top_terms(weights: DataFrame, group: str, k: int = 8, in_label: int = 4) -> DataFrame:
    """(group, top_terms, label): the k terms of most weight, ties by term, and the first of them as a label."""
    w = Window.partitionBy(group).orderBy(F.desc("weight"), "term")
    top = weights.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
    ordered = top.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("r", "term"))).alias("t")).withColumn("t", F.transform("t", lambda x: x["term"]))
    return ordered.select(group, F.array_join("t", ", ").alias("top_terms"), F.array_join(F.slice("t", 1, in_label), ", ").alias("label"))


def topic_count(n: int, min_docs: int, docs_per_topic: int) -> int:
    """Topics of a domain of n texts: one up to `min_docs` texts; beyond, one for `docs_per_topic` texts or sqrt(n / 2) where that is less, and two at least."""
    return 1 if n <= max(min_docs, 1) else max(2, min(n // docs_per_topic, round((n / 2) ** 0.5)))


def text_vectors(texts: DataFrame, key: str, text: str, domain: str) -> DataFrame:
    """(key, domain, features) of unit length: TF-IDF over every term of all texts, the terms of most texts numbered first; the driver holds the
    vocabulary. Null texts count as empty. Where no text has a word there is no row."""
    spark = texts.sparkSession
    t = texts.select(key, F.col(domain).cast("string").alias("domain"), F.coalesce(tokens(F.col(text)), F.array().cast("array<string>")).alias("tokens")).where(F.col("domain").isNotNull())
    t = cut(t, "tokens")
    df = t.select(F.explode(F.array_distinct("tokens")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    known = df.toArrow().sort_by([("df", "descending"), ("term", "ascending")])
    shape = f"`{key}` {texts.schema[key].dataType.simpleString()}, domain string, features struct<indices:array<int>,values:array<double>>"
    if not len(known):
        return t.select(key, "domain", F.lit(None).cast("struct<indices:array<int>,values:array<double>>").alias("features")).limit(0)
    idf = np.log((t.count() + 1) / (known["df"].to_numpy() + 1))
    shared = spark.sparkContext.broadcast((known["term"].combine_chunks(), idf))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf = shared.value
        for b in batches:
            lists = b.column("tokens")
            rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            number = pc.index_in(lists.flatten(), value_set=terms).to_numpy(zero_copy_only=False).astype(np.int64)
            pairs, tf = np.unique(rows * len(terms) + number, return_counts=True)
            rows, number = pairs // len(terms), pairs % len(terms)
            v = tf * idf[number]
            norm = np.sqrt(np.bincount(rows, v**2, minlength=len(lists)))
            v = v / np.where(norm > 0, norm, 1.0)[rows]
            ptr = pa.array(np.searchsorted(rows, np.arange(len(lists) + 1)), pa.int32())
            f = pa.StructArray.from_arrays([pa.ListArray.from_arrays(ptr, pa.array(x)) for x in (number.astype(np.int32), v)], ["indices", "values"])
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("domain"), f], names=[key, "domain", "features"])

    out = cut(t.mapInArrow(weigh, shape), "vectors")
    discard(t)
    return out


def given_vectors(df: DataFrame, key: str, vector: str, domain: str) -> DataFrame:
    """(key, domain, features) of unit length from a column of numbers, such as embeddings; rows without domain, vector or a number in it are left out."""
    whole = F.col(domain).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x))
    d = df.where(whole).select(key, F.col(domain).cast("string").alias("domain"), F.transform(vector, lambda x: x.cast("double")).alias("raw"))
    norm = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda a, x: a + x * x))
    places = F.transform("raw", lambda x, i: i)
    d = d.withColumn("_norm", F.when(norm > 0, norm).otherwise(1.0))
    return cut(d.select(key, "domain", F.struct(places.alias("indices"), F.transform("raw", lambda x: x / F.col("_norm")).alias("values")).alias("features")), "vectors")


def cluster(texts: DataFrame, key: str, text: str, domain: str, min_docs: int = 3, docs_per_topic: int = 25, seed: int = 5, max_iter: int = 100) -> DataFrame:
    """Topics of texts: cluster_vectors on their TF-IDF."""
    v = text_vectors(texts, key, text, domain)
    out = cluster_vectors(v, key, min_docs, docs_per_topic, seed, max_iter)
    discard(v)
    return out


def cluster_vectors(vec: DataFrame, key: str, min_docs: int = 3, docs_per_topic: int = 25, seed: int = 5, max_iter: int = 100, per_block: int = 2000) -> DataFrame:
    """(key, domain, topic_id, features) from (key, domain, features): k-means within each domain, k by its size; topics are numbered by size, largest
    first (topic_count). A domain of up to `min_docs` rows gets one topic. All domains are fitted in the same passes (kmeans.fit).

    `features` is sparse (indices, values). A fit goes on until its centers no longer move by k-means' tolerance; where `max_iter` ends it
    before, there is a warning. Fits are seeded and read rows in blocks of about `per_block` by key, so that a rerun gives the same clusters. No
    rows give no rows. The result is read from the blocks; `discard` removes them.
    """
    sizes = {r["domain"]: r["count"] for r in vec.groupBy("domain").count().orderBy("domain").collect()}
    if not sizes:
        return vec.select(key, "domain", F.lit(None).cast("string").alias("topic_id"), "features").limit(0)
    b = kmeans.blocks(vec, key, sizes, seed, per_block)
    centers, counts = kmeans.fit(b, {d: topic_count(n, min_docs, docs_per_topic) for d, n in sizes.items()}, seed, max_iter)
    names: dict[str, list[str]] = {}
    for d in sizes:
        order = np.argsort(-counts.get(d, np.ones(1)), kind="stable")
        number = np.empty(len(order), int)
        number[order] = np.arange(1, len(order) + 1)
        names[d] = [f"{d}_t{i}" for i in number]
    out = kmeans.assigned(b, key, vec.schema[key].dataType.simpleString(), centers, names)
    out.cut_path = b.cut_path
    return out


def anchors(n: int) -> tuple[np.ndarray, float]:
    """(n places in the unit square, radius): the places are at least four radii apart and a radius within the border."""
    side = int(np.ceil(np.sqrt(n)))
    step = 1.0 / side
    grid = np.array([((i % side + 0.5) * step, (i // side + 0.5) * step) for i in range(n)])
    return grid, step / 4


#: Terms that `_plane` holds as columns at a time.
WIDTH = 4096


def _plane(df: pd.DataFrame) -> pd.DataFrame:
    """(domain, term, bx, by): the two principal directions of the points (point, term, v) of one domain; fewer where they span less. Points by
    terms are a matrix of WIDTH terms at a time."""
    seen = df.dropna(subset=["term"])
    points, terms = np.sort(df["point"].unique()), np.sort(seen["term"].unique())
    row, col, v = np.searchsorted(points, seen["point"]), np.searchsorted(terms, seen["term"]), seen["v"].to_numpy()
    order = np.argsort(col, kind="stable")
    row, col, v = row[order], col[order], v[order]

    def slices() -> Iterator[tuple[int, np.ndarray]]:
        for a in range(0, len(terms), WIDTH):
            i, j = np.searchsorted(col, [a, a + WIDTH])
            m = np.zeros((len(points), min(WIDTH, len(terms) - a)))
            m[row[i:j], col[i:j] - a] = v[i:j]
            yield a, m - m.mean(0)

    val, vec = np.linalg.eigh(sum((m @ m.T for _, m in slices()), np.zeros((len(points), len(points)))))
    b = np.zeros((len(terms), 2))
    for i in range(min(2, len(val))):
        if val[-1 - i] > 1e-9:
            for a, m in slices():
                b[a : a + WIDTH, i] = m.T @ vec[:, -1 - i] / np.sqrt(val[-1 - i])
            b[:, i] *= np.sign(b[np.argmax(np.abs(np.round(b[:, i], 6))), i])
    return pd.DataFrame({"domain": df["domain"].iloc[0], "term": terms.astype("int32"), "bx": b[:, 0], "by": b[:, 1]})


def _projected(c: DataFrame, plane: DataFrame, key: str) -> DataFrame:
    """(key, domain, topic_id, px, py): texts on the directions of their domain, which the driver collects and every task gets: two numbers a term."""
    t = plane.toArrow().sort_by([("domain", "ascending"), ("term", "ascending")])
    by: dict[str, tuple[np.ndarray, ...]] = {}
    for d in pc.unique(t["domain"]).to_pylist():
        own = t.filter(pc.equal(t["domain"], d))
        by[d] = tuple(own[x].to_numpy() for x in ("term", "bx", "by"))
    shared = c.sparkSession.sparkContext.broadcast(by)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_domain = shared.value
        for b in batches:
            terms, values = b.column("indices"), b.column("values")
            row = np.repeat(np.arange(len(terms)), terms.value_lengths().to_numpy(zero_copy_only=False))
            idx, val = (x.flatten().to_numpy(zero_copy_only=False) for x in (terms, values))
            p, domain = np.zeros((2, len(terms))), b.column("domain").to_numpy(zero_copy_only=False)
            of = domain[row]
            for d in set(domain) & by_domain.keys():
                known, *axes = by_domain[d]
                i = np.flatnonzero(of == d)
                if len(known) and len(i):
                    at = np.minimum(np.searchsorted(known, idx[i]), len(known) - 1)
                    i, at = i[hit := known[at] == idx[i]], at[hit]
                    p += [np.bincount(row[i], val[i] * x[at], minlength=len(terms)) for x in axes]
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("domain"), b.column("topic_id"), *map(pa.array, p)], names=[key, "domain", "topic_id", "px", "py"])

    kind = c.schema[key].dataType.simpleString()
    return c.select(key, "domain", "topic_id", "features.indices", "features.values").mapInArrow(project, f"`{key}` {kind}, domain string, topic_id string, px double, py double")


def _spread(df: pd.DataFrame) -> pd.DataFrame:
    """(domain, topic_id, ax, ay, r) from the means (topic_id, mx, my) of one domain's topics: rows of the grid by my, places in a row by mx."""
    d = df.assign(mx=df["mx"].round(6), my=df["my"].round(6)).sort_values(["my", "topic_id"], ignore_index=True)
    grid, r = anchors(len(d))
    d["row"] = d.index // int(np.ceil(np.sqrt(len(d))))
    d = d.sort_values(["row", "mx", "topic_id"], ignore_index=True)
    return pd.DataFrame({"domain": d["domain"], "topic_id": d["topic_id"], "ax": grid[:, 0], "ay": grid[:, 1], "r": float(r)})


def map_places(clustered: DataFrame, key: str) -> DataFrame:
    """(key, domain, topic_id, map_x, map_y): places in the unit square in which every text is nearer its own topic's mean than any other
    of its domain: each topic has an anchor, its members lie within a radius of a quarter of the least distance of anchors.

    Texts are projected on the two principal directions of their domain's topic means (with fewer than three topics: of its
    different texts). The topics' projections order the anchors; a member's offset from its anchor is its own projection less the
    topic's mean, scaled so that the farthest member of a topic lies on the radius. A domain's means, topics by terms, are
    one task's.
    """
    c = clustered.join(F.broadcast(clustered.groupBy("domain").agg(F.count_distinct("topic_id").alias("topics"))), "domain")
    c = c.withColumn("point", F.when(F.col("topics") < 3, F.xxhash64("features.indices", "features.values").cast("string")).otherwise(F.col("topic_id")))
    size = c.groupBy("domain", "point").agg(F.count("*").alias("n"))
    long = c.select("domain", "point", F.explode_outer(F.arrays_zip("features.indices", "features.values")).alias("e")).select("domain", "point", F.col("e.indices").alias("term"), F.col("e.values").alias("v"))
    means = long.groupBy("domain", "point", "term").agg(F.sum("v").alias("v")).join(size, ["domain", "point"]).select("domain", "point", "term", F.round(F.col("v") / F.col("n"), 9).alias("v"))
    plane = means.groupBy("domain").applyInPandas(_plane, "domain string, term int, bx double, by double")
    p = _projected(clustered, plane, key)
    p = cut(p, "projected")
    mean = p.groupBy("domain", "topic_id").agg(F.avg("px").alias("mx"), F.avg("py").alias("my"))
    spots = mean.join(mean.groupBy("domain").applyInPandas(_spread, "domain string, topic_id string, ax double, ay double, r double"), ["domain", "topic_id"])
    off = p.join(spots, ["domain", "topic_id"]).withColumns({"dx": F.col("px") - F.col("mx"), "dy": F.col("py") - F.col("my")})
    far = off.groupBy("domain", "topic_id").agg(F.max(F.hypot("dx", "dy")).alias("far"))
    scale = F.when(F.col("far") > 1e-9, F.col("r") / F.col("far")).otherwise(0.0)
    return off.join(far, ["domain", "topic_id"]).select(key, "domain", "topic_id", F.round(F.col("ax") + scale * F.col("dx"), 6).alias("map_x"), F.round(F.col("ay") + scale * F.col("dy"), 6).alias("map_y"))


def centroids(places: DataFrame) -> DataFrame:
    """(domain, topic_id, size, x, y) of the placed texts."""
    return places.where("map_x IS NOT NULL AND map_y IS NOT NULL").groupBy("domain", "topic_id").agg(F.count("*").alias("size"), F.round(F.avg("map_x"), 6).alias("x"), F.round(F.avg("map_y"), 6).alias("y"))


def misplaced(places: DataFrame, cents: DataFrame, key: str) -> DataFrame:
    """(domain, placed, misplaced): the placed texts of each domain, and how many of them are farther from their own topic's centroid than from another's of the domain."""
    c = cents.select("domain", F.col("topic_id").alias("other"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    d = places.where("map_x IS NOT NULL AND map_y IS NOT NULL").join(F.broadcast(c), "domain").withColumn("d", F.hypot(F.col("map_x") - F.col("cx"), F.col("map_y") - F.col("cy")))
    own = F.col("other") == F.col("topic_id")
    each = d.groupBy("domain", key).agg(F.min(F.when(own, F.col("d"))).alias("own"), F.min(F.when(~own, F.col("d"))).alias("rest"))
    return each.groupBy("domain").agg(F.count("*").alias("placed"), F.count_if(F.col("own") > F.col("rest")).alias("misplaced"))
