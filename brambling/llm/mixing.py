"""Mixing sources to target weights, by Pareto order sampling (problem 9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brambling.llm.bpe import TOKENIZER_DIR, with_ids
from brambling.runtime import attach, cut

BUCKETS = 4096


def mixture(documents: DataFrame, targets: DataFrame, total: float | None = None, seed: str = "mix", tokenizer_dir: str = TOKENIZER_DIR) -> tuple[DataFrame, DataFrame]:
    """(copies, shares) for documents (doc_id, text, source) and targets (source, target_share, max_repeats).

    copies: doc_id, source, n_tokens, copies (at least 1). shares: one row per target with what it reached.

    Size is counted in tokens of byte_bpe_50k. `total` is the size wanted; by default the largest at which every source that
    has documents reaches its share among those sources under its cap. A document's expected copies are in proportion to its
    weight, 1 / the number of exact copies of its text within the source; they sum, times tokens, to the source's part of
    the total, and never exceed max_repeats. Their whole part is allocated for certain. The fractions are inclusion
    probabilities p; documents are ranked by the odds of a uniform number, drawn from a hash of seed and doc_id, divided
    by the odds of p, and taken in this order until the source's remaining tokens are filled (the last one only if that comes
    nearer). The cut of the ranking is found by a histogram per source, so that no source is sorted in one task.

    Null or empty texts, null sources and sources without target give no copies. A target without documents reaches 0. Target
    shares need not sum to 1. Repeated targets of one source: the largest share counts.
    """
    goal = targets.where("source IS NOT NULL").groupBy("source").agg(F.max(F.coalesce("target_share", F.lit(0.0))).alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(0))).alias("max_repeats"))
    wanted = documents.select("doc_id", "text", "source").where("source IS NOT NULL AND doc_id IS NOT NULL").join(goal.select("source"), "source", "left_semi")
    sized = cut(with_ids(wanted, "text", tokenizer_dir=tokenizer_dir).select("doc_id", "source", F.md5("text").alias("h"), F.size("ids").alias("n_tokens")).where("n_tokens > 0"), "sized")
    # a text's k copies together weigh as one; k is attached to the repeated texts only, and a text repeated very often is spread
    repeated = cut(sized.groupBy("source", "h").agg(F.count("*").alias("k")).where("k > 1"), "repeated")
    many = attach(sized, repeated, ["source", "h"], "k", sized.count(), ["doc_id"]).select("doc_id", "source", "n_tokens", (1.0 / F.col("k")).alias("w"))
    once = sized.groupBy("source", "h").agg(F.min(F.struct("doc_id", "n_tokens")).alias("d"), F.count("*").alias("k")).where("k = 1").select("d.doc_id", "source", "d.n_tokens", F.lit(1.0).alias("w"))
    w = cut(many.unionByName(once), "weighed")
    stats = w.groupBy("source").agg(F.sum(F.col("w") * F.col("n_tokens")).alias("mass"), F.sum("n_tokens").cast("bigint").alias("available_tokens"), F.count("*").alias("n_docs"), F.max("w").alias("top"))
    per = goal.join(stats, "source").where("target_share > 0 AND max_repeats > 0")
    norm = per.agg(F.sum("target_share")).first()[0] or 1.0
    per = per.withColumn("part", F.col("target_share") / norm).withColumn("most", F.col("max_repeats") * F.col("mass") / F.col("top"))
    if total is None:
        total = per.agg(F.min(F.col("most") / F.col("part"))).first()[0] or 0.0
    per = cut(per.withColumn("goal_tokens", F.least("most", F.lit(float(total)) * F.col("part"))), "goals")

    e = F.col("goal_tokens") * F.col("w") / F.col("mass")
    odds = lambda p: p / (1 - p)
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(2**52)).cast("double") + 0.5) / float(2**52)
    d = w.join(per.select("source", "goal_tokens", "mass"), "source").select("doc_id", "source", "n_tokens", F.floor(e + 1e-9).cast("int").alias("whole"), (e - F.floor(e + 1e-9)).alias("p"))
    q = odds(u) / odds(F.col("p"))
    d = cut(d.withColumn("v", F.when(F.col("p") > 1e-9, q / (1 + q)).otherwise(2.0)), "ranked").withColumn("bucket", F.floor(F.col("v") * BUCKETS).cast("int"))
    certain = d.groupBy("source").agg(F.sum(F.col("whole").cast("bigint") * F.col("n_tokens")).alias("certain"))
    left = per.join(certain, "source").select("source", (F.col("goal_tokens") - F.col("certain")).alias("left"))
    hist = d.where("v <= 1").groupBy("source", "bucket").agg(F.sum("n_tokens").alias("t"))
    ordered = Window.partitionBy("source").orderBy("bucket")
    hist = hist.withColumn("before", F.sum("t").over(ordered) - F.col("t")).join(left, "source")
    edge = cut(hist.where("before < left AND before + t >= left").select("source", F.col("bucket").alias("edge"), "before", "left"), "edge")
    # a source whose whole ranking is needed has no edge
    full = left.join(edge.select("source"), "source", "left_anti").select("source", F.lit(BUCKETS + 1).alias("edge"), F.lit(0).cast("bigint").alias("before"), "left")
    m = d.join(edge.unionByName(full), "source")
    taken = m.where("bucket < edge AND v <= 1 AND left > 0").select("doc_id", F.lit(1).alias("extra"))
    run = F.sum("n_tokens").over(Window.partitionBy("source").orderBy("v", "doc_id").rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    last = m.where("bucket = edge").withColumn("run", run).where((F.col("run") <= F.col("left")) | (F.col("run") - F.col("left") < F.col("left") - F.col("run") + F.col("n_tokens")))
    extra = taken.unionByName(last.select("doc_id", F.lit(1).alias("extra")))
    out = d.join(extra, "doc_id", "left").select("doc_id", "source", "n_tokens", (F.col("whole") + F.coalesce("extra", F.lit(0))).alias("copies")).where("copies > 0")
    out = cut(out, "mixture")
    got = out.groupBy("source").agg(F.sum(F.col("n_tokens").cast("bigint") * F.col("copies")).alias("mixed_tokens"), F.count("*").alias("used_docs"), F.max("copies").alias("most_copies"))
    all_tokens = got.agg(F.sum("mixed_tokens")).first()[0] or 1
    zero = lambda c, t="bigint": F.coalesce(c, F.lit(0)).cast(t).alias(c)
    shares = goal.join(stats.select("source", "available_tokens", "n_docs"), "source", "left").join(got, "source", "left")
    shares = shares.select("source", "target_share", "max_repeats", zero("n_docs"), zero("available_tokens"), zero("used_docs"), zero("most_copies", "int"), zero("mixed_tokens"), (F.coalesce("mixed_tokens", F.lit(0)) / F.lit(all_tokens)).alias("reached_share"))
    return out, shares
