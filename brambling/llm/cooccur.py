"""Items that appear together, with large baskets split into blocks (problem 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brambling.runtime import attach, cut

MAX_BROADCAST = 200_000


def pair_counts(baskets: DataFrame, basket: str, item: str, chunk: int = 64) -> DataFrame:
    """(a, b, n): number of different baskets that hold both items, a < b. `item` holds bigints; (basket, item) is distinct.

    Baskets of more than `chunk` items are dealt into chunks by a hash of the item; each pair of chunks of a basket becomes a
    row of its own, so that one basket's products are spread over tasks and no row holds more than about two chunks.
    """
    x = baskets.select(F.col(basket).alias("u"), F.col(item).alias("i"))
    sizes = x.groupBy("u").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / chunk).cast("int")
    dealt = attach(x, sizes.where("size > 1"), ["u"], "size", x.count(), ["i"]).withColumn("parts", parts).withColumn("c", F.pmod(F.xxhash64("i"), F.col("parts")).cast("int"))
    chunks = dealt.groupBy("u", "parts", "c").agg(F.sort_array(F.collect_list("i")).alias("items"))
    within = chunks.select(F.explode(F.flatten(F.transform("items", lambda p, k: F.transform(F.slice("items", k + 2, F.size("items")), lambda q: F.struct(p.alias("a"), q.alias("b")))))).alias("p"))
    large = chunks.where("parts > 1")
    meet = large.select("u", "c", "items", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("d")).where("c <> d")
    met = meet.groupBy("u", F.least("c", "d").alias("lo"), F.greatest("c", "d").alias("hi")).agg(F.min_by("items", "c").alias("left"), F.max_by("items", "c").alias("right"), F.count("*").alias("k")).where("k = 2")
    across = met.select(F.explode(F.flatten(F.transform("left", lambda p: F.transform("right", lambda q: F.struct(F.least(p, q).alias("a"), F.greatest(p, q).alias("b")))))).alias("p"))
    return within.unionByName(across).groupBy("p.a", "p.b").agg(F.count("*").alias("n"))


def associations(df: DataFrame, basket: str, item: str, least: int = 5, lift: float = 4.0, chunk: int = 64) -> DataFrame:
    """(item_a, item_b, n_ab, n_a, n_b, n_all, lift) of item pairs in at least `least` baskets and at least `lift` times chance.

    Counts are of different baskets; n_all counts all of them, also those without an item. Null items and baskets are left
    out, repeated rows count once. Items in fewer than `least` baskets, and those in more than 1 / `lift` of all (no partner
    can reach the ratio then), cannot be in a result and are left out before pairs are made; this drops no result.
    """
    src = df.select(F.col(basket).alias("u"), F.col(item).cast("string").alias("item")).where("u IS NOT NULL")
    n_all = src.select("u").distinct().count()
    x = cut(src.where("item IS NOT NULL").distinct(), "baskets")
    counted = x.groupBy("item").agg(F.count("*").alias("n")).where((F.col("n") >= least) & (F.col("n") * lift <= n_all))
    items = cut(counted.withColumn("i", F.monotonically_increasing_id()), "items")
    coded = cut(attach(x, items, ["item"], "n", x.count(), ["u"]).select("u", "i"), "coded")
    pairs = pair_counts(coded, "u", "i", chunk).where(F.col("n") >= least).withColumnRenamed("n", "n_ab")
    side = lambda s: items.select(F.col("i").alias(s), F.col("item").alias(f"item_{s}"), F.col("n").alias(f"n_{s}"))
    if items.count() <= MAX_BROADCAST:
        both = pairs.join(F.broadcast(side("a")), "a").join(F.broadcast(side("b")), "b")
    else:
        both = cut(pairs, "pairs")
        total = both.count()
        for s in "ab":  # an item may have partners without bound
            both = attach(both, side(s).join(both.groupBy(s).agg(F.count("*").alias(f"partners_{s}")), s), [s], f"partners_{s}", total, ["a", "b"])
    both = both.where(F.col("n_ab").cast("double") * n_all >= F.lit(lift) * F.col("n_a") * F.col("n_b"))
    turn = F.col("item_a") > F.col("item_b")
    return both.select(
        F.least("item_a", "item_b").alias("item_a"),
        F.greatest("item_a", "item_b").alias("item_b"),
        "n_ab",
        F.when(turn, F.col("n_b")).otherwise(F.col("n_a")).alias("n_a"),
        F.when(turn, F.col("n_a")).otherwise(F.col("n_b")).alias("n_b"),
        F.lit(n_all).cast("bigint").alias("n_all"),
        (F.col("n_ab").cast("double") * n_all / (F.col("n_a").cast("double") * F.col("n_b"))).alias("lift"),
    )
