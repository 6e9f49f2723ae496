"""Best representative of each duplicate group, by iterative truth discovery (problem 4)."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brambling.operators.components import components
from brambling.runtime import attach, cut, discard

MAX_BROADCAST = 100_000


@dataclass
class Field:
    """value: what is voted on (null: no claim). prefer: number that decides before anything else. by_votes: whether the
    weighted votes decide next; the latest row and then the largest id decide last."""

    name: str
    value: Column
    prefer: Column | None = None
    by_votes: bool = True


def _linked(rows: DataFrame, keys: int) -> DataFrame:
    """`rows` with `group`, from the key columns k0, k1, ...: rows that share a key belong together, also through other rows. Graph nodes
    are key values, so that copies of one record add nothing to the graph; rows find their group by a join that spreads hot keys."""
    ks = [F.col(f"k{i}") for i in range(keys)]
    rows = cut(rows.withColumn("node", F.coalesce(*ks)).where("node IS NOT NULL"), "keyed")
    edges = rows.select(F.explode(F.array(*[F.struct(F.col("node").alias("u"), k.alias("v")) for k in ks])).alias("e")).select("e.*")
    sizes = rows.groupBy("node").agg(F.count("*").alias("n"))
    small = sizes.join(components(edges).withColumnRenamed("component", "group"), "node")
    return cut(attach(rows, small, ["node"], "n", rows.count(), ["id"]).drop("node", "n", *[f"k{i}" for i in range(keys)]), "linked")


def discover(claims: DataFrame, max_rounds: int = 100, tolerance: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """(votes, reliability) from claims (group, field, value, source, n).

    Alternates between the votes of each value, weighted by its sources' reliability, and the reliability of each source, minus
    the log of its smoothed share of claims that differ from the highest vote, until no reliability moves by `tolerance`;
    where `max_rounds` ends it before (votes may alternate), there is a warning.
    Null sources count as one source. Ties of votes go to the greater value.
    """
    c = claims.withColumn("source", F.coalesce(F.col("source").cast("string"), F.lit("")))
    trust = cut(c.groupBy("source").agg(F.lit(1.0).alias("w")), "trust")
    # of few sources each may have made a third of all claims: their list is broadcast; many are joined, and adaptive execution splits the frequent ones
    few = trust.count() <= MAX_BROADCAST
    side = lambda t: F.broadcast(t) if few else t
    for _ in range(max_rounds):
        votes = c.join(side(trust), "source").groupBy("group", "field", "value").agg(F.sum(F.col("n") * F.col("w")).alias("vote"))
        best = votes.groupBy("group", "field").agg(F.max_by("value", F.struct("vote", "value")).alias("truth"))
        err = c.join(best, ["group", "field"]).groupBy("source").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("value") != F.col("truth"), F.col("n")).otherwise(0)).alias("wrong"))
        new = cut(err.select("source", F.round(-F.log((F.col("wrong") + 1) / (F.col("n") + 2)), 9).alias("w")), "trust")
        moved = new.join(trust.withColumnRenamed("w", "w0"), "source").agg(F.max(F.abs(F.col("w") - F.col("w0")))).first()[0]
        discard(trust)
        trust = new
        if moved is None or moved < tolerance:
            break
    else:
        warnings.warn(f"reliabilities still moved after {max_rounds} rounds", stacklevel=2)
    return c.join(side(trust), "source").groupBy("group", "field", "value").agg(F.sum(F.col("n") * F.col("w")).alias("vote")), trust


def representatives(df: DataFrame, id_col: str, keys: dict[str, Column], source: Column, latest: Column, fields: list[Field], least: int = 2) -> DataFrame:
    """One row per group of `least` rows or more: group, first_id, n_rows, and per field <name> (the value chosen, as text) and
    <name>_id (its row).

    Rows that share the value of any of `keys` belong together, also through other rows; rows whose keys are all null or whose
    id is null are left out, and repeated rows count as rows. Within a group the order is: prefer, a claim before none (for
    fields that go by votes), votes, latest, id. Where no row makes a claim the value is null and the row is the last by the rest
    of the order. Null `prefer` counts as 0, null `latest` as oldest. Votes are weighted by the reliability found for each
    `source`. Rows are aggregated per (group, field, value) before they are shuffled, so that a group of any size costs a
    few rows. Only the given columns are read; others may have any name.
    """
    k = [F.when(c.isNotNull(), F.concat(F.lit(f"{name}:"), c)).alias(f"k{i}") for i, (name, c) in enumerate(keys.items())]
    claims = [F.struct(f.value.cast("string").alias("value"), F.coalesce((f.prefer if f.prefer is not None else F.lit(0)).cast("double"), F.lit(0.0)).alias("prefer")).alias(f"f{i}") for i, f in enumerate(fields)]
    flat = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), source.cast("string").alias("source"), latest.alias("latest"), *k, *claims)
    rows = _linked(flat, len(keys))
    several = cut(rows.groupBy("group").agg(F.min("id").alias("first_id"), F.count("*").alias("n_rows")).where(F.col("n_rows") >= least), "groups")
    long = rows.select("group", "id", "source", "latest", F.explode(F.array(*[F.struct(F.lit(i).alias("field"), F.col(f"f{i}").alias("c")) for i in range(len(fields))])).alias("p"))
    long = long.select("group", "id", "source", "latest", "p.field", "p.c.value", "p.c.prefer")
    cand = long.groupBy("group", "field", "value").agg(F.max(F.struct("prefer", "latest", "id")).alias("top")).join(several.select("group"), "group", "left_semi")
    said = long.where("value IS NOT NULL").groupBy("group", "field", "value", "source").agg(F.count("*").alias("n")).join(several.select("group"), "group", "left_semi")
    votes = discover(cut(said, "claims"))[0]
    cand = cand.join(votes, ["group", "field", "value"], "left")
    by_votes = F.col("field").isin([i for i, f in enumerate(fields) if f.by_votes])
    has = (by_votes & F.col("value").isNotNull()).cast("int")
    vote = F.when(by_votes, F.round(F.coalesce("vote", F.lit(0.0)), 6)).otherwise(F.lit(0.0))
    order = F.struct(F.col("top.prefer"), has, vote, F.col("top.latest"), F.col("top.id"))
    picked = cand.groupBy("group").agg(*[F.max(F.when(F.col("field") == i, F.struct(order.alias("o"), "value"))).alias(f"b{i}") for i in range(len(fields))])
    out = several.join(picked, "group")
    return out.select("group", "first_id", "n_rows", *[x for i, f in enumerate(fields) for x in (F.col(f"b{i}.value").alias(f.name), F.col(f"b{i}.o.id").alias(f"{f.name}_id"))])


def clean_doi(c: Column) -> Column:
    """A DOI in lower case without outer blanks, resolver address or `doi:`; null unless something follows its slash."""
    t = F.regexp_replace(F.lower(c), r"^[\s ]+|[\s ]+$", "")
    t = F.regexp_replace(t, r"^(?:(?:https?://)?(?:dx\.)?doi\.[a-z.]+/|https?://[^/\s]+/|doi:\s*)+", "")
    return F.when(t.rlike(r"^10\.[^/\s]+/\S"), t)


# Texts that stand in place of an abstract, without case and punctuation.
NOTICE = r"^(?:n a|na|none|no abstract|(?:no )?abstract (?:is )?(?:not )?(?:available|unavailable|provided|missing)(?: .*)?)$"


def abstract_size(c: Column) -> Column:
    """Number of non-white characters; 0 for null and for a notice in place of an abstract."""
    bare = F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))
    return F.when(c.isNull() | bare.rlike(NOTICE), 0).otherwise(F.length(F.regexp_replace(c, r"(?U)\s+", "")))


def mesh_set(c: Column) -> Column:
    """Different terms without case and outer blanks, sorted; empty for null; null and blank terms are none."""
    terms = F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda t: F.lower(F.regexp_replace(t, r"(?U)^\s+|\s+$", "")))
    return F.array_sort(F.array_distinct(F.filter(terms, lambda t: t.isNotNull() & (t != ""))))
