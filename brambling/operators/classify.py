"""Labels by curated terms, and a vocabulary derived from the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brambling.functions.text import folded, norm_title, phrases
from brambling.runtime import attach, cut

WEIGHTS = {"title": 3, "mesh": 3, "keyword": 2, "abstract": 1}
OTHER = "Other/unspecified"


MAX_BROADCAST = 200_000


def small(df: DataFrame, most: int = MAX_BROADCAST) -> DataFrame:
    """`df` marked for broadcast if it has `most` rows at most, which is counted; else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def _field_texts() -> dict[str, Column]:
    """The texts of a record by field: normalised words between blanks; the members of a list are kept apart by a sign no term holds."""
    of_list = lambda c: F.array_join(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.coalesce(folded(x), F.lit(""))), " | ")
    raw = {"title": folded(F.col("title")), "abstract": folded(F.col("abstract")), "mesh": of_list(F.col("mesh_terms")), "keyword": of_list(F.col("keywords"))}
    return {f: F.concat(F.lit(" "), F.coalesce(t, F.lit("")), F.lit(" ")).alias(f) for f, t in raw.items()}


def term_hits(records: DataFrame, terms: DataFrame, key: str = "uid", most: int = MAX_BROADCAST) -> DataFrame:
    """(key, field, label_id, term) for every term of `terms` (label_id, term) that a record's field holds as whole words.

    A vocabulary of up to `most` terms (counted) is broadcast: the words of a text meet the terms that begin with them, and the rest of the
    term is looked for in the text, so that nothing of the records is shuffled. A longer one meets the runs of up to as many words
    as its longest term has in a join whose hot words are spread. MeSH terms and keywords match by their runs of words too. Null texts and
    terms match nothing.
    """
    t = terms.select("label_id", norm_title(F.col("term")).alias("term")).where("term IS NOT NULL").distinct()
    n, longest = t.agg(F.count("*"), F.max(F.size(F.split("term", " ")))).first()
    fields = _field_texts()
    texts = records.select(key, *fields.values()).select(key, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])).alias("f")).select(key, "f.field", "f.text")
    if n <= most:
        first = F.broadcast(t.withColumn("word", F.split("term", " ")[0]))
        words = texts.select(key, "field", "text", F.explode(F.array_distinct(F.split(F.trim("text"), " "))).alias("word"))
        return words.join(first, "word").where(F.expr("contains(text, concat(' ', term, ' '))")).select(key, "field", "label_id", "term")
    runs = F.array_distinct(F.flatten(F.transform(F.split(F.trim("text"), r" \| "), lambda x: phrases(x, longest))))
    grams = cut(texts.select(key, "field", F.explode(runs).alias("term")).join(t.select("term").distinct(), "term", "left_semi"), "runs")
    labels = t.groupBy("term").agg(F.collect_set("label_id").alias("labels"))
    counted = grams.groupBy("term").agg(F.count("*").alias("n")).join(labels, "term")
    return attach(grams, counted, ["term"], "n", grams.count(), [key, "field"]).select(key, "field", F.explode("labels").alias("label_id"), "term")


def scores(hits: DataFrame, key: str = "uid", least: int = 4, weights: dict[str, int] | None = None) -> DataFrame:
    """(key, label_id, score): sum over the matched terms of their field's weight, where it reaches `least`."""
    w = weights or WEIGHTS
    weight = F.create_map(*[F.lit(x) for p in w.items() for x in p])[F.col("field")]
    return hits.groupBy(key, "label_id").agg(F.sum(weight).cast("bigint").alias("score")).where(F.col("score") >= least)


def with_primary(scored: DataFrame, labels: DataFrame, key: str = "uid") -> DataFrame:
    """Add is_primary: the highest score of the key, on a tie the label first in `labels` (label_id, pos)."""
    w = Window.partitionBy(key).orderBy(F.desc("score"), "pos")
    return scored.join(small(labels.select("label_id", "pos")), "label_id").withColumn("is_primary", (F.row_number().over(w) == 1).cast("int")).drop("pos")


def with_fallback(records: DataFrame, labelled: DataFrame, key: str = "uid", other: str = "other_id") -> DataFrame:
    """`labelled` and, for records without a label, one primary row `other` with a null score."""
    rest = records.select(key).join(labelled.select(key).distinct(), key, "left_anti")
    return labelled.unionByName(rest.select(key, F.lit(other).alias("label_id"), F.lit(None).cast("bigint").alias("score"), F.lit(1).alias("is_primary")))


def vocabulary(tagged: DataFrame, stoplist: DataFrame, key: str = "uid", least: int = 3, top_k: int = 12) -> DataFrame:
    """(domain_id, mesh_term, frequency, rank): per domain the terms on most of its records, generic ones left out.

    `tagged`: key, domain_id, mesh_term. Terms are compared in small letters. Equal frequencies rank by term. Terms are counted before generic ones are left out, so that no
    frequent term is shuffled row by row.
    """
    t = tagged.select(key, "domain_id", F.lower(F.trim("mesh_term")).alias("mesh_term")).where("mesh_term <> ''")
    f = t.distinct().groupBy("domain_id", "mesh_term").agg(F.count("*").alias("frequency")).where(F.col("frequency") >= least)
    f = f.join(stoplist.select(F.lower(F.trim("term")).alias("mesh_term")).distinct(), "mesh_term", "left_anti")
    w = Window.partitionBy("domain_id").orderBy(F.desc("frequency"), "mesh_term")
    return f.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_k)


def relabel(vocab: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Add display_label: that of the previous vocabulary (domain_id, mesh_term, display_label) where it has one, else the term."""
    default = F.initcap("mesh_term")
    if previous is None:
        return vocab.withColumn("display_label", default)
    old = previous.select("domain_id", F.lower(F.trim("mesh_term")).alias("mesh_term"), F.col("display_label").alias("_old")).dropDuplicates(["domain_id", "mesh_term"])
    return vocab.join(old, ["domain_id", "mesh_term"], "left").withColumn("display_label", F.coalesce("_old", default)).drop("_old")


def assign_terms(tagged: DataFrame, vocab: DataFrame, key: str = "uid") -> DataFrame:
    """(key, domain_id, subdomain_mesh, subdomain, rank): the best-ranked vocabulary term the record itself carries, else OTHER with nulls."""
    t = tagged.select(key, "domain_id", F.lower(F.trim("mesh_term")).alias("mesh_term"))
    best = t.join(small(vocab), ["domain_id", "mesh_term"]).groupBy(key, "domain_id").agg(F.min(F.struct("rank", "mesh_term", "display_label")).alias("b"))
    every = tagged.select(key, "domain_id").distinct()
    return every.join(best, [key, "domain_id"], "left").select(key, "domain_id", F.col("b.mesh_term").alias("subdomain_mesh"), F.coalesce("b.display_label", F.lit(OTHER)).alias("subdomain"), F.col("b.rank").alias("vocabulary_rank"))
