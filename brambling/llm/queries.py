"""The pN_ queries of the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.llm import bpe, canonical, cooccur, merkle, mixing, names, subjects, truth
from brambling.operators import dialect
from brambling.plans.problems import affiliations
from brambling.runtime import blank_to_null, cut, table


def _titles(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "articles").select(F.col("rec_id").alias("id"), "title")
    return a.unionByName(table(spark, sf, "scholar_leads").select(F.col("lead_id").alias("id"), "title"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.formatting_copies(_titles(spark, sf), "id", ["title"])[1]


def p1_copies(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.formatting_copies(_titles(spark, sf), "id", ["title"])[0]


def _spellings(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "articles").select(F.explode("authors").alias("a")).where("a.fore_name IS NOT NULL AND trim(a.fore_name) <> ''")
    a = a.select(F.concat("a.last_name", F.lit(", "), "a.fore_name").alias("name"))
    r = table(spark, sf, "scholar_leads").select(F.explode(F.split("authors_raw", ", ")).alias("name")).select(F.trim("name").alias("name"))
    return a.unionByName(r).unionByName(table(spark, sf, "network_author_nodes").select(F.col("label").alias("name")))


def p2_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """A row for each spelling with its class: what scales, where p2_found gives all pairs because its definition asks for them."""
    return names.link_names(_spellings(spark, sf), table(spark, sf, "name_nicknames"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    c = cut(p2_clusters(spark, sf), "clusters")
    a, b = (c.select("cluster", F.col("name").alias(f"name_{s}")) for s in "ab")
    return a.join(names.spread(b, c.count()), "cluster").where("name_a < name_b").select("name_a", "name_b")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    one = dialect.with_values(affiliations(spark, sf), "text").where(F.size("values") == 1).withColumn("value", F.element_at("values", 1))
    return canonical.map_values(one, "value", table(spark, sf, "network_institution_nodes")).select("rec_id", "author_no", "affiliation_no", "node_id")


def _best(spark: SparkSession, sf: str, complete: bool) -> DataFrame:
    a = table(spark, sf, "articles")
    doi = F.coalesce(truth.clean_doi(F.col("doi")), truth.clean_doi(F.col("identifiers.doi")))
    n_abstract, mesh = truth.abstract_size(F.col("abstract")), truth.mesh_set(F.col("mesh_terms"))
    fields = [
        truth.Field("doi", doi),
        truth.Field("abstract", F.when(n_abstract > 0, F.md5("abstract")), n_abstract if complete else None, not complete),
        truth.Field("mesh", F.when(F.size(mesh) > 0, F.md5(F.concat_ws("|", mesh))), F.size(mesh) if complete else None, not complete),
    ]
    return truth.representatives(a, "rec_id", {"doi": doi, "pmid": blank_to_null(F.col("identifiers.pmid"))}, F.col("query_id"), F.col("fetched_at"), fields)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _best(spark, sf, True).select(F.col("first_id").alias("first_rec_id"), "doi", F.col("abstract_id").alias("abstract_rec_id"), F.col("mesh_id").alias("mesh_rec_id"))


def p4_by_votes(spark: SparkSession, sf: str) -> DataFrame:
    return _best(spark, sf, False).select(F.col("first_id").alias("first_rec_id"), "n_rows", "doi", F.col("abstract_id").alias("abstract_rec_id"), F.col("mesh_id").alias("mesh_rec_id"))


def p6_pairs(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "publication_authors")
    parts = [cooccur.associations(t, "uid", item).select(F.lit(kind).alias("kind"), "*") for kind, item in (("author", "author_key"), ("institution", "institution_id"))]
    return parts[0].unionByName(parts[1])


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return p6_pairs(spark, sf).select("kind", "item_a", "item_b")


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.with_ids(table(spark, sf, "documents").select("doc_id", "text"), "text").select("doc_id", "ids")


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))[1]


def p9_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))[0]


def p9_shares_check(spark: SparkSession, sf: str) -> DataFrame:
    """Per target whether no document has more copies than allowed, whether its tokens are its share of all (among sources with documents) to
    within two documents, and whether the report agrees with the documents taken."""
    taken, shares = mixing.mixture(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))
    t = taken.groupBy("source").agg(F.max("copies").alias("copies"), F.sum(F.col("n_tokens").cast("bigint") * F.col("copies")).alias("tokens"), F.max("n_tokens").alias("longest"))
    s = shares.join(F.broadcast(shares.where("n_docs > 0").agg(F.sum("target_share").alias("named"))), F.lit(True)).join(F.broadcast(t.agg(F.sum("tokens").alias("all_tokens"), F.max("longest").alias("most"))), F.lit(True)).join(t, "source", "left")
    due = F.when(F.col("n_docs") > 0, F.col("target_share") / F.col("named") * F.col("all_tokens")).otherwise(0.0)
    flag = lambda c, name: F.coalesce(c.cast("int"), F.lit(0)).alias(name)
    tokens = F.coalesce("tokens", F.lit(0))
    return s.select("source", flag(F.coalesce("copies", F.lit(0)) <= F.col("max_repeats"), "cap_kept"), flag(F.abs(tokens - due) <= 2 * F.col("most"), "share_reached"), flag((tokens == F.col("mixed_tokens")) & (F.coalesce("copies", F.lit(0)) == F.col("most_copies")), "mixture_agrees"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return subjects.assign(table(spark, sf, "documents"), table(spark, sf, "subject_examples"), table(spark, sf, "subject_list"))


QUERIES = {
    "p1_found": p1_found,
    "p1_copies": p1_copies,
    "p2_found": p2_found,
    "p2_clusters": p2_clusters,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_by_votes": p4_by_votes,
    "p6_found": p6_found,
    "p6_pairs": p6_pairs,
    "p8_ids": p8_ids,
    "p9_mixture": p9_mixture,
    "p9_shares": p9_shares,
    "p9_shares_check": p9_shares_check,
    "p10_found": p10_found,
}
