"""Records from fetched articles and leads: one flat shape, identity, and duplicates with provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brambling.functions.text import norm_title, year_of
from brambling.operators.components import components
from brambling.runtime import attach, blank_to_null, cut


def clean_doi(c: Column) -> Column:
    """A DOI in small letters without blanks around it, resolver address or `doi:`; null for fillers."""
    t = F.regexp_replace(F.lower(c), r"^\s+|\s+$", "")
    t = F.regexp_replace(t, r"^(?:https?://[^/\s]+/|doi:\s*)+", "")
    return F.when(t.rlike(r"^10\.[^/\s]+/\S"), t)


def from_articles(a: DataFrame) -> DataFrame:
    """Articles as records; arrays are never null."""
    arr = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>")).alias(c)
    affs = F.flatten(F.transform(F.coalesce("authors", F.array().cast(a.schema["authors"].dataType)), lambda x: F.coalesce(x["affiliations"], F.array().cast("array<string>"))))
    return a.select(
        F.col("rec_id").alias("rid"), F.lit("pubmed").alias("origin"), "query_id",
        F.coalesce(clean_doi(F.col("doi")), clean_doi(F.col("identifiers.doi"))).alias("doi"),
        blank_to_null(F.col("identifiers.pmid")).alias("pmid"), "title", "abstract",
        F.col("journal.title").alias("journal"), year_of(F.col("publication_date.year")).alias("year"),
        "language", arr("article_types"), arr("mesh_terms"), arr("keywords"), "authors", affs.alias("affiliations"),
    )


def from_leads(s: DataFrame) -> DataFrame:
    """Leads as records: the snippet stands for the abstract; what leads don't have is null or empty."""
    none = F.array().cast("array<string>")
    return s.select(
        F.col("lead_id").alias("rid"), F.lit("scholar").alias("origin"), "query_id", F.lit(None).cast("string").alias("doi"), F.lit(None).cast("string").alias("pmid"),
        "title", F.col("snippet").alias("abstract"), F.col("venue").alias("journal"), year_of(F.col("year")).alias("year"),
        F.lit(None).cast("string").alias("language"), none.alias("article_types"), none.alias("mesh_terms"), none.alias("keywords"), none.alias("affiliations"),
    )


def unite(*parts: DataFrame) -> DataFrame:
    """Union by name; columns that a part lacks are null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def uid(doi: Column, pmid: Column, title: Column) -> Column:
    """`doi:` or else `pmid:` or else `title:` with a hash of the normalised title; null if there is none of them."""
    t = norm_title(title)
    return F.coalesce(F.concat(F.lit("doi:"), doi), F.concat(F.lit("pmid:"), pmid), F.concat(F.lit("title:"), F.substring(F.sha2(t, 256), 1, 16)))


def duplicate_groups(r: DataFrame) -> DataFrame:
    """`r` with `group`: records that share DOI, PMID or normalised title, also through others. Records without any key are
    groups of their own. Key values are the graph's nodes; hot keys are spread when rows look up their group."""
    keys = {"d:": F.col("doi"), "p:": F.col("pmid"), "t:": norm_title(F.col("title"))}
    nodes = [F.concat(F.lit(p), c) for p, c in keys.items()]
    own = F.concat(F.lit("r:"), F.col("rid").cast("string"))
    k = cut(r.withColumns({f"_k{i}": n for i, n in enumerate(nodes)}).withColumn("_node", F.coalesce(*[F.col(f"_k{i}") for i in range(3)], own)), "keyed")
    edges = k.select(F.explode(F.array(*[F.struct(F.col("_node").alias("u"), F.coalesce(F.col(f"_k{i}"), F.col("_node")).alias("v")) for i in range(3)])).alias("e")).select("e.*")
    sizes = k.groupBy("_node").agg(F.count("*").alias("_n"))
    small = sizes.join(components(edges).select(F.col("node").alias("_node"), F.col("component").alias("group")), "_node")
    return attach(k, small, ["_node"], "_n", k.count(), ["rid"]).drop("_node", "_n", "_k0", "_k1", "_k2")


def merge(grouped: DataFrame) -> DataFrame:
    """One record per group: the row of the better origin (articles before leads), then the smallest rid, with all query ids and
    origins of the group; DOI and PMID are taken from any row where the survivor lacks them. Rows are reduced to the best of each group and sets of query
    ids before they are shuffled; repeated rows count in n_copies."""
    rank = F.struct((F.col("origin") != "pubmed").alias("lead"), F.col("rid"))
    cols = [c for c in grouped.columns if c != "group"]
    g = grouped.groupBy("group").agg(
        F.min_by(F.struct(*cols), rank).alias("best"), F.min("rid").alias("first_rid"), F.array_sort(F.collect_set("query_id")).alias("provenance"), F.array_sort(F.collect_set("origin")).alias("origins"),
        F.count("*").cast("bigint").alias("n_copies"), F.min("doi").alias("any_doi"), F.min("pmid").alias("any_pmid"),
    )
    top = g.select("best.*", *[c for c in g.columns if c not in ("best", "group")])
    out = top.withColumns({"doi": F.coalesce("doi", "any_doi"), "pmid": F.coalesce("pmid", "any_pmid")}).drop("any_doi", "any_pmid")
    return out.withColumns({"uid": F.coalesce(uid(F.col("doi"), F.col("pmid"), F.col("title")), F.concat(F.lit("row:"), F.col("rid").cast("string"))), "needs_manual_metadata": ~F.array_contains("origins", "pubmed"), "seq": F.col("first_rid")})
