"""Readers of a run directory: article pages, search pages, leads, decisions, stage files, and a roster from HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARTICLE = (
    "identifiers struct<pmid:string,doi:string,pmc:string,pii:string>, title string, abstract string, doi string, journal struct<title:string,iso_abbreviation:string>,"
    "authors array<struct<last_name:string,fore_name:string,initials:string,affiliations:array<string>>>, publication_date struct<year:string,month:string,day:string>,"
    "article_types array<string>, language string, citation struct<volume:string,issue:string,pages:string>, mesh_terms array<string>, keywords array<string>"
)
LEAD = "title string, authors_raw string, year string, venue string, url string, source string, snippet string"
DECISION = "uid string, decision string, rule_id string, reason string, decided_by string, evidence string"


def _file(c: str = "_metadata.file_name") -> F.Column:
    return F.col(c)


def _row_number_id(df: DataFrame) -> DataFrame:
    return df.withColumn("rec_id", F.monotonically_increasing_id())


def articles(spark: SparkSession, run_dir: str) -> DataFrame:
    """Articles of raw/pubmed_<query>_<n>.json, n from 1: query_id, page_no, rec_id (by file, then position) and the article's columns."""
    fields = ", ".join(f.replace(" ", ":", 1) for f in _split(ARTICLE))
    df = spark.read.schema(f"articles array<struct<{fields}>>, count bigint").option("multiLine", True).json(f"{run_dir}/raw/pubmed_*_[1-9]*.json")
    f = F.regexp_extract(_file(), r"^pubmed_(.+)_(\d+)\.json$", 1)
    n = F.regexp_extract(_file(), r"^pubmed_(.+)_(\d+)\.json$", 2).cast("int")
    df = df.select(f.alias("query_id"), n.alias("page_no"), F.posexplode("articles").alias("pos", "a"))
    return _row_number_id(df.orderBy("query_id", "page_no", "pos")).select("rec_id", "query_id", "page_no", "a.*")


def _split(schema: str) -> list[str]:
    """Top-level fields of a schema text."""
    out, depth, cur = [], 0, ""
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(cur.strip())
            cur = ""
        else:
            cur += c
    return [*out, cur.strip()]


def search_pages(spark: SparkSession, run_dir: str) -> DataFrame:
    """Hit lists of raw/pubmed_<query>_0.json with the share of the hits that was returned."""
    df = spark.read.schema("pmids array<string>, total_count bigint, returned_count bigint, has_more boolean").option("multiLine", True).json(f"{run_dir}/raw/pubmed_*_0.json")
    share = F.when(F.col("total_count") > 0, F.round(F.col("returned_count") / F.col("total_count"), 6))
    return df.select(F.regexp_extract(_file(), r"^pubmed_(.+)_0\.json$", 1).alias("query_id"), "pmids", "total_count", "returned_count", "has_more", share.alias("coverage"))


def leads(spark: SparkSession, run_dir: str, first_id: int = 10**12) -> DataFrame:
    """Leads of raw/scholar_<query>.jsonl, one a line; lines that can't be read are left out."""
    parsed = F.from_json("value", LEAD + ", bad string", {"columnNameOfCorruptRecord": "bad"})
    df = spark.read.text(f"{run_dir}/raw/scholar_*.jsonl").select(F.regexp_extract(_file(), r"^scholar_(.+)\.jsonl$", 1).alias("query_id"), parsed.alias("r"))
    df = df.where("r.bad IS NULL AND r IS NOT NULL").select("query_id", "r.*").drop("bad").orderBy("query_id", "url", "title")
    return df.withColumn("lead_id", F.monotonically_increasing_id() + F.lit(first_id))


def decisions(spark: SparkSession, path: str) -> DataFrame:
    """Decisions, one a line, with `line`, which tells their order: the later of two on one record counts. Lines that can't be read are left out."""
    parsed = F.from_json("value", DECISION + ", bad string", {"columnNameOfCorruptRecord": "bad"})
    line = F.struct(_file().alias("file"), _file("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    df = spark.read.text(path).select(parsed.alias("r"), line.alias("line"))
    return df.where("r.bad IS NULL AND r IS NOT NULL").select("r.*", "line").drop("bad")


def coverage(pages: DataFrame, fetched: DataFrame) -> DataFrame:
    """(query_id, reported, listed, fetched, share): hits the search reported and listed, and articles fetched, by query; share of the reported
    hits that was fetched, null where none were reported. Queries of one side only are kept."""
    p = pages.groupBy("query_id").agg(F.max("total_count").alias("reported"), F.sum("returned_count").alias("listed"))
    f = fetched.groupBy("query_id").agg(F.count("*").alias("fetched"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    out = p.join(f, "query_id", "full_outer").select("query_id", zero("reported"), zero("listed"), zero("fetched"))
    return out.withColumn("share", F.when(F.col("reported") > 0, F.round(F.col("fetched") / F.col("reported"), 6)))


def stage(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows of a stage's JSON-lines file."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def roster_from_html(pages: DataFrame, html: str = "html") -> DataFrame:
    """(profile_url, name) of every profile link in HTML pages: anchors whose address has /expert or /profile in it, tags and entities
    removed from the name; each link once."""
    link = r'<a\s[^>]*href="([^"]*/(?:experts?|profiles?)/[^"]+)"[^>]*>(.*?)</a>'
    all_ = F.arrays_zip(F.regexp_extract_all(html, F.lit(f"(?is){link}"), 1).alias("u"), F.regexp_extract_all(html, F.lit(f"(?is){link}"), 2).alias("n"))
    df = pages.select(F.explode(all_).alias("x"))
    name = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace("x.n", "<[^>]+>", " "), "&amp;", "&"), r"\s+", " "))
    return df.select(F.col("x.u").alias("profile_url"), name.alias("name")).where("name <> ''").groupBy("profile_url").agg(F.min("name").alias("name"))
