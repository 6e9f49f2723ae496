"""Command line over a run directory: python -m brambling.cli STAGE --run-dir DIR [options]."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.operators import screen
from brambling.plans import pipeline as p
from brambling.runtime import local
from brambling.sources import files, raw, sinks, vocab

STAGES = ("preflight", "build_queries", "ingest", "screen", "classify", "topic_model", "build_dataset", "fetch_experts")


def _spark() -> SparkSession:
    return SparkSession.builder.appName("brambling").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def preflight(spark: SparkSession, a: argparse.Namespace) -> list[str]:
    """What is missing: a file that was named, a vocabulary without rows, or with columns other than its stage reads; empty where all is fine."""
    bad = [f"Python {sys.version_info.major}.{sys.version_info.minor} is too old"] if sys.version_info < (3, 10) else []
    named = {n: getattr(a, n) for n in ("domains", "types", "rules", "stoplist", "institutions", "countries", "roster") if getattr(a, n)}
    gone = {n for n, path in named.items() if not files.found(spark, path)}
    bad += [f"{n}: no file {named[n]}" for n in sorted(gone)]
    columns = {"stoplist": ["term"], "institutions": ["alias", "label", "country", "region", "sector"], "countries": ["alias", "country", "region", "iso3"], "roster": ["profile_url", "pubmed_author_query", "active"]}
    for n, cols in columns.items():
        if n in named and n not in gone:
            t = vocab.csv_table(spark, named[n])
            if missing := [c for c in cols if c not in t.columns]:
                bad.append(f"{n}: no column {', '.join(missing)}")
            elif n != "roster" and t.isEmpty():  # a roster may have a header only
                bad.append(f"{n}: no rows")
    for n in ("domains", "types", "rules"):
        if n in named and n not in gone:
            try:
                rows = vocab.rules(spark, named[n]) if n == "rules" else _terms(spark, named[n]).collect()
                if n == "rules":
                    screen.rules_of(rows, a.from_year, a.to_year, "x")
                if not rows:
                    bad.append(f"{n}: no rows")
            except Exception as e:  # noqa: BLE001
                bad.append(f"{n}: {str(e).splitlines()[0]}")
    if a.stage != "preflight" and not files.found(spark, f"{a.run_dir}/raw/*"):
        bad.append(f"no fetched pages in {a.run_dir}/raw")
    return bad


def _terms(spark: SparkSession, path: str) -> DataFrame:
    return vocab.json_block(spark, path, "pos:int,label_id:string,label:string,terms:array<string>").select("pos", "label_id", "label", F.explode("terms").alias("term"))


def _vocabularies(spark: SparkSession, a: argparse.Namespace) -> p.Vocabularies:
    v = p.Vocabularies.default(spark)
    for name in ("institutions", "countries", "stoplist"):
        if path := getattr(a, name):
            setattr(v, name, vocab.csv_table(spark, path))
    for name in ("domains", "types"):
        if path := getattr(a, name):
            setattr(v, name, _terms(spark, path))
    return v


def run(a: argparse.Namespace) -> int:
    spark, d = _spark(), a.run_dir.rstrip("/")
    if a.stage == "preflight":
        bad = preflight(spark, a)
        print("\n".join(bad) or "ready")
        return 1 if bad else 0
    o = p.Options(from_year=a.from_year, to_year=a.to_year, top_k=a.subdomain_top_k, min_records=a.subdomain_min_records, min_docs=a.min_docs)
    if a.rules:
        o.rules = vocab.rules(spark, a.rules)
    v = _vocabularies(spark, a)
    at = lambda name: f"{d}/stages/{name}.parquet"
    save = lambda df, name: df.write.mode("overwrite").parquet(at(name))
    load = lambda name: spark.read.parquet(at(name))
    if a.stage == "build_queries":
        roster = vocab.csv_table(spark, a.roster) if a.roster else None
        rows = p.build_queries(v.domains, roster, o).orderBy("query_id").collect()
        files.write_text(spark, f"{d}/queries.json", json.dumps({"queries": [r.asDict() for r in rows]}, indent=1))
    elif a.stage == "ingest":
        leads = raw.leads(spark, d) if files.found(spark, f"{d}/raw/scholar_*.jsonl") else None
        articles = raw.articles(spark, d)
        recs = p.ingest(articles, leads)
        save(recs, "records")
        sinks.json_lines(recs, f"{d}/records.jsonl", ["seq"])
        if files.found(spark, f"{d}/raw/pubmed_*_0.json"):
            sinks.csv(raw.coverage(raw.search_pages(spark, d), articles), f"{d}/coverage.csv", ["query_id"])
    elif a.stage == "screen":
        path = f"{d}/screening/decisions.jsonl"
        decided = raw.decisions(spark, path) if files.found(spark, path) else None
        by_rules = p.screened(load("records"), None, v.domains, o)
        save(by_rules, "by_rules")
        save(screen.overlay(load("by_rules"), decided, order="line") if decided is not None else load("by_rules"), "screened")
        for w in ("included", "excluded", "uncertain"):
            sinks.json_lines(load("screened").where(F.col("verdict") == w), f"{d}/screening/{w}.jsonl", ["seq"])
        if decided is not None:
            sinks.json_lines(screen.amendments(load("by_rules"), decided, order="line"), f"{d}/screening/amendments.jsonl", ["rule_id", "decision"])
    elif a.stage == "classify":
        old = f"{d}/classification/subdomain_vocabulary.csv"
        previous = vocab.csv_table(spark, old).select("domain_id", "mesh_term", "display_label") if files.found(spark, old) else None
        t = p.classified(load("screened").where("verdict = 'included'"), v, o, previous)
        for name, df in t.items():
            save(df, f"classified_{name}")
        sinks.csv(t["vocabulary"].select("domain_id", "mesh_term", "frequency", "rank", "display_label"), old, ["domain_id", "rank"])
        sinks.json_lines(t["facts"].drop("text"), f"{d}/classification/classified.jsonl", ["seq"])
    elif a.stage == "topic_model":
        t = p.topic_tables(load("classified_facts"), o)
        sinks.csv(t["publication_topics"], f"{d}/topics/publication_topics.csv", p.order_of("publication_topics"))
        sinks.csv(t["topic_map_centroids"], f"{d}/topics/topic_centroids.csv", p.order_of("topic_map_centroids"))
    elif a.stage == "build_dataset":
        t = {n: load(f"classified_{n}") for n in ("domains", "types", "vocabulary", "subdomains", "affiliations", "facts")}
        for name, df in p.dataset(t, v, o).items():
            sinks.csv(df, f"{d}/dataset/{name}.csv", p.order_of(name))
    elif a.stage == "fetch_experts":
        fetched = raw.roster_from_html(spark.read.text(a.html, wholetext=True).withColumnRenamed("value", "html"))
        if fetched.isEmpty():
            return 1  # nothing is written
        cols = "profile_url string, name string, pubmed_author_query string, orcid string, domains string, notes string, active string"
        old = vocab.csv_table(spark, a.out) if files.found(spark, a.out) else local(spark, [], cols)
        sinks.csv(sinks.upsert_roster(old, fetched), a.out, ["profile_url"])
    return 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("stage", choices=STAGES)
    ap.add_argument("--run-dir", default="run")
    ap.add_argument("--from-year", type=int, default=2015)
    ap.add_argument("--to-year", type=int, default=2026)
    ap.add_argument("--subdomain-top-k", type=int, default=12)
    ap.add_argument("--subdomain-min-records", type=int, default=3)
    ap.add_argument("--min-docs", type=int, default=3)
    ap.add_argument("--no-bertopic", action="store_true", help="accepted; clustering always uses TF-IDF and k-means")
    for name in ("domains", "types", "rules", "stoplist", "institutions", "countries", "roster", "html", "out"):
        ap.add_argument(f"--{name}")
    return run(ap.parse_args(argv))


if __name__ == "__main__":
    sys.exit(main())
