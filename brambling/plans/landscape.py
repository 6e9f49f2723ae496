"""Queries over the stored tables, one or more per operator."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brambling.functions.text import author_key, norm_title, tokens
from brambling.operators import classify, network, records, screen, topics
from brambling.plans import pipeline
from brambling.runtime import attach, cut, discard, local, table
from brambling.sources import sinks, vocab
from brambling.streaming import windows

FIRST_YEAR, LAST_YEAR, PLACE = 2015, 2026, "singapore"


def _articles(spark: SparkSession, sf: str) -> DataFrame:
    return records.from_articles(table(spark, sf, "articles"))


def _leads(spark: SparkSession, sf: str) -> DataFrame:
    return records.from_leads(table(spark, sf, "scholar_leads"))


def _all(spark: SparkSession, sf: str) -> DataFrame:
    return records.unite(_articles(spark, sf), _leads(spark, sf))


# records


def article_records(spark: SparkSession, sf: str) -> DataFrame:
    n = lambda c, a: F.size(c).cast("bigint").alias(a)
    return _articles(spark, sf).select("rid", "query_id", "doi", "pmid", "journal", "year", "language", n("article_types", "n_types"), n("mesh_terms", "n_mesh"), n("affiliations", "n_affiliations"))


def lead_records(spark: SparkSession, sf: str) -> DataFrame:
    return _leads(spark, sf).select("rid", "query_id", norm_title(F.col("title")).alias("norm"), "year", "journal")


def record_uid(spark: SparkSession, sf: str) -> DataFrame:
    return _all(spark, sf).select("rid", records.uid(F.col("doi"), F.col("pmid"), F.col("title")).alias("uid"))


def json_lines_fields(spark: SparkSession, sf: str) -> DataFrame:
    g = lambda k: F.get_json_object("raw_line", f"$.{k}").alias(k)
    return table(spark, sf, "scholar_leads").select("lead_id", g("title"), g("venue"), g("year"), g("source"))


def search_coverage(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "articles").groupBy("query_id").agg(F.count("*").alias("fetched"), F.count_distinct("page_no").alias("pages"))
    total = table(spark, sf, "articles").agg(F.count("*").alias("total"))
    return a.join(F.broadcast(total)).select("query_id", "fetched", "pages", F.round(F.col("fetched") / F.col("total"), 6).alias("share"))


def _grouped(spark: SparkSession, sf: str) -> DataFrame:
    return cut(records.duplicate_groups(_all(spark, sf)), "grouped")


def dedupe_groups(spark: SparkSession, sf: str) -> DataFrame:
    g = _grouped(spark, sf).select("rid", "group")
    first = g.groupBy("group").agg(F.min("rid").alias("first_rid"), F.count("*").alias("n"))
    return attach(g, first, ["group"], "n", g.count(), ["rid"]).select("rid", "first_rid")


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    return records.merge(_grouped(spark, sf))


def dedupe_records(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf).select("first_rid", F.col("rid").alias("survivor"), "doi", "pmid", "n_copies", F.array_join("provenance", "|").alias("provenance"), F.array_join("origins", "|").alias("origins"), F.col("needs_manual_metadata").cast("int").alias("needs_manual_metadata"))


def dedupe_title(spark: SparkSession, sf: str) -> DataFrame:
    t = _all(spark, sf).select("rid", norm_title(F.col("title")).alias("t")).where("t IS NOT NULL")
    return t.groupBy("t").agg(F.min("rid").alias("survivor"), F.count("*").alias("n_copies"))


# screening


def _screened(spark: SparkSession, sf: str) -> DataFrame:
    return screen.screen(_all(spark, sf), screen.standard_rules(FIRST_YEAR, LAST_YEAR, PLACE))


def screen_three_way(spark: SparkSession, sf: str) -> DataFrame:
    return _screened(spark, sf).select("rid", "verdict", "rule_id")


def screen_rules(spark: SparkSession, sf: str) -> DataFrame:
    return _screened(spark, sf).select(F.explode("rule_ids").alias("rule_id")).groupBy("rule_id").agg(F.count("*").alias("n"))


def screen_partition_check(spark: SparkSession, sf: str) -> DataFrame:
    return screen.partition_check(_screened(spark, sf), "rid")


def _decided(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lang = F.lower(F.trim("lang"))
    rules = [screen.Rule("LANG", "excluded", lang != "en"), screen.Rule("NOLANG", "uncertain", F.col("lang").isNull()), screen.Rule("EMPTY", "uncertain", F.coalesce(F.length(F.trim("text")), F.lit(0)) == 0)]
    s = screen.screen(table(spark, sf, "documents"), rules)
    d = table(spark, sf, "subject_examples").select("doc_id", F.when(F.col("labelled_by") == "user", "include").otherwise("exclude").alias("decision"), F.col("subject_id").alias("rule_id"), F.col("subject_id").alias("reason"))
    return s, d


def decision_overlay(spark: SparkSession, sf: str) -> DataFrame:
    s, d = _decided(spark, sf)
    return screen.overlay(s, d, "doc_id", "rule_id").select("doc_id", "verdict", "rule_id", F.col("decided").cast("int").alias("decided"))


# labels


def _scored(spark: SparkSession, sf: str, terms: DataFrame, least: int) -> DataFrame:
    return classify.scores(classify.term_hits(_articles(spark, sf), terms, "rid"), "rid", least)


def term_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, vocab.domains(spark), 1)


def _domains(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table: several steps of a query read it."""
    d = vocab.domains(spark)
    p = classify.with_primary(_scored(spark, sf, d, 4), d.select("label_id", "pos").distinct(), "rid")
    p = cut(p.select("rid", "label_id", "score", "is_primary"), "scored")
    return cut(classify.with_fallback(_articles(spark, sf), p, "rid"), "domains")


def publication_domains(spark: SparkSession, sf: str) -> DataFrame:
    return _domains(spark, sf).withColumnRenamed("label_id", "domain_id")


def primary_domain(spark: SparkSession, sf: str) -> DataFrame:
    return _domains(spark, sf).where("is_primary = 1").groupBy(F.col("label_id").alias("domain_id")).agg(F.count("*").alias("records"))


def research_types(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, vocab.research_types(spark), 3).withColumnRenamed("label_id", "type_id")


def summary_research_type_year(spark: SparkSession, sf: str) -> DataFrame:
    names = vocab.research_types(spark).select("label_id", F.col("label").alias("type_label")).distinct()
    t = _scored(spark, sf, vocab.research_types(spark), 3).join(names, "label_id").join(_articles(spark, sf).select("rid", "year"), "rid")
    return t.groupBy("type_label", "year").agg(F.count("*").alias("publications"))


def _tagged(spark: SparkSession, sf: str, domains: DataFrame | None = None) -> DataFrame:
    d = (_domains(spark, sf) if domains is None else domains).where("label_id <> 'other_id'").select("rid", F.col("label_id").alias("domain_id"), "is_primary")
    m = _articles(spark, sf).select("rid", "year", F.explode_outer("mesh_terms").alias("mesh_term"))
    return cut(d.join(m, "rid"), "tagged")


def _vocabulary(spark: SparkSession, sf: str, tagged: DataFrame | None = None) -> DataFrame:
    return classify.vocabulary(_tagged(spark, sf) if tagged is None else tagged, vocab.stoplist(spark), "rid")


def subdomain_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return _vocabulary(spark, sf)


def _edited(spark: SparkSession) -> DataFrame:
    rows = [("tb", "sputum", "Sputum tests"), ("vector_borne", "dengue", "Dengue fever"), ("rti", "covid-19", "COVID-19 (all)"), ("sti", "no such term", "Nothing")]
    return local(spark, rows, "domain_id string, mesh_term string, display_label string")


def display_label_overlay(spark: SparkSession, sf: str) -> DataFrame:
    return classify.relabel(_vocabulary(spark, sf), _edited(spark)).select("domain_id", "mesh_term", "rank", "display_label")


def _assigned(spark: SparkSession, sf: str, domains: DataFrame | None = None) -> DataFrame:
    t = _tagged(spark, sf, domains)
    return classify.assign_terms(t, cut(classify.relabel(_vocabulary(spark, sf, t), _edited(spark)), "vocabulary"), "rid")


def subdomain_assignment(spark: SparkSession, sf: str) -> DataFrame:
    return _assigned(spark, sf)


def summary_subdomain_year(spark: SparkSession, sf: str) -> DataFrame:
    d = _domains(spark, sf)
    p = d.where("is_primary = 1").select("rid", F.col("label_id").alias("domain_id")).join(_articles(spark, sf).select("rid", "year"), "rid")
    s = p.join(_assigned(spark, sf, d).select("rid", "domain_id", "subdomain"), ["rid", "domain_id"], "left")
    return s.groupBy("domain_id", F.coalesce("subdomain", F.lit(classify.OTHER)).alias("subdomain_label"), "year").agg(F.count("*").alias("publications"))


# publications from articles, by the functions of the pipeline


def _vocabularies(spark: SparkSession, sf: str) -> pipeline.Vocabularies:
    """The library's vocabularies with the institutions of the stored list, each its own alias."""
    n = table(spark, sf, "network_institution_nodes").where("label IS NOT NULL")
    return dataclasses.replace(pipeline.Vocabularies.default(spark), institutions=n.select(F.col("label").alias("alias"), "label", "country", "region", "sector"))


OPTIONS = pipeline.Options(dialects=False)


def _included(spark: SparkSession, sf: str) -> DataFrame:
    """Every article as a publication of its own."""
    return _articles(spark, sf).withColumns({"uid": F.col("rid").cast("string"), "seq": F.col("rid"), "provenance": F.array("query_id")})


def _affiliations(spark: SparkSession, sf: str) -> DataFrame:
    return cut(pipeline.author_affiliations(_included(spark, sf), _vocabularies(spark, sf), OPTIONS.dialects), "affiliations")


def author_affiliations(spark: SparkSession, sf: str) -> DataFrame:
    return _affiliations(spark, sf)


def publication_authors(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.publication_authors(_affiliations(spark, sf))


def publication_institutions(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.publication_institutions(_affiliations(spark, sf))


def publication_countries(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.publication_countries(_affiliations(spark, sf))


def led_and_international(spark: SparkSession, sf: str) -> DataFrame:
    """First or last author at the place; two countries or more."""
    led = pipeline.leadership(_affiliations(spark, sf), OPTIONS)
    return led.select("uid", F.col("singapore_led").cast("int").alias("led"), (F.col("n_countries") > 1).cast("int").alias("international"), "n_authors")


def publications(spark: SparkSession, sf: str) -> DataFrame:
    included, v = _included(spark, sf), _vocabularies(spark, sf)
    dom = pipeline.domain_labels(included, v, OPTIONS)
    sub = pipeline.subdomain_labels(included, dom, v, OPTIONS)[1]
    return pipeline.publications(pipeline.publication_facts(included, dom, sub, _affiliations(spark, sf), OPTIONS)).drop("_seq")


def summary_by_domain_year(spark: SparkSession, sf: str) -> DataFrame:
    included = _included(spark, sf)
    dom = pipeline.domain_labels(included, _vocabularies(spark, sf), OPTIONS)
    facts = cut(pipeline.led_records(included, _affiliations(spark, sf), OPTIONS), "led")
    return pipeline.summary_by_domain_year(pipeline.publication_domains(dom, facts, _vocabularies(spark, sf)), facts)


def author_attributes(spark: SparkSession, sf: str) -> DataFrame:
    authors = cut(publication_authors(spark, sf), "authors")
    return pipeline.node_attributes(authors, _vocabularies(spark, sf), OPTIONS)["author"]


def author_labels(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.author_labels(publication_authors(spark, sf))


# star schema


def _institutions(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "publication_authors").where("uid IS NOT NULL AND institution_id IS NOT NULL").select("uid", "institution_id").distinct()
    n = table(spark, sf, "network_institution_nodes").select(F.col("node_id").alias("institution_id"), "country", "region", "sector", "iso3", "is_singapore")
    return b.join(n, "institution_id", "left")


def summary_top_authors(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "publication_authors").where("author_key IS NOT NULL").select("uid", "author_key").distinct()
    p = table(spark, sf, "publications").select("uid", F.col("primary_domain").alias("domain_id"))
    x = b.join(p, "uid").groupingSets([["author_key", "domain_id"], ["author_key"]], "author_key", "domain_id")
    return x.agg(F.count_distinct("uid").alias("n_publications"), F.grouping("domain_id").alias("over_all")).select("author_key", F.when(F.col("over_all") == 1, network.ALL).otherwise(F.col("domain_id")).alias("domain_id"), "n_publications")


def top_authors_per_domain(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("domain_id").orderBy(F.desc("n_publications"), "author_key")
    return summary_top_authors(spark, sf).withColumn("rank", F.row_number().over(w)).where("rank <= 10")


# networks


def _bridge(spark: SparkSession, sf: str, node: str) -> DataFrame:
    b = table(spark, sf, "publication_authors").where(F.col(node).isNotNull()).select("uid", F.col(node).alias("node")).distinct()
    return b.join(table(spark, sf, "publications").select("uid", F.col("primary_domain").alias("domain")), "uid", "left")


def _country_bridge(spark: SparkSession, sf: str) -> DataFrame:
    return _institutions(spark, sf).where("country IS NOT NULL").select("uid", F.col("country").alias("node")).distinct()


def coauthor_institution_edges(spark: SparkSession, sf: str) -> DataFrame:
    return network.edges(_bridge(spark, sf, "institution_id"), "uid", "node", ["domain"])


def coauthor_author_edges(spark: SparkSession, sf: str) -> DataFrame:
    return network.edges(_bridge(spark, sf, "author_key"), "uid", "node", ["domain"]).where(F.col("layer") != network.ALL).select(network.edge_id().alias("edge_id"), F.col("layer").alias("domain"), "source", "target", "weight")


def coauthor_country_edges(spark: SparkSession, sf: str) -> DataFrame:
    return network.edges(_country_bridge(spark, sf), "uid", "node")


def network_institution_nodes(spark: SparkSession, sf: str) -> DataFrame:
    b = _bridge(spark, sf, "institution_id")
    n = network.nodes(b, "uid", "node", network.edges(b, "uid", "node"))
    attr = table(spark, sf, "network_institution_nodes").select("node_id", "label", "country", "region", "sector", "iso3", "is_singapore")
    return n.join(attr, "node_id", "left").select("node_id", "label", "country", "region", "sector", "iso3", "is_singapore", "degree", "weighted_degree", "n_publications")


def network_author_nodes(spark: SparkSession, sf: str) -> DataFrame:
    b = _bridge(spark, sf, "author_key")
    return network.nodes(b, "uid", "node", network.edges(b, "uid", "node"), 250)


def network_country_nodes(spark: SparkSession, sf: str) -> DataFrame:
    b = _country_bridge(spark, sf)
    return network.nodes(b, "uid", "node", network.edges(b, "uid", "node"))


def network_institution_paths(spark: SparkSession, sf: str) -> DataFrame:
    return network.paths(coauthor_institution_edges(spark, sf), table(spark, sf, "network_institution_nodes"))


def network_layout(spark: SparkSession, sf: str) -> DataFrame:
    b = _bridge(spark, sf, "institution_id")
    e = cut(network.edges(b, "uid", "node"), "edges")
    return network.layout(network.nodes(b, "uid", "node", e, 250), e)


# checks


def referential_integrity(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "publication_authors")
    gone = lambda name, col, other, key: a.where(F.col(col).isNotNull()).join(table(spark, sf, other).select(F.col(key).alias(col)), col, "left_anti").agg(F.count("*").alias("orphans")).select(F.lit(name).alias("link"), "orphans")
    return gone("publication", "uid", "publications", "uid").unionByName(gone("author", "author_key", "network_author_nodes", "node_id")).unionByName(gone("institution", "institution_id", "network_institution_nodes", "node_id"))


def semi_membership(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "publications").join(table(spark, sf, "publication_authors").where("institution_id IS NOT NULL"), "uid", "left_semi").groupBy("primary_domain").agg(F.count("*").alias("publications"))


def uniqueness_checks(spark: SparkSession, sf: str) -> DataFrame:
    u = lambda t, c: table(spark, sf, t).agg(F.count(c).alias("n"), F.count_distinct(c).alias("distinct_n")).select(F.lit(f"{t}.{c}").alias("key"), "n", "distinct_n")
    out = u("articles", "rec_id")
    for t, c in (("scholar_leads", "lead_id"), ("publications", "uid"), ("network_author_nodes", "node_id"), ("network_institution_nodes", "node_id"), ("documents", "doc_id")):
        out = out.unionByName(u(t, c))
    return out


def node_consistency(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes whose stored number of publications differs from the one counted, with both."""
    b = _bridge(spark, sf, "institution_id").groupBy(F.col("node").alias("node_id")).agg(F.count_distinct("uid").alias("counted"))
    s = table(spark, sf, "network_institution_nodes").select("node_id", F.col("n_publications").cast("bigint").alias("stored"))
    return s.join(b, "node_id", "full_outer").where("NOT (stored <=> counted)").select("node_id", "stored", "counted")


def path_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Edges by number of path rows; every placed edge has exactly two."""
    return network_institution_paths(spark, sf).groupBy("edge_id").agg(F.count("*").alias("rows")).groupBy("rows").agg(F.count("*").alias("edges"))


# text


def author_slug(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "articles").select(F.explode("authors").alias("a")).where("a.last_name IS NOT NULL AND a.fore_name IS NOT NULL")
    a = a.select("a.last_name", "a.fore_name", author_key(F.col("a.last_name"), F.col("a.fore_name")).alias("author_key"))
    return a.groupBy("last_name", "fore_name", "author_key").agg(F.count("*").alias("n"))


def token_df(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("token"))
    return d.groupBy("token").agg(F.count("*").alias("df")).where("df >= 5")


def tfidf_top_terms(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "articles").select("rec_id", F.col("journal.title").alias("journal"), F.concat_ws(" ", "title", "abstract").alias("text")).where("journal IS NOT NULL")
    return topics.top_terms(topics.term_weights(a, "journal", "rec_id", "text"), "journal")


def topic_centroids(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("dim", "v"))
    return e.groupBy("label", "dim").agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("mean"), F.count("*").alias("n"))


def nearest_centroid(spark: SparkSession, sf: str, block: int = 1_000) -> DataFrame:
    """Per vector the label of the nearest centroid over all its dimensions, ties by label, and whether it is its own. Vectors meet the
    centroids in blocks of `block`; a single block is broadcast."""
    v = table(spark, sf, "embeddings")
    means = v.select("label", F.posexplode("embedding").alias("dim", "v")).groupBy(F.col("label").alias("c"), "dim").agg(F.avg(F.col("v").cast("double")).alias("m"))
    c = cut(means.groupBy("c").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda x: x["m"]).alias("m")), "centroids")
    blocks = max(1, -(-c.count() // block))
    sets = c.groupBy(F.pmod(F.xxhash64("c"), F.lit(blocks)).cast("int").alias("block")).agg(F.collect_list(F.struct("c", "m")).alias("cs"))
    square = lambda m: F.aggregate(F.zip_with("embedding", m, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda a, x: a + x)
    met = v.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(F.broadcast(sets) if blocks == 1 else sets, "block")
    best = met.select("vec_id", "label", F.array_min(F.transform("cs", lambda x: F.struct(F.round(F.sqrt(square(x["m"])), 9).alias("d"), x["c"].alias("c")))).alias("m"))
    best = best if blocks == 1 else best.groupBy("vec_id", "label").agg(F.min("m").alias("m"))
    return best.select("vec_id", F.col("m.c").alias("nearest"), F.when(F.col("m.c") == F.col("label"), 1).otherwise(0).alias("own"))


def minmax_coords(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "network_author_nodes").select("node_id", F.col("degree").cast("double").alias("d"), F.col("weighted_degree").cast("double").alias("w"))
    r = n.agg(*[f(c).alias(f"{c}_{k}") for c in ("d", "w") for k, f in (("lo", F.min), ("hi", F.max))])
    scaled = lambda c: F.round((F.col(c) - F.col(f"{c}_lo")) / F.nullif(F.col(f"{c}_hi") - F.col(f"{c}_lo"), F.lit(0.0)), 6)
    return n.join(F.broadcast(r)).select("node_id", scaled("d").alias("x"), scaled("w").alias("y"))


def _clusters(spark: SparkSession, sf: str) -> DataFrame:
    p = _domains(spark, sf).where("is_primary = 1").select("rid", F.col("label_id").alias("domain_id"))
    t = _articles(spark, sf).select("rid", F.concat_ws(" ", "title", "abstract").alias("text")).join(p, "rid")
    return topics.cluster(t, "rid", "text", "domain_id")


def _stored_clusters(spark: SparkSession, sf: str) -> DataFrame:
    c = _clusters(spark, sf)
    stored = cut(c, "topics")
    discard(c)
    return stored


def topic_kmeans(spark: SparkSession, sf: str) -> DataFrame:
    return _clusters(spark, sf).select("rid", "domain", "topic_id")


def topic_map(spark: SparkSession, sf: str) -> DataFrame:
    return topics.map_places(_stored_clusters(spark, sf), "rid")


def topic_map_centroids(spark: SparkSession, sf: str) -> DataFrame:
    c = _stored_clusters(spark, sf)
    t = _articles(spark, sf).select("rid", F.concat_ws(" ", "title", "abstract").alias("text")).join(c.select("rid", "topic_id"), "rid")
    terms = topics.top_terms(topics.term_weights(t, "topic_id", "rid", "text"), "topic_id")
    return topics.centroids(topics.map_places(c, "rid")).join(terms, "topic_id", "left").select(F.col("domain").alias("domain_id"), "topic_id", F.col("label").alias("topic_label"), "top_terms", "size", "x", "y")


def topic_kmeans_check(spark: SparkSession, sf: str) -> DataFrame:
    """Per domain its texts, whether it has more topics than its size allows, and texts of topics numbered against their size."""
    c = cut(topic_kmeans(spark, sf), "clustered")
    sizes = c.groupBy("domain", "topic_id").agg(F.count("*").alias("n")).withColumn("k", F.regexp_extract("topic_id", r"_t(\d+)$", 1).cast("int"))
    w = Window.partitionBy("domain").orderBy("k")
    s = sizes.withColumn("wrong", (F.col("n") > F.lag("n").over(w)) | (F.row_number().over(w) != F.col("k")))
    per = s.groupBy("domain").agg(F.sum("n").cast("bigint").alias("texts"), F.count("*").alias("topics"), F.count_if("wrong").alias("misnumbered"))
    most = F.when(F.col("texts") <= 3, 1).otherwise(F.greatest(F.lit(2), F.least(F.floor(F.col("texts") / 25), F.round(F.sqrt(F.col("texts") / 2)))))
    return per.select("domain", "texts", (F.col("topics") > most).cast("int").alias("too_many"), "misnumbered")


def topic_kmeans_given(spark: SparkSession, sf: str) -> DataFrame:
    """Topics of given vectors: the embeddings within their labels."""
    v = topics.given_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding", "label")
    return topics.cluster_vectors(v, "vec_id").select("vec_id", "domain", "topic_id")


def topic_kmeans_given_check(spark: SparkSession, sf: str) -> DataFrame:
    """Per label its vectors and those in a topic of another label."""
    return topic_kmeans_given(spark, sf).groupBy("domain").agg(F.count("*").alias("vectors"), F.count_if(~F.col("topic_id").startswith(F.concat("domain", F.lit("_t")))).alias("astray"))


def network_layout_check(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes placed, nodes without a place and places outside the unit square."""
    inside = F.col("x").between(0, 1) & F.col("y").between(0, 1)
    return network_layout(spark, sf).agg(F.count_distinct("node_id").alias("nodes"), F.count_if(F.col("x").isNull() | F.col("y").isNull()).alias("unplaced"), F.count_if(~inside).alias("outside"))


def decision_amendments(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions on documents by the rule that had caught them."""
    s, d = _decided(spark, sf)
    return screen.amendments(s, d, "doc_id", "rule_id").select("rule_id", "decision", "n", F.array_join("reasons", "|").alias("reasons"))


def topic_map_check(spark: SparkSession, sf: str) -> DataFrame:
    """Per domain its placed texts, and those that lie nearer to another topic's centroid than to their own (JN-13)."""
    p = cut(topic_map(spark, sf), "places")
    return topics.misplaced(p, topics.centroids(p), "rid")


# sinks and events


def roster_upsert(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").where("c_custkey IS NOT NULL")
    old = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("profile_url"), F.concat(F.lit("old "), "c_name").alias("name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("notes"))
    new = c.where("c_custkey % 3 <> 1").select(F.col("c_custkey").alias("profile_url"), F.col("c_name").alias("name"), F.lit("fetched").alias("notes"))
    return sinks.upsert_roster(old, new)


def events_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return windows.tumbling(table(spark, sf, "events"))


def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return windows.sessions(table(spark, sf, "events"))


def events_by_hour_streamed(spark: SparkSession, sf: str) -> DataFrame:
    return windows.streamed(spark, f"{sf}/events.parquet", windows.tumbling, ["window_start", "event_type"])


def region_rollup(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    r = o.rollup("r_name", "n_name").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return r.select(F.coalesce("r_name", F.lit("ALL")).alias("region"), F.coalesce("n_name", F.lit("ALL")).alias("nation"), "orders", "total")


_NAMES = [
    "article_records", "lead_records", "record_uid", "json_lines_fields", "search_coverage", "dedupe_groups", "dedupe_records", "dedupe_title", "screen_three_way", "screen_rules",
    "screen_partition_check", "decision_overlay", "decision_amendments", "term_scoring", "publication_domains", "primary_domain", "research_types", "summary_research_type_year", "subdomain_vocabulary",
    "display_label_overlay", "subdomain_assignment", "summary_subdomain_year", "author_affiliations", "publication_authors", "publication_institutions", "publication_countries", "led_and_international", "publications", "summary_by_domain_year",
    "summary_top_authors", "top_authors_per_domain", "coauthor_institution_edges", "coauthor_author_edges", "coauthor_country_edges", "network_institution_nodes", "network_author_nodes",
    "network_country_nodes", "network_institution_paths", "network_layout", "network_layout_check", "author_attributes", "author_labels", "referential_integrity", "semi_membership", "uniqueness_checks", "node_consistency",
    "path_pairs", "author_slug", "token_df", "tfidf_top_terms", "topic_centroids", "nearest_centroid", "minmax_coords", "topic_kmeans", "topic_kmeans_check", "topic_kmeans_given", "topic_kmeans_given_check", "topic_map",
    "topic_map_centroids", "topic_map_check", "roster_upsert", "events_by_hour", "event_sessions", "events_by_hour_streamed", "region_rollup",
]
QUERIES = {n: globals()[n] for n in _NAMES}
