"""The stages from fetched pages to the published tables. Every stage is a function from tables to tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.functions.text import author_key, norm_title
from brambling.operators import classify, dialect, network, records, screen, topics
from brambling.runtime import attach, cut, local
from brambling.sources import vocab


@dataclass
class Options:
    """from_year, to_year: publication years kept. place: the country in question. least_score, type_score: lowest scores of a domain and of a
    research type. top_k, min_records: of the derived vocabulary. min_docs: fewest texts of a domain that are clustered. author_cap:
    nodes of the author network. dialects: whether fields of several affiliations are divided by their cheapest dialect, else at
    semicolons. rules: the screening rules as data."""

    from_year: int = 2015
    to_year: int = 2026
    place: str = "singapore"
    language: str = "eng"
    least_score: int = 4
    type_score: int = 3
    top_k: int = 12
    min_records: int = 3
    min_docs: int = 3
    author_cap: int = 250
    dialects: bool = True
    rules: list[dict] = field(default_factory=lambda: vocab.RULES)


def build_queries(domains: DataFrame, roster: DataFrame | None, o: Options) -> DataFrame:
    """(query_id, kind, text): one search per domain and one for all, leads per domain, and one per active expert."""
    window = F.lit(f"{o.from_year}:{o.to_year}[dp]")
    terms = domains.groupBy("label_id").agg(F.array_join(F.array_sort(F.collect_set(F.concat(F.lit('"'), "term", F.lit('"')))), " OR ").alias("t"))
    place = F.lit(f"{o.place}[ad]")
    search = terms.select(F.concat(F.lit("geo_"), "label_id").alias("query_id"), F.lit("search").alias("kind"), F.concat(F.lit("("), "t", F.lit(") AND "), place, F.lit(" AND "), window).alias("text"))
    every = local(domains.sparkSession, [("geo_all_id", "search", f"infection[mh] AND {o.place}[ad] AND {o.from_year}:{o.to_year}[dp]")], "query_id string, kind string, text string")
    leads = terms.select(F.concat(F.lit("sch_"), "label_id").alias("query_id"), F.lit("lead").alias("kind"), F.concat("t", F.lit(f" {o.place} {o.from_year}..{o.to_year}")).alias("text"))
    out = search.unionByName(every).unionByName(leads)
    if roster is not None:
        active = roster.where("coalesce(lower(trim(active)), '') NOT IN ('0', 'no', 'false') AND pubmed_author_query IS NOT NULL")
        out = out.unionByName(active.select(F.concat(F.lit("exp_"), F.substring(F.sha2("profile_url", 256), 1, 8)).alias("query_id"), F.lit("expert").alias("kind"), F.concat("pubmed_author_query", F.lit(" AND "), window).alias("text")))
    return out


def ingest(articles: DataFrame, leads: DataFrame | None = None) -> DataFrame:
    """One record per work with provenance."""
    parts = [records.from_articles(articles)] + ([records.from_leads(leads)] if leads is not None else [])
    grouped = cut(records.duplicate_groups(records.unite(*parts)), "grouped")
    merged = records.merge(grouped)
    return cut(merged.withColumn("origin", F.when(F.array_contains("origins", "pubmed"), "pubmed").otherwise("scholar")), "records")


def screened(recs: DataFrame, decisions: DataFrame | None, domains: DataFrame, o: Options) -> DataFrame:
    """Records with verdict and reasons, after the decisions. Records without any domain are uncertain."""
    n = classify.scores(classify.term_hits(recs, domains), least=o.least_score).groupBy("uid").agg(F.count("*").alias("n_domains"))
    s = screen.screen(recs.join(n, "uid", "left"), screen.rules_of(o.rules, o.from_year, o.to_year, o.place, o.language)).drop("n_domains")
    return s if decisions is None else screen.overlay(s, decisions, order="line" if "line" in decisions.columns else None)


@dataclass
class Vocabularies:
    domains: DataFrame
    types: DataFrame
    stoplist: DataFrame
    institutions: DataFrame
    countries: DataFrame

    @staticmethod
    def default(spark: SparkSession) -> Vocabularies:
        """Those of the library: domains, types, stoplist, institutions (alias, label, country, region, sector) and countries (alias, country,
        region, iso3)."""
        return Vocabularies(vocab.domains(spark), vocab.research_types(spark), vocab.stoplist(spark), vocab.institutions(spark), vocab.countries(spark))


def at_semicolons(text: Column) -> Column:
    """The parts of a field between semicolons, without electronic addresses and outer blanks."""
    bare = F.regexp_replace(text, r"(?is)\s*electronic address:.*", "")
    return F.filter(F.transform(F.split(bare, ";"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")


def author_affiliations(included: DataFrame, v: Vocabularies, dialects: bool = True) -> DataFrame:
    """uid, author_no, n_authors, author_key, label, text, institution, country, region, sector, iso3 of every value in every affiliation;
    authors without any have one row. Fields of several values are divided (Options.dialects). The institution is the longest alias that the
    text holds as whole words, of equals the last by text. The country is the institution's, else the last part of the text if that is an
    alias, else the longest alias in it. Every different text is resolved once; what can't be is null.
    """
    a = included.select("uid", F.size("authors").alias("n_authors"), F.posexplode("authors").alias("i", "a"))
    a = a.select("uid", "n_authors", (F.col("i") + 1).alias("author_no"), author_key(F.col("a.last_name"), F.col("a.fore_name")).alias("author_key"), F.concat_ws(", ", "a.last_name", "a.fore_name").alias("label"), F.coalesce("a.affiliations", F.array().cast("array<string>")).alias("affs"))
    fields = a.select("uid", "author_no", F.explode("affs").alias("t"))
    divided = dialect.with_values(fields, "t") if dialects else fields.withColumn("values", at_semicolons(F.col("t")))
    split = cut(divided.select("uid", "author_no", F.explode("values").alias("text")), "affiliation_texts")
    texts = cut(split.groupBy("text").agg(F.count("*").alias("n")), "different_texts")
    none = F.array().cast("array<string>")
    as_record = texts.select(F.col("text").alias("uid"), F.col("text").alias("title"), F.lit(None).cast("string").alias("abstract"), none.alias("mesh_terms"), none.alias("keywords"))

    def longest(aliases: DataFrame, name: str) -> DataFrame:
        hits = classify.term_hits(as_record, aliases)
        return hits.groupBy(F.col("uid").alias("text")).agg(F.max(F.struct(F.length("term").alias("l"), "term", "label_id")).alias("b")).select("text", F.col("b.label_id").alias(name))

    inst = longest(v.institutions.select(F.col("label").alias("label_id"), F.col("alias").alias("term")), "institution")
    inside = longest(v.countries.select(F.col("country").alias("label_id"), F.col("alias").alias("term")), "inside")
    known = v.countries.groupBy(norm_title(F.col("alias")).alias("tail")).agg(F.min("country").alias("at_end"))
    tail = norm_title(F.element_at(F.split("text", ","), -1))
    iattr = v.institutions.groupBy(F.col("label").alias("institution")).agg(F.min("country").alias("ic"), F.min("region").alias("ir"), F.min("sector").alias("sector"))
    cattr = v.countries.groupBy("country").agg(F.min("region").alias("cr"), F.min("iso3").alias("iso3"))
    r = texts.withColumn("tail", tail).join(classify.small(known), "tail", "left").join(inst, "text", "left").join(inside, "text", "left").join(classify.small(iattr), "institution", "left")
    r = r.withColumn("country", F.coalesce("ic", "at_end", "inside")).join(classify.small(cattr), "country", "left")
    resolved = r.select("text", "n", "institution", "country", F.coalesce("ir", "cr").alias("region"), "sector", "iso3")
    total = texts.agg(F.sum("n")).first()[0] or 0
    placed = attach(split, resolved, ["text"], "n", total, ["uid", "author_no"]).drop("n")
    return a.drop("affs").join(placed, ["uid", "author_no"], "left")


def domain_labels(included: DataFrame, v: Vocabularies, o: Options) -> DataFrame:
    """(uid, domain_id, score, is_primary): every domain of a record, or `other_id`."""
    order = v.domains.groupBy("label_id").agg(F.min("pos").alias("pos"))
    scored = cut(classify.with_primary(classify.scores(classify.term_hits(included, v.domains), least=o.least_score), order).select("uid", "label_id", "score", "is_primary"), "scored")
    return cut(classify.with_fallback(included, scored).withColumnRenamed("label_id", "domain_id"), "domains")


def subdomain_labels(included: DataFrame, dom: DataFrame, v: Vocabularies, o: Options, previous: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(vocabulary, subdomains): the terms of this corpus by domain, and each record's best one for each of its domains."""
    mesh = included.select("uid", F.explode_outer("mesh_terms").alias("mesh_term"))
    tagged = cut(dom.where("domain_id <> 'other_id'").join(mesh, "uid"), "tagged")
    words = cut(classify.relabel(classify.vocabulary(tagged, v.stoplist, least=o.min_records, top_k=o.top_k), previous), "vocabulary")
    sub = classify.assign_terms(tagged, words).join(dom.select("uid", "domain_id", "is_primary"), ["uid", "domain_id"])
    rest = dom.where("domain_id = 'other_id'").select("uid", "domain_id", F.lit(None).cast("string").alias("subdomain_mesh"), F.lit(classify.OTHER).alias("subdomain"), F.lit(None).cast("int").alias("vocabulary_rank"), "is_primary")
    return words, cut(sub.unionByName(rest), "subdomains")


def leadership(aff: DataFrame, o: Options) -> DataFrame:
    """(uid, singapore_led, n_countries, n_authors): whether the first or last author is at the place, and how many countries take part."""
    here = F.coalesce(F.lower("country") == o.place.lower(), F.lit(False))
    end = (F.col("author_no") == 1) | (F.col("author_no") == F.col("n_authors"))
    return aff.groupBy("uid").agg(F.bool_or(end & here).alias("singapore_led"), F.count_distinct("country").cast("int").alias("n_countries"), F.max("n_authors").alias("n_authors"))


def led_records(included: DataFrame, aff: DataFrame, o: Options) -> DataFrame:
    """(uid, year, seq, singapore_led, n_countries, n_authors) of every record; one without authors is led from nowhere."""
    r = included.select("uid", "year", "seq").join(leadership(aff, o), "uid", "left")
    return r.withColumns({"singapore_led": F.coalesce("singapore_led", F.lit(False)), "n_countries": F.coalesce("n_countries", F.lit(0)), "n_authors": F.coalesce("n_authors", F.lit(0))})


def publication_facts(included: DataFrame, dom: DataFrame, sub: DataFrame, aff: DataFrame, o: Options) -> DataFrame:
    """One row per record: labels, whether led from the place, countries and authors; `text` for topics and `seq`, the order of records."""
    p = dom.where("is_primary = 1").select("uid", F.col("domain_id").alias("primary_domain"))
    s = sub.where("is_primary = 1").select("uid", F.col("subdomain").alias("primary_subdomain"), F.col("subdomain_mesh").alias("primary_subdomain_mesh"))
    text = F.concat_ws(" ", "title", "abstract", F.concat_ws(" ", "mesh_terms")).alias("text")
    facts = included.select("uid", "title", "year", "journal", "doi", "pmid", "provenance", "seq", text).join(p, "uid").join(s, "uid", "left")
    return facts.join(led_records(included, aff, o).drop("year", "seq"), "uid")


def classified(included: DataFrame, v: Vocabularies, o: Options, previous: DataFrame | None = None) -> dict[str, DataFrame]:
    """Tables: domains (uid, domain_id, score, is_primary), types, vocabulary, subdomains, affiliations, facts (one row per record)."""
    dom = domain_labels(included, v, o)
    types = cut(classify.scores(classify.term_hits(included, v.types), least=o.type_score).withColumnRenamed("label_id", "type_id"), "types")
    words, sub = subdomain_labels(included, dom, v, o, previous)
    aff = cut(author_affiliations(included, v, o.dialects), "affiliations")
    return {"domains": dom, "types": types, "vocabulary": words, "subdomains": sub, "affiliations": aff, "facts": cut(publication_facts(included, dom, sub, aff, o), "facts")}


def topic_tables(facts: DataFrame, o: Options) -> dict[str, DataFrame]:
    c = cut(topics.cluster(facts, "uid", "text", "primary_domain", o.min_docs), "clusters")
    places = cut(topics.map_places(c, "uid"), "places")
    t = facts.select("uid", "text").join(c.select("uid", "topic_id"), "uid")
    terms = topics.top_terms(topics.term_weights(t, "topic_id", "uid", "text"), "topic_id")
    cents = topics.centroids(places).join(terms, "topic_id", "left")
    cents = cents.select(F.col("domain").alias("domain_id"), "topic_id", F.col("label").alias("topic_label"), "top_terms", "size", "x", "y", F.regexp_extract("topic_id", r"_t(\d+)$", 1).cast("int").alias("_no"))
    in_all = cents.groupBy("domain_id").agg(F.sum("size").alias("_in_all"))
    return {
        "publication_topics": places.withColumnRenamed("domain", "domain_id").join(facts.select("uid", F.col("seq").alias("_seq")), "uid"),
        "topic_map_centroids": cents.join(F.broadcast(in_all), "domain_id"),
    }


def _network(bridge: DataFrame, attributes: DataFrame, cap: int | None, layers: list[str]) -> dict[str, DataFrame]:
    e = cut(network.edges(bridge, "uid", "node", layers), "edges")
    n = cut(network.nodes(bridge, "uid", "node", e, cap), "nodes")
    placed = cut(network.layout(n, e), "layout")
    nodes = n.join(attributes, "node_id", "left").join(placed, "node_id")
    cols = [c for c in ("node_id", "label", "country", "region", "sector", "iso3", "is_singapore") if c in nodes.columns]
    return {"edges": e.select(network.edge_id().alias("edge_id"), F.col("layer").alias("domain"), "source", "target", "weight"), "nodes": nodes.select(*cols, "x", "y", "degree", "weighted_degree", "n_publications"), "paths": network.paths(e, placed).withColumnRenamed("layer", "domain")}


def _named(t: DataFrame, v: Vocabularies) -> DataFrame:
    """`t` (domain_id, ...) with domain_label."""
    names = v.domains.groupBy(F.col("label_id").alias("domain_id")).agg(F.min("label").alias("domain_label"))
    return t.join(classify.small(names), "domain_id", "left").withColumn("domain_label", F.coalesce("domain_label", F.lit("Other infectious disease")))


def publications(facts: DataFrame) -> DataFrame:
    return facts.select("uid", "title", "year", "journal", "primary_domain", "primary_subdomain", F.col("singapore_led").cast("int").alias("singapore_led"), "n_authors", "n_countries", F.col("seq").alias("_seq"))


def publication_domains(dom: DataFrame, facts: DataFrame, v: Vocabularies) -> DataFrame:
    base = facts.select("uid", "year", F.col("singapore_led").cast("int").alias("singapore_led"), F.col("seq").alias("_seq"))
    return _named(dom, v).join(base, "uid").select("uid", "domain_id", "domain_label", "is_primary", F.col("score").alias("domain_score"), "year", "singapore_led", "_seq")


def summary_by_domain_year(domains: DataFrame, facts: DataFrame) -> DataFrame:
    """Publications, those led from the place and international ones (two countries or more) by domain and year; a publication counts in each of
    its domains."""
    international = facts.select("uid", (F.col("n_countries") > 1).alias("intl"))
    return domains.join(international, "uid").groupBy("domain_id", "domain_label", "year").agg(F.count("*").alias("publications"), F.sum("singapore_led").alias("singapore_led"), F.count_if("intl").alias("international"))


def publication_authors(aff: DataFrame) -> DataFrame:
    """(uid, author_no, author_key, label, institution_id): one row per author with a key; of several institutions the first by text."""
    return aff.where("author_key IS NOT NULL").groupBy("uid", "author_no").agg(F.min("author_key").alias("author_key"), F.min("label").alias("label"), F.min("institution").alias("institution_id"))


def publication_institutions(aff: DataFrame) -> DataFrame:
    return aff.where("institution IS NOT NULL").select("uid", F.col("institution").alias("institution_id"), "country", "region", "sector").distinct()


def publication_countries(aff: DataFrame) -> DataFrame:
    return aff.where("country IS NOT NULL").groupBy("uid", "country").agg(F.min("region").alias("region"), F.min("iso3").alias("iso3"))


def author_labels(authors: DataFrame) -> DataFrame:
    """(author_key, label): the most frequent spelling, of equals the first by text."""
    n = authors.groupBy("author_key", "label").agg(F.count("*").alias("n"))
    return n.groupBy("author_key").agg(F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("b")).select("author_key", F.col("b.label").alias("label"))


def author_institutions(authors: DataFrame) -> DataFrame:
    """(author_key, institution): the one on most publications, of equals the first by text; authors without any have no row."""
    n = authors.where("institution_id IS NOT NULL").groupBy("author_key", "institution_id").agg(F.count("*").alias("n"))
    return n.groupBy("author_key").agg(F.min(F.struct((-F.col("n")).alias("n"), "institution_id")).alias("b")).select("author_key", F.col("b.institution_id").alias("institution"))


def node_attributes(authors: DataFrame, v: Vocabularies, o: Options) -> dict[str, DataFrame]:
    """Attributes of nodes by network: node_id, label, country, region, sector, iso3, is_singapore. Those of an author are the attributes of
    the author's institution, null where none was resolved; countries have no sector."""
    cattr = v.countries.groupBy("country").agg(F.min("region").alias("region"), F.min("iso3").alias("iso3"))
    iattr = v.institutions.groupBy(F.col("label").alias("institution")).agg(F.min("country").alias("country"), F.min("region").alias("region"), F.min("sector").alias("sector")).join(classify.small(cattr.select("country", "iso3")), "country", "left")
    flagged = lambda df: df.withColumn("is_singapore", F.coalesce((F.lower("country") == o.place.lower()).cast("int"), F.lit(0)))
    shown = lambda df, node, label: flagged(df).select(F.col(node).alias("node_id"), F.col(label).alias("label"), "country", "region", "sector", "iso3", "is_singapore")
    of_author = author_labels(authors).join(author_institutions(authors), "author_key", "left").join(classify.small(iattr), "institution", "left")
    return {"institution": shown(iattr, "institution", "institution"), "author": shown(of_author, "author_key", "label"), "country": shown(cattr.withColumn("sector", F.lit(None).cast("string")), "country", "country")}


def dataset(t: dict[str, DataFrame], v: Vocabularies, o: Options) -> dict[str, DataFrame]:
    """The published tables by name; columns that begin with `_` give their order only."""
    facts, dom, aff = t["facts"], t["domains"], t["affiliations"]
    seq = facts.select("uid", F.col("seq").alias("_seq"))
    pd_ = publication_domains(dom, facts, v)
    tn = v.types.groupBy(F.col("label_id").alias("type_id")).agg(F.min("label").alias("type_label"))
    prt = t["types"].join(classify.small(tn), "type_id").join(facts.select("uid", "year", "primary_domain"), "uid").select("uid", "type_id", "type_label", F.col("score").alias("type_score"), "year", "primary_domain")
    domains = dom.select("uid", F.col("domain_id").alias("domain"))
    authors = cut(publication_authors(aff), "authors")
    inst, cty = publication_institutions(aff), publication_countries(aff)
    attributes = node_attributes(authors, v, o)
    bridges = {"institution": inst.select("uid", F.col("institution_id").alias("node")), "author": authors.select("uid", F.col("author_key").alias("node")), "country": cty.select("uid", F.col("country").alias("node"))}
    nets = {k: _network(b.join(domains, "uid"), attributes[k], o.author_cap if k == "author" else None, ["domain"]) for k, b in bridges.items()}
    top = authors.select("uid", "author_key").distinct().join(domains, "uid")
    per = top.groupBy("author_key", F.col("domain").alias("domain_id")).agg(F.count_distinct("uid").alias("n_publications"))
    every = top.groupBy("author_key").agg(F.count_distinct("uid").alias("n_publications")).select("author_key", F.lit(network.ALL).alias("domain_id"), "n_publications")
    sub = _named(t["subdomains"], v)
    out = {
        "publications": publications(facts),
        "publication_domains": pd_,
        "publication_subdomains": sub.where("is_primary = 1").select("uid", "domain_id", "subdomain", "subdomain_mesh", "is_primary", "vocabulary_rank").join(seq, "uid"),
        "publication_research_types": prt.join(seq, "uid"),
        "publication_authors": authors.join(seq, "uid"),
        "publication_institutions": inst.join(seq, "uid"),
        "publication_countries": cty.join(seq, "uid"),
        "summary_top_authors": per.unionByName(every),
        "summary_by_domain_year": summary_by_domain_year(pd_, facts),
        "summary_subdomain_year": sub.where("is_primary = 1").join(facts.select("uid", "year"), "uid").groupBy("domain_id", "domain_label", F.col("subdomain").alias("subdomain_label"), "year").agg(F.count("*").alias("publications")),
        "summary_research_type_year": prt.groupBy("type_label", "year").agg(F.count("*").alias("publications")),
    }
    for k, x in nets.items():
        e = x["edges"] if k != "author" else x["edges"].where(F.col("domain") != network.ALL)
        out |= {f"coauthor_{k}_edges": e, f"network_{k}_nodes": x["nodes"], f"network_{k}_paths": x["paths"]}
    return out | topic_tables(facts, o)


def order_of(name: str) -> list[str | Column]:
    """The published order of a table: records as first seen, labels by score, topics by the size of their domain, others by their keys."""
    by_record = {
        "publications": [], "publication_domains": [F.desc("is_primary"), F.desc_nulls_last("domain_score"), "domain_id"], "publication_subdomains": ["domain_id"], "publication_research_types": [F.desc("type_score"), "type_id"],
        "publication_authors": ["author_no"], "publication_institutions": ["institution_id"], "publication_countries": ["country"], "publication_topics": [],
    }
    if name in by_record:
        return ["_seq", "uid", *by_record[name]]
    return [F.desc("_in_all"), "domain_id", "_no"] if name == "topic_map_centroids" else KEYS[name]


KEYS = {
    "summary_top_authors": ["author_key", "domain_id"], "summary_by_domain_year": ["domain_id", "year"], "summary_subdomain_year": ["domain_id", "subdomain_label", "year"],
    "summary_research_type_year": ["type_label", "year"], "topic_map_centroids": [],
    **{f"coauthor_{k}_edges": ["edge_id"] for k in ("institution", "author", "country")}, **{f"network_{k}_nodes": ["node_id"] for k in ("institution", "author", "country")}, **{f"network_{k}_paths": ["edge_id", "node_id"] for k in ("institution", "author", "country")},
}
TABLES = ("publications", "publication_domains", "publication_subdomains", "publication_research_types", "publication_authors", "publication_institutions", "publication_countries", "publication_topics", *KEYS)


def checks(t: dict[str, DataFrame]) -> DataFrame:
    """(check, bad): rows that break a rule of the published tables; all must be 0."""
    pubs = t["publications"].select("uid")

    def orphans(n: str) -> DataFrame:
        return t[n].join(pubs, "uid", "left_anti")

    def repeated(df: DataFrame, c: str) -> DataFrame:
        return df.groupBy(c).count().where("count > 1")

    tests = {f"{n} orphans": orphans(n) for n in ("publication_domains", "publication_subdomains", "publication_research_types", "publication_authors", "publication_institutions", "publication_countries")}
    tests["publications repeated"] = repeated(t["publications"], "uid")
    tests["not one primary domain"] = t["publication_domains"].groupBy("uid").agg(F.sum("is_primary").alias("n")).where("n <> 1")
    for k in ("institution", "author", "country"):
        e, p, n = t[f"coauthor_{k}_edges"], t[f"network_{k}_paths"], t[f"network_{k}_nodes"]
        tests[f"{k} edges repeated"] = repeated(e, "edge_id")
        tests[f"{k} edges turned"] = e.where("source >= target OR weight < 1")
        tests[f"{k} paths not in pairs"] = p.groupBy("edge_id").count().where("count <> 2")
        tests[f"{k} paths without node"] = p.join(n.select("node_id"), "node_id", "left_anti")
        tests[f"{k} places outside"] = n.where("NOT (x BETWEEN 0 AND 1 AND y BETWEEN 0 AND 1)")
    out = None
    for name, df in tests.items():
        one = df.agg(F.count("*").alias("bad")).select(F.lit(name).alias("check"), "bad")
        out = one if out is None else out.unionByName(one)
    return out
