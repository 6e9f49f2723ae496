"""The pN_ queries of the general problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.operators import dialect
from brambling.runtime import table
from brambling.sources import pages


def _page_table(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return pages.page_tables(pages.page_stripes(table(spark, sf, "raw_pages")))[name].withColumnRenamed("id", "page_id")

    return run


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    a = _page_table("affiliations")(spark, sf).where("author_no > 0")
    return a.select("page_id", "article_no", "author_no", "affiliation_no", F.coalesce("pmid", F.lit("")).alias("pmid"))


def affiliations(spark: SparkSession, sf: str) -> DataFrame:
    """rec_id, author_no, affiliation_no, text of every stored affiliation of `articles`."""
    a = table(spark, sf, "articles").select("rec_id", F.posexplode("authors").alias("i", "a"))
    return a.select("rec_id", (F.col("i") + 1).alias("author_no"), F.posexplode("a.affiliations").alias("j", "text")).select("rec_id", "author_no", (F.col("j") + 1).alias("affiliation_no"), "text")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    v = dialect.with_values(affiliations(spark, sf), "text").where(F.size("values") > 1)
    return v.select("rec_id", "author_no", "affiliation_no", F.posexplode("values").alias("k", "affiliation")).select("rec_id", "author_no", "affiliation_no", (F.col("k") + 1).alias("part_no"), "affiliation")


QUERIES = {"p7_found": p7_found, "p5_found": p5_found, **{f"p5_{n}": _page_table(n) for n in ("articles", "authors", "affiliations", "mesh_terms", "keywords", "article_types")}}
_LIST = "CASE json_type({0}) WHEN 'ARRAY' THEN from_json({0}, '[\"JSON\"]') WHEN 'OBJECT' THEN [{0}] WHEN 'VARCHAR' THEN [{0}] ELSE [] END"
_ARTICLES = f"""
WITH p AS (SELECT page_id, body::JSON AS j FROM raw_pages WHERE body IS NOT NULL AND json_valid(body)),
a AS (SELECT page_id, CASE WHEN json_type(j) = 'ARRAY' THEN j WHEN json_type(j, '$.articles') IN ('ARRAY', 'OBJECT') THEN j->'$.articles' ELSE j->'$.result.articles' END AS l FROM p),
b AS (SELECT page_id, {_LIST.format('l')} AS l FROM a),
x AS (SELECT page_id, i AS article_no, l[i] AS t FROM b, unnest(range(1, len(l) + 1)) r(i))"""


def _leaf(e: str) -> str:
    return f"CASE json_type({e}) WHEN 'NULL' THEN NULL WHEN 'VARCHAR' THEN {e}->>'$' ELSE ({e})::VARCHAR END"


def _of(group: str, member: str) -> str:
    return _leaf(f"(t->'$.{group}.{member}')")


def _identifier(kind: str) -> str:
    listed = f"list_filter(from_json(t->'$.identifiers', '[\"JSON\"]'), lambda e: lower(e->>'$.type') = '{kind}')[-1]->'$.value'"
    return f"CASE json_type(t, '$.identifiers') WHEN 'ARRAY' THEN {_leaf(f'({listed})')} ELSE {_of('identifiers', kind)} END"


def _date(n: int, part: str) -> str:
    text = "string_split(replace(replace(t->>'$.publication_date', '/', '-'), ' ', '-'), '-')"
    return f"CASE WHEN json_type(t, '$.publication_date') = 'OBJECT' THEN {_of('publication_date', part)} WHEN json_type(t, '$.publication_date') <> 'NULL' THEN {text}[{n}] END"


_FIELDS = {
    "pmid": _identifier("pmid"), "doi": _leaf("(t->'$.doi')"), "pmc": _identifier("pmc"), "pii": _identifier("pii"), **{c: _leaf(f"(t->'$.{c}')") for c in ("title", "abstract", "language")},
    "journal": f"CASE WHEN json_type(t, '$.journal') = 'OBJECT' THEN {_of('journal', 'title')} ELSE {_leaf("(t->'$.journal')")} END", "iso_abbreviation": _of("journal", "iso_abbreviation"),
    "year": _date(1, "year"), "month": _date(2, "month"), "day": _date(3, "day"), **{c: _of("citation", c) for c in ("volume", "issue", "pages")},
}
_AUTHORS = f"""{_ARTICLES},
y AS (SELECT page_id, article_no, {_LIST.format("(t->'$.authors')")} AS l, {_identifier("pmid")} AS pmid FROM x),
w AS (SELECT page_id, article_no, k AS author_no, l[k] AS u, pmid FROM y, unnest(range(1, len(l) + 1)) r(k)),
z AS (SELECT page_id, article_no, author_no, {_LIST.format("(u->'$.affiliations')")} AS l, pmid FROM w)"""
_ROWS = "unnest(CASE WHEN len(l) = 0 THEN [0] ELSE range(1, len(l) + 1) END) r(m)"
_PERSON = {c: _leaf(f"(u->'$.{c}')") for c in ("last_name", "fore_name", "initials", "collective_name")}
_PERSON["last_name"] = f"CASE WHEN json_type(u) = 'OBJECT' THEN {_PERSON['last_name']} ELSE {_leaf('u')} END"


def _values(member: str) -> str:
    return f"{_ARTICLES}, v AS (SELECT page_id, article_no, {_LIST.format(f"(t->'$.{member}')")} AS l FROM x) SELECT page_id, article_no::INT AS article_no, n::INT AS value_no, {_leaf('l[n]')} AS value FROM v, unnest(range(1, len(l) + 1)) r(n)"


ORACLES: dict[str, str] = {
    "p5_found": f"{_AUTHORS} SELECT page_id, article_no::INT AS article_no, author_no::INT AS author_no, m::INT AS affiliation_no, coalesce(pmid, '') AS pmid FROM z, {_ROWS}",
    "p5_articles": f"{_ARTICLES} SELECT page_id, article_no::INT AS article_no, {', '.join(f'{e} AS {c}' for c, e in _FIELDS.items())} FROM x",
    "p5_authors": f"{_AUTHORS} SELECT page_id, article_no::INT AS article_no, author_no::INT AS author_no, {', '.join(f'{e} AS {c}' for c, e in _PERSON.items())} FROM w",
    "p5_affiliations": f"{_AUTHORS} SELECT page_id, article_no::INT AS article_no, author_no::INT AS author_no, m::INT AS affiliation_no, CASE WHEN json_type(l[m]) = 'OBJECT' THEN {_leaf("(l[m]->'$.name')")} ELSE {_leaf('l[m]')} END AS affiliation, pmid FROM z, {_ROWS}",
    **{f"p5_{n}": _values(n) for n in ("mesh_terms", "keywords", "article_types")},
}
