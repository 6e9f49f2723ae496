"""Result pages as fetched: their shapes, read tolerantly."""

from __future__ import annotations

from pyspark.sql import DataFrame

from brambling.operators.shred import Node, flat_table, stripes


def _named(key: str):
    def adapt(x: object) -> object:
        return {key: x} if isinstance(x, (str, int, float)) else x

    return adapt


def _identifiers(x: object) -> object:
    """A list of {type, value} as one object."""
    if isinstance(x, list):
        return {str(e["type"]).lower(): e.get("value") for e in x if isinstance(e, dict) and e.get("type") is not None}
    return x


def _date(x: object) -> object:
    """A date as text: its parts."""
    if isinstance(x, (str, int)):
        return dict(zip(("year", "month", "day"), str(x).replace("/", "-").replace(" ", "-").split("-"), strict=False))
    return x


def _affiliation(x: object) -> object:
    return x.get("name") if isinstance(x, dict) else x


def _leaves(*names: str) -> list[Node]:
    return [Node(n) for n in names]


PAGE = Node("page", [
    Node("articles", [
        Node("identifiers", _leaves("pmid", "doi", "pmc", "pii"), adapt=_identifiers),
        *_leaves("title", "abstract", "doi", "language"),
        Node("journal", _leaves("title", "iso_abbreviation"), adapt=_named("title")),
        Node("publication_date", _leaves("year", "month", "day"), adapt=_date),
        Node("citation", _leaves("volume", "issue", "pages")),
        Node("authors", [*_leaves("last_name", "fore_name", "initials", "collective_name"), Node("affiliations", repeated=True, adapt=_affiliation)], repeated=True, adapt=_named("last_name")),
        Node("mesh_terms", repeated=True),
        Node("keywords", repeated=True),
        Node("article_types", repeated=True),
    ], repeated=True),
])


def page_record(v: object) -> object:
    """The page as {articles: [...]}: a bare list, an object with `articles` at any depth of wrapping, or one bare article."""
    if isinstance(v, list):
        return {"articles": v}
    if isinstance(v, dict):
        if "articles" in v:
            return v
        if {"identifiers", "title", "authors"} & v.keys():
            return {"articles": [v]}
        for x in v.values():
            if isinstance(x, dict) and (r := page_record(x)) and r.get("articles") is not None:
                return r
    return {}


def page_stripes(pages: DataFrame) -> DataFrame:
    return stripes(pages, "page_id", "body", PAGE, page_record)


def page_tables(striped: DataFrame) -> dict[str, DataFrame]:
    """The flat tables of the pages; (id, article_no[, author_no[, affiliation_no]]) are keys and links to the parent."""
    art = {n: f"articles.{p}" for n, p in (("pmid", "identifiers.pmid"), ("doi", "doi"), ("pmc", "identifiers.pmc"), ("pii", "identifiers.pii"), ("title", "title"), ("abstract", "abstract"), ("language", "language"), ("journal", "journal.title"), ("iso_abbreviation", "journal.iso_abbreviation"), ("year", "publication_date.year"), ("month", "publication_date.month"), ("day", "publication_date.day"), ("volume", "citation.volume"), ("issue", "citation.issue"), ("pages", "citation.pages"))}
    out = {
        "articles": flat_table(striped, PAGE, "articles", art, ["article_no"]),
        "authors": flat_table(striped, PAGE, "articles.authors", {n: f"articles.authors.{n}" for n in ("last_name", "fore_name", "initials", "collective_name")}, ["article_no", "author_no"]),
        "affiliations": flat_table(striped, PAGE, "articles.authors.affiliations", {"affiliation": "articles.authors.affiliations", "pmid": "articles.identifiers.pmid"}, ["article_no", "author_no", "affiliation_no"], absent=True),
    }
    for n in ("mesh_terms", "keywords", "article_types"):
        out[n] = flat_table(striped, PAGE, f"articles.{n}", {"value": f"articles.{n}"}, ["article_no", "value_no"])
    return out
