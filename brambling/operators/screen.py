"""Screening by declared rules, with an overlay of decisions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brambling.functions.text import folded
from brambling.sources.vocab import RULES


@dataclass
class Rule:
    """verdict: `excluded` or `uncertain`, where `test` holds (null counts as not). needs: columns that tests share, by name; each is
    worked out once a record."""

    rule_id: str
    verdict: str
    test: Column
    needs: dict[str, Column] = field(default_factory=dict)


def has_type(*types: str) -> Column:
    return F.arrays_overlap(F.transform("article_types", lambda t: F.lower(F.trim(t))), F.array(*[F.lit(t.lower()) for t in types]))


def mentions(c: Column, word: str) -> Column:
    """Whether a text holds the word (or phrase) as whole words."""
    return F.concat(F.lit(" "), F.coalesce(folded(c), F.lit("")), F.lit(" ")).contains(f" {word.lower()} ")


def rules_of(specs: list[dict], first_year: int, last_year: int, place: str, language: str = "eng") -> list[Rule]:
    """Rules from their data: rule_id, verdict, test and values, in the order of reasons.

    Tests: `type` (a publication type among values), `language` (another than the one asked), `year` (outside the window), `no_place`
    (an article without the place in affiliations and text), `lead` (from no article), `only_office` (all affiliations at the place
    have a word among values), `place_in_text` (there only), `no_abstract`, `no_domain` (needs the column n_domains).
    Any other test is an error.
    """
    near = {"_placed": F.filter("affiliations", lambda a: mentions(a, place)), "_in_text": mentions(F.concat_ws(" ", "title", "abstract"), place)}
    here = F.size("_placed") > 0
    article = F.col("origin") == "pubmed"

    def test(s: dict) -> Column:
        values = s.get("values") or []
        made = {
            "type": lambda: has_type(*values),
            "language": lambda: F.col("language") != language,
            "year": lambda: ~F.col("year").between(first_year, last_year),
            "no_place": lambda: article & ~here & ~F.col("_in_text"),
            "lead": lambda: ~article,
            "only_office": lambda: here & F.forall("_placed", lambda a: F.lower(a).rlike(r"\b(?:" + "|".join(values) + r")\b")),
            "place_in_text": lambda: ~here & F.col("_in_text"),
            "no_abstract": lambda: F.coalesce(F.length(F.trim("abstract")), F.lit(0)) == 0,
            "no_domain": lambda: F.coalesce("n_domains", F.lit(0)) == 0,
        }
        if s["test"] not in made or s["verdict"] not in ("excluded", "uncertain"):
            raise ValueError(f"rule {s['rule_id']}: no test {s['test']} or verdict {s['verdict']}")
        return made[s["test"]]()

    return [Rule(s["rule_id"], s["verdict"], test(s), near if s["test"] in ("no_place", "only_office", "place_in_text") else {}) for s in specs]


def standard_rules(first_year: int, last_year: int, place: str, language: str = "eng") -> list[Rule]:
    """The rules of the library that need no labels."""
    return rules_of([r for r in RULES if r["test"] != "no_domain"], first_year, last_year, place, language)


def screen(records: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add rule_ids (all rules that hold, in order), rule_id (the first of the verdict) and verdict: excluded if any such rule holds,
    else uncertain if any, else included. No shuffle."""
    hits = F.array_compact(F.array(*[F.when(F.coalesce(r.test, F.lit(False)), F.struct(F.lit(r.rule_id).alias("id"), F.lit(r.verdict).alias("v"))) for r in rules]))
    of = lambda v: F.filter("_hits", lambda h: h["v"] == v)
    needs = {k: c for r in rules for k, c in r.needs.items()}
    out = records.withColumns(needs).withColumn("_hits", hits).drop(*needs)
    verdict = F.when(F.size(of("excluded")) > 0, "excluded").when(F.size(of("uncertain")) > 0, "uncertain").otherwise("included")
    out = out.withColumn("verdict", verdict).withColumn("rule_id", F.get(F.filter("_hits", lambda h: h["v"] == F.col("verdict")), F.lit(0))["id"])
    return out.withColumn("rule_ids", F.transform("_hits", lambda h: h["id"])).drop("_hits")


def overlay(screened: DataFrame, decisions: DataFrame, key: str = "uid", order: str | None = None) -> DataFrame:
    """Decisions (key, decision include|exclude, rule_id) override the verdict. Of several decisions on one key the last by `order`
    counts (or the last by text of its columns), as decisions are appended. Decisions are small beside the records; the optimizer
    broadcasts them if their size allows."""
    d = decisions.where(F.col(key).isNotNull() & F.col("decision").isin("include", "exclude"))
    w = Window.partitionBy(key).orderBy(F.desc(order) if order else F.desc("decision"), F.desc("decision"))
    d = d.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(key, "decision", F.col("rule_id").alias("_rule"))
    word = F.when(F.col("decision") == "include", "included").when(F.col("decision") == "exclude", "excluded")
    out = screened.join(d, key, "left").withColumn("verdict", F.coalesce(word, "verdict")).withColumn("rule_id", F.coalesce("_rule", "rule_id"))
    return out.withColumn("decided", F.col("decision").isNotNull()).drop("decision", "_rule")


def partition_check(screened: DataFrame, key: str = "uid") -> DataFrame:
    """Counts per verdict, of keys in more than one verdict and of rows without verdict; the last two must be 0."""
    n = lambda v: F.count_if(F.col("verdict") == v).alias(v)
    per = screened.groupBy(key).agg(F.count_distinct("verdict").alias("k"))
    twice = per.agg(F.count_if(F.col("k") > 1).alias("overlapping"))
    return screened.agg(n("included"), n("excluded"), n("uncertain"), F.count_if(F.col("verdict").isNull()).alias("unassigned"), F.count("*").alias("total")).crossJoin(twice)


def amendments(screened: DataFrame, decisions: DataFrame, key: str = "uid", order: str | None = None) -> DataFrame:
    """(rule_id, decision, n, reasons): what people decided on records that a rule had caught, the log from which rules are amended."""
    d = overlay(screened.select(key, F.lit(None).cast("string").alias("verdict"), F.lit(None).cast("string").alias("rule_id")), decisions, key, order).where("decided").select(key, F.col("verdict").alias("decision"))
    why = decisions.where(F.col("reason").isNotNull()).groupBy(key).agg(F.collect_set("reason").alias("why"))
    caught = screened.select(key, "rule_id").where("rule_id IS NOT NULL").join(d, key).join(why, key, "left")
    return caught.groupBy("rule_id", "decision").agg(F.count("*").alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("why", F.array().cast("array<string>")))))).alias("reasons"))
