"""Edge cases and brute force of the general operators."""

import datetime
import itertools
import json
import math
import os
import random
import warnings
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brambling import runtime
from brambling.functions import text
from brambling.operators import classify, components, dialect, network, records, screen, shred, topics
from brambling.runtime import attach, local
from brambling.sources import pages, raw, sinks, vocab
from brambling.streaming import windows


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# components and joins


def test_components_against_union_find(spark):
    rnd = random.Random(1)
    es = [(f"n{rnd.randint(0, 80)}", f"n{rnd.randint(0, 80)}") for _ in range(60)] + [(f"c{i}", f"c{i + 1}") for i in range(60)] + [("x", "x"), (None, "y"), ("z", None)]
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in es:
        if a is not None and b is not None:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    df = spark.createDataFrame(es, "u string, v string")
    assert dict(rows(components.components(df))) == {n: find(n) for n in list(parent)}
    assert components.components(df.limit(0)).count() == 0


def test_attach_spreads_hot_keys(spark):
    big = spark.range(20000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    small = big.groupBy("k").agg(F.count("*").alias("n"))
    out = attach(big, small, ["k"], "n", 20000)
    assert out.count() == 20000 and out.where("k = 0").count() == 6667 and out.columns == ["k", "id", "n"]


def test_attach_deals_rows_by_the_columns_named(spark):
    """A key of a third of all rows gets a task for every 1,000 of them here; its rows meet their group once each."""
    big = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id")
    small = big.groupBy("k").agg(F.count("*").alias("n"))
    out = attach(big, small, ["k"], "n", 30000, ["id"])
    assert out.count() == 30000 == out.select("id").distinct().count() and out.where("k = 'hot' AND n = 10000").count() == 10000


def test_components_of_a_hub(spark):
    hub = spark.range(1, 5001).select(F.lit(0).cast("bigint").alias("u"), F.col("id").alias("v"))
    star = spark.range(1, 5001).select(F.col("id").alias("u"), F.lit(10**6).cast("bigint").alias("v"))
    assert {r[0] for r in components.components(hub.unionByName(star)).select("component").distinct().collect()} == {0}


def test_own_folder_is_for_local_masters_only(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "x"

    class Session:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})
        sparkContext = Context  # noqa: N815

    with pytest.raises(ValueError, match="checkpoint"):
        runtime.shared_dir(Session)


def test_term_hits_of_any_vocabulary_size(spark):
    """The same hits whether the vocabulary is broadcast or shuffled; whole words only, not across members of a list; nulls match nothing."""
    recs = spark.createDataFrame([(1, "Dengue fever, in DENGUE", "scrub typhus and typhus", ["Hand Hygiene", "Cross"], ["x"]), (2, None, None, None, None), (3, "dengues", "", ["cross", "infection"], [None]), (4, "Fièvre dengue", "a" * 5000, [], [])], "uid int, title string, abstract string, mesh_terms array<string>, keywords array<string>")
    terms = local(spark, [("a", "dengue"), ("a", "Dengue fever"), ("b", "typhus"), ("b", "cross infection"), ("c", "hand hygiene"), ("c", None), ("c", "dengue"), ("c", "dengue"), ("d", "fievre")], "label_id string, term string")
    want = {(1, "title", "a", "dengue"), (1, "title", "c", "dengue"), (1, "title", "a", "dengue fever"), (1, "abstract", "b", "typhus"), (1, "mesh", "c", "hand hygiene"), (4, "title", "a", "dengue"), (4, "title", "c", "dengue"), (4, "title", "d", "fievre")}
    for most in (100, 1):
        got = [tuple(r) for r in classify.term_hits(recs, terms, most=most).collect()]
        assert set(got) == want and len(got) == len(want)
    assert classify.term_hits(recs, terms.limit(0)).count() == 0 == classify.term_hits(recs.limit(0), terms).count()
    plan = classify.term_hits(recs, terms)._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "Exchange hashpartitioning(uid" not in plan


# problem 5


def test_shred_levels():
    root = shred.Node("r", [shred.Node("a", [shred.Node("x"), shred.Node("b", repeated=True)], repeated=True)])
    got = shred.shred({"a": [{"x": 1, "b": ["p", None]}, {}, {"b": "q"}]}, root)
    assert got["a.x"] == ([0, 1, 1], [2, 1, 1], ["1", None, None])
    assert got["a.b"] == ([0, 2, 1, 1], [3, 2, 1, 3], ["p", None, None, "q"])
    assert shred.shred({}, root)["a.b"] == ([0], [0], [None])


def _page(rnd):
    aff = lambda: rnd.choice(["A", {"name": "B", "country": None}, "C" * 3])
    affs = lambda: rnd.choice([None, "one", [], [aff() for _ in range(rnd.randint(1, 3))]])
    person = lambda: rnd.choice([{"last_name": "L", "affiliations": affs()}, {"collective_name": "G"}, {"last_name": "M", "fore_name": "F", "affiliations": affs()}])
    art = lambda: {"identifiers": rnd.choice([None, {"pmid": rnd.choice([1, "2", "", None])}, [{"type": "pmid", "value": "7"}, {"type": "doi", "value": "d"}]]), "authors": rnd.choice([None, person(), [], [person() for _ in range(rnd.randint(1, 4))]]), "journal": rnd.choice(["J", {"title": "J"}, None]), "more": {"authors": [1]}, "mesh_terms": rnd.choice([None, "m", ["m", "n"]])}
    arts = [art() for _ in range(rnd.randint(0, 4))]
    return rnd.choice([{"articles": arts, "count": 1}, arts, {"status": "ok", "result": {"articles": arts}}, {"articles": art()}, {"error": "x"}])


def _brute(pid, page):
    arts = page if isinstance(page, list) else page.get("articles", (page.get("result") or {}).get("articles"))
    arts = [arts] if isinstance(arts, dict) else arts or []
    for i, a in enumerate(arts, 1):
        ids = a["identifiers"] or {}
        pmid = next((x["value"] for x in ids if x["type"] == "pmid"), None) if isinstance(ids, list) else ids.get("pmid")
        people = a["authors"] or []
        for k, p in enumerate([people] if isinstance(people, dict) else people, 1):
            af = p.get("affiliations") or []
            af = af if isinstance(af, list) else [af]
            for j in range(1, len(af) + 1) if af else [0]:
                v = af[j - 1] if j else None
                yield (pid, i, k, j, v["name"] if isinstance(v, dict) else v, None if pmid is None else str(pmid))


def test_pages_against_walk(spark):
    rnd = random.Random(5)
    data = [(i, _page(rnd)) for i in range(300)]
    bodies = [(i, json.dumps(p), "x") for i, p in data] + [(900, None, "x"), (901, "{", "x"), (902, "", "x"), (903, "3", "x"), (904, "null", "x"), (905, "[" * 5000, "x")]
    df = spark.createDataFrame(bodies, "page_id bigint, body string, id string")
    t = pages.page_tables(pages.page_stripes(df))
    got = rows(t["affiliations"].where("author_no > 0").select("id", "article_no", "author_no", "affiliation_no", "affiliation", "pmid"))
    assert got == sorted((r for i, p in data for r in _brute(i, p)), key=repr)
    keys = set(rows(t["authors"].select("id", "article_no", "author_no")))
    assert {r[:3] for r in got} == keys and len(keys) == t["authors"].count()
    assert {k[:2] for k in keys} <= set(rows(t["articles"].select("id", "article_no")))
    terms = Counter(r[1] for r in rows(t["mesh_terms"].select("id", "value")))
    assert terms["n"] <= terms["m"]
    for x in pages.page_tables(pages.page_stripes(df.limit(0))).values():
        assert x.count() == 0


# problem 7

PARTS = ["Dept. of A, X Hospital, Kenya", "Unit B/C, St. Y Hosp. 123, U.S.A", "University of Z, Kenya", "Royal &amp; W, Viet Nam"]


@pytest.fixture(scope="module")
def parser():
    return dialect.Parser({"kenya": 2.0, "u.s.a": 3.0, "viet nam": 3.0}, {})


@pytest.mark.parametrize(
    "pack",
    [
        lambda p: "; ".join(p), lambda p: ";".join(p) + ";", lambda p: ";; ".join(p) + ";;", lambda p: " | ".join(p), lambda p: " / ".join(p), lambda p: "\r\n".join(p), lambda p: ". ".join(p) + ".", lambda p: ".; ".join(p) + ". Electronic address: a.b@c.example.",
        lambda p: ", ".join(f'"{x}"' for x in p), lambda p: " ".join(f"[{i}] {x}" for i, x in enumerate(p, 1)), lambda p: " ".join(f"{i}) {x}" for i, x in enumerate(p, 1)), lambda p: " ".join(f"{i}. {x}" for i, x in enumerate(p, 1)),
        lambda p: "; ".join(f"{chr(97 + i)} {x}" for i, x in enumerate(p)), lambda p: p[0] + "; " + " | ".join(p[1:]),
    ],
)
def test_dialects(parser, pack):
    for n in (2, 3, 4):
        assert parser.parse(pack(PARTS[:n])) == PARTS[:n]


def test_single_and_odd_fields(parser):
    assert parser.parse("Level 6 | Tower B, X Hospital, Kenya.") == ["Level 6 | Tower B, X Hospital, Kenya"]
    assert parser.parse('"Wards 1; 3 and 6, X, Kenya"; Y, Kenya') == ["Wards 1; 3 and 6, X, Kenya", "Y, Kenya"]
    assert parser.parse("nowhere") == ["nowhere"]
    assert parser.parse("1. X, Kenya") == ["X, Kenya"]
    for t in (None, "", "  ", ";", '""', "a@b.example"):
        assert parser.parse(t) == []
    many = "; ".join(["X, Kenya"] * 2000)
    assert parser.parse(many) == ["X, Kenya"] * 2000


def test_any_number_of_delimiters(parser):
    """All delimiters of a field are looked at, as brute force over all divisions does; one value with many strokes stays one."""
    one = "Unit of Strokes " + " / ".join(["xy"] * 81) + ", Meridian Institute, Kenya"
    assert len(parser.parse(one)) == 1
    assert len(parser.parse("; ".join(f"Dept {k}, Town, Kenya" for k in range(200)))) == 200
    rnd = random.Random(5)
    for _ in range(40):
        text = "".join(rnd.choice(["Dept a", "Town", "Kenya", ", ", ", ", " / ", "; ", " | "]) for _ in range(rnd.randint(4, 16))).strip(" ,/;|")
        bits, parts, _ = parser._parse(text, False)
        marks = [(m.start(), m.end()) for m in dialect._CUT.finditer(text) if 0 < m.start() and m.end() < len(text)]
        costs = []
        for chosen in itertools.product((False, True), repeat=len(marks)):
            kept = [m for m, c in zip(marks, chosen, strict=True) if c]
            edges = [0, *(x for m in kept for x in m), len(text)]
            costs.append(sum(parser.length(text[i:j]) for i, j in zip(edges[::2], edges[1::2], strict=True)) + dialect.PER_CUT * len(kept))
        kinds = {m.lastgroup for m in dialect._CUT.finditer(text)}
        assert min(costs) <= bits <= min(costs) + dialect.PER_DIALECT * len(kinds)


def test_with_values(spark):
    data = [(i, "X, Kenya") for i in range(20)] + [(50, "X, Kenya; Y, Kenya"), (51, None), (52, ""), (50, "X, Kenya; Y, Kenya")]
    df = spark.createDataFrame([(*d, "q") for d in data], "id int, t string, v string")
    got = Counter((r["id"], tuple(r["values"])) for r in dialect.with_values(df, "t").collect())
    assert got[50, ("X, Kenya", "Y, Kenya")] == 2 and got[51, ()] == got[52, ()] == 1
    assert dialect.with_values(df.limit(0), "t").count() == 0


# text


def test_text_functions(spark):
    df = spark.createDataFrame([("Ábc—D 12",), ("",), (None,), ("?!",)], "t string")
    assert [r[0] for r in df.select(text.norm_title(F.col("t"))).collect()] == ["abc d 12", None, None, None]
    assert [r[0] for r in df.select(text.phrases(F.lit("a b c"), 2)).limit(1).collect()] == [["a", "b", "c", "a b", "b c"]]
    k = spark.createDataFrame([("D'Ambrosio-É", "Lia"), ("De Oliveira", None), (None, "x"), ("", "x")], "l string, f string").select(text.author_key(F.col("l"), F.col("f")))
    assert [r[0] for r in k.collect()] == ["dambrosioe-l", "deoliveira-", None, None]
    y = spark.createDataFrame([("2020",), ("in 1999.",), ("20201",), ("n.d.",), (None,)], "y string").select(text.year_of(F.col("y")))
    assert [r[0] for r in y.collect()] == [2020, 1999, None, None, None]
    assert [r[0] for r in df.select(text.tokens(F.lit("SARS-CoV-2 is a per"))).limit(1).collect()] == [["sars-cov-2", "per"]]


# records, screening and labels

REC = "rid bigint, origin string, query_id string, doi string, pmid string, title string, abstract string, journal string, year int, language string, article_types array<string>, mesh_terms array<string>, keywords array<string>, affiliations array<string>"


def rec(rid, origin="pubmed", q="q", doi=None, pmid=None, title=None, abstract="text", year=2020, lang="eng", types=(), mesh=(), affs=("X, Singapore",)):
    return (rid, origin, q, doi, pmid, title, abstract, None, year, lang, list(types), list(mesh), [], list(affs))


def test_duplicates_and_merge(spark):
    data = [rec(2, "scholar", "s", title="Same Title!"), rec(3, q="b", doi="10.1/a", title="same title"), rec(4, q="a", doi="10.1/a", pmid="1", title="other"), rec(5, pmid="1"), rec(6), rec(6), rec(7), rec(8, "scholar", title="alone")]
    assert records.merge(records.duplicate_groups(spark.createDataFrame(data, REC))).count() == 4
    got = {r["first_rid"]: r for r in records.merge(records.duplicate_groups(spark.createDataFrame(data, REC))).collect()}
    assert sorted(got) == [2, 6, 7, 8]
    r = got[2]
    assert r["rid"] == 3 and r["pmid"] == "1" and r["provenance"] == ["a", "b", "q", "s"] and r["n_copies"] == 4 and r["uid"] == "doi:10.1/a"
    assert got[8]["needs_manual_metadata"] and got[6]["uid"] == "row:6" and got[6]["n_copies"] == 2
    assert records.merge(records.duplicate_groups(spark.createDataFrame([], REC))).count() == 0


def test_screen_and_overlay(spark):
    data = [rec(1, types=["Editorial "]), rec(2), rec(3, year=None), rec(4, abstract=None), rec(5, affs=["A Ltd, Singapore"]), rec(6, affs=[], abstract="in Singapore"), rec(7, affs=[]), rec(8, "scholar"), rec(9, lang=None)]
    s = screen.screen(spark.createDataFrame(data, REC), screen.standard_rules(2015, 2026, "singapore"))
    assert {r["rid"]: (r["verdict"], r["rule_id"]) for r in s.collect()} == {1: ("excluded", "EXC-TYP-01"), 2: ("included", None), 3: ("included", None), 4: ("uncertain", "EXC-GEN-03"), 5: ("uncertain", "EXC-GEO-02"), 6: ("uncertain", "INC-GEO-02"), 7: ("excluded", "EXC-GEO-01"), 8: ("uncertain", "UNC-LEAD"), 9: ("included", None)}
    d = spark.createDataFrame([(1, "include", "A", 1), (1, "exclude", "B", 2), (4, "include", "C", 1), (5, "maybe", "D", 1), (None, "include", "E", 1)], "rid bigint, decision string, rule_id string, at int")
    o = {r["rid"]: (r["verdict"], r["rule_id"]) for r in screen.overlay(s, d, "rid", "at").collect()}
    assert o[1] == ("excluded", "B") and o[4] == ("included", "C") and o[5][0] == "uncertain" and len(o) == 9
    assert rows(screen.partition_check(s, "rid"))[0] == (3, 2, 4, 0, 9, 0)


def test_labels(spark):
    terms = spark.createDataFrame([(0, "a", "blue whale"), (1, "b", "whale"), (1, "b", "Fin-Whale"), (1, "b", None)], "pos int, label_id string, term string")
    data = [rec(1, title="A Blue  Whale", abstract=None), rec(2, title="whalebone", abstract=None), rec(3, title=None, abstract=None, mesh=["Fin whale", None, ""])]
    r = spark.createDataFrame(data, REC)
    sc = classify.scores(classify.term_hits(r, terms, "rid"), "rid", 3)
    assert rows(sc) == [(1, "a", 3), (1, "b", 3), (3, "b", 6)]
    p = classify.with_primary(sc, terms.select("label_id", "pos").distinct(), "rid").select("rid", "label_id", "score", "is_primary")
    assert rows(classify.with_fallback(r, p, "rid")) == [(1, "a", 3, 1), (1, "b", 3, 0), (2, "other_id", None, 1), (3, "b", 6, 1)]


def test_vocabulary(spark):
    data = [(i, "d", t) for i, ts in enumerate([["X", "y "], ["x", "humans"], ["y", "X"], ["z"], [None], ["x", "x"]]) for t in ts]
    tagged = spark.createDataFrame(data, "uid int, domain_id string, mesh_term string")
    stop = spark.createDataFrame([("Humans",), (None,)], "term string")
    v = classify.relabel(classify.vocabulary(tagged, stop, least=2, top_k=5), spark.createDataFrame([("d", "Y", "Why"), ("d", "gone", "G")], "domain_id string, mesh_term string, display_label string"))
    assert rows(v.select("mesh_term", "frequency", "rank", "display_label")) == [("x", 4, 1, "X"), ("y", 2, 2, "Why")]
    assert rows(classify.assign_terms(tagged, v).select("uid", "subdomain")) == [(0, "X"), (1, "X"), (2, "X"), (3, classify.OTHER), (4, classify.OTHER), (5, "X")]
    assert len(vocab.STOPLIST) >= 30 and "dengue" not in vocab.STOPLIST and len(vocab.RESEARCH_TYPES) == 16 and len(vocab.DOMAINS) == 5


# networks and topics


@pytest.mark.parametrize("chunk", [3, 256])
def test_edges_against_brute_force(spark, chunk):
    rnd = random.Random(chunk)
    data = [(f"u{rnd.randint(0, 20)}", f"n{rnd.randint(0, 12)}", rnd.choice(["a", "b", None])) for _ in range(150)] + [(None, "n1", "a"), ("u1", None, "a")] + [("big", f"n{i}", "a") for i in range(13)]
    want = Counter()
    for layer in ("ALL", "a", "b"):
        by = defaultdict(set)
        for u, n, d in data:
            if u and n and layer in ("ALL", d):
                by[u].add(n)
        for s in by.values():
            want.update((layer, *p) for p in itertools.combinations(sorted(s), 2))
    df = spark.createDataFrame(data, "uid string, node string, domain string")
    e = network.edges(df, "uid", "node", ["domain"], chunk)
    assert {(r[0], r[1], r[2]): r[3] for r in e.collect()} == dict(want)
    n = network.nodes(df, "uid", "node", e, 5).collect()
    assert len(n) == 5 and all(r["degree"] <= 4 for r in n)
    assert network.edges(df.limit(0), "uid", "node").count() == 0


def test_spring_is_fixed_and_inside():
    p = [("a", "b", 3.0), ("b", "c", 1.0)]
    one = network.spring(["c", "a", "b", "d"], p)
    assert one == network.spring(["a", "b", "c", "d"], p) and {c for xy in one.values() for c in xy} >= {0.0, 1.0} and all(0 <= c <= 1 for xy in one.values() for c in xy)
    assert network.spring([], []) == {} and network.spring(["a"], []) == {"a": (0.5, 0.5)}


def test_layout_places_any_number_of_nodes(spark):
    n = spark.range(10).select(F.col("id").cast("string").alias("node_id"))
    e = spark.createDataFrame([("ALL", "1", "2", 1)], "layer string, source string, target string, weight bigint")
    assert network.layout(n, e).count() == 10 == network.layout(n, e, 5).select("node_id").distinct().count()


def test_anchors_keep_apart():
    for n in (1, 2, 5, 9, 30):
        at, r = topics.anchors(n)
        assert (at - r >= 0).all() and (at + r <= 1).all()
        d = np.linalg.norm(at[:, None] - at[None], axis=2) + np.eye(n) * 9
        assert d.min() >= 4 * r - 1e-12


def test_topics(spark):
    rnd = random.Random(1)
    kinds = [["dengue", "mosquito", "larvae"], ["sputum", "culture", "lung"]]
    data = [(i, " ".join(rnd.choices(kinds[i % 2], k=12)), "d") for i in range(80)] + [(100, "alone here", "e"), (101, None, "d"), (102, "x", None)]
    df = spark.createDataFrame(data, "uid int, text string, dom string")
    got = {r["uid"]: r["topic_id"] for r in topics.cluster(df, "uid", "text", "dom", docs_per_topic=40).collect()}
    assert got[100] == "e_t1" and 102 not in got and len({got[i] for i in range(0, 80, 2)}) == 1 and got[0] != got[1]
    assert topics.cluster(df.limit(0), "uid", "text", "dom").count() == 0
    w = topics.top_terms(topics.term_weights(df.where("dom = 'd'"), "dom", "uid", "text"), "dom").collect()[0]
    assert set(w["top_terms"].split(", ")) == set(kinds[0] + kinds[1]) and len(w["label"].split(", ")) == 4


def test_map_follows_content(spark):
    """Like texts of a topic lie together, unlike ones apart; like topics have neighbouring anchors; a place doesn't depend on the key."""
    mix = {"a": [1.0, 0.3, 0.0, 0.0], "b": [1.0, 0.0, 0.3, 0.0]}
    at = {"d_t1": 0, "d_t2": 4, "d_t3": 8, "d_t4": 12}
    rows = [(f"{t}{m}{i}", "d", t, ([0 + o, 1 + o, 2 + o, 3 + o], mix[m])) for t, o in at.items() for m in mix for i in range(4)]
    rows += [(f"x{i}", "d", "d_t1", ([0, 1, 4], [1.0, 0.3, 0.2])) for i in range(2)] + [("none", "e", "e_t1", ([], []))] + [(f"s{m}{i}", "s", "s_t1", ([0, 1, 2, 3], v)) for m, v in mix.items() for i in range(3)]
    df = spark.createDataFrame(rows, "uid string, domain string, topic_id string, features struct<indices:array<int>, values:array<double>>")
    got = {r["uid"]: (r["map_x"], r["map_y"]) for r in topics.map_places(df, "uid").collect()}
    assert len(got) == len(rows) and got["none"] == (0.5, 0.5) and all(0 <= c <= 1 for p in got.values() for c in p)
    assert len({got[f"sa{i}"] for i in range(3)}) == 1 and len({got[f"sb{i}"] for i in range(3)}) == 1 and math.dist(got["sa0"], got["sb0"]) > 0.2
    for t in at:
        assert len({got[f"{t}a{i}"] for i in range(4)}) == 1
    assert got["x0"] == got["x1"] and math.dist(got["x0"], got["d_t1a0"]) > 1e-3
    means = pd.DataFrame({"domain": "d", "topic_id": list("pqrs"), "mx": [9.0, 0.0, 9.1, 0.1], "my": [0.0, 0.1, 5.0, 5.1]})
    assert [*topics._spread(means).sort_values("topic_id")[["ax", "ay"]].itertuples(index=False, name=None)] == [(0.75, 0.25), (0.25, 0.25), (0.75, 0.75), (0.25, 0.75)]


def test_map_plane_in_slices(monkeypatch):
    """The directions of the means don't depend on how many terms are held at a time, and are those of the whole matrix."""
    rnd = np.random.default_rng(2)
    m = rnd.random((6, 50)) * (rnd.random((6, 50)) < 0.5)
    df = pd.DataFrame([("d", f"p{i}", j, m[i, j]) for i in range(6) for j in range(50) if m[i, j]] + [("d", "none", None, None)], columns=["domain", "point", "term", "v"])
    widths = []
    for w in (7, 4096):
        monkeypatch.setattr(topics, "WIDTH", w)
        widths.append(topics._plane(df))
    assert np.allclose(widths[0][["bx", "by"]], widths[1][["bx", "by"]]) and (widths[0]["term"] == widths[1]["term"]).all()
    whole = np.vstack([np.zeros(50), m])[:, widths[0]["term"]]
    first = np.linalg.svd(whole - whole.mean(0))[2][:2]
    assert np.allclose(np.abs((first * widths[0][["bx", "by"]].to_numpy().T).sum(1)), 1)


def test_map_moves_no_terms(spark):
    """Texts are projected where they lie: no join or group of theirs by term."""
    rows = [(i, "d", f"d_t{i % 3}", ([i % 5, 7 + i % 3], [0.6, 0.8])) for i in range(30)]
    df = spark.createDataFrame(rows, "uid int, domain string, topic_id string, features struct<indices:array<int>, values:array<double>>")
    plane = spark.createDataFrame([("d", t, t / 10, 1.0) for t in range(9)], "domain string, term int, bx double, by double")
    p = topics._projected(df, plane, "uid")
    assert "Exchange" not in p._jdf.queryExecution().executedPlan().toString()
    got = {r["uid"]: (round(r["px"], 9), round(r["py"], 9)) for r in p.collect()}
    assert got == {i: (round(0.06 * (i % 5) + (0.08 * (7 + i % 3) if 7 + i % 3 < 9 else 0), 9), 1.4 if 7 + i % 3 < 9 else 0.6) for i in range(30)}


def test_topics_keep_every_term(spark):
    """More different terms than any fixed vocabulary: each is a feature, and a text of rare terms only isn't empty."""
    data = [(i, " ".join(f"w{i}x{j}" for j in range(100)), "d") for i in range(45)] + [(100 + i, "common words here", "d") for i in range(45)]
    got = topics.cluster(spark.createDataFrame(data, "uid int, text string, dom string"), "uid", "text", "dom", docs_per_topic=1000).collect()
    assert all(len(r["features"]["indices"]) == (100 if r["uid"] < 100 else 3) for r in got) and len({i for r in got for i in r["features"]["indices"]}) == 4503


def test_unconverged_topics_are_reported(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(i, " ".join(rnd.choices([f"w{j}" for j in range(40)], k=8)), "d") for i in range(150)], "uid int, text string, dom string")
    with pytest.warns(UserWarning, match="topics of d"):
        topics.cluster(df, "uid", "text", "dom", max_iter=1)
    with warnings.catch_warnings():
        warnings.filterwarnings("error", message="topics of")
        topics.cluster(df, "uid", "text", "dom")


def _groups(spark, domains, n=60, words=3000):
    rnd = random.Random(7)
    return spark.createDataFrame([(1000 * d + i, " ".join([*rnd.choices([f"c{i % 5}x{j}" for j in range(12)], k=8), f"own{rnd.randrange(words)}"]), f"d{d}") for d in range(domains) for i in range(n)], "uid int, text string, dom string")


def test_domains_are_fitted_in_the_same_passes(spark, monkeypatch):
    """Many domains take as many reads of their texts as the slowest of them alone, not one fit after another."""
    reads, read = [], topics.kmeans._pass
    monkeypatch.setattr(topics.kmeans, "_pass", lambda *a: reads.append(sorted(a[1])) or read(*a))
    df = _groups(spark, 5)
    got = {r["uid"]: r["topic_id"] for r in topics.cluster(df, "uid", "text", "dom", docs_per_topic=12).collect()}
    most = max(sum(f"d{d}" in r for r in reads) for d in range(5))
    assert len(reads) == most and reads[0] == [f"d{d}" for d in range(5)]
    assert len(got) == 300 and len({*got.values()}) == 25


@pytest.mark.parametrize("dense", [0, 20, 4000])
def test_clusters_are_a_fixed_point(spark, monkeypatch, dense):
    """By brute force over whole vectors: every text is nearest the mean of its own topic's texts, however many terms are columns."""
    monkeypatch.setattr(topics.kmeans, "DENSE", dense)
    got = topics.cluster_vectors(topics.text_vectors(_groups(spark, 2), "uid", "text", "dom"), "uid", docs_per_topic=12, per_block=25).collect()
    for d in ("d0", "d1"):
        own = [r for r in got if r["domain"] == d]
        x = np.zeros((60, 1 + max(i for r in own for i in r["features"]["indices"])))
        for row, r in zip(x, own, strict=True):
            row[r["features"]["indices"]] = r["features"]["values"]
        assert np.allclose((x**2).sum(1), 1)
        names = sorted({r["topic_id"] for r in own})
        at = np.array([names.index(r["topic_id"]) for r in own])
        means = np.array([x[at == i].mean(0) for i in range(len(names))])
        far = ((x[:, None, :] - means) ** 2).sum(2)
        assert len(names) == 5 and (far[np.arange(60), at] <= far.min(1) + 1e-5).all()


def test_number_of_topics_follows_size():
    n = [topics.topic_count(x, 3, 25) for x in (0, 3, 4, 30, 200, 400, 20_000, 2_000_000)]
    assert n == [1, 1, 2, 2, 8, 14, 100, 1000]


def test_misplaced(spark):
    places = spark.createDataFrame([(1, "d", "a", 0.1, 0.1), (2, "d", "a", 0.9, 0.9), (3, "d", "b", 0.9, 0.8), (4, "e", "c", 0.9, 0.9), (5, "e", "c", None, None)], "uid int, domain string, topic_id string, map_x double, map_y double")
    cents = spark.createDataFrame([("d", "a", 0.1, 0.1), ("d", "b", 0.9, 0.9), ("e", "c", 0.0, 0.0)], "domain string, topic_id string, x double, y double")
    assert sorted(map(tuple, topics.misplaced(places, cents, "uid").collect())) == [("d", 3, 1), ("e", 1, 0)]


# readers, writers and windows


def test_json_block(spark, tmp_path):
    p = tmp_path / "t.md"
    p.write_text('# T\n```json\n[{"id": "a", "n": 1}]\n```\n')
    assert rows(vocab.json_block(spark, str(p), "id:string,n:int")) == [("a", 1)]
    p.write_text('```json\n[{"id": \n```')
    with pytest.raises(Exception, match="(?i)malformed"):
        vocab.json_block(spark, str(p), "id:string,n:int").collect()
    p.write_text("none")
    with pytest.raises(ValueError, match="no json block"):
        vocab.json_block(spark, str(p), "id:string")


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", 'q"x, y', None, True), ("a", "", 1, False)], "k string, s string, n int, f boolean")
    sinks.csv(df, str(tmp_path / "o"), ["k"])
    body = (tmp_path / "o").read_bytes()
    assert body == b'k,s,n,f\r\na,,1,0\r\nb,"q""x, y",,1\r\n'
    sinks.csv(spark.range(0, 500, 1, 7).withColumn("_o", -F.col("id")), str(tmp_path / "o"), ["_o"])
    assert (tmp_path / "o").read_text() == "id\n" + "".join(f"{i}\n" for i in range(499, -1, -1)) and [p.name for p in tmp_path.iterdir()] == ["o"]
    back = vocab.csv_table(spark, str(tmp_path / "o")).where("id < 3")
    sinks.csv(back, str(tmp_path / "o"), ["id"])  # over the file it is read from
    assert rows(vocab.csv_table(spark, str(tmp_path / "o"))) == [("0",), ("1",), ("2",)]
    (tmp_path / "h.csv").write_text("a,b\n")
    assert vocab.csv_table(spark, str(tmp_path / "h.csv"), "a string, b string").count() == 0


def test_upsert(spark):
    old = spark.createDataFrame([("u", "old", "mine"), ("v", "kept", None)], "profile_url string, name string, notes string")
    new = spark.createDataFrame([("u", "new", "theirs"), ("w", "fresh", None), (None, "x", None)], "profile_url string, name string, notes string")
    assert rows(sinks.upsert_roster(old, new)) == [("u", "new", "mine"), ("v", "kept", None), ("w", "fresh", None)]
    assert rows(sinks.upsert_roster(old, new.limit(0))) == rows(old)


def test_bad_lead_lines(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "scholar_a_b.jsonl").write_text('{"title": "x", "odd": 1}\n{bad\n\n')
    assert [(r["query_id"], r["title"]) for r in raw.leads(spark, str(tmp_path)).collect()] == [("a_b", "x")]


def test_stream_equals_table(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    if not os.path.exists(src):
        pytest.skip("no test tables")
    keys = ["window_start", "event_type"]
    assert rows(windows.streamed(spark, src, windows.tumbling, keys)) == rows(windows.tumbling(spark.read.parquet(src)))
    e = spark.read.parquet(src)
    assert windows.first_seen(e.unionByName(e)).count() == e.select("event_id").distinct().count()


def test_stream_in_batches_forgets_closed_windows(spark, tmp_path):
    """A window that changes in a later batch has its last state; a row later than the watermark is left out, others are counted."""
    at = datetime.datetime(2026, 1, 1)
    hours = lambda *hs: [(i, at + datetime.timedelta(hours=h), "a", 1.0) for i, h in enumerate(hs)]
    for k, part in enumerate((hours(0.1, 0.2, 3.1), hours(3.2, 9.0), hours(9.1, 0.3))):
        spark.createDataFrame(part, "event_id int, ts timestamp_ntz, event_type string, value double").coalesce(1).write.parquet(str(tmp_path / f"in{k}"))
        for f in (tmp_path / f"in{k}").glob("part-*"):
            (tmp_path / "src").mkdir(exist_ok=True)
            f.rename(tmp_path / "src" / f"{k}.parquet")
            os.utime(tmp_path / "src" / f"{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    got = windows.streamed(spark, str(tmp_path / "src"), windows.tumbling, ["window_start", "event_type"], files_per_batch=1)
    assert {(r["window_start"].hour, r["n"]) for r in got.collect()} == {(0, 2), (3, 2), (9, 2)}


def test_layout_of_more_nodes_than_springs_take(spark):
    """Nodes beyond the bound lie near their neighbours; every node has one place in the unit square, the same in each run."""
    e = spark.createDataFrame([("ALL", f"n{i:02}", f"n{j:02}", 5) for i in range(6) for j in range(i + 1, 6)] + [("ALL", "n00", "x1", 1), ("ALL", "x1", "x2", 1), ("ALL", "p", "q", 1)], "layer string, source string, target string, weight bigint")
    nodes = spark.createDataFrame([(f"n{i:02}",) for i in range(6)] + [("x1",), ("x2",), ("p",), ("q",), ("alone",)], "node_id string")
    got = {r["node_id"]: (r["x"], r["y"]) for r in network.layout(nodes, e, 6).collect()}
    assert len(got) == 11 and all(0 <= v <= 1 for p in got.values() for v in p)
    assert math.dist(got["x1"], got["n00"]) < 0.1 and math.dist(got["x2"], got["x1"]) < 0.1
    assert got == {r["node_id"]: (r["x"], r["y"]) for r in network.layout(nodes, e, 6).collect()}


def test_given_vectors_are_clustered(spark):
    """Vectors of two directions fall into two topics; rows without a whole vector are left out."""
    data = [(i, [1.0, 0.01 * i] if i % 2 else [0.01 * i, 1.0], "d") for i in range(10)] + [(20, None, "d"), (21, [1.0, None], "d"), (22, [1.0, 2.0], None), (23, [3.0, 4.0], "e")]
    v = topics.given_vectors(spark.createDataFrame(data, "k int, vec array<double>, dom string"), "k", "vec", "dom")
    got = {r["k"]: r["topic_id"] for r in topics.cluster_vectors(v, "k").collect()}
    assert set(got) == {*range(10), 23} and got[23] == "e_t1" and len({got[i] for i in range(0, 10, 2)}) == len({got[i] for i in range(1, 10, 2)}) == 1 and got[0] != got[1]
    assert topics.cluster_vectors(v.limit(0), "k").count() == 0


def test_later_decision_counts(spark, tmp_path):
    p = tmp_path / "d.jsonl"
    p.write_text('{"uid": "a", "decision": "include", "rule_id": "X"}\nbad\n{"uid": "a", "decision": "exclude", "rule_id": "Y"}\n')
    s = spark.createDataFrame([("a", "uncertain", "R"), ("b", "included", None)], "uid string, verdict string, rule_id string")
    assert rows(screen.overlay(s, raw.decisions(spark, str(p)), order="line").select("uid", "verdict", "rule_id")) == [("a", "excluded", "Y"), ("b", "included", None)]
