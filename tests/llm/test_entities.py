"""Problems 1 to 4: edge cases and brute force."""

import datetime
import itertools
import random
import warnings
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brambling.llm import canonical, cooccur, merkle, names, truth

LONG = "long words " * 20_000


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# 1


@pytest.mark.parametrize(("a", "b"), [("Naïve COHORT–2", "naïve cohort２"), ("A​b­c", "ABC."), ("Обзор Й", "обзор Й"), ("[x]  y", "X—y"), ("ﬁne", "Fine")])
def test_fold_same(a, b):
    assert merkle.fold(a) == merkle.fold(b)


@pytest.mark.parametrize(("a", "b"), [("naïve", "naive"), ("a1", "a2"), ("ab", "ba")])
def test_fold_different(a, b):
    assert merkle.fold(a) != merkle.fold(b)


def test_digest_order_of_members_and_lists():
    a = {"x": "One", "y": ["b", "A"], "z": None}
    assert merkle.digest(a, frozenset())[0] == merkle.digest({"y": ["B.", "a"], "x": "one"}, frozenset())[0]
    assert merkle.digest(a, frozenset())[0] != merkle.digest({"x": "one", "y": ["a", "b"]}, frozenset())[0]
    assert merkle.digest(a, frozenset({"y"}))[0] == merkle.digest({"x": "one", "y": ["a", "b"]}, frozenset({"y"}))[0]
    assert merkle.digest({"x": "", "y": []}, frozenset()) is None


def test_formatting_copies(spark):
    data = [(5, "A b"), (3, "a-B!"), (9, "AB"), (4, None), (6, ""), (7, "..."), (8, "...."), (None, "ab"), (3, "a-B!"), (1, LONG), (2, LONG.upper()), (10, "other")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in data], "id bigint, title string, root string, canon string")
    classes, members = merkle.formatting_copies(df, "id", ["title"])
    assert rows(members) == [(1, 2), (3, 5), (3, 9)]
    assert set(rows(classes)) == {(1, 2), (3, 4), (10, 1)}
    empty = merkle.formatting_copies(df.limit(0), "id", ["title"])
    assert rows(empty[0]) == rows(empty[1]) == []


def test_formatting_copies_hot_group(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "Same Title").otherwise(F.concat(F.lit("t"), "id")).alias("title"))
    assert merkle.formatting_copies(df, "id", ["title"])[1].count() == 1999


def test_nested_records(spark):
    df = spark.createDataFrame([(1, {"k": "V", "m": "w"}, ["a", "b"]), (2, {"m": "W", "k": "v"}, ["b", "a"]), (3, {"k": "v"}, ["a", "b"])], "id int, m map<string,string>, l array<string>")
    assert rows(merkle.formatting_copies(df, "id", ["m", "l"], ("l",))[1]) == [(1, 2)]
    assert rows(merkle.formatting_copies(df, "id", ["m", "l"])[1]) == []


# 2


def test_name_tokens():
    assert names.tokens("O'Neil-Abc, JK") == ("oneilabc", "j.", "k.")
    assert names.tokens("DE FUBROFANE, Ana") == ("fubrofane", "ana")
    assert names.tokens("Waxa, Gachura-broyixuse") == ("waxa", "gachura", "broyixuse")
    assert names.tokens("") == ()


def test_same_person():
    m = names.Matcher([("Thulera", "Thui"), (None, "x")])
    t = lambda s: tuple(p + "~" if p in ("ana", "maria", "thulera", "thui") else p for p in names.tokens(s))
    yes = [("Duxowanu, Ana", "A Duxowanu"), ("Duxowanu, Ana", "Ana, Duxowanu"), ("Duxowanu, Ana", "Duxwoanu, Ana"), ("Thayachiyo, Thui", "THAYACHIYO, Thulera"), ("Abc Defgh, Ana", "Abc-Defgh, Ana"), ("Duxowanu, Ana Maria", "Duxowanu, Ana")]
    no = [("Duxowanu, Ana", "Duxowanu, Maria"), ("Duxowanu, Ana", "Kexowano, Ana"), ("Duxowanu, Ana Maria", "M Duxowanu"), ("Huthodili, Ana K", "Ana Kredrigepi")]
    assert all(m.same_person(t(a), t(b)) > 0 for a, b in yes)
    assert not any(m.same_person(t(a), t(b)) for a, b in no)


def test_common_parts_tell_a_person_together():
    """A common surname counts with a given name, also a misspelt one; two known given names, or an initial alone, tell two people apart or nobody."""
    m = names.Matcher([("xiaoming", "ming")])
    same = lambda a, b: m.same_person(tuple(a.split(" ")), tuple(b.split(" ")))
    assert same("wang~ xiaoming~", "xiaoming~ wang~") and same("wang~ xiaoming~", "wang~ xiaomng") and same("wang~ xiaoming~", "wang~ ming~") and same("wang~ xiaoming~", "wnagu xiaoming~") == 0
    assert same("wang~ xiaoming~", "wang~ xiaomin~") == 0 == same("wang~ xiaoming~", "wang~ x.") == same("wang~ xiaoming~", "wang~ bo~")


def test_common_parts_by_shares(spark):
    """The same parts are common in a corpus and in one eight times as large in which every name has its own namesakes."""
    fore = [f"given{i}" for i in range(50)]
    data = [(f"rare{i}", f) for i in range(60) for f in (fore[i % 9], fore[i % 7])] + [("often", f) for f in fore] + [("both", f) for f in fore[:8]] + [(f"rare{i}", "both") for i in range(6)] + [("once", "once")]
    for times in (1, 8):
        spelled = [(f"{x}{k}", f) if x.startswith("rare") else (x, f"{f}{k}") for k in range(times) for x, f in data]
        df = spark.createDataFrame([(f"{x}, {f}", [x, f], 1) for x, f in spelled] + [("x y", ["x", "y"], 0)], "name string, parts array<string>, n_last int")
        got = {r["t"] for r in names.common_parts(df, surname_share=0.05, surname_least=20).collect()}
        assert got >= {"often", "given7"} and not got & {"both", "once", "x", "rare1"}


def test_form_pairs_of_a_hot_key(spark):
    """All pairs of a key's forms and of two near keys' forms, once each, whatever the cells."""
    forms = spark.range(700).select(F.when(F.col("id") < 400, "hot").when(F.col("id") < 500, "near").otherwise(F.concat(F.lit("k"), "id")).alias("key"), F.col("id").alias("node"), F.array(F.col("id").cast("string")).alias("form"))
    sizes = forms.groupBy("key").agg(F.count("*").alias("n"))
    near = spark.createDataFrame([("hot", "near")], "key_a string, key_b string")
    for cell in (64, 10_000):
        got = names.form_pairs(forms, sizes, near, cell).select("a", "b")
        assert got.count() == got.distinct().count() == 400 * 399 // 2 + 100 * 99 // 2 + 400 * 100


@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
@settings(max_examples=200, deadline=None)
def test_edits_against_full_table(a, b):
    d = {}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            x = i + j if 0 in (i, j) else min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                x = min(x, d[i - 2, j - 2] + 1)
            d[i, j] = x
    assert names.edits(a, b, 2) == min(d[len(a), len(b)], 3)


def test_collision_curve(spark):
    bands = names.bands_for(0.42, 3, 0.99)
    assert names.curve(0.42, 3, bands) >= 0.99 > names.curve(0.42, 3, bands - 1)
    rnd = random.Random(1)
    words = ["".join(rnd.choice("bdfgklmnprstvz") + rnd.choice("aeiou") for _ in range(5)) for _ in range(300)]
    pairs = [(w, w[:4] + "x" + w[5:]) for w in words]
    df = spark.createDataFrame([(w,) for p in pairs for w in p], "k string")
    got = {r["k"]: set(enumerate(r["b"])) for r in names.min_buckets(df, "k", "b", 3, 3, bands).collect()}
    assert sum(bool(got[a] & got[b]) for a, b in pairs) >= 0.95 * len(pairs)


def test_star_clusters_against_greedy(spark):
    rnd = random.Random(4)
    es = sorted({tuple(sorted(rnd.sample(range(60), 2))) for _ in range(90)})
    adj = defaultdict(dict)
    for a, b in es:
        adj[a][b] = adj[b][a] = 1.0 / (1 + (a * 7 + b) % 5)
    order = sorted(range(60), key=lambda n: (n % 2, len(adj[n]), -n), reverse=True)
    centers = []
    for n in order:
        if not any(c in adj[n] for c in centers):
            centers.append(n)
    key = {n: (n % 2, len(adj[n]), -n) for n in range(60)}
    want = {n: n if n in centers else max((c for c in adj[n] if c in centers), key=lambda c: (adj[n][c], key[c])) for n in range(60)}
    nodes = spark.createDataFrame([(n, n % 2) for n in range(60)], "node bigint, rank int")
    edges = spark.createDataFrame([(a, b, adj[a][b]) for a, b in es], "a bigint, b bigint, w double")
    assert dict(rows(names.star_clusters(nodes, edges))) == want


def test_link_names(spark):
    n = ["Duxowanu, Ana", "A Duxowanu", "DUXOWANU, ANA", "Duxowanu, Ana", "Dxuowanu, Ana", "Kexigabo, Peter", "Kexigabo, P", None, "", "  ", "12", "Zz", "Lorem " * 3000]
    df = spark.createDataFrame([(x, "c") for x in n], "name string, cluster string")
    nick = spark.createDataFrame([("Peter", "Pit"), (None, "x"), ("y", None)], "formal_name string, nickname string")
    got = defaultdict(set)
    for name, c in rows(names.link_names(df, nick)):
        got[c].add(name)
    groups = sorted((sorted(g) for g in got.values() if len(g) > 1), key=repr)
    assert groups == [sorted(["Duxowanu, Ana", "A Duxowanu", "DUXOWANU, ANA", "Dxuowanu, Ana"]), ["Kexigabo, P", "Kexigabo, Peter"]]
    assert rows(names.link_names(df.limit(0), nick.limit(0))) == []


def test_size_of_buckets_is_known(spark, monkeypatch):
    """What pairs are made of isn't taken for as small as the keys it comes from, else it is broadcast however large it is."""
    seen = []

    def pair_counts(baskets, *a):
        seen.append((int(str(baskets._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())), baskets.count()))
        return cooccur.pair_counts(baskets, *a)

    monkeypatch.setattr(names, "pair_counts", pair_counts)
    df = spark.createDataFrame([(f"{a}{b}{c}owanu, Ana",) for a in "bdfgk" for b in "aeiou" for c in "lmnprst"], "name string")
    names.link_names(df, spark.createDataFrame([("Peter", "Pit")], "formal_name string, nickname string"))
    ((size, n),) = seen
    assert n >= 175 * 100 and size >= 4 * n


def test_no_broadcast_beyond_the_counted_size(spark, monkeypatch):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    forms = spark.range(700).select(F.lit("hot").alias("key"), F.col("id").alias("node"), F.array(F.col("id").cast("string")).alias("form"))
    sizes = forms.groupBy("key").agg(F.count("*").alias("n"))
    near = spark.createDataFrame([("hot", "near")], "key_a string, key_b string")
    df = spark.createDataFrame([("Duxowanu, Ana",), ("Dxuowanu, Ana",), ("A Duxowanu",), ("Kexigabo, Peter",)], "name string")
    nick = spark.createDataFrame([("Peter", "Pit")], "formal_name string, nickname string")
    want = {n: {m for m, d in r if c == d} for r in [rows(names.link_names(df, nick))] for n, c in r}
    monkeypatch.setattr(names, "MAX_BROADCAST", 0, raising=False)
    assert "BroadcastHashJoin" not in plan(names.form_pairs(forms, sizes, near))
    linked = names.link_names(df, nick)
    assert "BroadcastHashJoin" not in plan(linked)
    assert want == {n: {m for m, d in r if c == d} for r in [rows(linked)] for n, c in r}


# 3


def test_trie_against_brute_force():
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 4)))
    entries = list(dict.fromkeys(" ".join(word() for _ in range(rnd.randint(1, 3))) for _ in range(80)))
    t = canonical.Trie()
    for i, w in enumerate(entries):
        t.add([(x,) for x in w.split(" ")], i)
    for _ in range(400):
        q = "".join(rnd.choice("ab ") for _ in range(rnd.randint(0, 10)))
        for most in (0, 1, 2):
            assert t.search(q, most) == {i: d for i, w in enumerate(entries) if (d := names.edits(q, w, most)) <= most}


def test_other_forms_against_all_their_combinations():
    """Every combination of forms is a path, though only one node a word is kept: also for a label with more than 10^6 of them."""
    rnd = random.Random(3)
    slots = [tuple(sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(1, 3))})) for _ in range(4)]
    t = canonical.Trie()
    t.add(slots, 0)
    paths = [" ".join(p) for p in itertools.product(*slots)]
    for p in paths:
        assert t.exact(p.split(" ")) == {0} == set(t.search(p, 1))
        i = rnd.randrange(len(p))
        q = p[:i] + "d" + p[i:]
        assert t.search(q, 1) == {0: min(names.edits(q, x, 1) for x in paths)}
    words = "National University Hospital Medical Center of Public Health Research Institute for International Technology and General Medicine".split(" ")
    c = canonical.Canonical([("L", " ".join(words), None)])
    short = [canonical.OTHER_FORMS.get(w.lower(), [w])[0] for w in words]
    for k in (1, 3, len(words)):
        assert c.match(" ".join([*short[:k], *words[k:]]))[0] == "L" == c.match(" ".join([*words[:-k], *short[-k:]]))[0]


def test_canonical_forms():
    c = canonical.Canonical([("U", "University of Lucosa", "Kenya"), ("S", "Saint Pisuto Hospital", "China"), ("Z", "Ziroche School of Hygiene and Public Health", None), ("M1", "Manago General Hospital", "India"), ("M2", "Meyisho General Hospital", "Kenya")])
    for text, want in [("Dept. of X, Univ. of Lucosa 123, Kenya", "U"), ("Lucosa University", "U"), ("St. Pisuto Hosp., China", "S"), ("Saint Psiuto Hospital", "S"), ("School of Hygiene &amp; Publ. Hlth, Ziroche, Y", "Z"), ("MGH, Kenya", "M2"), ("MGH, Manago, Q", "M1"), ("MGH", None), ("Saint Lucosa Hospital", None), ("", None), (LONG, None)]:
        assert c.match(text)[0] == want, text


def test_map_values(spark):
    df = spark.createDataFrame([(1, "Univ. of Lucosa", "q"), (2, "nobody", "q"), (3, None, "q"), (1, "Univ. of Lucosa", "q")], "i int, v string, label string")
    lst = spark.createDataFrame([("U", "University of Lucosa", None, 1), ("U", "University of Lucosa", None, 1), ("N", None, None, 1)], "node_id string, label string, country string, v int")
    for block in (50_000, 1):
        assert rows(canonical.map_values(df, "v", lst, block=block).select("i", "node_id")) == [(1, "U"), (1, "U"), (2, "unmatched"), (3, None)]
    assert rows(canonical.map_values(df, "v", lst.limit(0)).select("i", "node_id")) == [(1, "unmatched"), (1, "unmatched"), (2, "unmatched"), (3, None)]
    assert canonical.map_values(df.limit(0), "v", lst).count() == 0


def test_short_names_match_exactly():
    c = canonical.Canonical([("C", "CERN", "Switzerland"), ("N", "NIH", None)])
    assert [c.match(x)[0] for x in ("CERN, Geneva, Switzerland", "NIH", "CERM, Geneva, Switzerland", "NI")] == ["C", "N", None, None]


def test_blocks_decide_as_the_whole_list(spark):
    """What is meant is decided over all blocks: equally near entries of different blocks, countries, acronyms and places behind."""
    entries = [("X", "Bergen Clinic", None), ("Y", "Bergem Clinic", None), ("M1", "Manago General Hospital", "India"), ("M2", "Meyisho General Hospital", "Kenya"), ("P", "School of Health Ziroche", None), ("Q", "Mgh Institute", None)]
    texts = ["Bergex Clinic", "Bergen Clinic", "MGH, Kenya", "MGH", "School of Health, Ziroche, Y", "nothing", None, "", "Mgh Institut", "MGH, Manago, Q"] * 2
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    lst = spark.createDataFrame(entries, "node_id string, label string, country string")
    whole = rows(canonical.map_values(df, "v", lst))
    assert [r[2] for r in sorted(whole)[:9]] == ["unmatched", "X", "M2", "unmatched", "P", "unmatched", None, "unmatched", "Q"]
    for block in (1, 2, 4):
        assert rows(canonical.map_values(df, "v", lst, block=block, group=3)) == whole


def test_forms_come_from_a_table(spark):
    table = spark.createDataFrame([("form", "clinic", "klinik"), ("filler", "von", None), ("phrase", "bc", "bergen clinic"), ("country", "norge", "norway")], "kind string, word string, other string")
    lang = canonical.Language.of(table)
    c = canonical.Canonical([("X", "Bergen Clinic", "Norway"), ("Y", "Bergen Clinic", "Chad")], lang)
    assert [c.match(t)[0] for t in ("Bergen Klinik, Norge", "BC, Chad", "von Bergen Clinic, Norway", "Bergen Clinic")] == ["X", "Y", "X", None]
    with pytest.raises(ValueError, match="rows at most"):
        canonical.Language.of(table, 2)


# 4

T = [datetime.datetime(2026, 1, d) for d in range(1, 9)]


def test_clean_values(spark):
    d = ["https://DOI.example/10.1/AbC ", "DOI: 10.1/abc", "\t10.1/abc\n", "10.1/", "n/a", "", None, "doi.org/10.1/x"]
    df = spark.createDataFrame([(x,) for x in d], "d string").select(truth.clean_doi(F.col("d")))
    assert [r[0] for r in df.collect()] == ["10.1/abc"] * 3 + [None] * 4 + ["10.1/x"]
    a = ["No abstract is provided.", "[No abstract]", "n/a", "ABSTRACT UNAVAILABLE", None, "", " a b c ", "Abstract concepts matter."]
    df = spark.createDataFrame([(x,) for x in a], "a string").select(truth.abstract_size(F.col("a")))
    assert [r[0] for r in df.collect()] == [0, 0, 0, 0, 0, 0, 3, 23]


def _best(spark, data, complete=True):
    df = spark.createDataFrame(data, "rid bigint, doi string, pmid string, src string, at timestamp, v string, group string, node string")
    f = [truth.Field("v", F.col("v"), F.length("v") if complete else None, not complete)]
    return truth.representatives(df, "rid", {"doi": F.col("doi"), "pmid": F.col("pmid")}, F.col("src"), F.col("at"), f)


def test_representatives_links_and_order(spark):
    data = [(4, "a", None, "s", T[0], "long", "g", "n"), (3, "a", "1", "s", T[1], "long", "g", "n"), (9, None, "1", None, None, None, None, None), (5, None, None, "s", T[0], "alone", "g", "n"), (6, "z", None, "s", T[0], "single", "g", "n"), (None, "a", None, "s", T[0], "no id", "g", "n")]
    assert rows(_best(spark, data).select("first_id", "n_rows", "v", "v_id")) == [(3, 3, "long", 3)]
    assert rows(_best(spark, [])) == []
    none = [(1, "a", None, "s", T[0], None, "g", "n"), (2, "a", None, "s", T[0], None, "g", "n")]
    assert rows(_best(spark, none).select("first_id", "v", "v_id")) == [(1, None, 2)]


def test_votes_follow_reliable_sources(spark):
    data = []
    for g in range(20):
        for s in ("good1", "good2", "good3"):
            data.append((g * 10 + len(data) % 10, f"d{g}", None, s, T[0], f"true{g}", "g", "n"))
        for s in ("bad1", "bad2"):
            data.append((g * 10 + len(data) % 10, f"d{g}", None, s, T[0], f"{s}{g}", "g", "n"))
    # one group where only a good source stands against two bad ones that agree
    data += [(1000, "last", None, "good1", T[0], "right", "g", "n"), (1001, "last", None, "bad1", T[5], "wrong", "g", "n"), (1002, "last", None, "bad2", T[6], "wrong", "g", "n")]
    got = {r["first_id"]: r["v"] for r in _best(spark, data, False).collect()}
    assert got.pop(1000) == "right"
    assert all(v.startswith("true") for v in got.values())


def test_hot_group(spark):
    df = spark.range(5000).select(F.col("id").alias("rid"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("d"), "id")).alias("doi"), F.lit(None).cast("string").alias("pmid"), F.lit("s").alias("src"), F.lit(T[0]).alias("at"), F.col("id").cast("string").alias("v"))
    got = truth.representatives(df, "rid", {"doi": F.col("doi"), "pmid": F.col("pmid")}, F.col("src"), F.col("at"), [truth.Field("v", F.col("v"), F.col("rid"), False)])
    assert rows(got.select("first_id", "n_rows", "v_id")) == [(0, 2500, 4998)]


def test_unconverged_truth_is_reported(spark):
    claims = spark.createDataFrame([(g, 0, v, s, 1) for g in range(6) for s, v in (("a", "x"), ("b", "x"), ("c", f"y{g}"))], "group int, field int, value string, source string, n bigint")
    with pytest.warns(UserWarning, match="still moved after 1 rounds"):
        truth.discover(claims, max_rounds=1)
    with warnings.catch_warnings():
        warnings.filterwarnings("error", message="reliabilities")
        votes, trust = truth.discover(claims)
    w = {r["source"]: r["w"] for r in trust.collect()}
    assert w["a"] == w["b"] > w["c"]
