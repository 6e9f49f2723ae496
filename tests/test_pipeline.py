"""The stages end to end over the fixture; every output is opened as the file it is named."""

import csv
import json

import pytest

from brambling import cli
from brambling.plans import pipeline
from brambling.sources import raw
from tests import fixture


def lines(path):
    return [json.loads(x) for x in path.read_text(encoding="utf-8").splitlines()]


def table(path):
    with path.open(newline="", encoding="utf-8") as f:
        return list(csv.DictReader(f))


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("run")
    fixture.write(d)
    inst = d / "inst.csv"
    inst.write_text("alias,label,country,region,sector\nmeridian hospital,Meridian Hospital,Singapore,Southeast Asia,hospital\nkestrel institute,Kestrel Institute,Singapore,Southeast Asia,research_institute\nandes institute,Andes Institute,Peru,Latin America,research_institute\n")
    go = lambda stage, *x: cli.main([stage, "--run-dir", str(d), "--institutions", str(inst), "--subdomain-min-records", "1", *x])
    assert go("preflight") == 0
    assert go("build_queries") == 0
    assert go("ingest") == 0
    assert go("screen") == 0
    first = {w: len(lines(d / "screening" / f"{w}.jsonl")) for w in ("included", "excluded", "uncertain")}
    reasons = {r["uid"]: r["rule_id"] for w in ("excluded", "uncertain") for r in lines(d / "screening" / f"{w}.jsonl")}
    fixture.write_decisions(d)
    assert go("screen") == 0
    assert go("classify") == 0
    assert go("topic_model", "--no-bertopic") == 0
    assert go("build_dataset") == 0
    return d, first, reasons, go


def test_counts(run):
    """As many records of each verdict as the table of cases has, before and after decisions; of two decisions the later counts."""
    d, first, _, _ = run
    assert len(json.loads((d / "queries.json").read_text())["queries"]) >= 9
    recs = lines(d / "records.jsonl")
    assert len(recs) == len(fixture.RECORDS) == len({r["uid"] for r in recs})
    assert [r["seq"] for r in recs] == sorted(r["seq"] for r in recs)
    assert first == fixture.totals()
    want = fixture.totals(after=True)
    assert {w: len(lines(d / "screening" / f"{w}.jsonl")) for w in want} == want
    assert len(lines(d / "classification" / "classified.jsonl")) == want["included"] == len(table(d / "dataset" / "publications.csv"))


def test_provenance_and_precedence(run):
    recs = {r["uid"]: r for r in lines(run[0] / "records.jsonl")}
    pages = fixture.pages()
    for c, uid, a in fixture.RECORDS:
        if uid:
            r = recs[uid]
            assert r["title"] == a["title"] and not r["needs_manual_metadata"]
            assert {q for q in r["provenance"] if q.startswith("geo_")} == {q for q, x in pages.items() if a in x} and len(pages) > c.fetched
    assert sum(r["origins"] == ["pubmed", "scholar"] for r in recs.values()) == fixture.SPELLED_ANEW
    manual = [r for r in recs.values() if r["needs_manual_metadata"]]
    assert len(manual) == sum(c.times for c in fixture.CASES if c.lead) and all(r["uid"].startswith("title:") for r in manual)


def test_reasons_and_amendments(run):
    d, _, reasons, _ = run
    for c, uid, _ in fixture.RECORDS:
        if uid:
            assert reasons.get(uid, "") == c.reason, c.name
    got = {(r["rule_id"], r["decision"]): r["n"] for r in lines(d / "screening" / "amendments.jsonl")}
    want = {}
    for c, _, _ in fixture.RECORDS:
        if c.after:
            want[c.reason, c.after] = want.get((c.reason, c.after), 0) + 1
    assert got == want


def test_labels(run):
    d = run[0]
    dom = {}
    for r in table(d / "dataset" / "publication_domains.csv"):
        dom.setdefault(r["uid"], set()).add(r["domain_id"])
    for c, uid, _ in fixture.RECORDS:
        if uid in dom:
            assert dom[uid] == set(c.domains), c.name
    vaccine = {uid for c, uid, _ in fixture.RECORDS if "vaccine" in c.name}
    assert vaccine == {r["uid"] for r in table(d / "dataset" / "publication_research_types.csv") if r["type_label"] == "Vaccine"}
    other = [r for r in table(d / "dataset" / "publication_domains.csv") if r["domain_id"] == "other_id"]
    assert other and all(r["domain_score"] == "" and r["is_primary"] == "1" for r in other)
    own = {r["uid"]: {m.lower() for m in r["mesh_terms"]} for r in lines(d / "screening" / "included.jsonl")}
    sub = table(d / "dataset" / "publication_subdomains.csv")
    assert len(sub) == fixture.totals(after=True)["included"] and all(r["subdomain"] for r in sub)
    assert all(r["subdomain_mesh"] in own[r["uid"]] for r in sub if r["subdomain"] != "Other/unspecified")
    vocabulary = table(d / "classification" / "subdomain_vocabulary.csv")
    assert not {"humans", "seasons"} & {r["mesh_term"] for r in vocabulary} and all(int(r["frequency"]) >= 1 for r in vocabulary)
    led = {r["uid"]: r["singapore_led"] for r in table(d / "dataset" / "publications.csv")}
    for c, uid, _ in fixture.RECORDS:
        if uid in led:
            assert led[uid] == ("0" if c.name == "led from abroad" else "1"), c.name


def test_multi_label_summary(run):
    """A publication counts in each of its domains; led and international follow from its affiliations."""
    d = run[0]
    pubs = {r["uid"]: r for r in table(d / "dataset" / "publications.csv")}
    want = {}
    for r in table(d / "dataset" / "publication_domains.csv"):
        w = want.setdefault((r["domain_id"], r["year"]), [0, 0, 0])
        w[0] += 1
        w[1] += int(pubs[r["uid"]]["singapore_led"])
        w[2] += int(pubs[r["uid"]]["n_countries"]) > 1
    got = {(r["domain_id"], r["year"]): [int(r[c]) for c in ("publications", "singapore_led", "international")] for r in table(d / "dataset" / "summary_by_domain_year.csv")}
    assert got == want and sum(w[0] for w in want.values()) > len(pubs) and sum(w[2] for w in want.values()) == 2


def test_published_tables_hold_together(run):
    d = run[0]
    names = sorted(p.name[:-4] for p in (d / "dataset").iterdir())
    assert set(names) == set(pipeline.TABLES) and all((d / "dataset" / f"{n}.csv").is_file() for n in names)
    pubs = {r["uid"] for r in table(d / "dataset" / "publications.csv")}
    for n in names:
        rows = table(d / "dataset" / f"{n}.csv")
        assert rows and not any(c.startswith("_") for c in rows[0]), n
        if "uid" in rows[0]:
            assert {r["uid"] for r in rows} <= pubs, n
    data = (d / "dataset" / "publications.csv").read_bytes()
    assert data.count(b"\r\n") == len(pubs) + 1 == data.count(b"\n") and not data.startswith(b"\xef\xbb\xbf")
    for k in ("institution", "author", "country"):
        nodes = {r["node_id"]: r for r in table(d / "dataset" / f"network_{k}_nodes.csv")}
        edges = table(d / "dataset" / f"coauthor_{k}_edges.csv")
        paths = table(d / "dataset" / f"network_{k}_paths.csv")
        assert len({e["edge_id"] for e in edges}) == len(edges) and all(e["source"] < e["target"] and int(e["weight"]) >= 1 for e in edges)
        assert all(r["node_id"] in nodes for r in paths) and all(0 <= float(r[c]) <= 1 for r in paths for c in "xy")
        assert {r["domain"] for r in paths} >= {"ALL"}
    top = {r["author_key"]: int(r["n_publications"]) for r in table(d / "dataset" / "summary_top_authors.csv") if r["domain_id"] == "ALL"}
    assert all(int(r["n_publications"]) == top[k] for k, r in {r["node_id"]: r for r in table(d / "dataset" / "network_author_nodes.csv")}.items())
    assert {"koh-b", "diaz-e"} <= set(top)


def test_published_orders(run):
    """Records as first seen, labels of a record by score, primary first; domains of the topic map by size, topics by number."""
    d = run[0]
    seq = {r["uid"]: i for i, r in enumerate(lines(d / "records.jsonl"))}
    for n in ("publications", "publication_domains", "publication_research_types", "publication_authors", "publication_topics"):
        at = [seq[r["uid"]] for r in table(d / "dataset" / f"{n}.csv")]
        assert at == sorted(at), n
    for n, primary, score, key in (("publication_domains", "is_primary", "domain_score", "domain_id"), ("publication_research_types", "year", "type_score", "type_id")):
        rows = [(seq[r["uid"]], -int(r[primary]), -int(r[score] or 0), r[key]) for r in table(d / "dataset" / f"{n}.csv")]
        assert rows == sorted(rows), n
    cents = table(d / "topics" / "topic_centroids.csv")
    in_all = {}
    for r in cents:
        in_all[r["domain_id"]] = in_all.get(r["domain_id"], 0) + int(r["size"])
    keys = [(-in_all[r["domain_id"]], r["domain_id"], int(r["topic_id"].rpartition("_t")[2])) for r in cents]
    assert keys == sorted(keys) and table(d / "dataset" / "topic_map_centroids.csv") == cents


def test_map_keeps_topics_apart(run):
    d = run[0]
    cents = {r["topic_id"]: r for r in table(d / "topics" / "topic_centroids.csv")}
    checked = 0
    for r in table(d / "topics" / "publication_topics.csv"):
        x, y = float(r["map_x"]), float(r["map_y"])
        assert 0 <= x <= 1 and 0 <= y <= 1
        dist = {t: (x - float(c["x"])) ** 2 + (y - float(c["y"])) ** 2 for t, c in cents.items() if c["domain_id"] == r["domain_id"]}
        assert dist[r["topic_id"]] <= min(dist.values()) + 1e-9
        checked += len(dist) > 1
    assert checked


def test_relabel_survives_and_runs_repeat(run):
    """The vocabulary is edited in its file, as a person would, and keeps the label."""
    d, _, _, go = run
    path = d / "classification" / "subdomain_vocabulary.csv"
    rows = table(path)
    pick = next(r for r in rows if r["domain_id"] == "tb")["mesh_term"]
    for r in rows:
        if r["mesh_term"] == pick:
            r["display_label"] = "Edited, by hand"
    with path.open("w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, fieldnames=list(rows[0]))
        w.writeheader()
        w.writerows(rows)
    before = {n: (d / "dataset" / f"{n}.csv").read_bytes() for n in ("network_author_nodes", "publication_topics", "topic_map_centroids")}
    assert go("classify") == 0 and go("build_dataset") == 0
    assert {r["display_label"] for r in table(path) if r["mesh_term"] == pick} == {"Edited, by hand"}
    assert any(r["subdomain_label"] == "Edited, by hand" for r in table(d / "dataset" / "summary_subdomain_year.csv"))
    assert before == {n: (d / "dataset" / f"{n}.csv").read_bytes() for n in before}


def test_checks_are_clean(run, spark):
    d = run[0]
    load = lambda n: spark.read.parquet(f"{d}/stages/classified_{n}.parquet")
    v = pipeline.Vocabularies.default(spark)
    t = pipeline.dataset({n: load(n) for n in ("domains", "types", "vocabulary", "subdomains", "affiliations", "facts")}, v, pipeline.Options())
    assert {r["bad"] for r in pipeline.checks(t).collect()} == {0}


def test_readers_and_coverage(run, spark):
    d = run[0]
    pages = fixture.pages()
    assert raw.articles(spark, str(d)).count() == sum(len(a) for a in pages.values())
    assert {r["query_id"]: r["coverage"] for r in raw.search_pages(spark, str(d)).collect()} == {q: 0.25 for q in pages}
    assert raw.leads(spark, str(d)).count() == len(fixture.leads())
    assert {r["query_id"]: (int(r["reported"]), int(r["fetched"]), float(r["share"])) for r in table(d / "coverage.csv")} == {q: (4 * len(a), len(a), 0.25) for q, a in pages.items()}


def test_preflight_says_what_is_missing(run, tmp_path, capsys):
    bad = tmp_path / "bad.csv"
    bad.write_text("alias,label\nx,y\n")
    rules = tmp_path / "rules.md"
    rules.write_text('text\n```json\n[{"rule_id": "R", "verdict": "excluded", "test": "moon"}]\n```\n')
    assert cli.main(["preflight", "--institutions", str(bad), "--stoplist", str(tmp_path / "none.csv"), "--rules", str(rules)]) == 1
    said = capsys.readouterr().out
    assert "institutions: no column" in said and "stoplist: no file" in said and "moon" in said


def test_rules_come_from_a_file(run, tmp_path):
    """The first rule left out: what it excluded is included."""
    d, _, _, go = run
    rules = tmp_path / "rules.md"
    rules.write_text("Rules\n```json\n" + json.dumps([r for r in pipeline.vocab.RULES if r["rule_id"] != "EXC-TYP-01"]) + "\n```\n")
    assert go("screen", "--rules", str(rules)) == 0
    freed = sum(c.times for c in fixture.CASES if c.reason == "EXC-TYP-01")
    assert len(lines(d / "screening" / "included.jsonl")) == fixture.totals(after=True)["included"] + freed


def test_fetch_experts(tmp_path, spark):
    html, out = tmp_path / "p.html", tmp_path / "roster.csv"
    html.write_text('<a class="x" href="/experts/a">Dr <b>Ann</b> A &amp; co</a><a href="/other">no</a>')
    assert cli.main(["fetch_experts", "--html", str(html), "--out", str(out)]) == 0
    text = out.read_text().replace("Dr Ann A & co,,", "Old name,Ann A[au],")
    out.write_text(text + "/experts/gone,Gone,q,,,,1\n")
    assert cli.main(["fetch_experts", "--html", str(html), "--out", str(out)]) == 0
    rows = {r["profile_url"]: r for r in csv.DictReader(out.open())}
    assert rows["/experts/a"]["name"] == "Dr Ann A & co" and rows["/experts/a"]["pubmed_author_query"] == "Ann A[au]" and "/experts/gone" in rows
    html.write_text("nothing")
    before = out.read_bytes()
    assert cli.main(["fetch_experts", "--html", str(html), "--out", str(out)]) == 1 and out.read_bytes() == before


def test_queries_of_experts(spark):
    """One query per active expert with a search of their own, with the window of years."""
    from brambling.runtime import local

    roster = local(spark, [("/a", "Ann A[au]", "1"), ("/b", "Bo B[au]", "no"), ("/c", None, "1"), ("/d", "Di D[au]", None)], "profile_url string, pubmed_author_query string, active string")
    o = pipeline.Options(from_year=2016, to_year=2018)
    got = pipeline.build_queries(pipeline.vocab.domains(spark), roster, o).collect()
    assert sorted(r["text"] for r in got if r["kind"] == "expert") == ["Ann A[au] AND 2016:2018[dp]", "Di D[au] AND 2016:2018[dp]"]
    assert {r["query_id"] for r in got if r["kind"] == "search"} == {"geo_all_id", *(f"geo_{d}" for d in pipeline.vocab.DOMAINS)} and len({r["query_id"] for r in got}) == len(got)


def test_affiliations_resolve(spark):
    """The longest alias, the country of the institution, of the last part or of any; addresses, blanks, nulls and authors without any."""
    texts = ["Saw Swee Hock School of Public Health, National University of Singapore, Singapore; Mahidol University", "Unknown Clinic, Lima, Peru. Electronic address: a@b.example", "Clinic of Kenya Street 5", "Nowhere", "", None, "; ;"]
    authors = [{"last_name": f"N{i}", "fore_name": "A", "affiliations": [t]} for i, t in enumerate(texts)] + [{"last_name": "None", "fore_name": None, "affiliations": None}, {"last_name": None, "fore_name": None, "affiliations": []}]
    df = spark.createDataFrame([("u", authors), ("v", None), ("w", [])], "uid string, authors array<struct<last_name:string,fore_name:string,affiliations:array<string>>>")
    v = pipeline.Vocabularies.default(spark)
    got = {(r["author_no"], r["text"]): (r["institution"], r["country"], r["iso3"]) for r in pipeline.author_affiliations(df, v, False).collect()}
    assert got == {
        (1, "Saw Swee Hock School of Public Health, National University of Singapore, Singapore"): ("National University of Singapore", "Singapore", "SGP"), (1, "Mahidol University"): ("Mahidol University", "Thailand", "THA"),
        (2, "Unknown Clinic, Lima, Peru."): (None, "Peru", "PER"), (3, "Clinic of Kenya Street 5"): (None, "Kenya", "KEN"), (4, "Nowhere"): (None, None, None),
        **{(k, None): (None, None, None) for k in (5, 6, 7, 8, 9)},
    }
    led = {r["uid"]: (r["singapore_led"], r["n_countries"]) for r in pipeline.leadership(pipeline.author_affiliations(df, v, False), pipeline.Options()).collect()}
    assert led == {"u": (True, 4)}
