"""A run directory made from a table of cases: what each case is, how often it occurs, and what must become of it. All records are invented."""

import json
from dataclasses import dataclass, field
from pathlib import Path

PLACE, FIRST_YEAR, LAST_YEAR = "singapore", 2015, 2026

# what a record of a domain says in title and abstract, and its heading
TERMS = {
    "vector_borne": ("malaria", "Malaria"),
    "sti": ("syphilis", "Syphilis"),
    "tb": ("bedaquiline", "Tuberculosis"),
    "rti": ("pertussis", "Whooping Cough"),
    "amr_hai": ("surgical-site infection", "Surgical Wound Infection"),
    "other_id": ("leptospirosis", "Leptospirosis"),
}
HERE = ["Meridian Hospital, Singapore; Kestrel Institute, Singapore.", "Kestrel Institute, Singapore. Electronic address: desk@kestrel.example"]
ABROAD = "Andes Institute, Quito, Peru."
OFFICE = "Trials unit, Oakmoor Biologics Inc, Singapore."


@dataclass
class Case:
    """before: verdict by rules. after: by decisions, where there is one. reason: the rule's id. domains: all that the record has."""

    name: str
    times: int
    before: str
    domains: tuple[str, ...] = ("vector_borne",)
    reason: str = ""
    after: str = ""
    record: dict = field(default_factory=dict)
    lead: bool = False
    fetched: int = 1  # in so many queries


CASES = [
    *[Case(f"plain {d}", n, "included", (d,)) for d, n in (("vector_borne", 6), ("sti", 2), ("tb", 3), ("rti", 2), ("amr_hai", 4))],
    Case("two domains", 2, "included", ("tb", "sti")),
    Case("two domains again", 1, "included", ("amr_hai", "rti"), fetched=3),
    Case("booster dose of a vaccine", 2, "included", ("rti",), record={"title": "Vaccination and a booster dose against {t}"}),
    Case("fetched by two queries", 2, "included", ("amr_hai",), fetched=2),
    Case("led from abroad", 2, "included", ("vector_borne",), record={"ends": ABROAD}),
    Case("comment", 2, "excluded", reason="EXC-TYP-01", record={"types": ["Comment"]}),
    Case("news", 1, "excluded", reason="EXC-TYP-01", record={"types": ["Journal Article", "News"]}),
    Case("in Spanish", 2, "excluded", reason="EXC-TYP-03", record={"language": "spa"}),
    Case("too early", 1, "excluded", reason="EXC-TYP-04", record={"year": FIRST_YEAR - 6}),
    Case("too late", 2, "excluded", reason="EXC-TYP-04", record={"year": LAST_YEAR + 3}),
    Case("elsewhere", 3, "excluded", reason="EXC-GEO-01", record={"all": ABROAD}),
    Case("office only", 2, "uncertain", reason="EXC-GEO-02", after="excluded", record={"all": OFFICE}),
    Case("place in the text only", 1, "uncertain", reason="INC-GEO-02", after="excluded", record={"all": ABROAD, "abstract": "Data on {t} from Singapore."}),
    Case("letter", 2, "uncertain", reason="UNC-LETTER", after="included", record={"types": ["Letter"]}),
    Case("single patient", 1, "uncertain", reason="EXC-TYP-02", record={"types": ["Case Reports"]}),
    Case("without abstract", 1, "uncertain", reason="EXC-GEN-03", after="included", record={"title": "{t}: malaria then and now", "abstract": "", "heading": "Malaria"}),
    Case("no domain", 2, "uncertain", ("other_id",), "UNC-DOMAIN", "included"),
    Case("lead only", 2, "uncertain", reason="UNC-LEAD", lead=True),
]
SPELLED_ANEW = 2  # leads with the title of an article, in other formatting


def records():
    """(case, uid, article or lead) for each record of the table, numbered from 9001."""
    out, n = [], 9000
    for c in CASES:
        for _ in range(c.times):
            n += 1
            t = [TERMS[d] for d in c.domains]
            words = " and ".join(x for x, _ in t)
            title = c.record.get("title", "Study {n} on {t}").format(t=words, n=n) + f" ({c.name} {n})"
            if c.lead:
                out.append((c, None, {"title": title, "authors_raw": "B Koh", "year": "2020", "venue": "Notes", "url": f"https://leads.example/{n}", "source": "scholar", "snippet": f"About {words}."}))
                continue
            everyone = c.record.get("all")
            first = everyone or c.record.get("ends") or HERE[n % 2]
            last = everyone or c.record.get("ends") or HERE[0]
            people = [("Koh", "Bea", first), ("Díaz", "Eva", everyone or HERE[1]), ("Ng" if n % 3 else "Koh", "Sam", last)]
            doi = f"10.7777/Fix.{n}"
            out.append((c, f"doi:{doi.lower()}", {
                "identifiers": {"pmid": str(n), "doi": doi}, "title": title, "abstract": c.record.get("abstract", "We looked at {t} for a year.").format(t=words), "doi": doi,
                "journal": {"title": f"Annals {n % 4}", "iso_abbreviation": f"Ann {n % 4}"}, "authors": [{"last_name": x, "fore_name": y, "initials": y[0], "affiliations": [z]} for x, y, z in people],
                "publication_date": {"year": str(c.record.get("year", 2018 + n % 7)), "month": "03", "day": "09"}, "article_types": c.record.get("types", ["Journal Article"]),
                "language": c.record.get("language", "eng"), "citation": {"pages": "9"}, "mesh_terms": [c.record.get("heading", h) for _, h in t] + ["Humans", "Seasons"],
            }))
    return out


RECORDS = records()


def pages():
    """Articles by query: a record fetched k times is in k queries."""
    names = [f"geo_{d}" for d in TERMS]
    out = {q: [] for q in names}
    for c, uid, r in RECORDS:
        if uid:
            at = names.index(f"geo_{c.domains[0]}")
            for k in range(c.fetched):
                out[names[(at + k) % len(names)]].append(r)
    return out


def leads():
    articles = [r for _, uid, r in RECORDS if uid]
    again = [{"title": r["title"].upper().replace(" ", "  ") + "!", "authors_raw": "", "year": "n.d.", "venue": "", "url": f"https://leads.example/{i}", "source": "scholar", "snippet": ""} for i, r in enumerate(articles[:SPELLED_ANEW])]
    return [r for _, uid, r in RECORDS if not uid] + again


def totals(after=False):
    out = dict.fromkeys(("included", "excluded", "uncertain"), 0)
    for c, _, _ in RECORDS:
        out[(after and c.after) or c.before] += 1
    return out


def write(run_dir):
    raw = Path(run_dir) / "raw"
    raw.mkdir(parents=True)
    for q, a in pages().items():
        half = len(a) // 2
        for i, part in enumerate((a[:half], a[half:]), 1):
            (raw / f"pubmed_{q}_{i}.json").write_text(json.dumps({"articles": part, "count": len(part)}, indent=2))
        (raw / f"pubmed_{q}_0.json").write_text(json.dumps({"pmids": [x["identifiers"]["pmid"] for x in a], "total_count": 4 * len(a), "returned_count": len(a), "has_more": True}))
    (raw / "scholar_sch_all.jsonl").write_text("".join(json.dumps(x) + "\n" for x in leads()) + "{broken\n")


def write_decisions(run_dir):
    """Each decision twice: first the opposite, then, on a later line, the one that counts."""
    word = {"included": "include", "excluded": "exclude"}
    other = {"included": "excluded", "excluded": "included"}
    decided = [(uid, c) for c, uid, _ in RECORDS if c.after]
    rows = [{"uid": uid, "decision": word[v(c.after)], "rule_id": f"PPL-{c.reason}", "reason": "full text", "decided_by": "user"} for v in (other.get, str) for uid, c in decided]
    path = Path(run_dir) / "screening" / "decisions.jsonl"
    path.parent.mkdir(exist_ok=True)
    path.write_text("".join(json.dumps(x) + "\n" for x in rows) + "not json\n")
