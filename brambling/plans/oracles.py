"""The queries of landscape.py in SQL for DuckDB. Queries on clusters and layouts have none."""

from __future__ import annotations

from brambling.functions.text import MARKED, PLAIN
from brambling.operators.classify import OTHER, WEIGHTS
from brambling.sources.vocab import COUNTRIES, DOMAINS, RESEARCH_TYPES, STOPLIST


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _norm(c: str) -> str:
    return f"nullif(trim(regexp_replace(lower(regexp_replace(translate({c}, '{MARKED}', '{PLAIN}'), '\\p{{M}}+', '', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), '')"


def _year(c: str) -> str:
    return f"try_cast(nullif(regexp_extract({c}, '(^|[^0-9])([0-9]{{4}})([^0-9]|$)', 2), '') AS INT)"


def _doi(c: str) -> str:
    t = f"regexp_replace(regexp_replace(lower({c}), '^\\s+|\\s+$', '', 'g'), '^(https?://[^/\\s]+/|doi:\\s*)+', '')"
    return f"CASE WHEN regexp_matches({t}, '^10\\.[^/\\s]+/\\S') THEN {t} END"


def _has(text: str, word: str) -> str:
    return f"contains(' ' || coalesce({_norm(text)}, '') || ' ', ' {word} ')"


_RECORDS = f"""
art AS (SELECT rec_id AS rid, 'pubmed' AS origin, query_id, coalesce({_doi('doi')}, {_doi('identifiers.doi')}) AS doi, nullif(trim(identifiers.pmid), '') AS pmid, title, abstract,
  journal.title AS journal, {_year('publication_date.year')} AS year, language, coalesce(article_types, []) AS article_types, coalesce(mesh_terms, []) AS mesh_terms, coalesce(keywords, []) AS keywords,
  flatten(list_transform(coalesce(authors, []), lambda a: coalesce(a.affiliations, []))) AS affiliations FROM articles),
lea AS (SELECT lead_id AS rid, 'scholar' AS origin, query_id, NULL AS doi, NULL AS pmid, title, snippet AS abstract, venue AS journal, {_year('year')} AS year, NULL AS language,
  []::VARCHAR[] AS article_types, []::VARCHAR[] AS mesh_terms, []::VARCHAR[] AS keywords, []::VARCHAR[] AS affiliations FROM scholar_leads),
rec AS (SELECT * FROM art UNION ALL SELECT * FROM lea),
ren AS (SELECT *, {_norm('title')} AS nt FROM rec)"""

_GROUPS = f"""WITH RECURSIVE {_RECORDS},
keys AS (SELECT rid, 'd' || doi AS k FROM ren WHERE doi IS NOT NULL UNION ALL SELECT rid, 'p' || pmid FROM ren WHERE pmid IS NOT NULL UNION ALL SELECT rid, 't' || nt FROM ren WHERE nt IS NOT NULL),
links AS (SELECT DISTINCT x.rid AS u, y.rid AS v FROM keys x JOIN keys y USING (k)),
walk AS (SELECT rid AS u, rid AS r FROM rec UNION SELECT l.v, w.r FROM walk w JOIN links l ON l.u = w.u),
grp AS (SELECT u AS rid, min(r) AS first_rid FROM walk GROUP BY u)"""

_TYPE = "list_has_any(list_transform(article_types, lambda t: lower(trim(t))), {})"
_OFFICE = "regexp_matches(lower(a), '\\b(inc|ltd|limited|gmbh|corp|pharmaceuticals?|biologics|branch)\\b')"
_HERE = f"len(list_filter(affiliations, lambda a: {_has('a', 'singapore')})) > 0"
_TEXT = _has("concat_ws(' ', title, abstract)", "singapore")
_RULES = [
    ("EXC-TYP-01", "excluded", _TYPE.format("['editorial', 'comment', 'news']")),
    ("EXC-TYP-03", "excluded", "language <> 'eng'"),
    ("EXC-TYP-04", "excluded", "NOT (year BETWEEN 2015 AND 2026)"),
    ("EXC-GEO-01", "excluded", f"origin = 'pubmed' AND NOT ({_HERE}) AND NOT {_TEXT}"),
    ("UNC-LEAD", "uncertain", "origin <> 'pubmed'"),
    ("EXC-GEO-02", "uncertain", f"({_HERE}) AND len(list_filter(affiliations, lambda a: {_has('a', 'singapore')} AND NOT {_OFFICE})) = 0"),
    ("INC-GEO-02", "uncertain", f"NOT ({_HERE}) AND {_TEXT}"),
    ("UNC-LETTER", "uncertain", _TYPE.format("['letter']")),
    ("EXC-TYP-02", "uncertain", _TYPE.format("['case reports']")),
    ("EXC-GEN-03", "uncertain", "coalesce(length(trim(abstract)), 0) = 0"),
]
_SCREEN = f"WITH {_RECORDS}, hit AS (" + " UNION ALL ".join(f"SELECT rid, {i} AS i, {_q(r)} AS rule_id, {_q(v)} AS v FROM rec WHERE coalesce({t}, false)" for i, (r, v, t) in enumerate(_RULES)) + """),
one AS (SELECT rec.rid, CASE WHEN count(*) FILTER (v = 'excluded') > 0 THEN 'excluded' WHEN count(*) FILTER (v = 'uncertain') > 0 THEN 'uncertain' ELSE 'included' END AS verdict,
  coalesce(arg_min(rule_id, i) FILTER (v = 'excluded'), arg_min(rule_id, i) FILTER (v = 'uncertain')) AS rule_id FROM rec LEFT JOIN hit USING (rid) GROUP BY rec.rid)"""


def _terms(source: dict[str, tuple[str, list[str]]]) -> str:
    rows = ", ".join(f"({i}, {_q(k)}, {_q(label)}, {_q(t)})" for i, (k, (label, ts)) in enumerate(source.items()) for t in ts)
    return f"terms AS (SELECT DISTINCT pos, label_id, label, {_norm('term')} AS term FROM (VALUES {rows}) v(pos, label_id, label, term))"


def _scored(source: dict[str, tuple[str, list[str]]], least: int) -> str:
    inside = lambda c: f"contains(' ' || coalesce({c}, '') || ' ', ' ' || term || ' ')"
    lists = lambda c: f"list_transform({c}, lambda x: coalesce({_norm('x')}, ''))"
    return f"""{_RECORDS}, {_terms(source)},
fld AS (SELECT rid, year, {_norm('title')} AS t, {_norm('abstract')} AS b, {lists('mesh_terms')} AS m, {lists('keywords')} AS k FROM art),
hit AS (SELECT rid, label_id, pos, (CASE WHEN {inside('t')} THEN {WEIGHTS['title']} ELSE 0 END) + (CASE WHEN {inside('b')} THEN {WEIGHTS['abstract']} ELSE 0 END)
  + (CASE WHEN len(list_filter(m, lambda x: {inside('x')})) > 0 THEN {WEIGHTS['mesh']} ELSE 0 END) + (CASE WHEN len(list_filter(k, lambda x: {inside('x')})) > 0 THEN {WEIGHTS['keyword']} ELSE 0 END) AS w FROM fld, terms),
sc AS (SELECT rid, label_id, min(pos) AS pos, sum(w)::BIGINT AS score FROM hit GROUP BY rid, label_id HAVING sum(w) >= {least})"""


_DOMS = f"""WITH {_scored(DOMAINS, 4)},
pri AS (SELECT rid, label_id AS domain_id, score, CASE WHEN row_number() OVER (PARTITION BY rid ORDER BY score DESC, pos) = 1 THEN 1 ELSE 0 END AS is_primary FROM sc),
dom AS (SELECT * FROM pri UNION ALL SELECT rid, 'other_id', NULL, 1 FROM art WHERE rid NOT IN (SELECT rid FROM pri))"""

_VOCAB = f"""{_DOMS},
stp AS (SELECT * FROM (VALUES {', '.join(f'({_q(t)})' for t in STOPLIST)}) v(term)),
tag AS (SELECT d.rid, d.domain_id, lower(trim(x)) AS mesh_term FROM dom d JOIN art USING (rid), unnest(mesh_terms) u(x) WHERE d.domain_id <> 'other_id'),
frq AS (SELECT domain_id, mesh_term, count(DISTINCT rid) AS frequency FROM tag WHERE mesh_term <> '' AND mesh_term NOT IN (SELECT term FROM stp) GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
voc AS (SELECT *, row_number() OVER (PARTITION BY domain_id ORDER BY frequency DESC, mesh_term) AS rank FROM frq QUALIFY rank <= 12),
old AS (SELECT * FROM (VALUES ('tb', 'sputum', 'Sputum tests'), ('vector_borne', 'dengue', 'Dengue fever'), ('rti', 'covid-19', 'COVID-19 (all)'), ('sti', 'no such term', 'Nothing')) v(domain_id, mesh_term, dl)),
lab AS (SELECT v.*, coalesce(dl, array_to_string(list_transform(string_split(v.mesh_term, ' '), lambda w: upper(w[1:1]) || w[2:]), ' ')) AS display_label FROM voc v LEFT JOIN old o ON o.domain_id = v.domain_id AND o.mesh_term = v.mesh_term),
bst AS (SELECT t.rid, t.domain_id, min(struct_pack(rank := l.rank, mesh_term := l.mesh_term, dl := l.display_label)) AS b FROM tag t JOIN lab l ON l.domain_id = t.domain_id AND l.mesh_term = t.mesh_term GROUP BY ALL),
asg AS (SELECT d.rid, d.domain_id, b.mesh_term AS subdomain_mesh, coalesce(b.dl, {_q(OTHER)}) AS subdomain, b.rank AS vocabulary_rank FROM dom d LEFT JOIN bst USING (rid, domain_id) WHERE d.domain_id <> 'other_id')"""

_INST = """inst AS (SELECT DISTINCT a.uid, a.institution_id, country, region, sector, iso3, is_singapore FROM publication_authors a LEFT JOIN network_institution_nodes n ON n.node_id = a.institution_id
  WHERE a.uid IS NOT NULL AND a.institution_id IS NOT NULL),
cty AS (SELECT DISTINCT uid, country, region, iso3 FROM inst WHERE country IS NOT NULL),
nct AS (SELECT uid, count(DISTINCT country) AS n_countries FROM cty GROUP BY uid)"""


def _edges(bridge: str) -> str:
    """`bridge` gives uid, node, domain (or NULL)."""
    return f"""bri AS (SELECT DISTINCT uid, node, domain FROM ({bridge}) WHERE node IS NOT NULL AND uid IS NOT NULL),
lay AS (SELECT DISTINCT uid, node, 'ALL' AS layer FROM bri UNION SELECT uid, node, domain FROM bri WHERE domain IS NOT NULL),
edg AS (SELECT a.layer, a.node AS source, b.node AS target, count(*) AS weight FROM lay a JOIN lay b ON a.layer = b.layer AND a.uid = b.uid AND a.node < b.node GROUP BY ALL),
all_ AS (SELECT * FROM edg WHERE layer = 'ALL'),
two AS (SELECT source AS node_id, target AS other, weight FROM all_ UNION ALL SELECT target, source, weight FROM all_),
deg AS (SELECT b.node AS node_id, any_value(n) AS n_publications, count(weight) AS degree, coalesce(sum(weight), 0)::BIGINT AS weighted_degree
  FROM (SELECT node, count(DISTINCT uid) AS n FROM bri GROUP BY node) b LEFT JOIN two ON two.node_id = b.node GROUP BY b.node)"""


def _pub(node: str) -> str:
    return f"SELECT a.uid, a.{node} AS node, p.primary_domain AS domain FROM publication_authors a LEFT JOIN publications p USING (uid)"


_E_INST, _E_AUTH = "WITH " + _edges(_pub("institution_id")), "WITH " + _edges(_pub("author_key"))
_E_CTY = f"WITH {_INST}, " + _edges("SELECT uid, country AS node, NULL AS domain FROM cty")
_TOP = """WITH x AS (SELECT DISTINCT a.uid, a.author_key, p.primary_domain AS domain_id FROM publication_authors a JOIN publications p USING (uid) WHERE a.author_key IS NOT NULL),
top AS (SELECT author_key, CASE WHEN grouping(domain_id) = 1 THEN 'ALL' ELSE domain_id END AS domain_id, count(DISTINCT uid) AS n_publications FROM x GROUP BY GROUPING SETS ((author_key, domain_id), (author_key)))"""
_SLUG = f"""WITH au AS (SELECT unnest(authors) AS a FROM articles),
sl AS (SELECT a.last_name AS last_name, a.fore_name AS fore_name, replace({_norm('a.last_name')}, ' ', '') || '-' || coalesce(replace({_norm('a.fore_name')}, ' ', '')[1:1], '') AS author_key, count(*) AS n
  FROM au WHERE a.last_name IS NOT NULL AND a.fore_name IS NOT NULL GROUP BY ALL)"""
_NO_LABELS = _VOCAB.replace(_VOCAB[_VOCAB.index("('tb', 'sputum'") : _VOCAB.index(") v(domain_id, mesh_term, dl)")], "('', '', '')")
_AFF = f"""au AS (SELECT rec_id::VARCHAR AS uid, len(authors)::INT AS n_authors, i::INT AS author_no, replace({_norm('authors[i].last_name')}, ' ', '') || '-' || coalesce(replace({_norm('authors[i].fore_name')}, ' ', '')[1:1], '') AS author_key,
  concat_ws(', ', authors[i].last_name, authors[i].fore_name) AS label, authors[i].affiliations AS affs FROM articles, unnest(range(1, len(authors) + 1)) r(i)),
fie AS (SELECT uid, author_no, unnest(affs) AS t FROM au),
txt AS (SELECT uid, author_no, unnest(list_filter(list_transform(string_split(regexp_replace(t, '(?is)\\s*electronic address:.*', ''), ';'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')) AS text FROM fie),
dif AS (SELECT text, ' ' || coalesce({_norm('text')}, '') || ' ' AS nt, {_norm("string_split(text, ',')[-1]")} AS tail FROM (SELECT DISTINCT text FROM txt)),
ins AS (SELECT label AS institution, {_norm('label')} AS term, country, region, sector FROM network_institution_nodes WHERE label IS NOT NULL),
cou AS (SELECT {_norm('alias')} AS term, country, region, iso3 FROM (VALUES {', '.join('(' + ', '.join(map(_q, r)) + ')' for r in COUNTRIES)}) v(alias, country, region, iso3)),
hin AS (SELECT text, arg_max(institution, (length(term), term, institution)) AS institution FROM dif JOIN ins ON contains(nt, ' ' || term || ' ') GROUP BY text),
hco AS (SELECT text, arg_max(country, (length(term), term, country)) AS inside FROM dif JOIN cou ON contains(nt, ' ' || term || ' ') GROUP BY text),
tai AS (SELECT term AS tail, min(country) AS at_end FROM cou GROUP BY term),
iat AS (SELECT institution, min(country) AS ic, min(region) AS ir, min(sector) AS sector FROM ins GROUP BY institution),
cat AS (SELECT country, min(region) AS cr, min(iso3) AS iso3 FROM cou GROUP BY country),
rea AS (SELECT text, institution, coalesce(ic, at_end, inside) AS country, ir, sector FROM dif LEFT JOIN hin USING (text) LEFT JOIN hco USING (text) LEFT JOIN tai USING (tail) LEFT JOIN iat USING (institution)),
res AS (SELECT text, institution, rea.country, coalesce(ir, cr) AS region, sector, iso3 FROM rea LEFT JOIN cat ON cat.country = rea.country),
aff AS (SELECT au.uid, au.author_no, n_authors, author_key, label, txt.text, institution, country, region, sector, iso3 FROM au LEFT JOIN txt ON txt.uid = au.uid AND txt.author_no = au.author_no LEFT JOIN res ON res.text = txt.text),
led AS (SELECT uid, coalesce(bool_or((author_no = 1 OR author_no = n_authors) AND lower(country) = 'singapore'), false) AS led, count(DISTINCT country) AS n_countries, max(n_authors) AS n_authors FROM aff GROUP BY uid),
pau AS (SELECT uid, author_no, min(author_key) AS author_key, min(label) AS label, min(institution) AS institution_id FROM aff WHERE author_key IS NOT NULL GROUP BY uid, author_no),
lab_ AS (SELECT author_key, arg_min(label, (-n, label)) AS label FROM (SELECT author_key, label, count(*) AS n FROM pau GROUP BY ALL) GROUP BY author_key),
mod_ AS (SELECT author_key, arg_min(institution_id, (-n, institution_id)) AS institution FROM (SELECT author_key, institution_id, count(*) AS n FROM pau WHERE institution_id IS NOT NULL GROUP BY ALL) GROUP BY author_key)"""
_PUBS = _NO_LABELS + f""", {_AFF},
ful AS (SELECT a.rid, a.rid::VARCHAR AS uid, a.title, a.year, a.journal, coalesce(led, false)::INT AS singapore_led, coalesce(n_countries, 0)::INT AS n_countries, coalesce(n_authors, 0)::INT AS n_authors FROM art a LEFT JOIN led ON led.uid = a.rid::VARCHAR)"""
_LABEL_OF = "CASE domain_id " + " ".join(f"WHEN {_q(k)} THEN {_q(label)}" for k, (label, _) in DOMAINS.items()) + " ELSE 'Other infectious disease' END"
_TOKENS = "list_filter(regexp_extract_all(lower({}), '[\\p{{L}}\\p{{M}}\\p{{N}}]+(?:-[\\p{{L}}\\p{{M}}\\p{{N}}]+)*'), lambda t: length(t) >= 3)"
_HOURS = "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE ts IS NOT NULL GROUP BY ALL"

_DECIDED = """WITH s AS (SELECT doc_id, CASE WHEN lower(trim(lang)) <> 'en' THEN 'excluded' WHEN lang IS NULL OR coalesce(length(trim(text)), 0) = 0 THEN 'uncertain' ELSE 'included' END AS v,
  CASE WHEN lower(trim(lang)) <> 'en' THEN 'LANG' WHEN lang IS NULL THEN 'NOLANG' WHEN coalesce(length(trim(text)), 0) = 0 THEN 'EMPTY' END AS r FROM documents),
d AS (SELECT doc_id, CASE WHEN labelled_by = 'user' THEN 'included' ELSE 'excluded' END AS v, subject_id AS r FROM subject_examples QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY subject_id DESC, CASE WHEN labelled_by = 'user' THEN 1 ELSE 0 END DESC) = 1)
"""

# what checks of clusters, maps and layouts must find: all rows, and none that breaks a rule
_CHECKS = {
    "topic_map_check": _DOMS + " SELECT domain_id AS domain, count(*) AS placed, 0::BIGINT AS misplaced FROM dom WHERE is_primary = 1 GROUP BY domain_id",
    "topic_kmeans_check": _DOMS + " SELECT domain_id AS domain, count(*) AS texts, 0 AS too_many, 0::BIGINT AS misnumbered FROM dom WHERE is_primary = 1 GROUP BY domain_id",
    "topic_kmeans_given_check": "SELECT label::VARCHAR AS domain, count(*) AS vectors, 0::BIGINT AS astray FROM embeddings GROUP BY label",
    "network_layout_check": "SELECT least(250, count(DISTINCT institution_id)) AS nodes, 0::BIGINT AS unplaced, 0::BIGINT AS outside FROM publication_authors WHERE uid IS NOT NULL AND institution_id IS NOT NULL",
}

ORACLES = {
    **_CHECKS,
    "article_records": f"WITH {_RECORDS} SELECT rid, query_id, doi, pmid, journal, year, language, len(article_types) AS n_types, len(mesh_terms) AS n_mesh, len(affiliations) AS n_affiliations FROM art",
    "lead_records": f"WITH {_RECORDS} SELECT rid, query_id, {_norm('title')} AS norm, year, journal FROM lea",
    "record_uid": f"WITH {_RECORDS} SELECT rid, coalesce('doi:' || doi, 'pmid:' || pmid, 'title:' || sha256(nt)[1:16]) AS uid FROM ren",
    "json_lines_fields": "SELECT lead_id, raw_line->>'$.title' AS title, raw_line->>'$.venue' AS venue, raw_line->>'$.year' AS year, raw_line->>'$.source' AS source FROM scholar_leads",
    "search_coverage": "SELECT query_id, count(*) AS fetched, count(DISTINCT page_no) AS pages, round(count(*) / (SELECT count(*) FROM articles), 6) AS share FROM articles GROUP BY query_id",
    "dedupe_groups": _GROUPS + " SELECT rid, first_rid FROM grp",
    "dedupe_records": _GROUPS + """, m AS (SELECT first_rid, arg_min(rid, (CASE WHEN origin = 'pubmed' THEN 0 ELSE 1 END, rid)) AS survivor, min(doi) AS any_doi, min(pmid) AS any_pmid, count(*) AS n_copies,
  string_agg(DISTINCT query_id, '|' ORDER BY query_id) AS provenance, string_agg(DISTINCT origin, '|' ORDER BY origin) AS origins, CASE WHEN count(*) FILTER (origin = 'pubmed') > 0 THEN 0 ELSE 1 END AS needs_manual_metadata FROM ren JOIN grp USING (rid) GROUP BY first_rid)
SELECT m.first_rid, survivor, coalesce(r.doi, any_doi) AS doi, coalesce(r.pmid, any_pmid) AS pmid, n_copies, coalesce(provenance, '') AS provenance, origins, needs_manual_metadata FROM m JOIN ren r ON r.rid = survivor""",
    "dedupe_title": f"WITH {_RECORDS} SELECT nt AS t, min(rid) AS survivor, count(*) AS n_copies FROM ren WHERE nt IS NOT NULL GROUP BY nt",
    "screen_three_way": _SCREEN + " SELECT rid, verdict, rule_id FROM one",
    "screen_rules": _SCREEN + " SELECT rule_id, count(*) AS n FROM hit GROUP BY rule_id",
    "screen_partition_check": _SCREEN + " SELECT count(*) FILTER (verdict = 'included') AS included, count(*) FILTER (verdict = 'excluded') AS excluded, count(*) FILTER (verdict = 'uncertain') AS uncertain, count(*) FILTER (verdict IS NULL) AS unassigned, count(*) AS total, (SELECT count(*) FROM (SELECT rid FROM one GROUP BY rid HAVING count(DISTINCT verdict) > 1)) AS overlapping FROM one",
    "decision_overlay": _DECIDED + "SELECT s.doc_id, coalesce(d.v, s.v) AS verdict, coalesce(d.r, s.r) AS rule_id, CASE WHEN d.v IS NULL THEN 0 ELSE 1 END AS decided FROM s LEFT JOIN d USING (doc_id)",
    "decision_amendments": _DECIDED + "SELECT s.r AS rule_id, d.v AS decision, count(DISTINCT doc_id) AS n, string_agg(DISTINCT e.subject_id, '|' ORDER BY e.subject_id) AS reasons FROM s JOIN d USING (doc_id) JOIN subject_examples e USING (doc_id) WHERE s.r IS NOT NULL GROUP BY ALL",
    "term_scoring": f"WITH {_scored(DOMAINS, 1)} SELECT rid, label_id, score FROM sc",
    "publication_domains": _DOMS + " SELECT rid, domain_id, score, is_primary FROM dom",
    "primary_domain": _DOMS + " SELECT domain_id, count(*) AS records FROM dom WHERE is_primary = 1 GROUP BY domain_id",
    "research_types": f"WITH {_scored(RESEARCH_TYPES, 3)} SELECT rid, label_id AS type_id, score FROM sc",
    "summary_research_type_year": f"WITH {_scored(RESEARCH_TYPES, 3)} SELECT label AS type_label, year, count(*) AS publications FROM sc JOIN (SELECT DISTINCT label_id, label FROM terms) USING (label_id) JOIN art USING (rid) GROUP BY ALL",
    "subdomain_vocabulary": _VOCAB + " SELECT domain_id, mesh_term, frequency, rank FROM voc",
    "display_label_overlay": _VOCAB + " SELECT domain_id, mesh_term, rank, display_label FROM lab",
    "subdomain_assignment": _VOCAB + " SELECT rid, domain_id, subdomain_mesh, subdomain, vocabulary_rank FROM asg",
    "summary_subdomain_year": _VOCAB + f" SELECT d.domain_id, coalesce(subdomain, {_q(OTHER)}) AS subdomain_label, year, count(*) AS publications FROM dom d JOIN art USING (rid) LEFT JOIN asg USING (rid, domain_id) WHERE is_primary = 1 GROUP BY ALL",
    "author_affiliations": f"WITH {_AFF} SELECT * FROM aff",
    "publication_authors": f"WITH {_AFF} SELECT * FROM pau",
    "publication_institutions": f"WITH {_AFF} SELECT DISTINCT uid, institution AS institution_id, country, region, sector FROM aff WHERE institution IS NOT NULL",
    "publication_countries": f"WITH {_AFF} SELECT uid, country, min(region) AS region, min(iso3) AS iso3 FROM aff WHERE country IS NOT NULL GROUP BY uid, country",
    "led_and_international": f"WITH {_AFF} SELECT uid, led::INT AS led, (n_countries > 1)::INT AS international, n_authors FROM led",
    "publications": _PUBS + f""" SELECT uid, title, year, journal, d.domain_id AS primary_domain, coalesce(subdomain, {_q(OTHER)}) AS primary_subdomain, singapore_led, n_authors, n_countries
FROM ful JOIN dom d ON d.rid = ful.rid AND d.is_primary = 1 LEFT JOIN asg ON asg.rid = d.rid AND asg.domain_id = d.domain_id""",
    "summary_by_domain_year": _PUBS + f" SELECT domain_id, {_LABEL_OF} AS domain_label, year, count(*) AS publications, sum(singapore_led)::BIGINT AS singapore_led, count(*) FILTER (n_countries > 1) AS international FROM dom JOIN ful USING (rid) GROUP BY ALL",
    "summary_top_authors": _TOP + " SELECT * FROM top",
    "top_authors_per_domain": _TOP + " SELECT *, row_number() OVER (PARTITION BY domain_id ORDER BY n_publications DESC, author_key) AS rank FROM top QUALIFY rank <= 10",
    "coauthor_institution_edges": _E_INST + " SELECT layer, source, target, weight FROM edg",
    "coauthor_author_edges": _E_AUTH + " SELECT layer || '::' || source || '::' || target AS edge_id, layer AS domain, source, target, weight FROM edg WHERE layer <> 'ALL'",
    "coauthor_country_edges": _E_CTY + " SELECT layer, source, target, weight FROM edg",
    "network_institution_nodes": _E_INST + " SELECT d.node_id, label, country, region, sector, iso3, is_singapore, d.degree, d.weighted_degree, d.n_publications FROM deg d LEFT JOIN network_institution_nodes n USING (node_id)",
    "network_author_nodes": _E_AUTH + ", kept AS (SELECT * FROM deg ORDER BY weighted_degree DESC, node_id LIMIT 250) SELECT k.node_id, count(o.node_id) AS degree, any_value(k.weighted_degree) AS weighted_degree, any_value(k.n_publications) AS n_publications FROM kept k LEFT JOIN two t ON t.node_id = k.node_id LEFT JOIN kept o ON o.node_id = t.other GROUP BY k.node_id",
    "network_country_nodes": _E_CTY + " SELECT node_id, degree, weighted_degree, n_publications FROM deg",
    "network_institution_paths": _E_INST + ", p AS (SELECT layer || '::' || source || '::' || target AS edge_id, layer, unnest([source, target]) AS node_id FROM edg WHERE source IN (SELECT node_id FROM network_institution_nodes) AND target IN (SELECT node_id FROM network_institution_nodes)) SELECT edge_id, layer, node_id, x, y FROM p JOIN network_institution_nodes USING (node_id)",
    "author_attributes": f"""WITH {_AFF} SELECT author_key AS node_id, label, ic AS country, ir AS region, sector, iso3, CASE WHEN lower(ic) = 'singapore' THEN 1 ELSE 0 END AS is_singapore
FROM lab_ LEFT JOIN mod_ USING (author_key) LEFT JOIN iat USING (institution) LEFT JOIN cat ON cat.country = ic""",
    "author_labels": f"WITH {_AFF} SELECT author_key, label FROM lab_",
    "referential_integrity": """SELECT 'publication' AS link, count(*) AS orphans FROM publication_authors a WHERE uid IS NOT NULL AND uid NOT IN (SELECT uid FROM publications)
UNION ALL SELECT 'author', count(*) FROM publication_authors WHERE author_key IS NOT NULL AND author_key NOT IN (SELECT node_id FROM network_author_nodes)
UNION ALL SELECT 'institution', count(*) FROM publication_authors WHERE institution_id IS NOT NULL AND institution_id NOT IN (SELECT node_id FROM network_institution_nodes)""",
    "semi_membership": "SELECT primary_domain, count(*) AS publications FROM publications WHERE uid IN (SELECT uid FROM publication_authors WHERE institution_id IS NOT NULL) GROUP BY primary_domain",
    "uniqueness_checks": " UNION ALL ".join(f"SELECT '{t}.{c}' AS key, count({c}) AS n, count(DISTINCT {c}) AS distinct_n FROM {t}" for t, c in (("articles", "rec_id"), ("scholar_leads", "lead_id"), ("publications", "uid"), ("network_author_nodes", "node_id"), ("network_institution_nodes", "node_id"), ("documents", "doc_id"))),
    "node_consistency": "WITH b AS (SELECT institution_id AS node_id, count(DISTINCT uid) AS counted FROM publication_authors WHERE institution_id IS NOT NULL GROUP BY ALL) SELECT node_id, n_publications::BIGINT AS stored, counted FROM network_institution_nodes FULL JOIN b USING (node_id) WHERE n_publications IS DISTINCT FROM counted",
    "path_pairs": _E_INST + ", p AS (SELECT layer || '::' || source || '::' || target AS edge_id, unnest([source, target]) AS node_id FROM edg), q AS (SELECT edge_id, count(*) AS rows FROM p JOIN network_institution_nodes USING (node_id) GROUP BY edge_id) SELECT rows, count(*) AS edges FROM q WHERE edge_id IN (SELECT layer || '::' || source || '::' || target FROM edg WHERE source IN (SELECT node_id FROM network_institution_nodes) AND target IN (SELECT node_id FROM network_institution_nodes)) GROUP BY rows",
    "author_slug": _SLUG + " SELECT * FROM sl",
    "token_df": f"WITH t AS (SELECT unnest(list_distinct({_TOKENS.format('text')})) AS token FROM documents) SELECT token, count(*) AS df FROM t GROUP BY token HAVING count(*) >= 5",
    "tfidf_top_terms": f"""WITH t AS (SELECT journal.title AS journal, unnest({_TOKENS.format("concat_ws(' ', title, abstract)")}) AS term FROM articles WHERE journal.title IS NOT NULL),
tf AS (SELECT journal, term, count(*) AS tf FROM t GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL), n AS (SELECT count(DISTINCT journal.title)::DOUBLE AS n FROM articles WHERE journal.title IS NOT NULL),
w AS (SELECT journal, term, row_number() OVER (PARTITION BY journal ORDER BY round(tf * ln(1 + n / df), 6) DESC, term) AS r FROM tf JOIN df USING (term), n)
SELECT journal, string_agg(term, ', ' ORDER BY r) FILTER (r <= 8) AS top_terms, string_agg(term, ', ' ORDER BY r) FILTER (r <= 4) AS label FROM w GROUP BY journal""",
    "topic_centroids": "SELECT label, (i - 1)::INT AS dim, round(avg(embedding[i]::DOUBLE), 6) AS mean, count(*) AS n FROM embeddings, unnest(range(1, len(embedding) + 1)) r(i) GROUP BY ALL",
    "nearest_centroid": """WITH e AS (SELECT vec_id, label, i, embedding[i]::DOUBLE AS v FROM embeddings, unnest(range(1, len(embedding) + 1)) r(i)), c AS (SELECT label AS c, i, avg(v) AS m FROM e GROUP BY ALL),
d AS (SELECT vec_id, label, c, round(sqrt(sum((v - m) ** 2)), 9) AS d FROM e JOIN c USING (i) GROUP BY ALL)
SELECT vec_id, arg_min(c, (d, c)) AS nearest, CASE WHEN arg_min(c, (d, c)) = label THEN 1 ELSE 0 END AS own FROM d GROUP BY vec_id, label""",
    "minmax_coords": "SELECT node_id, round((degree - min(degree) OVER ()) / nullif(max(degree) OVER () - min(degree) OVER (), 0)::DOUBLE, 6) AS x, round((weighted_degree - min(weighted_degree) OVER ()) / nullif(max(weighted_degree) OVER () - min(weighted_degree) OVER (), 0)::DOUBLE, 6) AS y FROM network_author_nodes",
    "roster_upsert": """SELECT coalesce(o.k, n.k) AS profile_url, coalesce(n.name, o.name) AS name, coalesce(o.notes, n.notes) AS notes
FROM (SELECT c_custkey AS k, 'old ' || c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS notes FROM customer WHERE c_custkey % 3 <> 0) o
FULL JOIN (SELECT c_custkey AS k, c_name AS name, 'fetched' AS notes FROM customer WHERE c_custkey % 3 <> 1) n ON o.k = n.k""",
    "events_by_hour": _HOURS,
    "events_by_hour_streamed": _HOURS,
    "event_sessions": """WITH e AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, k""",
    "region_rollup": "SELECT coalesce(r_name, 'ALL') AS region, coalesce(n_name, 'ALL') AS nation, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)",
}
