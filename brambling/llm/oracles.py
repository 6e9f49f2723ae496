"""The same results in SQL, where SQL can state them."""

_TITLES = """
WITH t AS (SELECT rec_id AS id, title FROM articles UNION ALL SELECT lead_id, title FROM scholar_leads),
k AS (SELECT id, regexp_replace(lower(nfc_normalize(translate(title, '０１２３４５６７８９', '0123456789'))), '[^\\p{L}\\p{N}\\p{M}]', '', 'g') AS k FROM t WHERE title IS NOT NULL),
g AS (SELECT id, min(id) OVER (PARTITION BY k) AS first_id, count(*) OVER (PARTITION BY k) AS n_copies FROM k WHERE k <> '')
"""

_PAIRS = """
WITH x AS (
  SELECT DISTINCT 'author' AS kind, uid, author_key AS k FROM publication_authors WHERE author_key IS NOT NULL AND uid IS NOT NULL
  UNION ALL SELECT DISTINCT 'institution', uid, institution_id FROM publication_authors WHERE institution_id IS NOT NULL AND uid IS NOT NULL),
m AS (SELECT count(DISTINCT uid) AS n_all FROM publication_authors),
f AS (SELECT kind, k, count(*) AS n FROM x GROUP BY ALL),
p AS (SELECT a.kind, a.k AS item_a, b.k AS item_b, count(*) AS n_ab FROM x a JOIN x b ON a.kind = b.kind AND a.uid = b.uid AND a.k < b.k GROUP BY ALL HAVING count(*) >= 5),
r AS (SELECT p.*, fa.n AS n_a, fb.n AS n_b, n_all, n_ab::DOUBLE * n_all / (fa.n::DOUBLE * fb.n) AS lift FROM p, m, f fa, f fb
  WHERE fa.kind = p.kind AND fa.k = item_a AND fb.kind = p.kind AND fb.k = item_b AND n_ab * n_all >= 4 * fa.n * fb.n)
"""

_WORKS = """
WITH RECURSIVE a AS (
  SELECT rec_id, fetched_at, mesh_terms, abstract, nullif(trim(identifiers.pmid), '') AS pmid,
    regexp_replace(regexp_replace(lower(doi), '^\\s+|\\s+$', '', 'g'), '^((https?://)?(dx\\.)?doi\\.[a-z.]+/|https?://[^/\\s]+/|doi:\\s*)+', '') AS d FROM articles),
b AS (SELECT rec_id, fetched_at, pmid, CASE WHEN regexp_matches(d, '^10\\.[^/\\s]+/\\S') THEN d END AS doi,
    CASE WHEN abstract IS NULL OR regexp_matches(trim(regexp_replace(lower(abstract), '[^\\p{L}\\p{N}]+', ' ', 'g')), '^(n a|na|none|no abstract|(no )?abstract (is )?(not )?(available|unavailable|provided|missing)( .*)?)$') THEN 0
      ELSE length(regexp_replace(abstract, '\\s+', '', 'g')) END AS na,
    coalesce(len(list_distinct(list_filter(list_transform(mesh_terms, lambda t: lower(regexp_replace(t, '^\\s+|\\s+$', '', 'g'))), lambda t: t IS NOT NULL AND t <> ''))), 0) AS nm FROM a),
keys AS (SELECT rec_id, 'd' || doi AS k FROM b WHERE doi IS NOT NULL UNION ALL SELECT rec_id, 'p' || pmid FROM b WHERE pmid IS NOT NULL),
edges AS (SELECT DISTINCT x.rec_id AS u, y.rec_id AS v FROM keys x JOIN keys y USING (k)),
walk AS (SELECT DISTINCT rec_id AS u, rec_id AS r FROM keys UNION SELECT e.v, w.r FROM walk w JOIN edges e ON e.u = w.u),
grp AS (SELECT u AS rec_id, min(r) AS g FROM walk GROUP BY u),
big AS (SELECT g FROM grp GROUP BY g HAVING count(*) > 1)
"""

# the three fields of each row of a work with several, and their claims by source
_CLAIMS = """,
l AS (SELECT g, r.rec_id, r.fetched_at, coalesce(a.query_id, '') AS source, f.field, CASE f.field WHEN 0 THEN r.doi WHEN 1 THEN CASE WHEN r.na > 0 THEN md5(a.abstract) END
    ELSE CASE WHEN r.nm > 0 THEN md5(array_to_string(list_sort(list_distinct(list_filter(list_transform(a.mesh_terms, lambda t: lower(regexp_replace(t, '^\\s+|\\s+$', '', 'g'))), lambda t: t IS NOT NULL AND t <> ''))), '|')) END END AS value
  FROM grp JOIN big USING (g) JOIN b r USING (rec_id) JOIN articles a USING (rec_id), (VALUES (0), (1), (2)) f(field)),
c AS (SELECT g, field, value, source, count(*) AS n FROM l WHERE value IS NOT NULL GROUP BY ALL),
w0 AS (SELECT DISTINCT source, 1.0::DOUBLE AS w FROM c)"""


def _rounds(n: int) -> str:
    """Votes by reliability and reliability by votes in turn, `n` times; v is the votes of the last reliability."""
    votes = "SELECT g, field, value, sum(n * w) AS vote FROM c JOIN w{} USING (source) GROUP BY ALL"
    out = ""
    for i in range(n):
        out += f""",
v{i} AS ({votes.format(i)}),
t{i} AS (SELECT g, field, arg_max(value, (vote, value)) AS truth FROM v{i} GROUP BY g, field),
w{i + 1} AS (SELECT source, round(-ln((coalesce(sum(n) FILTER (value <> truth), 0) + 1) / (sum(n) + 2)::DOUBLE), 9) AS w FROM c JOIN t{i} USING (g, field) GROUP BY source)"""
    return out + f",\nv AS ({votes.format(n)})"


_BY_VOTES = """,
k AS (SELECT g, field, value, arg_max(rec_id, (fetched_at, rec_id)) AS id, max(fetched_at) AS latest FROM l GROUP BY ALL),
s AS (SELECT k.g, k.field, k.value, id, row_number() OVER (PARTITION BY k.g, k.field ORDER BY k.value IS NOT NULL DESC, round(coalesce(vote, 0), 6) DESC, latest DESC, id DESC) AS r
  FROM k LEFT JOIN v ON v.g = k.g AND v.field = k.field AND v.value = k.value),
m AS (SELECT g, count(DISTINCT rec_id) AS n_rows FROM l GROUP BY g)
SELECT m.g AS first_rec_id, n_rows, max(value) FILTER (field = 0) AS doi, max(id) FILTER (field = 1) AS abstract_rec_id, max(id) FILTER (field = 2) AS mesh_rec_id FROM m JOIN s USING (g) WHERE r = 1 GROUP BY ALL"""

ORACLES = {
    "p4_by_votes": _WORKS + _CLAIMS + _rounds(8) + _BY_VOTES,
    "p9_shares_check": "SELECT source, 1 AS cap_kept, 1 AS share_reached, 1 AS mixture_agrees FROM mix_targets WHERE source IS NOT NULL GROUP BY source",
    "p1_found": _TITLES + "SELECT DISTINCT first_id, id AS copy_id FROM g WHERE id <> first_id",
    "p1_copies": _TITLES + "SELECT DISTINCT first_id, n_copies FROM g",
    "p4_found": _WORKS + """SELECT g AS first_rec_id, max(doi) AS doi, arg_max(rec_id, (na, fetched_at, rec_id)) AS abstract_rec_id, arg_max(rec_id, (nm, fetched_at, rec_id)) AS mesh_rec_id
FROM grp JOIN big USING (g) JOIN b USING (rec_id) GROUP BY g""",
    "p6_found": _PAIRS + "SELECT kind, item_a, item_b FROM r",
    "p6_pairs": _PAIRS + "SELECT kind, item_a, item_b, n_ab, n_a, n_b, n_all, lift FROM r",
}
