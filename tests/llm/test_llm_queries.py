"""The queries of this subpackage at sf0.001: columns, no repeated rows, and their SQL where there is one."""

import os

import pytest

from brambling.llm.oracles import ORACLES
from brambling.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

COLUMNS = {
    "p1_found": [("first_id", "bigint"), ("copy_id", "bigint")],
    "p2_found": [("name_a", "string"), ("name_b", "string")],
    "p3_found": [("rec_id", "bigint"), ("author_no", "int"), ("affiliation_no", "int"), ("node_id", "string")],
    "p4_found": [("first_rec_id", "bigint"), ("doi", "string"), ("abstract_rec_id", "bigint"), ("mesh_rec_id", "bigint")],
    "p6_found": [("kind", "string"), ("item_a", "string"), ("item_b", "string")],
    "p8_ids": [("doc_id", "bigint"), ("ids", "array<int>")],
    "p10_found": [("doc_id", "bigint"), ("subject_id", "string")],
}


@pytest.fixture(scope="module")
def db():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, db):
    df = QUERIES[name](spark, SF)
    assert df.dtypes == COLUMNS.get(name, df.dtypes)
    cols = sorted(df.columns)
    got = sorted((tuple(tuple(v) if isinstance(v, list) else v for v in (r[c] for c in cols)) for r in df.collect()), key=repr)
    assert len(got) == len(set(got))
    if name in ORACLES:
        r = db.execute(ORACLES[name])
        names = [d[0] for d in r.description]
        assert sorted(names) == cols
        assert [repr(x) for x in got] == sorted(repr(tuple(x[names.index(c)] for c in cols)) for x in r.fetchall())
