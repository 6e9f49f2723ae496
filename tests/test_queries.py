"""Every query outside the llm subpackage against its SQL at sf0.001, and the contract without that subpackage."""

import math
import os
import subprocess
import sys

import pytest

from brambling.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def db():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(name, spark, db):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in catalogue.ORACLES:
        return
    r = db.execute(catalogue.ORACLES[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    assert got == sorted((tuple(norm(x[names.index(c)]) for c in cols) for x in r.fetchall()), key=repr)


def test_nearest_centroid_over_all_dimensions(spark):
    """Against numpy, over all components of each vector."""
    import numpy as np

    rows = catalogue.QUERIES["topic_centroids"](spark, SF).select("label").distinct().collect()
    e = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x, own = np.array([r["embedding"] for r in e], dtype=np.float64), np.array([r["label"] for r in e])
    labels = sorted(r["label"] for r in rows)
    c = np.array([x[own == n].mean(0) for n in labels])
    near = np.round(np.linalg.norm(x[:, None] - c[None], axis=2), 9).argmin(1)
    got = {r["vec_id"]: (r["nearest"], r["own"]) for r in catalogue.QUERIES["nearest_centroid"](spark, SF).collect()}
    assert got == {r["vec_id"]: (labels[k], int(labels[k] == r["label"])) for r, k in zip(e, near, strict=True)}


def test_oracles_have_queries():
    assert catalogue.ORACLES.keys() <= catalogue.QUERIES.keys()


def test_entry_without_llm(tmp_path):
    """The contract's module works where the llm subpackage is gone."""
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/brambling", tmp_path / "brambling", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'p5_found' in q and 'p1_found' not in q and o.keys() <= q.keys()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": ""})
