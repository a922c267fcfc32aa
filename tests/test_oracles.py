"""Every query of the engine against its SQL on the driver's smallest tables."""

from __future__ import annotations

import math
import os

import pytest

from silkgrain.plans import catalog

duckdb = pytest.importorskip("duckdb")
DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables aren't here")


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 9) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DIR}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    ours = sorted((tuple(cell(r[k]) for k in cols) for r in df.collect()), key=repr)
    if name not in catalog.SQL:
        assert ours
        return
    q = db.execute(catalog.SQL[name])
    names = [x[0] for x in q.description]
    assert sorted(names) == cols
    at = [names.index(k) for k in cols]
    assert ours == sorted((tuple(cell(r[k]) for k in at) for r in q.fetchall()), key=repr)
