"""Every registered query with SQL against DuckDB on the smallest driver tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

from lexmesh.plans import catalog, norms, outputs  # noqa: F401

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if hasattr(x, "isoformat"):
        return str(x)[:26]
    return round(x, 6) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, db, name):
    got = catalog.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    ran = db.execute(catalog.ORACLES[name])
    names = [d[0] for d in ran.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = Counter(tuple(plain(r[i]) for i in at) for r in ran.fetchall())
    assert Counter(tuple(plain(r[c]) for c in cols) for r in got.collect()) == want


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())
