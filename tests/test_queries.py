"""Every registered query with SQL gives the rows that the SQL gives, on the smallest tables."""

import math
import os

import duckdb
import pytest

from quern.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def same(x, y):
    return math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) if isinstance(x, float) and isinstance(y, float) else x == y


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    if name not in registry.oracle_sql():
        assert got
        return
    rel = con.sql(registry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    expected = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
    assert len(got) == len(expected)
    assert all(same(x, y) for a, b in zip(got, expected, strict=True) for x, y in zip(a, b, strict=True))


def test_entry_imports(spark):
    import __spark_entry__

    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
    assert os.path.exists(__spark_entry__.__file__)
