"""Registered queries against their SQL on the smallest driver tables."""

import os

import duckdb
import pytest

from korbwerk.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name in registry.ORACLE_SQL:
        result = duck.execute(registry.ORACLE_SQL[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        assert rows == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=str)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["source", "n_before", "n_after", "n_removed"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
