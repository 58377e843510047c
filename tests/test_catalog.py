"""Every query of the catalog against its oracle."""

import math

import duckdb
import pytest

import __spark_entry__
from millrace.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    return repr(round(float(v), 6)) if isinstance(v, (int, float)) else str(v)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_equals_oracle(spark, sf, duck, name):
    df = catalog.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(tuple(normal(r[c]) for c in columns) for r in df.collect())
    found = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted(tuple(normal(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert got == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["host", "n_links"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(catalog.oracle_sql()) == set(catalog.queries())
