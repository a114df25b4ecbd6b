"""Every registered query with SQL gives the SQL's rows on the smallest tables."""

import math
import os

import duckdb
import pytest

from millrace.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    return repr(float(value)) if isinstance(value, (int, float)) or hasattr(value, "quantize") else str(value)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = registry.queries()[name](spark, FOLDER)
    rows = duck.sql(registry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(rows.columns)
    place = [rows.columns.index(c) for c in columns]
    expected = sorted(tuple(normal(r[i]) for i in place) for r in rows.fetchall())
    assert sorted(tuple(normal(r[c]) for c in columns) for r in got.collect()) == expected


def test_names_are_unique():
    assert set(registry.oracle_sql()) <= set(registry.queries())
