"""Every query with SQL gives DuckDB's rows on the same tables."""

import glob
import math
import os

import pytest

import __spark_entry__
from meridian.queries import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(value):
    if isinstance(value, (list, tuple)) or type(value).__name__ == "ndarray":
        return tuple(plain(v) for v in value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name in SQL:
        found = duck.sql(SQL[name])
        at = {c: k for k, c in enumerate(found.columns)}
        assert sorted(at) == columns
        assert ours == sorted(tuple(plain(r[at[c]]) for c in columns) for r in found.fetchall())


def test_registry():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and set(QUERIES) <= set(queries)
