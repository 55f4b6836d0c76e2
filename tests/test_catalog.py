import math

import duckdb
import pytest

import __spark_entry__
from aerostrata.plans import ORACLE_SQL, QUERIES

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{D}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float) or hasattr(v, "as_tuple"):
        return "nan" if math.isnan(v) else float(f"{float(v):.9g}")
    return v if isinstance(v, (int, str)) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, D)
    cols = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    if name not in ORACLE_SQL:
        assert rows
        return
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(QUERIES) <= set(__spark_entry__.queries())
