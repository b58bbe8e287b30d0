"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

from tidemark.queries import QUERIES, SQL  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    rows = duck.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({SQL[name]})").fetchall()
    assert got == sorted((tuple(map(plain, r)) for r in rows), key=repr)
