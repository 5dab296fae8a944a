"""Every query with SQL gives the rows that DuckDB gives."""

import math
import os

import pytest

from cartulary.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def plain(rows, columns):
    cell = lambda v: "" if v is None else f"{v:.9g}" if isinstance(v, float) and math.isfinite(v) else str(v)
    return sorted(tuple(cell(r[c]) for c in columns) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    rows = [r.asDict() for r in df.collect()]
    if name not in catalogue.oracle_sql():
        assert rows
        return
    rel = duck.sql(catalogue.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(df.columns)
    expected = [dict(zip(rel.columns, r, strict=True)) for r in rel.fetchall()]
    assert plain(rows, sorted(df.columns)) == plain(expected, sorted(df.columns))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
