"""Functions over rows whose failures stay rows."""

import pytest

from cartulary.operators.parallel import failures, map_rows, succeeded


def halve(row):
    if row["k"] % 5 == 0:
        raise KeyError(row["name"])
    return {"half": row["k"] // 2 if row["k"] % 2 == 0 else [][1], "name2": row["name"] * 2}


def test_results_and_errors(spark):
    df = spark.range(1300).selectExpr("id as k", "concat('n', id) as name", "array(id) as more", "cast(null as int) as result").repartition(3)
    out = map_rows(df, halve, "half bigint, name2 string")
    assert out.columns == ["row", "result", "error"] and out.count() == 1300
    good = {r.k: (r.half, r.name2) for r in succeeded(out).drop("result").collect()}
    assert good == {k: (k // 2, f"n{k}n{k}") for k in range(1300) if k % 5 and k % 2 == 0}
    bad = {r.k: r.error for r in failures(out).collect()}
    assert bad == {k: f"KeyError: 'n{k}'" if k % 5 == 0 else "IndexError: list index out of range" for k in range(1300) if k % 5 == 0 or k % 2}


@pytest.mark.parametrize("work", [halve, lambda row: {"half": None, "name2": None}])
def test_no_rows_and_nulls(spark, work):
    df = spark.range(4).selectExpr("id + 1 as k", "cast(null as string) as name").where("k = 2")
    assert map_rows(df.limit(0), work, "half bigint, name2 string").isEmpty()
    told = map_rows(df, work, "half bigint, name2 string").first()
    assert (told.error is None) == (work is not halve)
