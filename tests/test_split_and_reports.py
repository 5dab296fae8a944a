import pytest
from pyspark.sql import functions as F

from cartulary.operators import render, reports, split
from cartulary.operators.split import Ratios


def records(spark, rows):
    return spark.createDataFrame(rows, "dataset string, subject string, modality string")


def sizes(df):
    return {r.split: r["count"] for r in df.groupBy("split").count().collect()}


@pytest.mark.parametrize(("n", "expected"), [(10, {"train": 8, "val": 1, "test": 1}), (7, {"train": 5, "test": 2}), (1, {"test": 1})])
def test_sizes(spark, n, expected):
    assert sizes(split.assign_splits(records(spark, [("d", f"s{i}", "t1w") for i in range(n)]))) == expected


def test_case_and_sessions(spark):
    rows = records(spark, [("d", "S1", "t1w"), ("d", "s1", "t1w"), ("d", "s2", "t1w")])
    out = split.label_records(rows, split.assign_splits(rows))
    assert out.count() == 3 and out.where("lower(subject) = 's1'").select("split").distinct().count() == 1
    assert tuple(split.check_splits(rows, out).first()) == (0, 0, 3, 3)


def test_rarest_first(spark):
    rows = [("d", f"s{i}", "t1w") for i in range(20)] + [("d", f"s{i}", "flair") for i in range(10)]
    out = split.assign_splits(records(spark, rows))
    assert {(r.stratum, r["count"]) for r in out.groupBy("stratum").count().collect()} == {("flair", 10), ("t1w", 10)}


def test_same_for_any_partitioning(spark):
    rows = records(spark, [("d", f"s{i}", f"m{i % 3}") for i in range(50)])
    a = sorted(map(tuple, split.assign_splits(rows.repartition(7)).collect()))
    assert a == sorted(map(tuple, split.assign_splits(rows.coalesce(1)).collect()))


def test_two_pools(spark):
    df = spark.createDataFrame([(f"training-{i}", "training") for i in range(8)] + [(f"validation-{i}", "validation") for i in range(2)], "subject string, pool string")
    assert sizes(split.assign_two_pools(df)) == {"train": 8, "val": 1, "test": 1}
    with pytest.raises(ValueError, match="validation pool"):
        split.assign_two_pools(df, Ratios(0.5, 0.1, 0.4))
    with pytest.raises(ValueError, match="neither"):
        split.assign_two_pools(df.withColumn("pool", F.lit("other")))
    with pytest.raises(ValueError, match="add up"):
        Ratios(0.5, 0.3, 0.1)


def test_distribution(spark):
    rows = records(spark, [("d", f"s{i}", m) for i in range(10) for m in ("t1w", "seg")])
    got = {r.modality: r for r in split.distribution_table(split.label_records(rows, split.assign_splits(rows))).collect()}
    assert set(got) == {"t1w", "All"} and got["All"].total == got["t1w"].total == 10 and got["All"].share == 100.0


@pytest.mark.parametrize(("age", "bin_"), [(0.0, 0), (5.0, 0), (5.1, 1), (100.0, 19), (110.0, 19), (22.5, 4)])
def test_bins(spark, age, bin_):
    assert spark.range(1).select(reports.nearest_bin(F.lit(age)).alias("b")).first().b == bin_


def test_bins_keep_zeros_and_median(spark):
    df = spark.createDataFrame([(1.0, "f"), (6.0, "m"), (7.0, "f"), (11.0, "m"), (None, "m")], "age double, sex string")
    rows = reports.binned(df, "age", "sex", ["m", "f"]).orderBy("bin").collect()
    assert len(rows) == 20 and [(r.n_m, r.n_f) for r in rows[:4]] == [(0, 1), (1, 1), (1, 0), (0, 0)]
    assert reports.median_bin(df, "age").first().median_bin == 1


def test_spread_is_of_the_population(spark):
    r = reports.mean_and_spread(spark.createDataFrame([(1.0,), (3.0,)], "x double"), "x").first()
    assert (r["mean"], r["std"]) == (2.0, 1.0)


def test_unlisted_category_counts(spark):
    df = spark.createDataFrame([("1",), ("6",), ("",), (None,)], "race string")
    assert {(r.category, r.pct) for r in reports.category_shares(df, "race").collect()} == {("1", 50.0), ("6", 50.0)}


def test_several_citations_raise(spark):
    with pytest.raises(Exception, match="more than one"):
        spark.range(1).select(render.citation_key(F.lit("@a{x, } @b{y, }")).alias("k")).collect()


def test_empty_tables(spark):
    empty = records(spark, [])
    assert split.assign_splits(empty).count() == 0
    assert reports.median_bin(spark.createDataFrame([], "age double"), "age").first().median_bin is None
