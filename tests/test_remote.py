"""The listing source: its lines against the column parser, byte ranges, filters and another store's lister."""

import datetime
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartulary.sources import remote
from cartulary.sources.listing import parse_remote_listing


class Toy(remote.Lister):
    """A store that notes what it is asked to list."""

    def prefixes(self):
        return ["a", "b", "c"]

    def parts(self, prefix):
        with open(f"{self.options['notes']}/{prefix}", "w") as f:
            f.write("listed")
        return [(1,), (2,)]

    def entries(self, prefix, part):
        yield pa.RecordBatch.from_pylist([{"prefix": prefix, "name": f"{part[0]}-{k}", "is_dir": False, "size": 10 * k, "modified": datetime.datetime(2024, 1, 1, k)} for k in range(5)], remote.SCHEMA)


def lines_of(r, n):
    out = []
    for k in range(n):
        name = "  ".join(r.choice(["a", "bb", "é", "PREfix" if r.random() < 0.1 else "x", "y.nii.gz"]) for _ in range(r.randint(1, 3)))
        out.append(r.choice([f"      PRE {name}/", f"2023-01-{1 + k % 28:02d} 10:00:00  {k} {name}", f"2023-01-01 10:00:00 {k}", "", "odd"]))
    return out


@pytest.mark.parametrize("step", [1, 7, 100, 1 << 20])
def test_lines_and_ranges(spark, tmp_path, step):
    remote.register(spark)
    r = random.Random(step)
    lines = {p: lines_of(r, 40) for p in ("s 1", "s/2", "z")}
    rows = [(p, x) for p, xs in lines.items() for x in xs]
    path = f"file://{tmp_path}/listing"
    spark.createDataFrame(rows, "prefix string, value string").repartition("prefix").write.partitionBy("prefix").text(path)
    got = sorted(tuple(x) for x in spark.read.format("listing").option("path", path).option("bytes", step).load().select("prefix", F.coalesce("name", F.lit("-")), "is_dir").collect())
    want = spark.createDataFrame([x for x in rows if x[1].strip()], "prefix string, value string").select("prefix", parse_remote_listing(F.col("value")).alias("r"))
    assert got == sorted(tuple(x) for x in want.select("prefix", F.coalesce("r.name", F.lit("-")), "r.is_dir").collect())


def test_filters_go_to_the_store(spark, tmp_path):
    remote.register(spark)
    toy = spark.read.format("listing").option("lister", "tests.test_remote:Toy").option("notes", str(tmp_path)).load()
    df = toy.where("prefix in ('b', 'zz') and size >= 20 and name like '2-%' and modified < timestamp_ntz'2024-01-01 04:00:00' and size % 20 = 0")
    assert [tuple(x)[:4] for x in df.collect()] == [("b", "2-2", False, 20)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["b"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "listing" in plan and plan.count("size") and "% 20" in plan
    reader = remote.ListingReader(Toy({"notes": str(tmp_path)}))
    from pyspark.sql.datasource import EqualTo, IsNull, Not

    odd = [Not(EqualTo(("prefix",), "a")), IsNull(("name",)), EqualTo(("x", "y"), 1)]
    assert list(reader.pushFilters([*odd, EqualTo(("prefix",), "c")])) == odd and {p.prefix for p in reader.partitions()} == {"c"}


@pytest.mark.parametrize("condition", ["prefix = 'a'", "prefix like 'b%'", "prefix is null", "name = '1-3' or size = 0", "name is not null and not is_dir", "size > 10 and size <= 30", "name <=> null", "name like '%-2'", "name like '%-%' and prefix <> 'a'", "prefix = 'none'"])
def test_filters_change_nothing(spark, tmp_path, condition):
    remote.register(spark)
    toy = spark.read.format("listing").option("lister", "tests.test_remote:Toy").option("notes", str(tmp_path)).load()
    plain = spark.createDataFrame(toy.collect(), toy.schema)
    assert sorted(map(tuple, toy.where(condition).collect())) == sorted(map(tuple, plain.where(condition).collect()))
