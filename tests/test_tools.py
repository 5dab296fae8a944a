"""Ranks, containment, volumes in space, inventories, the command line and named steps."""

import gzip
import json
import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartulary import cli
from cartulary.operators import joins, ranking, registry, render, steps  # noqa: F401  (steps register themselves)
from cartulary.operators.validate import HeaderRules, validate_headers
from cartulary.plans import base
from cartulary.sources import listing, nifti, tables


def test_ranks_are_those_of_one_window(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("g"), F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("k"), (F.col("id") % 1999).cast("string").alias("s"), F.col("id").alias("part"))
    out = ranking.rank_by_digest(df, ["g", "k"], F.md5("s"), ["s", "part"], "_rn", "_n")
    by = Window.partitionBy("g", "k")
    want = df.select("*", F.row_number().over(by.orderBy(F.md5("s"), "s", "part")).cast("bigint").alias("_rn"), F.count("*").over(by).alias("_n"))
    assert out.columns == want.columns and out.exceptAll(want).count() == want.exceptAll(out).count() == 0


def test_numbered_lines(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k")).repartition(5)
    got = ranking.numbered_lines(df, ["k"], F.col("k").cast("string"), 3).collect()
    assert sorted((r.line_no, int(r.line)) for r in got) == [(k + 3, k) for k in range(1000)]
    assert render.markdown_lines(df.limit(0), ["k"]).count() == 2


def test_ranks_of_a_whole_table(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 5 > 0, (F.col("id") * 7919) % 3000).alias("k"), F.col("id").alias("at"), F.lit("x").alias("part"))
    order = [F.col("k").desc_nulls_last(), "at"]
    got = [(r.k, r.at, r.rank) for r in ranking.ranked(df.repartition(7), order).collect()]
    want = [(r.k, r.at, i + 1) for i, r in enumerate(df.orderBy(*order).collect())]
    assert sorted(got, key=lambda r: r[2]) == want
    assert ranking.ranked(df.limit(0), order, "place").columns == ["k", "at", "part", "place"] and ranking.ranked(df.limit(0), order).isEmpty()


def header(version: int, **told) -> bytes:
    size = {1: 348, 2: 540}[version]
    data = bytearray(size + 4)
    struct.pack_into("<i", data, 0, size)
    fields = {"dim": (3, 2, 3, 4, 1, 1, 1, 1), "intent": (0,), "datatype": (4,), "pixdim": (1, 2, 3, 4, 0, 0, 0, 0), "offset": (size + 4,), "slope": (1,), "inter": (0,), "units": (2,)} | told
    for k, v in fields.items():
        f, p = nifti.HEADERS[size][k]
        struct.pack_into("<" + f, data, p, *v)
    at, magic = nifti.MAGIC[size]
    data[at : at + 3] = magic[0]
    return bytes(data) + np.arange(24, dtype="<i2").tobytes()


@pytest.mark.parametrize("version", [1, 2])
def test_places_in_space(version):
    """A half turn about z, a quarter turn about x with a reflected axis, no form at all, and a sform before a qform."""
    half = nifti.parse_volume(header(version, qform=(1,), quatern=(0, 0, 1), qoffset=(5, 6, 7)))
    assert np.allclose(np.reshape(half["affine"], (4, 4)), [[-2, 0, 0, 5], [0, -3, 0, 6], [0, 0, 4, 7], [0, 0, 0, 1]]) and half["orientation"] == "LPS"
    quarter = nifti.parse_volume(header(version, qform=(2,), quatern=(math.sqrt(0.5), 0, 0), pixdim=(-1, 1, 1, 2, 0, 0, 0, 0)))
    assert np.allclose(np.reshape(quarter["affine"], (4, 4))[:3, :3], [[1, 0, 0], [0, 0, 2], [0, 1, 0]], atol=1e-6)
    none = nifti.parse_volume(header(version))
    assert np.allclose(np.reshape(none["affine"], (4, 4)), [[-2, 0, 0, 1], [0, 3, 0, -3], [0, 0, 4, -6], [0, 0, 0, 1]]) and none["orientation"] == "LAS"
    both = nifti.parse_volume(header(version, qform=(1,), sform=(1,), quatern=(0, 0, 1), srow=(1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0)))
    assert both["orientation"] == "RAS" and (both["vmin"], both["vmax"], both["nonzero"], both["shape"]) == (0, 23, 23, [2, 3, 4])
    assert (both["sform_code"], both["qform_code"], both["xyzt_units"], both["datatype"]) == (1, 1, 2, 4)


def test_a_turned_file_fails_the_orientation(spark, tmp_path):
    (tmp_path / "t.nii.gz").write_bytes(gzip.compress(header(2, qform=(1,), quatern=(0, 0, 1))))
    (tmp_path / "u.nii").write_bytes(header(1)[:200])
    rules = HeaderRules(least_shape=(2, 2, 2), most_voxel=(9, 9, 9), form_code=None, orientation="RAS", mean=None)
    got = {r.path[-8:]: r.errors for r in validate_headers(nifti.read_headers(spark, f"file://{tmp_path}"), rules).collect()}
    assert sorted(map(str, got.values())) == ["['load']", "['orientation']"]


def test_inventory(spark, tmp_path):
    for name in ("keep/a/x.img", "keep/a/x.txt", "keep/y.img", "other/x.img", "top.img", "top.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x" * 3)
    names = lambda globs, **k: sorted(r.path for r in listing.inventory(spark, f"file://{tmp_path}", globs, **k).collect())
    assert names(["keep/*.img", "top*"]) == ["keep/a/x.img", "keep/y.img", "top.img", "top.txt"]
    assert names(["k[a-e]*/y.img"]) == ["keep/y.img"]
    assert names(["none/*"]) == names([]) == names(["keep/*"], verify=False) == []
    with pytest.raises(Exception, match="nowhere"):
        listing.inventory(spark, f"file://{tmp_path}/nowhere", ["*"])


def test_infos(spark, tmp_path):
    for name, text in (("a", "title: A\nyear: 2020\nnote:\n"), ("b", "- 1\n- 2\n"), ("c", "x: [")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "info.yaml").write_text(text)
    datasets = spark.createDataFrame([(x,) for x in "abcd"], "dataset string")
    got = {r.dataset: r.info for r in datasets.join(tables.read_infos(spark, f"file://{tmp_path}"), "dataset", "left").collect()}
    assert got == {"a": {"title": "A", "year": "2020", "note": ""}, "b": {}, "c": {}, "d": None}


def test_split_on_the_command_line(spark, tmp_path):
    rows = [{"dataset": "d", "subject": f"s{k}", "modality": m, "path": f"{k}.{m}"} for k in range(40) for m in ("t1", "t2")[: 1 + k % 2]]
    (tmp_path / "in.json").write_text("\n".join(map(json.dumps, rows)))
    told = cli.main(["split", "--dataset-json", f"file://{tmp_path}/in.json", "--output-json", f"file://{tmp_path}/out", "--train-ratio", "0.5", "--val-ratio", "0.25", "--test-ratio", "0.25"], spark)
    assert [r["modality"] for r in told] == ["t1", "t2", "All"] and told[-1]["total"] == 60
    out = spark.read.json(f"file://{tmp_path}/out")
    assert out.count() == 60 and {r.split for r in out.collect()} == {"train", "val", "test"}
    assert out.groupBy("subject").agg(F.count_distinct("split").alias("k")).where("k > 1").count() == 0
    with pytest.raises(ValueError, match="add up"):
        cli.main(["split", "--dataset-json", f"file://{tmp_path}/in.json", "--output-json", f"file://{tmp_path}/no", "--train-ratio", "0.9"], spark)


def test_flags_on_the_command_line(spark, tmp_path):
    rows = [("a", "x", "true"), ("a", "y", "true"), ("b", "x", "true"), ("c", "x", "true"), ("c", "y", "true")]
    (tmp_path / "in.json").write_text("\n".join(json.dumps(dict(zip(("dataset", "flag", "value"), r, strict=True))) for r in rows))
    args = ["reset-flags", "--ledger", f"file://{tmp_path}/in.json", "--output", f"file://{tmp_path}/out", "-k", "x", "y"]
    assert cli.main([*args, "-d", "a", "b", "--dry-run"], spark) == [{"n_patched": 1, "n_failed": 1}] and not (tmp_path / "out").exists()
    assert cli.main([*args, "-d", "a", "b"], spark) == [{"n_patched": 1, "n_failed": 1}]
    got = sorted(tuple(r) for r in spark.read.json(f"file://{tmp_path}/out").select("dataset", "flag", "value").collect())
    assert got == [("a", "x", "false"), ("a", "y", "false"), ("b", "x", "true"), ("c", "x", "true"), ("c", "y", "true")]


def test_named_steps(spark):
    assert [r.names() for r in (registry.mappers, registry.validators, registry.preprocessors, registry.exporters)] == [["segments"], ["headers"], ["pass_through"], ["file_tree", "split"]]
    files = spark.createDataFrame([("p1/v1/anat/t1.img",)], "path string")
    out = registry.mappers.run(files, "segments", subject="^p", session="^v", type="^anat", modality=(("t1", "^t1"),)).first()
    assert (out.subject, out.session, out.modality) == ("p1", "v1", "t1")
    assert registry.preprocessors.run(files, "pass_through").first().preprocessed == "p1/v1/anat/t1.img"
    records = spark.createDataFrame([("d", f"s{k}", "t1") for k in range(10)], "dataset string, subject string, modality string")
    assert registry.exporters.run(records, "split", train=0.6, val=0.2, test=0.2).groupBy("split").count().count() == 3


def test_a_cluster_needs_a_shared_folder(spark):
    class Away:
        conf = type("C", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("S", (), {"master": "spark://host:7077"})  # noqa: N815

    with pytest.raises(ValueError, match="share"):
        base.shared_dir(Away())
