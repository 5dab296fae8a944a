"""Paths to entries, joins with tables and sidecars, and what is written."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from cartulary.operators import grouping, joins, normalize, registry, settings
from cartulary.operators.normalize import Field
from cartulary.operators.paths import PathRules, parse_paths, rebuilt
from cartulary.operators.validate import HeaderRules, validate_headers
from cartulary.sources import listing, nifti, sinks, tables

BIDS = PathRules(subject="^sub-.*$", session="^ses-.*$", type="^anat", modality=(("t1w", "^.*T1w.nii.gz$"), ("t2w", "^.*T2w.nii.gz$")), exclude=("*_baseline",))


def entries(spark, paths, rules=BIDS):
    df = spark.createDataFrame([("D", p) for p in paths], "dataset string, path string")
    parsed = parse_paths(df, rules)
    return grouping.pivot_entries(parsed, ["dataset", "subject", "session", "type"], "modality", "path", ["path"], rules.first_group_only)


def test_paths_to_entries(spark):
    paths = [f"sub-1/ses-1/anat/{n}" for n in ("a_T1w.nii.gz", "b_T1w.nii.gz", "a_T2w.nii.gz", "a_T1w.json")]
    paths += ["sub-2/anat/a_T1w.nii.gz", "sub-3_baseline/ses-1/anat/a_T1w.nii.gz", "sub-4/ses-1/anat", "CHANGES"]
    got = {(r.subject, r.grp): r.files for r in entries(spark, paths).collect()}
    assert got == {
        ("sub-1", 0): {"t1w": paths[0], "t2w": paths[2]},
        ("sub-1", 1): {"t1w": paths[1]},
    }
    only = PathRules(**{**BIDS.__dict__, "first_group_only": True})
    assert [r.grp for r in entries(spark, paths, only).collect()] == [0]


def test_several_segments_and_none(spark):
    rules = PathRules(subject="^.*_.*$", type="^anat/NIfTI$", modality=(("t1w", "^mprage.nii.gz$"),))
    df = spark.createDataFrame([("A_1/anat/NIfTI/mprage.nii.gz",), ("A_1/anat/mprage.nii.gz",)], "path string")
    row = parse_paths(df, rules).select("*", rebuilt().alias("same")).collect()
    assert len(row) == 1 and row[0].type == "anat/NIfTI" and row[0].session == "" and row[0].same


FIELDS = [
    Field("participant_id", ("ID", "MR_ID"), strip=("^sub[-_]?",)),
    Field("sex", ("Sex", "gender"), {"female": ("F", "0", "Woman"), "male": ("M", "1"), "other": ("o",), "n/a": ("U",)}),
    Field("age", ("Age",)),
]


def test_columns_and_values(spark):
    df = spark.createDataFrame([("sub-1", "f", " 34 "), ("sub-2", " WOMAN ", "n/a"), ("sub-3", "x", "25+")], "`ID ` string, Gender string, AGE string")
    named = normalize.normalise_columns(df, FIELDS)
    assert named.columns == ["participant_id", "sex", "age"]
    out = normalize.normalise_values(named, FIELDS, strict=False).collect()
    assert [(r.sex, r.age, r._rejects) for r in out] == [("female", "34", []), ("female", "n/a", []), (None, "25+", ["sex"])]
    with pytest.raises(Exception, match="sex: invalid value"):
        normalize.normalise_values(named, FIELDS).collect()
    with pytest.raises(ValueError, match="colour"):
        normalize.normalise_columns(df.withColumn("colour", F.lit("")), FIELDS)


@pytest.mark.parametrize(("cell", "expected"), [("NA", ("", False, False)), ("25+", ("25+", True, False)), (" 130 ", ("130", False, True)), ("abc", ("abc", False, False)), ("1_000", ("1_000", True, False))])
def test_cells(spark, cell, expected):
    assert tuple(spark.range(1).select(normalize.check_cell(F.lit(cell), 0, 120).alias("c")).first().c) == expected


@pytest.mark.parametrize(("value", "expected"), [("Sub-S01", "s01"), ("subject01", "ject01"), ("x", "x"), ("sub-", None), ("  ", None)])
def test_prefixes(spark, value, expected):
    assert spark.range(1).select(normalize.strip_prefix(F.lit(value), ["^sub[-_]?"]).alias("k")).first().k == expected


def test_last_row_wins_and_unmatched_stay(spark):
    left = spark.createDataFrame([("a",), ("b",)], "pid string")
    right = spark.createDataFrame([("a", 1, "30"), ("a", 2, "31")], "pid string, row_idx int, age string")
    assert sorted((r.pid, r.age) for r in joins.attach(left, right, ["pid"], ["row_idx"]).collect()) == [("a", "31"), ("b", None)]


def test_sidecar_fallback(spark):
    df = spark.createDataFrame(
        [(1, {"Manufacturer": "S"}, {"Manufacturer": "R"}), (2, {"Manufacturer": "", "Field": "0"}, {"Field": "3"}), (3, None, None)],
        "k int, near map<string,string>, far map<string,string>",
    )
    got = {r.k: r.m for r in df.select("k", joins.fallback_lookup(F.col("near"), F.col("far"), ["Manufacturer", "Field"]).alias("m")).collect()}
    assert got == {1: {"Manufacturer": "S", "Field": ""}, 2: {"Manufacturer": "", "Field": "3"}, 3: {}}


def test_matches(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "z")], "k string, v string")
    assert [tuple(r) for r in joins.exactly_one(df, ["k"], "v").collect()] == [("a", "x")]
    with pytest.raises(Exception, match="exactly one"):
        joins.exactly_one(df, ["k"], "v", strict=True).collect()
    texts = spark.createDataFrame([(1, "zz one two three four five zz"), (2, "one two four"), (3, None)], "i int, t string")
    needles = spark.createDataFrame([(7, "one two three four five"), (8, "two"), (9, "")], "j int, n string")
    a = sorted((r.i, r.j) for r in joins.contains_join(texts, needles, "t", "n").collect())
    b = sorted((r.i, r.j) for r in joins.contains_join(texts, needles, "t", "n", most=0).collect())
    assert a == b == [(1, 7), (1, 8), (1, 9), (2, 8), (2, 9)]


def test_missing_and_extra(spark):
    a, b = (spark.createDataFrame([(x,) for x in s], "p string") for s in ("xyz", "yzw"))
    assert {(r.p, r.status) for r in joins.missing_extra(a, b, ["p"]).collect()} == {("x", "missing"), ("w", "extra")}


def test_unknown_exclusion(spark):
    names, out = spark.createDataFrame([("a",)], "d string"), spark.createDataFrame([("b",)], "d string")
    with pytest.raises(ValueError, match="b"):
        joins.select_datasets(names, None, out, "d")


def volume(shape=(80, 80, 60), value=10.0, zooms=(1.0, 1.0, 1.0), units=2, codes=(1, 1), qfac=1.0):
    head = bytearray(352)
    struct.pack_into("<i", head, 0, 348)
    struct.pack_into("<8h", head, 40, len(shape), *shape, *[1] * (7 - len(shape)))
    struct.pack_into("<2h", head, 70, 16, 32)
    struct.pack_into("<8f", head, 76, qfac, *zooms, 0, 0, 0, 0)
    struct.pack_into("<3f", head, 108, 352, 1, 0)
    head[123] = units
    struct.pack_into("<2h", head, 252, *codes)
    struct.pack_into("<12f", head, 280, -1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0)
    head[344:348] = b"n+1\0"
    import numpy as np

    return bytes(head) + np.full(shape, value, "<f4").tobytes()


def test_volumes(spark, tmp_path):
    import gzip

    cases = {
        "good": volume(), "small": volume((79, 80, 60)), "coarse_later_axis": volume(zooms=(1.0, 5.0, 5.0)), "metres": volume(units=1), "mm_s": volume(units=10),
        "codes": volume(codes=(2, 0)), "zero": volume(value=0.0), "negative": volume(value=-1.0), "nan": volume(value=float("nan")), "qfac": volume(qfac=0.0),
    }
    for name, data in cases.items():
        (tmp_path / f"{name}.nii.gz").write_bytes(gzip.compress(data, 1))
    (tmp_path / "broken.nii").write_bytes(b"no")
    headers = nifti.read_headers(spark, f"file://{tmp_path}").cache()
    got = {r.path.rpartition("/")[2].split(".")[0]: r for r in validate_headers(headers).collect()}
    assert {k: r.errors for k, r in got.items()} == {
        "good": [], "small": ["shape"], "coarse_later_axis": [], "metres": ["space_unit"], "mm_s": [], "codes": ["sform_code", "qform_code"],
        "zero": ["all_zero", "mean"], "negative": ["values", "mean"], "nan": [], "qfac": ["qfac"], "broken": ["load"],
    }
    assert got["good"].orientation == "LAS" and got["good"].shape == [80, 80, 60]
    strict = {r.path.rpartition("/")[2].split(".")[0]: r.errors for r in validate_headers(headers, HeaderRules(strict_voxel=True, orientation="RAS")).collect()}
    assert strict["coarse_later_axis"] == ["voxel_size", "orientation"]


def test_listing_lines(spark):
    lines = ["                           PRE sub-01/", "   PRE dir with space/", "2023-01-01 10:00:00       1234 README", "2023-01-01 10:00:00  1234 a/file with  spaces.nii.gz"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert [tuple(r.r) for r in df.select(listing.parse_remote_listing(F.col("line")).alias("r")).collect()] == [(True, "sub-01"), (True, "dir with space"), (False, "README"), (False, "a/file with spaces.nii.gz")]


def test_files_and_folders(spark, tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / "a/b/x.json").write_text('{"k": 1}')
    (tmp_path / "y.txt").write_text("y")
    assert sorted(r.path for r in listing.list_files(spark, f"file://{tmp_path}").collect()) == ["a/b/x.json", "y.txt"]
    assert listing.subdirectories(spark, f"file://{tmp_path}", names_only=True) == ["a"]
    with pytest.raises(NotADirectoryError):
        listing.subdirectories(spark, f"file://{tmp_path}/y.txt")
    with pytest.raises(FileNotFoundError):
        listing.subdirectories(spark, f"file://{tmp_path}/none")
    assert tables.read_sidecars(spark, f"file://{tmp_path}").first().fields == {"k": "1"}


def test_catalogue_round_trip(spark, tmp_path):
    told = {"D": [{"subject": "s1", "session": "", "type": "anat", "group": 0, "mris": {"t1w": "a"}, "download": {"t1w": "p/a"}}], "E": []}
    (tmp_path / "c.json").write_text(json.dumps(told))
    read = tables.read_catalogue(spark, f"file://{tmp_path}/c.json")
    assert [(r.dataset, r.subject, r.mris) for r in read.collect()] == [("D", "s1", {"t1w": "a"})]
    sinks.write_catalogue(read, f"file://{tmp_path}/out")
    assert spark.read.json(f"file://{tmp_path}/out").first().dataset == "D"
    plan = sinks.copy_plan(read, "download", f"file://{tmp_path}/src", f"file://{tmp_path}/dst")
    (tmp_path / "src/p").mkdir(parents=True)
    (tmp_path / "src/p/a").write_text("voxels")
    assert [r.error for r in sinks.copy_files(plan).collect()] == [None]
    assert (tmp_path / "dst/p/a").read_text() == "voxels"


def test_tsv_cells_stay_text(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("participant_id\tage\nsub-01\t034\n")
    df = tables.read_tsv(spark, f"file://{tmp_path}/p.tsv")
    assert df.first().age == "034"
    assert sorted((r.column, r.value) for r in tables.melt(df, "D").collect()) == [("age", "034"), ("participant_id", "sub-01")]


def test_settings_files(tmp_path):
    (tmp_path / "bad.json").write_text("{")
    assert tables.read_settings(str(tmp_path / "bad.json")) == {}
    with pytest.raises(FileNotFoundError):
        tables.read_settings(str(tmp_path / "none.json"))
    assert tables.read_settings(str(tmp_path / "new.json"), create=True) == {} and (tmp_path / "new.json").exists()


def test_merging():
    d = {"a": 1, "p": {"x": 1, "y": 2}}
    assert settings.merge_settings(d, {"p": {"x": 9}}) == {"a": 1, "p": {"x": 9}}
    assert settings.merge_settings(d, {"p": {"x": 9}}, deep=True) == {"a": 1, "p": {"x": 9, "y": 2}}
    with pytest.raises(TypeError):
        settings.merge_settings(d, [])


def test_flags_are_reset_together_or_not(spark):
    rows = [("a", "x", "true"), ("a", "y", "false"), ("b", "x", "true"), ("c", "x", "true"), ("c", "y", "1"), ("a", "other", "7")]
    ledger = spark.createDataFrame(rows, "dataset string, flag string, value string")
    got = {(r.dataset, r.flag): r.value for r in settings.reset_flags(ledger, ["x", "y"]).collect()}
    assert got == {("a", "x"): "false", ("a", "y"): "false", ("a", "other"): "7", ("b", "x"): "true", ("c", "x"): "true", ("c", "y"): "1"}
    assert tuple(settings.reset_summary(ledger, ["x", "y"]).first()) == (1, 2)


def test_registry(spark, tmp_path, monkeypatch):
    steps = registry.Registry()

    @steps.register("double")
    def double(df, by=2):
        return df.select((F.col("id") * by).alias("id"))

    assert [r.id for r in steps.run(spark.range(2), "double", by=3).collect()] == [0, 3]
    assert steps.get("none") is None
    with pytest.raises(KeyError):
        steps.run(spark.range(1), "none")
    with pytest.raises(ValueError):
        steps.discover("no_such_package_here")
    with pytest.raises(ValueError):
        steps.register("double")(double)
