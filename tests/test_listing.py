"""Folders listed by the tasks: as Spark's reader lists them, and without the list on its way through the driver."""

import json
import urllib.parse

import pytest
from pyspark.sql import functions as F

from cartulary.prepare import prepare
from cartulary.sources import listing, nifti, tables
from cartulary.sources.listing import binary_files, list_files, read_files

NAMES = ["a/b c/x%20y.json", "a/b c/+.json", "a/_hidden/x.json", "a/.dot/x.json", "a/_k=1/x.json", "_metadata/x.json", "a/.x.json", "a/x.json._COPYING_", "é/[1]/{2}.nii", "é/[1]/x.nii.gz", "é/[1]/x.NII", "top.json", "a/a/a/a/deep.txt", "r/r/r.json"]


def put(root, names, text="x"):
    for n in names:
        (root / n).parent.mkdir(parents=True, exist_ok=True)
        (root / n).write_text(text)


@pytest.mark.parametrize("most", [1, 3, 10_000])
def test_as_spark_lists(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(listing, "MET", most)
    root = tmp_path / "r"
    put(root, NAMES)
    put(root, ["a/empty.json"], "")
    (root / "a/link").symlink_to(root / "r")
    (root / "a/nothing").symlink_to(root / "none")
    for glob in (None, "*.json", "*.{nii,nii.gz}", "x*", "?.json", "[!x]*"):
        want = {(r.path, r.length, r.modificationTime) for r in binary_files(spark, f"file://{root}", glob).collect()}
        found = listing.found_files(spark, f"file://{root}", glob).collect()
        assert {(r.path, r.length, r.modified) for r in found} == want and len(found) == len(want) > 0
        assert sorted(r.path for r in list_files(spark, f"file://{root}/", glob).collect()) == sorted(p.removeprefix(f"file:{root}/") for p, _, _ in want)
        assert {(r.path, r.length, bytes(r.content)) for r in read_files(spark, f"file://{root}", glob).collect()} == {(p, n, b"x") for p, n, _ in want}
    assert [r.path for r in list_files(spark, f"file://{root}/top.json").collect()] == ["top.json"]
    assert {r.path for r in read_files(spark, f"file://{root}/*/*/r.json").collect()} == {r.path for r in binary_files(spark, f"file://{root}/*/*/r.json").collect()}
    with pytest.raises(FileNotFoundError):
        list_files(spark, f"file://{root}/nowhere")
    (tmp_path / "no files").mkdir()
    assert list_files(spark, f"file://{tmp_path}/no files").count() == read_files(spark, f"file://{tmp_path}/no files").count() == 0


def test_inventory_of_odd_names(spark, tmp_path):
    put(tmp_path, NAMES)
    names = lambda *globs: sorted(r.path for r in listing.inventory(spark, f"file://{tmp_path}", globs).collect())
    assert names("é/[[]1]/*") == ["é/[1]/x.NII", "é/[1]/x.nii.gz", "é/[1]/{2}.nii"]
    assert names("_meta*/*", "t*") == ["_metadata/x.json", "top.json"]
    put(tmp_path, [".data/x.json", "_old/x.json"])
    assert names(".d*", "_old/*", ".x*") == [".data/x.json", "_old/x.json"]


def test_stores_of_spark_alone(spark, tmp_path):
    put(tmp_path, ["a b/x.json", "a b/info.yaml"], '{"k": 1}')
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.only.link./in", f"file://{tmp_path}")
    root = "viewfs://only/in"
    assert sorted(r.path.rpartition("/")[2] for r in list_files(spark, root).collect()) == ["info.yaml", "x.json"]
    assert [(urllib.parse.unquote(r.path).rpartition("/in/")[2], r.fields) for r in tables.read_sidecars(spark, root).collect()] == [("a b/x.json", {"k": "1"})]
    assert [(r.dataset, r.info) for r in tables.read_infos(spark, root).collect()] == [("a b", {"k": "1"})]


def sent(spark, work) -> int:
    """Bytes of the results of all tasks that ``work`` runs."""
    sc = spark.sparkContext

    def stages():
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        told = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return {told.apply(i).stageId(): told.apply(i).resultSize() for i in range(told.size())}

    before = stages()
    work()
    return sum(n for k, n in stages().items() if k not in before)


def test_the_driver_gets_no_list(spark, tmp_path):
    n = 1500
    for k in range(n):
        put(tmp_path / "raw", [f"D/Download/sub-{k}/anat/{'t' * 150}T1w.nii.gz", f"D/Download/sub-{k}/anat/{'t' * 150}T1w.json"], "{}")
    regex = {"subject": "^sub-.*$", "session": "", "type": "^anat$", "modality": {"t1w": "^.*T1w.nii.gz$"}}
    put(tmp_path / "raw", ["D/metadata.json"], json.dumps({"mapping": {"regex": regex}}))
    root, out = f"file://{tmp_path}/raw", lambda df: df.write.format("noop").mode("overwrite").save()
    listed = sent(spark, lambda: out(binary_files(spark, root).select("path")))
    assert listed > n * 1000
    assert sent(spark, lambda: out(nifti.read_headers(spark, root).select(F.length("path")))) < listed / 10
    assert sent(spark, lambda: out(tables.read_sidecars(spark, root))) < listed / 10
    assert sent(spark, lambda: out(prepare(spark, root).entries)) < listed / 2  # of its many small stages, whatever the number of files
