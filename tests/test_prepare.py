"""The whole preparation over a small folder of datasets."""

import gzip
import json

import pytest

from cartulary import cli, prepare
from cartulary.operators import preprocess
from cartulary.operators.normalize import Field
from cartulary.operators.validate import HeaderRules
from cartulary.sources.copying import copy_tree
from cartulary.sources.ledger import FlagLedger
from tests.test_nifti import volume

FIELDS = [Field("participant_id", ("ID",)), Field("session", ("session_id",)), Field("age", ("Age",)), Field("sex", ("gender",), {"female": ("F", "0"), "male": ("M", "1"), "n/a": ("U",)})]
REGEX = {"subject": "^sub-.*$", "session": "", "type": "^anat$", "modality": {"t1w": "^.*T1w.nii.gz$", "t2w": "^.*T2w.nii.gz$"}}


@pytest.fixture
def root(tmp_path):
    def put(name, content):
        f = tmp_path / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(content if isinstance(content, bytes) else content.encode())

    image = gzip.compress(volume(range(20), 4, sform=(1,), qform=(1,), srow=(1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0)))
    for s in ("01", "02", "x3"):
        put(f"raw/A/Download/sub-{s}/anat/sub-{s}_T1w.nii.gz", image if s != "02" else image[:-9])
    put("raw/A/Download/sub-01/anat/sub-01_T2w.nii.gz", image)
    put("raw/A/Download/sub-01/anat/sub-01_run2_T1w.nii.gz", image)
    put("raw/A/Download/sub-01/func/sub-01_T1w.nii.gz", image)
    put("raw/A/Download/sub-01/anat/sub-01_T1w.json", json.dumps({"Manufacturer": "Near", "Other": 1}))
    put("raw/A/Download/T1w.json", json.dumps({"Manufacturer": "Far", "MagneticFieldStrength": 3}))
    put("raw/A/metadata.json", json.dumps({"mapping": {"regex": REGEX, "excludeSub": ["sub-x*"]}}))
    for s, e in (("7", "a"), ("7", "b"), ("8", "a")):
        put(f"raw/B/Download/sub-{s}/ses-{e}/anat/m_T1w.nii.gz", image)
    put("raw/B/metadata.json", json.dumps({"mapping": {"regex": {**REGEX, "session": "^ses-"}}, "preprocess": {"preprocessor": "identity", "alreadyPreprocessed": True}}))
    put("raw/C/metadata.json", json.dumps({"includeDataset": False}))
    put("raw/D/metadata.json", json.dumps({"mapping": {"regex": {**REGEX, "subject": "^sub-(", "session": ""}}}))
    put("raw/E/metadata.json", "{broken")
    put("raw/E/Download/x.nii.gz", image)
    put("people/A/participants.tsv", "ID\tAge\tgender\nsub-01\t20\tF\n01\t34\tM\n02\tn/a\tU\n")
    put("people/B/participants.tsv", "participant_id\tsession_id\tsex\n7\ta\t0\nsub-7\tses-b\t1\n8\tb\t0\n")
    return tmp_path


def rows(entries):
    return {(r.dataset, r.subject, r.session, r.group): r for r in entries.collect()}


def test_whole(spark, root):
    ledger = FlagLedger(spark, f"file://{root}/ledger")
    rules = HeaderRules(least_shape=(20, 1, 1), most_shape=(20, 1, 1), most_voxel=(9, 9, 9), mean=(1, 100))
    out = prepare.prepare(spark, f"file://{root}/raw", {"includeDataset": True}, {}, f"file://{root}/people", FIELDS, rules, ledger)
    got = rows(out.entries)
    assert set(got) == {("A", "sub-01", "", 0), ("A", "sub-01", "", 1), ("A", "sub-02", "", 0), ("B", "sub-7", "ses-a", 0), ("B", "sub-7", "ses-b", 0), ("B", "sub-8", "ses-a", 0)}
    first, second = got["A", "sub-01", "", 0], got["A", "sub-01", "", 1]
    assert first.mris == {"t1w": "sub-01_T1w.nii.gz", "t2w": "sub-01_T2w.nii.gz"} and first.download["t1w"] == "sub-01/anat/sub-01_T1w.nii.gz" and first.type == "anat"
    assert second.mris == {"t1w": "sub-01_run2_T1w.nii.gz"} or first.mris["t1w"] == "sub-01_T1w.nii.gz"
    assert first.demographics == second.demographics == {"participant_id": "01", "age": "34", "sex": "male"}  # the last row
    assert got["A", "sub-02", "", 0].demographics == {"participant_id": "02", "sex": "n/a"}
    assert got["B", "sub-7", "ses-a", 0].demographics["sex"] == "female" and got["B", "sub-7", "ses-b", 0].demographics["sex"] == "male" and got["B", "sub-8", "ses-a", 0].demographics == {}
    assert first.scanner["t1w"] == {"Manufacturer": "Near", "ManufacturersModelName": "", "MagneticFieldStrength": ""} and first.scanner["t2w"] == {}
    assert second.scanner["t1w"] == {"Manufacturer": "Far", "ManufacturersModelName": "", "MagneticFieldStrength": "3"}
    assert first.nifti_info["t1w"].downloadVoxelSizes == [1.0, 2.0, 3.0][:0] + list(first.nifti_info["t2w"].downloadVoxelSizes) and got["A", "sub-02", "", 0].nifti_info is None
    assert got["B", "sub-7", "ses-b", 0].preprocessed == {"t1w": "sub-7.ses-b.anat.0/norm_bet/m_T1w_t1w.nii.gz"} and first.preprocessed == {}
    assert {p[:2] for p in out.problems} == {("D", "mapping"), ("E", "mapping")}
    assert sorted(e for r in out.headers.collect() for e in r.errors) == ["load"]
    assert {(r.dataset, r.flag): r.value for r in ledger.read().collect()} == {**{(d, "isDatasetJsonCreated"): v for d, v in (("A", "true"), ("B", "true"), ("D", "false"), ("E", "false"))}, ("A", "isValidationCheckDone"): "true", ("B", "isValidationCheckDone"): "true"}
    copy_tree(preprocess.copies_of(out.entries.where("dataset = 'B'"), f"file://{root}/raw"), f"file://{root}/slim")
    assert sorted(str(p.relative_to(root / "slim")) for p in (root / "slim").rglob("*.gz"))[0] == "B/sub-7.ses-a.anat.0/norm_bet/m_T1w_t1w.nii.gz"


def test_bad_people_leave_the_entries(spark, root):
    (root / "people/A/participants.tsv").write_text("ID\tunknown\n01\t1\n")
    (root / "people/B/participants.tsv").write_text("ID\tage\n7\t12d\n")
    out = prepare.prepare(spark, f"file://{root}/raw", {}, {"include": ["A", "B"]}, f"file://{root}/people", FIELDS)
    assert len(rows(out.entries)) == 6 and {p[:2] for p in out.problems} == {("A", "demographics"), ("B", "demographics")}
    assert prepare.chosen(["a", "b"], {"exclude": ["a"]}) == ["b"]
    with pytest.raises(ValueError, match="excluded"):
        prepare.chosen(["a"], {"exclude": ["z"]})
    with pytest.raises(ValueError, match="can be mapped"):
        prepare.prepare(spark, f"file://{root}/raw", {}, {"include": ["D"]})


def test_refusal_without_the_mark(spark):
    df = spark.createDataFrame([("s", "", "", 0, {"t1w": "a.nii.gz", "t2w": "b.img"})], "subject string, session string, type string, group int, mris map<string,string>")
    assert preprocess.pass_through(df, {"preprocess": {"alreadyPreprocessed": True}}).first().preprocessed == {"t1w": "s...0/norm_bet/a_t1w.nii.gz", "t2w": "s...0/norm_bet/b.img"}
    for settings in ({}, {"preprocess": {}}, {"preprocess": {"alreadyPreprocessed": False}}):
        with pytest.raises(ValueError, match="not marked"):
            preprocess.pass_through(df, settings)


def test_on_the_command_line(spark, root):
    (root / "fields.yaml").write_text("fields:\n- name: participant_id\n  aliases: [ID]\n- name: age\n  aliases: [Age]\n- name: sex\n  aliases: [gender]\n  valid_values:\n  - main_value: male\n    aliases: [M]\n  - main_value: female\n    aliases: [F]\n  - main_value: n/a\n    aliases: [U]\n")
    args = ["prepare", "--root", f"file://{root}/raw", "--output", f"file://{root}/out", "--demographics", f"file://{root}/people", "--fields", f"{root}/fields.yaml", "--include", "A", "E"]
    assert cli.main(args, spark) == [{"dataset": "A", "n_entries": 3}, {"dataset": "E", "problem": "mapping: no mapping"}]
    assert spark.read.json(f"file://{root}/out").count() == 3
