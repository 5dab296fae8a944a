"""The flag ledger: writers at once, lost writers, merging, changes that depend on what is there."""

import threading

import pytest
from pyspark.sql import functions as F

from cartulary.operators.settings import reset_flags
from cartulary.sources.ledger import FlagLedger


def rows(spark, *told):
    return spark.createDataFrame([tuple(t) for t in told], "dataset string, flag string, value string")


def state(ledger, version=None):
    return {(r.dataset, r.flag): r.value for r in ledger.read(version).collect()}


@pytest.fixture
def ledger(spark, tmp_path):
    return FlagLedger(spark, f"file://{tmp_path}/ledger")


def test_versions(spark, ledger):
    assert state(ledger) == {} and ledger.version() == 0
    assert ledger.update(rows(spark, ("a", "x", "true"), ("b", "x", "false"), ("a", "x", "true"))) == 1
    assert ledger.update(rows(spark, ("a", "x", "false"), ("a", "y", None))) == 2
    assert ledger.remove(rows(spark, ("b", "x", None), ("none", "x", None)).drop("value")) == 3
    assert state(ledger, 1) == {("a", "x"): "true", ("b", "x"): "false"} and state(ledger) == {("a", "x"): "false", ("a", "y"): None}
    assert ledger.update(rows(spark).limit(0)) == 4 and state(ledger) == state(ledger, 3)
    with pytest.raises(Exception, match="different values"):
        ledger.update(rows(spark, ("a", "x", "1"), ("a", "x", "2")))
    assert ledger.version() == 4


def test_two_writers_at_once_both_survive(spark, ledger):
    ledger.update(rows(spark, *((f"d{k}", "all", "false") for k in range(5))))
    failed = []

    def write(flag):
        try:
            for k in range(5):
                FlagLedger(spark, ledger.root).update(rows(spark, (f"d{k}", flag, "true")))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    writers = [threading.Thread(target=write, args=(f,)) for f in ("x", "y", "z")]
    [w.start() for w in writers]
    [w.join() for w in writers]
    assert not failed and ledger.version() == 16
    assert state(ledger) == {(f"d{k}", f): "false" if f == "all" else "true" for k in range(5) for f in ("all", "x", "y", "z")}


def test_a_race_is_tried_again_on_the_newer_version(spark, ledger, monkeypatch):
    ledger.update(rows(spark, ("a", "x", "true"), ("a", "y", "true"), ("b", "x", "true")))
    seen, publish = [], ledger._publish

    def late(folders, version):
        if not seen:
            seen.append(version)
            FlagLedger(spark, ledger.root).update(rows(spark, ("b", "y", "true")))  # another writer comes first
        publish(folders, version)

    monkeypatch.setattr(ledger, "_publish", late)
    ledger.update(lambda now: reset_flags(now, ["x", "y"]).where("patched").select("dataset", "flag", "value"))
    assert state(ledger) == {(d, f): "false" for d in "ab" for f in "xy"} and ledger.version() == 3


def test_a_crash_before_publishing_changes_nothing(spark, ledger, monkeypatch):
    ledger.update(rows(spark, ("a", "x", "true")))
    before = state(ledger)

    def crash(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(ledger, "_publish", crash)
        with pytest.raises(KeyboardInterrupt):
            ledger.update(rows(spark, ("a", "x", "false")))
    assert state(ledger) == before and ledger.version() == 1
    ledger.vacuum()
    fs, p = ledger._fs("changes")
    assert len(fs.listStatus(p)) == 2
    ledger.vacuum(retention=-10)
    assert len(fs.listStatus(p)) == 1 and state(ledger) == before


def test_folders_are_merged(spark, tmp_path):
    ledger = FlagLedger(spark, f"file://{tmp_path}/ledger", most=3)
    for k in range(8):
        ledger.update(rows(spark, ("a", f"f{k % 4}", str(k))))
    ledger.remove(rows(spark, ("a", "f0", None)))
    assert state(ledger) == {("a", "f1"): "5", ("a", "f2"): "6", ("a", "f3"): "7"} and len(ledger.folders()) <= 4
    assert state(ledger, 5)[("a", "f0")] == "4" and ledger.read().where(F.col("flag") == "f0").isEmpty()
