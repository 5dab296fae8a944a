import os

import pytest
from pyspark.sql import functions as F

from cartulary.llm.common import work_dir
from cartulary.llm.sharding import ShardStore


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def store(spark):
    return ShardStore(spark, work_dir(spark, "shards"))


def local(store, *parts):
    return os.path.join(store.root.removeprefix("file://"), *parts)


def test_append_compact_read(odd_docs, store):
    with pytest.raises(FileNotFoundError):
        store.manifest()
    for k in range(5):
        assert store.append(odd_docs.where(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(5)) == k).repartition(2)) == k + 1
    before = store.manifest().agg(F.sum("files")).first()[0]
    assert rows_of(store.read()) == rows_of(odd_docs)
    assert store.read(1).count() < odd_docs.count()
    assert store.compact() == 6 and store.manifest().agg(F.sum("files")).first()[0] < before
    assert rows_of(store.read()) == rows_of(odd_docs)
    assert store.compact() == 6
    assert store.manifest().agg(F.sum("rows")).first()[0] == odd_docs.count()


def test_target_size_and_tiers(spark):
    df = spark.range(40_000).select("id", F.md5(F.col("id").cast("string")).alias("t"))
    store = ShardStore(spark, work_dir(spark, "shards"), target_bytes=600_000)
    for k in range(4):
        store.append(df.where(f"id % 4 = {k}").repartition(6))
    store.compact()
    run = store.manifest().first()
    assert store.manifest().count() == 1 and run.files < 24 and 300_000 < run.bytes / run.files < 1_200_000
    assert store.read().count() == 40_000


def test_one_writer_wins(spark, store):
    store.append(spark.range(3))
    with pytest.raises(FileExistsError):
        store._commit(store.manifest(), 1)
    assert store.version() == 1 and store.read().count() == 3
    assert os.listdir(local(store, "versions")) in (["0000000001"], [".0000000001.crc", "0000000001"]) or store.versions() == [1]


def test_a_writer_that_lost_tries_again(spark, store, monkeypatch):
    store.append(spark.range(3))
    publish, other = store._publish, [True]

    def late(text, name):
        if other.pop() if other else False:
            ShardStore(spark, store.root).append(spark.range(10, 12))
        publish(text, name)

    monkeypatch.setattr(store, "_publish", late)
    assert store.append(spark.range(20, 21)) == 3
    assert sorted(r.id for r in store.read().collect()) == [0, 1, 2, 10, 11, 20]


def test_driver_lost_while_committing(spark, store, monkeypatch):
    """Lost before the version's name appears, the store is as before and goes on; no version is ever half there."""
    store.append(spark.range(3))

    def lost(*_):
        raise KeyboardInterrupt

    for at in ("_publish", "_commit"):
        with monkeypatch.context() as m:
            m.setattr(store, at, lost)
            with pytest.raises(KeyboardInterrupt):
                store.append(spark.range(5))
        assert store.version() == 1 and store.read().count() == 3
    with open(local(store, "versions", ".0000000002-left"), "w") as f:
        f.write("half a na")
    assert store.append(spark.range(3, 5)) == 2 and store.read().count() == 5


def test_nothing_is_deleted_but_by_vacuum(spark, store):
    """An append that isn't committed yet survives a compaction and a vacuum, and old versions can be read after it."""
    for k in range(4):
        store.append(spark.range(k, k + 1))
    writing = store._write_run(spark.range(100, 103), "append")
    assert store.compact() == 5 and store.read(4).count() == store.read().count() == 4 and store.read(2).count() == 2
    store.vacuum()
    assert store.read(1).count() == 1
    store._commit(store.manifest().unionByName(writing), 6)
    assert store.read().count() == 7
    store.vacuum(-60)
    assert store.versions() == [6] and store.read().count() == 7
    with pytest.raises(FileNotFoundError):
        store.read(5)
    assert len(os.listdir(local(store, "data"))) == store.manifest().count() == 2


def test_empty_arrival(spark, store):
    assert store.append(spark.range(0)) == 1 and store.read().count() == 0
    store.append(spark.range(2))
    assert store.append(spark.range(0)) == 3 and store.read().count() == 2
