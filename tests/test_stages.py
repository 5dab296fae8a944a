"""Stage actions as reports arrive: against one aggregation, across restarts, timers."""

import datetime
import random

import pytest

from cartulary.streaming.incremental import run_available, write_by_batch
from cartulary.streaming.stages import follow_stages, newest_actions, stages_of

SCHEMA = "dataset string, at timestamp, seq bigint, kind string, value boolean"
NOON = datetime.datetime(2024, 5, 1, 12)


def run(spark, root, parts, together=False, **told):
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(f"{root}/reports")
        if together and k + 1 < len(parts):
            continue
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/reports")
        run_available(follow_stages(stream, **told), write_by_batch(f"{root}/out"), f"{root}/checkpoint", mode="update")
    return spark.read.parquet(f"{root}/out")


@pytest.mark.parametrize("redo", [False, True])
def test_three_parts_with_restarts(spark, tmp_path, redo):
    r = random.Random(redo)
    rows = [(r.choice(["a", "b", "c", "d", None]), NOON + datetime.timedelta(minutes=k // 3), k, r.choice(["done", "content", "other"]), r.choice([True, False, None])) for k in range(90)]
    parts = [rows[:30], rows[30:60], rows[60:]]
    [r.shuffle(p) for p in parts]
    want = sorted(tuple(x) for x in stages_of(spark.createDataFrame(rows, SCHEMA), redo).collect())
    out = run(spark, f"file://{tmp_path}/a", parts, redo=redo)
    assert sorted(tuple(x) for x in newest_actions(out, "batch").collect()) == want and len(want) == 4
    assert {x.batch for x in out.select("batch").collect()} >= {0, 2}
    whole = run(spark, f"file://{tmp_path}/b", parts, together=True, redo=redo)
    assert sorted(tuple(x) for x in newest_actions(whole, "batch").collect()) == want


def test_datasets_that_wait_too_long(spark, tmp_path):
    at = lambda h: NOON + datetime.timedelta(hours=h)
    parts = [
        [("waits", at(0), 1, "content", False), ("runs", at(0), 1, "done", False), ("fine", at(0), 1, "done", True), ("fine", at(0), 2, "content", True), ("later", at(3), 1, "done", True)],
        [("runs", at(1), 2, "done", True), ("runs", at(1), 3, "content", True), ("clock", at(6), 1, "content", True)],
        [("clock", at(7), 2, "content", True)],
        [("clock", at(8), 3, "content", True)],
    ]
    out = run(spark, f"file://{tmp_path}", parts, patience="4 hours", late="8 hours")
    assert out.where("event = 'overdue'").isEmpty()  # the watermark hasn't come that far
    out = run(spark, f"file://{tmp_path}", [[("clock", at(13), 4, "content", True)], [("clock", at(14), 5, "content", True)]], patience="4 hours", late="8 hours")
    assert [(x.dataset, x.action, x.at) for x in out.where("event = 'overdue'").collect()] == [("waits", "run", at(4))]
    out = run(spark, f"file://{tmp_path}", [[("clock", at(40), 6, "content", True)], [("clock", at(41), 7, "content", True)]], patience="4 hours", late="8 hours")
    assert sorted((x.dataset, x.action) for x in out.where("event = 'overdue'").collect()) == [("later", "reset"), ("waits", "run")]
