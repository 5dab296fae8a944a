"""The file tree sink: whole or nothing, whatever tasks do."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from cartulary.sources import copying


def tree(root) -> dict:
    return {str(p.relative_to(root)): p.read_text() for p in root.rglob("*") if p.is_file()} if root.exists() else None


@pytest.fixture
def sources(tmp_path):
    for k in range(30):
        f = tmp_path / "from" / f"d{k % 3}" / f"f {k}.txt"
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(f"text {k} " * k)
    return tmp_path


def plan_of(spark, root):
    rows = [(f"file://{p}", str(p.relative_to(root / "from"))) for p in (root / "from").rglob("*.txt")]
    return spark.createDataFrame(rows, "src string, path string").repartition(4)


def test_a_tree_is_copied_once(spark, sources):
    plan, target = plan_of(spark, sources), sources / "to"
    copying.copy_tree(plan, f"file://{target}")
    assert tree(target) == tree(sources / "from") and sorted(p.name for p in sources.iterdir()) == ["from", "to"]
    with pytest.raises(Exception, match="FileExistsError"):
        copying.copy_tree(plan, f"file://{target}")
    copying.copy_tree(plan.where("path like 'd1%'"), f"file://{target}", overwrite=True)
    assert tree(target) == {k: v for k, v in tree(sources / "from").items() if k.startswith("d1")} and sorted(p.name for p in sources.iterdir()) == ["from", "to"]
    copying.copy_tree(plan.limit(0), f"file://{sources}/none")
    assert tree(sources / "none") == {}


@pytest.mark.parametrize("src,path", [("file:///no/such/file", "a"), ("here", "../out"), ("here", "/abs"), ("here", ""), ("here", None)])
def test_a_failure_leaves_nothing(spark, sources, src, path):
    src = f"file://{sources}/from/d0/f 0.txt" if src == "here" else src
    plan = plan_of(spark, sources).union(spark.createDataFrame([(src, path)], "src string, path string"))
    before = tree(sources / "from")
    with pytest.raises(Exception, match="FileNotFound|no place in a tree"):
        copying.copy_tree(plan, f"file://{sources}/to")
    assert [p.name for p in sources.iterdir()] == ["from"] and tree(sources / "from") == before


def test_attempts_that_end_early_or_twice(spark, sources):
    rows = plan_of(spark, sources).collect()
    writer = copying.TreeWriter(f"file://{sources}/to", False)

    def dies(some):
        yield from some
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(dies(rows[:7]))
    writer.write(iter(rows[:15]))
    writer.write(iter(rows[:15]))
    writer.write(iter(rows[15:]))
    assert not (sources / "to").exists()
    writer.commit([])
    assert tree(sources / "to") == tree(sources / "from") and sorted(p.name for p in sources.iterdir()) == ["from", "to"]


KILLED = """
import os, sys
from cartulary.session import get_session
from cartulary.sources import copying
root, times = sys.argv[1], int(sys.argv[2])
spark = get_session("local[2,3]", **{"spark.ui.enabled": "false"})
spark.sparkContext.setLogLevel("OFF")
rows = [(f"file://{d}/{n}", n) for d, _, names in os.walk(root + "/from") for n in names]
def fatal(batches):
    for k, b in enumerate(batches):
        marks = os.listdir(root + "/marks")
        if k == 3 and len(marks) < times:
            open(root + f"/marks/{len(marks)}", "w").close()
            os.kill(os.getpid(), 9)
        yield b
spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
plan = spark.createDataFrame(rows, "src string, path string").coalesce(1).mapInArrow(fatal, "src string, path string")
try:
    copying.copy_tree(plan, f"file://{root}/to")
    print("DONE")
except Exception as e:
    print("FAILED")
"""


@pytest.mark.parametrize("times,outcome", [(1, "DONE"), (9, "FAILED")])
def test_a_killed_task_leaves_all_or_nothing(sources, times, outcome):
    (sources / "marks").mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", KILLED, str(sources), str(times)], env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=300)
    assert out.stdout.split()[-1] == outcome, out.stderr[-800:]
    want = {k.rpartition("/")[2]: v for k, v in tree(sources / "from").items()} if outcome == "DONE" else None
    assert tree(sources / "to") == want and sorted(p.name for p in sources.iterdir()) == ["from", "marks", *(["to"] if want else [])]
