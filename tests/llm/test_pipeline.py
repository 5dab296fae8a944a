"""Stages on a small corpus with planted cases, each judged on its own input."""

import os

import pytest

import corpus_pipeline
from cartulary.llm.common import components, lookup_join, materialise
from tests.llm.conftest import prose
from tests.llm.test_jaccard import brute as brute_components
from tests.llm.test_line_dedup import brute as brute_lines


def clean(seed, words=90):
    return "\n".join(f"the {x} and of it" for x in prose(seed, words).split("\n"))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('sf')}"
    item = " ".join(prose(700, 30).split())
    rows = [(k, clean(k)) for k in range(30)] + [(40 + k, "word " * 80) for k in range(3)] + [(50, clean(1)), (51, None), (52, "")]
    rows += [(60, clean(2) + "\nthe tail and of it"), (70, clean(60) + "\n" + item)]
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint, dedup int, row string, d int, h string, _gone int, n_words int, keeper string"
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t or ""), 1, "r", 2, "h", 3, 4, "k") for i, t in rows], kinds)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialise(stage(spark, docs, corpus), name)
        assert after.columns == docs.columns
        seen[name] = ({r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in after.collect()})
        docs = after
    assert set(seen["quality_rules"][1]) == {*range(30), 50, 60, 70}
    before, after = seen["line_dedup"]
    assert after == {k: t for k, t in brute_lines(sorted(before.items())).items() if t.strip()}
    before, after = seen["ngram_jaccard_join"]
    assert set(after) == {c for _, _, c in brute_components(sorted(before.items()))}
    assert set(seen["decontamination"][0]) - set(seen["decontamination"][1]) == {70}


def test_run(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus).collect()
    assert {r.doc_id for r in rows} >= set(range(30)) and 70 not in {r.doc_id for r in rows}
    for d in {r.doc_id for r in rows}:
        some = [r for r in rows if r.doc_id == d]
        assert sum(r.length for r in some) == some[0].doc_tokens


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8), (5, 5), (4, 1), (20, 10), (30, 20), (40, 30)], "src bigint, dst bigint")
    assert sorted(map(tuple, components(edges).collect())) == [(1, 1), (2, 1), (3, 1), (4, 1), (8, 8), (9, 8), (10, 10), (20, 10), (30, 10), (40, 10)]
    assert components(edges.limit(0)).count() == 0


def test_hot_keys(spark):
    left = spark.range(5000).selectExpr("if(id < 2000, 0, id) as k", "id")
    right = left.groupBy("k").count().withColumnRenamed("count", "n").where("k % 3 = 0")
    got = lookup_join(left, right, "k", "n", 5000)
    assert got.count() == 5000 and got.where("n is not null").count() == left.where("k % 3 = 0").count()


def test_subpackage_can_be_missing(tmp_path):
    """The entry module imports, and its other queries are there, without the subpackage and the pipeline."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    shutil.copytree(f"{root}/cartulary", tmp_path / "cartulary", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
