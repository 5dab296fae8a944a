"""Fill-in-the-middle examples against a plain version in Python."""

import hashlib
import re

from pyspark.sql import functions as F

from cartulary.llm.fim import Rates, digest, fill_in_middle, restore


def example(doc_id, text, seed=1, rearranged=90, spm=20):
    t = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", t)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rearranged:
        return len(units), "plain", None, None, t
    return (len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_against_plain_python(spark, odd_docs):
    hard = ["<P>", "a<S>b", "<", "<<P", "P>", "<S", ">M<", "<P<S<M", "<p>", "a" * 70_000, "1" * 5_000, "\n\n", "🙂é中a🙂", "x <M y", "<P> <S> <M>"]
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()] + [(100 + i, t) for i, t in enumerate(hard * 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = fill_in_middle(docs)
    got = sorted(map(repr, (tuple(r) for r in out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect())))
    assert got == sorted(repr((i, *example(i, t))) for i, t in rows)
    assert out.where(~restore(F.col("output"), F.col("form")).eqNullSafe(F.coalesce("text", F.lit("")))).count() == 0
    assert {r.form for r in out.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(map(repr, (tuple(r)[4:] for r in digest(out).collect()))) == sorted(repr((None if example(i, t)[3] is None else example(i, t)[3], sha(example(i, t)[4]), sha(t or ""))) for i, t in rows)


def test_columns_rates_and_empty_table(spark, odd_docs, no_docs):
    out = fill_in_middle(odd_docs.withColumn("form", F.lit("theirs")), seed=7, rates=Rates(50, 60))
    assert "theirs" not in {r.form for r in out.collect()} and set(out.columns) == set(odd_docs.columns) - {"n"} | {"n", "form", "prefix_chars", "middle_chars", "output"}
    assert sorted(map(repr, (tuple(r) for r in out.select("n", "form", "prefix_chars", "middle_chars", "output").collect()))) == sorted(repr(example(r.doc_id, r.text, 7, 50, 60)) for r in odd_docs.collect())
    assert fill_in_middle(no_docs).isEmpty()


def test_no_python_in_the_plan(spark, odd_docs):
    plan = digest(fill_in_middle(odd_docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
