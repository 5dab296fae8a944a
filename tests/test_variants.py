"""Typed settings in VARIANT columns against plain dictionaries."""

import json
import random

import pytest
from pyspark.sql import functions as F

from cartulary.functions import variants


def some(r, depth=0):
    return r.choice([True, False, "true", 1, 2.5, None, [True], *([{k: some(r, depth + 1) for k in r.sample(["a", "b", "c d", "é"], 2)}] * 3 if depth < 2 else [])])


def at(d, path):
    for k in path.split("."):
        if not isinstance(d, dict) or k not in d:
            return "MISSING"
        d = d[k]
    return d


def kind(x):
    return {bool: "BOOLEAN", int: "BIGINT", float: "DECIMAL", str: "STRING", list: "ARRAY", dict: "OBJECT", type(None): "VOID"}[type(x)]


@pytest.fixture(scope="module")
def documents():
    r = random.Random(4)
    told = [{k: some(r) for k in r.sample(["a", "b", "c d", "x"], r.randint(0, 4))} for _ in range(120)]
    return [*told, {"a": {"b": True}, "x": False}, {"a": {"b": False, "é": 1}, "x": True}]


def test_kinds_and_flags(spark, documents):
    rows = [(k, json.dumps(d)) for k, d in enumerate(documents)] + [(-1, "{broken"), (-2, None), (-3, "[1]")]
    df = spark.createDataFrame(rows, "k int, doc string")
    got = {(r.k, r.flag): (r.kind, r.value) for r in variants.flags_of(df, "k", "doc", ["a.b", "x", "c d"]).collect()}
    for k, d in enumerate(documents):
        for p in ("a.b", "x", "c d"):
            v = at(d, p)
            assert got[k, p] == ("MISSING", None) if v == "MISSING" else got[k, p] == (kind(v), v if isinstance(v, bool) else None)
    assert {got[k, "x"] for k in (-1, -2, -3)} == {("MISSING", None)}


def test_reset_all_or_nothing(spark, documents):
    rows = [(k, json.dumps(d)) for k, d in enumerate(documents)] + [(-1, "{broken"), (-2, None)]
    out = {r.k: (r.doc, r.patched) for r in variants.reset_nested(spark.createDataFrame(rows, "k int, doc string"), "doc", ["a.b", "x"]).collect()}
    changed = 0
    for k, d in enumerate(documents):
        if isinstance(at(d, "a.b"), bool) and isinstance(at(d, "x"), bool):
            changed += 1
            want = json.loads(json.dumps(d))
            want["a"]["b"] = want["x"] = False
            assert out[k][1] and json.loads(out[k][0]) == want
        else:
            assert out[k] == (json.dumps(d), False)
    assert changed >= 2 and out[-1] == ("{broken", False) and out[-2] == (None, False)


def test_members_are_made_and_merged(spark, documents):
    df = spark.createDataFrame([(k, json.dumps(a), json.dumps(b)) for k, (a, b) in enumerate(zip(documents, documents[1:], strict=False))], "k int, a string, b string")
    a, b = F.parse_json("a"), F.parse_json("b")
    out = df.select("k", F.to_json(variants.with_member(a, "a.new.y", F.parse_json(F.lit('{"z": 1}')))).alias("made"), F.to_json(variants.merge_documents(a, b)).alias("flat"), F.to_json(variants.merge_documents(a, b, True)).alias("deep"), variants.typed(a, {"a.b": "boolean", "x": "string"}).alias("t"))

    def deep(x, y):
        return {**x, **{k: deep(x[k], v) if isinstance(v, dict) and isinstance(x.get(k), dict) else v for k, v in y.items()}}

    for r in out.collect():
        x, y = documents[r.k], documents[r.k + 1]
        held = x.get("a") if isinstance(x.get("a"), dict) else {}
        new = held.get("new") if isinstance(held.get("new"), dict) else {}
        assert json.loads(r.made) == {**x, "a": {**held, "new": {**new, "y": {"z": 1}}}}
        assert json.loads(r.flat) == {**x, **y} and json.loads(r.deep) == deep(x, y)
        assert r.t.a_b is None or isinstance(r.t.a_b, bool)
