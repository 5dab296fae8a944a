"""Substrings by automaton against every pair."""

import random
import time

import pytest
from pyspark.sql import functions as F

from cartulary.operators.containment import Finder, contains_join, last_containing, shards_of


def some_texts(r):
    words = ["a", "bc", "bcd", "é", "x-y", "ab", "", "🙂", "aa", "_", "%"]
    texts = [(i, " ".join(r.choices(words, k=r.randint(0, 12)))) for i in range(60)] + [(99, None), (100, ""), (101, "aaaaaaaa"), (7, "aaaa")]
    needles = [(j, " ".join(r.choices(words, k=r.randint(1, 6)))) for j in range(40)]
    needles += [(100 + j, t[a : a + r.randint(1, 20)]) for j, (_, t) in enumerate(texts[:30]) if t for a in [r.randrange(len(t))]]
    return texts, [*needles, (200, None), (201, ""), (202, "a"), (203, "aa"), (204, "a"), (205, "no such")]


@pytest.mark.parametrize("seed", range(3))
def test_every_pair(spark, seed):
    texts, needles = some_texts(random.Random(seed))
    a, b = spark.createDataFrame(texts, "i int, t string"), spark.createDataFrame(needles, "j int, n string")
    want = sorted((i, j) for i, t in texts for j, n in needles if t is not None and n is not None and n in t)
    for limits in ({}, {"pass_bytes": 64, "shard_chars": 20, "chunk_bytes": 100}, {"shard_chars": 1, "chunk_bytes": 1}):
        assert sorted((x.i, x.j) for x in contains_join(a, b, "t", "n", **limits).collect()) == want
    one = contains_join(a, b, "t", "n", ["i"])
    assert one.columns == ["i", "j", "n"] and sorted((x.i, x.j) for x in one.collect()) == want
    assert contains_join(a.limit(0), b, "t", "n").isEmpty() and contains_join(a, b.limit(0), "t", "n").isEmpty()


@pytest.mark.parametrize("seed", range(2))
def test_last_that_contains_all(spark, seed):
    r = random.Random(seed)
    paths = [(r.randrange(20), "/".join(r.choice(["sub-01", "sub-02", "ses-1", "ses-12", "anat", "x_T1w", "MNI"]) for _ in range(r.randint(1, 5)))) for _ in range(80)] + [(3, None)]
    wanted = [(a, b, c) for a in ("01", "sub-0", "2", "none") for b in ("ses-1", "s-12", "") for c in ("T1w", "MNI/", "a")] + [("01", None, "a"), ("01", "ses-1", "T1w")]
    df = spark.createDataFrame(paths, "k int, path string")
    w = spark.createDataFrame(wanted, "s string, e string, m string")
    want = []
    for parts in wanted:
        hits = [(k, p) for k, p in paths if p is not None and None not in parts and all(x in p for x in parts)]
        want.append((*parts, max(hits)[1] if hits else None))
    for limits in ({}, {"pass_bytes": 20, "shard_chars": 10}):
        got = [tuple(x) for x in last_containing(df, w, "path", ["s", "e", "m"], ["k"], **limits).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_time_follows_the_length_of_a_text():
    r = random.Random(1)
    words = ["".join(r.choices("abcdef", k=5)) for _ in range(500)]
    finder = Finder([(" ".join(r.choices(words, k=k)),) for k in range(1, 30) for _ in range(20)])
    took = {}
    for n in (20_000, 160_000):
        text = " ".join(r.choices(words, k=n))
        took[n] = min(timed(finder, text) for _ in range(3))
    assert took[160_000] < 8 * 3 * took[20_000]


def timed(finder, text):
    began = time.perf_counter()
    finder.find(text)
    return time.perf_counter() - began


@pytest.mark.parametrize("n", [2_000, 16_000])
def test_long_texts(spark, n):
    words = [f"w{k * 7919 % 10007}" for k in range(n)]
    texts = spark.createDataFrame([(1, " ".join(words)), (2, "".join(words))], "i int, t string")
    needles = [" ".join(words[k : k + 7]) for k in range(0, n - 7, 97)] + ["".join(words[5:9])]
    found = contains_join(texts, spark.createDataFrame([(x,) for x in needles], "x string"), "t", "x", ["i"])
    assert {r.i: r.n for r in found.groupBy("i").agg(F.count_distinct("x").alias("n")).collect()} == {1: len(set(needles)) - 1, 2: 1}


def test_shards_hold_all():
    wanted = [("ab", "c"), ("d",), ("x" * 50,), ("e",), ("f", "g")]
    for most in (1, 3, 10, 1000):
        got = list(shards_of(wanted, most))
        assert [w for s in got for w in s] == wanted and all(len(s) == 1 or sum(len(p) for w in s for p in w) <= most for s in got)
