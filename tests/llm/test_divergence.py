"""Source divergences against exact counting in Python; the tokenizer's hashes, groups and cuts by themselves."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cartulary.llm import divergence as d

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(rows, least=10, top=10):
    docs = [(la or "", s or "", [t.translate(LOW) for t in TERM.findall(x or "")]) for x, la, s in rows]
    out = []
    for lang in {x[0] for x in docs}:
        mine = [x for x in docs if x[0] == lang]
        seen = Counter(t for _, _, ts in mine for t in set(ts))
        kept = sorted((t for t, k in seen.items() if k >= least), key=str.encode)
        whole = Counter(t for _, _, ts in mine for t in ts)
        count = {s: Counter() for _, s, _ in mine}
        for _, s, ts in mine:
            count[s].update(ts)
        p = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        q, of = p(whole), {s: p(c) for s, c in count.items()}
        for s in count:
            pairs = sorted(((-sum(f(of[s][t], of[o][t]) for t in kept), o.encode(), o) for o in count if o != s))
            terms = sorted((-f(of[s][t], q[t]), t.encode(), t) for t in kept if count[s][t] and of[s][t] > q[t])[:top]
            out += [(lang, s, part, x[2], -x[0], i + 1) for part, xs in (("pair", pairs), ("term", terms)) for i, x in enumerate(xs)]
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_against_exact_counting(spark, seed):
    r = random.Random(seed)
    words = ["The", "the", "é", "É", "naïve", "x", "中文", "don't", "a_b", "B", "Z1z", "🙂"] + [f"w{'abcdefghij'[k % 10]}{'klmnop'[k % 6]}" for k in range(40)]
    rows = [(None if r.random() < 0.05 else " ".join(r.choices(words, k=r.choice([0, 1, 5, 60]))), r.choice(["en", "en", None, "", "de"]), r.choice(["a", "b", None, "", "Ü", "hot", "hot"])) for _ in range(250)]
    rows += [("rare only once", "xx", "a"), (None, "xx", "b"), ("", "yy", "c")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    want = audit(rows)
    for entries, tile in ((1 << 15, 256), (7, 256), (20, 2), (1 << 15, 4)):
        assert sorted(tuple(x) for x in d.audit_sources(docs, entries=entries, tile=tile).collect()) == want
    assert {x[2] for x in want} == {"pair", "term"}


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("lang", F.lit("en")).withColumn("source", F.when(F.col("doc_id") > 5, "s")).withColumn("term", F.lit(1))
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert sorted(tuple(x) for x in d.audit_sources(docs, least_docs=2).collect()) == audit(rows, 2)
    assert d.audit_sources(no_docs.withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))).isEmpty()


def test_hashes_are_those_of_the_library():
    r = random.Random(1)
    parts = [r.randbytes(n) for n in [*range(1, 70), 200, 5000]]
    data = np.frombuffer(b"".join(parts), np.uint8)
    length = np.array([len(p) for p in parts])
    start = np.cumsum(length) - length
    assert d.slice_hashes(data, start, length).tolist() == [xxhash.xxh64_intdigest(p) for p in parts]


@pytest.mark.parametrize("bits", [0, 1, 3, 64])
def test_slices_of_one_hash_are_compared(bits):
    r = random.Random(bits)
    parts = [r.choice(["a", "b", "ab", "ba", "abc", "x" * 40, "x" * 39 + "y"]).encode() for _ in range(400)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    length = np.array([len(p) for p in parts])
    start = np.cumsum(length) - length
    weak = lambda *a: d.slice_hashes(*a) & np.uint64(2**bits - 1)
    term, first = d.group_slices(data, start, length, weak)
    assert [parts[first[t]] for t in term] == parts and len(first) == len(set(parts))


@pytest.mark.parametrize("most", [1, 5, 64, 10**6])
def test_long_texts_are_cut_between_terms_and_count_once(most):
    r = random.Random(most)
    texts = [" ".join(r.choices(["aa", "Bb", "é", "c"], k=n)) for n in (0, 1, 500, 3, 0, 2000)] + [None, "x" * 300, "z"]
    batch = pa.record_batch([pa.array(texts, pa.string()), pa.array(["en"] * len(texts)), pa.array(["s"] * len(texts))], names=["text", "lang", "source"])
    n, docs = Counter(), Counter()
    for out in d.count_terms(iter([batch.slice(1), batch.slice(0, 1)]), most):
        for row in out.to_pylist():
            n[row["term"]] += row["n"]
            docs[row["term"]] += row["docs"]
    found = [[t.translate(LOW) for t in TERM.findall(t or "")] for t in texts]
    assert +n == Counter(t for f in found for t in f) and +docs == Counter(t for f in found for t in set(f))


def test_shares_are_exact():
    for count, total in ((0, 4), (10**12, 3 * 10**12), (7 * 10**14, 9 * 10**14 + 7), (5, 7)):
        assert int(d.share(np.array([count]), total)[0]) == 1 + 10**9 * (count + 2) // total
