import random

import pytest

from cartulary.llm import common, jaccard
from cartulary.llm.jaccard import keep_one, link_documents
from tests.llm.conftest import prose


def brute(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    return sorted((d, len(sets[i]), min(least[find(i)])) for i, (d, _) in enumerate(rows))


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else f"new{seed}x{k}" for k, w in enumerate(text.split()))


@pytest.mark.parametrize("seed", range(2))
def test_all_links(spark, seed):
    r = random.Random(seed)
    texts = [prose(1000 * seed + k, r.choice([3, 5, 8, 40, 120, 300])) for k in range(60)]
    hot = prose(77, 150)
    texts += [edited(hot, k, r.choice([0.0, 0.005, 0.02, 0.04, 0.06])) for k in range(120)]
    texts += [edited(t, k, r.choice([0.01, 0.03])) for k, t in enumerate(texts[:60])]
    texts += [r.choice(texts) for _ in range(30)] + [hot + "\n" + prose(900 + k, 45) for k in range(20)] + ["", None, "a b", "A  B", "a b c d e", "Ä b", "ä b"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for parts in (1, 5):
        assert sorted(map(tuple, link_documents(df.repartition(parts)).collect())) == brute(rows)


def test_odd_documents(odd_docs, no_docs):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in link_documents(odd_docs).collect()), key=str)
    by_id = {g[0]: g for g in got}
    assert len(got) == odd_docs.count()
    assert [by_id[k][1:] for k in (1, 2, 3, 4)] == [(0, 1), (0, 2), (0, 3), (1, 4)]
    assert by_id[7][2] == by_id[6][2] == 6
    assert link_documents(no_docs).count() == 0
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 5, 6, 6, 9]


def test_one_id_under_several_texts(spark):
    """Every row has the component of its own text, though classes share their least id."""
    a, b, x = prose(1, 100), prose(2, 100), prose(3, 60)
    rows = [(5, a), (5, b), (5, x), (7, edited(b, 1, 0.01)), (8, edited(a, 2, 0.01)), (9, edited(a, 3, 0.01)), (9, x), (9, x), (12, prose(4, 70))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, link_documents(df).collect())) == brute(rows)
    kept = sorted(map(tuple, keep_one(df).collect()))
    assert kept == sorted([(5, a), (5, b), (5, x), (12, prose(4, 70))])


def test_rows_without_id(spark):
    a = prose(1, 100)
    rows = [(None, a), (4, edited(a, 1, 0.01)), (None, prose(2, 90)), (None, prose(2, 90)), (None, edited(prose(2, 90), 1, 0.01)), (None, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.component_id) for r in link_documents(df).collect()), key=str)
    assert got == sorted([(None, 4), (4, 4)] + [(None, None)] * 4, key=str)
    assert len([r for r in keep_one(df).collect() if r.text]) in (2, 3)  # the pair's smaller text hash, which may be the repeated row


def test_buckets_grow_with_the_texts(spark):
    buckets, partitions = jaccard.bucket_count(spark, 100 << 40)
    assert (100 << 40) / buckets <= jaccard.BUCKET_BYTES * 1.01 and buckets / partitions <= jaccard.BUCKETS * 1.01


def test_hot_keys_meet_in_blocks(spark):
    r = random.Random(3)
    x = spark.createDataFrame([(k, 7 if r.random() < 0.5 else r.randrange(9), r.randrange(2)) for k in range(200)], "x int, token int, size int")
    y = spark.createDataFrame([(k, 7 if r.random() < 0.5 else r.randrange(12), r.randrange(3)) for k in range(150)], "y int, token int, size int")
    want = sorted(tuple(t) for t in x.join(y, ["token", "size"]).select("token", "size", "x", "y").collect())
    for most in (1, 7, 10**6):
        assert sorted(tuple(t) for t in jaccard.meet_in_blocks(x, y, ["token", "size"], most).select("token", "size", "x", "y").collect()) == want


@pytest.mark.parametrize("blocks", [1, 3])
def test_links_with_small_blocks(spark, monkeypatch, blocks):
    monkeypatch.setattr(jaccard, "PAIR_ROWS", blocks)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(common, "HEAVY_SHARE", 10)
    r = random.Random(blocks)
    hot = prose(5, 90)
    rows = list(enumerate([edited(hot, k, r.choice([0.0, 0.02, 0.05, 0.08])) for k in range(60)] + [prose(k, 60) for k in range(20)]))
    assert sorted(map(tuple, link_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())) == brute(rows)


def test_components_of_hubs(spark, monkeypatch):
    monkeypatch.setattr(common, "HEAVY_SHARE", 10)
    r = random.Random(9)
    edges = [(5, k) for k in range(6, 2000)] + [(k, 3000) for k in range(1, 5)] + [(r.randrange(2000, 4000), r.randrange(2000, 4000)) for _ in range(700)] + [(1500, 1500), (4001, 4001), (9, 5), (5, 9)]
    edges += [(5000 + k, 5001 + k) for k in range(40)]
    root = {}

    def find(a):
        root.setdefault(a, a)
        while root[a] != a:
            a = root[a]
        return a

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    want = sorted((k, find(k)) for k in root)
    got = sorted(map(tuple, common.components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()))
    assert got == want
