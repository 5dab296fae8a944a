import random

import numpy as np
import pytest

from cartulary.llm.alignment import align
from cartulary.llm.decontamination import drop_contaminated, find_contamination
from tests.llm.conftest import prose

MATCH, MISMATCH, GAP = 2, -1, -1


def table(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1][j + 1] = max(0, h[i][j] + (MATCH if x == y else MISMATCH), h[i][j + 1] + GAP, h[i + 1][j] + GAP)
    return max(map(max, h))


def test_alignment_against_plain_tables():
    r = random.Random(2)
    for _ in range(300):
        a, b = ([r.choice([1, 2, 3, 4]) for _ in range(r.randint(1, 12))] for _ in range(2))
        x, y = np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)
        score, same, first, last = align(x, y)
        assert score == table(a, b)
        if score:
            assert b[first] in a and b[last] in a and table(a, b[first : last + 1]) == score and same <= last - first + 1
        assert align(x, y, -len(a), len(b))[0] == score
        low = r.randint(-5, 5)
        assert align(x, y, low, low + 3)[0] <= score


def corpus(spark):
    items = [(k, prose(500 + k, 15 + k)) for k in range(12)] + [(90, None), (91, ""), (92, "rare")]
    docs = [(k, prose(k, 150)) for k in range(60)]
    r = random.Random(1)
    for k in range(12):
        words = items[k][1].split()
        edited = [w if r.random() > 0.15 else "other" for w in words]
        del edited[len(edited) // 2]
        docs.append((100 + k, prose(100 + k, 80) + "\n" + items[k][1].upper() + "! " + prose(200 + k, 40)))
        docs.append((200 + k, prose(300 + k, 80) + " " + " ".join(edited) + " " + prose(400 + k, 40)))
    return docs, spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, doc_id string")


def test_copies_and_edits(spark):
    docs, df, items = corpus(spark)
    got = find_contamination(df, items).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.item_id < 90} == {(b + k, k) for k in range(12) for b in (100, 200)}
    whole = next(r for r in got if (r.doc_id, r.item_id) == (103, 3))
    assert whole.score == 1.0 and (whole.first_word, whole.last_word) == (80, 97)
    assert {r.doc_id for r in drop_contaminated(df, items).collect()} == {d for d, _ in docs if d < 100}


@pytest.mark.parametrize("share", [0.1, 0.2, 0.25, 0.3])
def test_edited_copies_against_exhaustive_alignment(spark, share):
    """Of the pairs that an alignment of every document with every item reports, nine in ten are found, and nothing else."""
    r = random.Random(share)
    items = [(k, prose(900 + k, r.choice([12, 20, 40, 90]))) for k in range(16)]
    docs = []
    for k, (_, text) in enumerate(items):
        for c in range(3):
            words = [w if r.random() > share else "new%d" % r.randrange(10**6) for w in text.split()]
            at = r.randrange(len(words))
            words[at:at] = prose(k + c, r.choice([0, 1, 6])).split()
            docs.append((10 * k + c, " ".join([prose(2000 + 3 * k + c, r.choice([0, 60])), *words, prose(3000 + k, 30)])))
    docs += [(1000 + k, prose(5000 + k, 200)) for k in range(10)]
    number = {}
    coded = lambda t: [number.setdefault(w, len(number)) for w in "".join(c if c.isalnum() else " " for c in t.lower()).split()]
    told = [(i, coded(t)) for i, t in items]
    want = {}
    for d, t in docs:
        b = coded(t)
        for i, a in told:
            score = align(np.array(a), np.array(b))[0]
            if score >= len(a):
                want[d, i] = score / (2 * len(a))
    got = {(x.doc_id, x.item_id): x.score for x in find_contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert set(got) <= set(want) and len(got) >= 0.9 * len(want)
    assert all(abs(want[k] - s) < 1e-9 for k, s in got.items())


def test_long_text_and_scattered_copies(spark):
    """A text of a million words: every item in it is found, and only windows are aligned."""
    items = [(k, prose(700 + k, 40)) for k in range(5)]
    text = "\n".join(prose(9000 + k, 200_000) + " " + items[k][1] for k in range(5))
    df = spark.createDataFrame([(1, text), (1, "short"), (1, items[2][1]), (None, items[3][1]), (None, "other")], "doc_id bigint, text string")
    many = spark.createDataFrame(items, "item_id bigint, text string")
    got = find_contamination(df, many).where("score = 1").collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got) == [(0, 3), (1, 0), (1, 1), (1, 2), (1, 2), (1, 3), (1, 4)]
    assert sorted(r.text for r in drop_contaminated(df, many).collect()) == ["other", "short"]


@pytest.mark.parametrize("seed", range(2))
def test_long_items_with_long_insertions(spark, seed):
    """Items of 100 to 1000 words, up to 200 words put in at one place or several: scored as by an alignment without a band."""
    r = random.Random(seed)
    items = [(k, prose(800 + 10 * seed + k, n)) for k, n in enumerate((100, 150, 230, 300, 400, 520, 700, 1000))]
    docs = []
    for k, (_, text) in enumerate(items):
        for c, pieces in enumerate((1, 3)):
            words = text.split()
            for p in range(pieces):
                at = r.randrange(len(words))
                words[at:at] = prose(7000 + 100 * k + 10 * c + p, 200 // pieces).split()
            docs.append((10 * k + c, " ".join([prose(100 + k + c, 50), *words, prose(300 + k, 50)])))
    number = {}
    coded = lambda t: np.array([number.setdefault(w, len(number)) for w in "".join(x if x.isalnum() else " " for x in t.lower()).split()])
    want = {}
    for d, t in docs:
        for i, a in items:
            score = align(coded(a), coded(t))[0]
            if score >= len(a.split()):
                want[d, i] = score / (2 * len(a.split()))
    got = {(x.doc_id, x.item_id): x.score for x in find_contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert len(want) >= 14 and set(got) == set(want)
    assert all(abs(want[k] - s) < 1e-9 for k, s in got.items())


def test_hot_item_is_found_everywhere(spark):
    _, df, items = corpus(spark)
    text = items.where("item_id = 5").first().text
    many = spark.createDataFrame([(k, prose(k, 30) + " " + text) for k in range(200)], "doc_id bigint, text string")
    assert find_contamination(many, items).where("item_id = 5").count() == 200


def test_odd_documents(spark, odd_docs, no_docs):
    _, _, items = corpus(spark)
    short = items.union(spark.createDataFrame([(93, "one", "x")], items.schema))
    assert [(r.doc_id, r.item_id) for r in find_contamination(odd_docs, short).collect()] == [(4, 93)]
    assert find_contamination(no_docs, items).count() == 0
    assert find_contamination(odd_docs, items.limit(0)).count() == 0
    assert drop_contaminated(odd_docs, short).columns == odd_docs.columns
    assert drop_contaminated(odd_docs, short).count() == odd_docs.count() - 1
