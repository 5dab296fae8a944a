import random

import numpy as np
import pytest

from cartulary.llm.toxicity import CODES, language_model, letter_codes, readings, score_toxicity
from tests.llm.conftest import prose

BAD = ["scoundrel", "blockhead", "nitwit"]


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(3)
    rows, labels = [], []
    for k in range(900):
        words = prose(k, 60).split()
        toxic = k % 4 == 0
        if toxic:
            words.insert(r.randrange(60), r.choice(BAD))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    extra = {1001: "sc0undrel", 1002: "b l o c k h e a d", 1003: "n1tw1t", 1004: "nitwiiit!", 1005: "n.i.t.w.i.t", 1006: "kind words", 1007: "5 6 7 8 m o"}
    rows += [(k, f"{prose(k, 20)} {w} {prose(k + 1, 20)}") for k, w in extra.items()] + [(2001, None), (2002, ""), (2003, prose(9, 30_000))]
    return spark.createDataFrame([(*r, 1.0, "en") for r in rows], "doc_id bigint, text string, score double, lang string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_scores(corpus):
    docs, labels = corpus
    got = {r.doc_id: r for r in score_toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [k for k in truth if got[k].held_out]
    assert 150 < len(held) < 300
    assert sum(got[k].predicted == truth[k] for k in held) >= 0.97 * len(held)
    assert [got[k].predicted for k in range(1001, 1008)] == [1, 1, 1, 1, 1, 0, 0]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert got[2001].predicted == got[2002].predicted == got[2003].predicted == 0


def test_no_labels_and_no_documents(corpus):
    docs, labels = corpus
    assert {r.predicted for r in score_toxicity(docs, labels.limit(0)).collect()} == {0}
    assert score_toxicity(docs.limit(0), labels).count() == 0


def test_viterbi_is_exact(corpus):
    """The best reading is the one that a search of all readings finds."""
    import itertools

    from cartulary.llm.toxicity import lattice

    model = language_model(corpus[0])
    for token in ("n1tw1t", "sc0und", "b.l0ck", "aa1!b"):
        best = None
        for choice in itertools.product(*lattice(token)):
            text, score = "".join(c for c, _ in choice), sum(s for _, s in choice)
            codes = np.concatenate([[0, 0], letter_codes(text), [0]]).astype(int)
            score += sum(model[a, b, c] for a, b, c in zip(codes, codes[1:], codes[2:], strict=False))
            if text and (best is None or score > best[0]):
                best = (score, text)
        assert readings(token, model)[0] == best[1]
    assert model.shape == (CODES, CODES, CODES)


def predicted(spark, corpus, texts):
    docs, labels = corpus
    more = spark.createDataFrame([(9000 + k, f"{prose(k, 20)} {w} {prose(k + 1, 20)}", 1.0, "en") for k, w in enumerate(texts)], docs.schema)
    got = {r.doc_id: r.predicted for r in score_toxicity(docs.union(more), labels).where("doc_id >= 9000").collect()}
    return [got[9000 + k] for k in range(len(texts))]


def test_spaces(spark, corpus):
    """Spaces are kept or deleted: after a word of one letter, two words in a row, words in pieces."""
    texts = ["a n i t w i t", "I n i t w i t", "k i n d b l o c k h e a d", "scound rel", "ni tw it", "nit.wit", "k i n d w o r d", "kind words"]
    assert predicted(spark, corpus, texts) == [1, 1, 1, 1, 1, 1, 0, 0]


def test_long_tokens(spark, corpus):
    """Tokens of more than 64 bytes and runs of more than 64 letters are decoded to their end."""
    spelled = " ".join("".join(prose(70, 30).split()) + "nitwit" + "".join(prose(71, 30).split())).replace(".", "")
    clean = " ".join("".join(prose(72, 60).split())).replace(".", "")
    chained = "_".join([*prose(73, 25).replace(".", "").split(), "blockhead", *prose(74, 25).replace(".", "").split()])
    texts = [spelled, "nit" + "w" * 80 + "it", " ".join("nit" + "w" * 80 + "it"), chained, clean, "_".join(prose(75, 60).replace(".", "").split())]
    assert len(chained) > 300 and len(spelled) > 300
    assert predicted(spark, corpus, texts) == [1, 1, 1, 1, 0, 0]


def test_disguises_beside_single_letters(spark, corpus):
    texts = ["you are a s c o u n d r e l", "i a m s c o u n d r e l o k", "y o u s c o u n d r e l", "sc0undrel" + "!" * 60, "k i n d " * 12 + "s c o u n d r e l", "you are a k i n d man", "n o t h i n g here"]
    assert predicted(spark, corpus, texts) == [1, 1, 1, 1, 1, 0, 0]


def test_small_vocabulary(spark):
    """Texts of few different words aren't taken for copies of one another."""
    r = random.Random(1)
    some = prose(1, 12).replace(".", "").split()
    rows = []
    for k in range(400):
        words = r.choices(some, k=30)
        if k % 4 == 0:
            words[r.randrange(30)] = "scoundrel"
        rows.append((k, " ".join(words)))
    labels = [(k, int(k % 4 == 0)) for k in range(400)]
    rows += [(900, f"{rows[1][1]} sc0undrel"), (901, f"{rows[2][1]} s c o u n d r e l"), (902, rows[3][1])]
    got = {x.doc_id: x.predicted for x in score_toxicity(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    assert [got[k] for k in (900, 901, 902)] == [1, 1, 0]


def test_copies_share_a_key():
    from cartulary.llm.toxicity import alike_keys
    from cartulary.llm.wordhash import NOT_WORD, Words

    text = prose(5, 300)
    texts = [text, text, text + " and more", prose(6, 300), "a b", "a b", "b a", "", ""]
    keys = alike_keys(Words([t.encode() for t in texts], NOT_WORD), len(texts))
    assert keys[0] == keys[1] == keys[2] != keys[3] and keys[4] == keys[5] != keys[6] and keys[7] == keys[8]


def test_odd_rows(spark, corpus, odd_docs):
    """Rows without an id are scored and never held out; rows that repeat are scored each; labels without an id or value are passed over."""
    docs, labels = corpus
    more = spark.createDataFrame([(None, "you scoundrel"), (None, "kind"), (3, "you scoundrel"), (3, "you scoundrel")], "doc_id bigint, text string")
    odd = labels.union(spark.createDataFrame([(None, 1, 1), (5000, 1, None)], labels.schema))
    got = [r for r in score_toxicity(docs.select("doc_id", "text").union(more), odd).collect() if r.doc_id is None or r.doc_id == 3]
    assert sorted((r.doc_id or 0, r.predicted) for r in got) == [(0, 0), (0, 1), (3, 0), (3, 1), (3, 1)]
    assert all(r.held_out is (r.doc_id == 3 and __import__("zlib").crc32(b"3") % 4 == 2) for r in got)
    assert score_toxicity(odd_docs, labels).count() == odd_docs.count()
