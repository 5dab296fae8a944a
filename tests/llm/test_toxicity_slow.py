"""Toxicity scores and the lexicon against a slow version that goes word by word, and the pipeline's packing stage against the tokenizer."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartulary.llm import toxicity as t
from tests.llm.conftest import prose
from tests.llm.test_packing import check

WORD = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")
MARKS, LIKE = set("0123456789@$!|+(*#%.-_~^=:/\\"), set("0123456789@$!|+(*#")


def letter(c):
    return "a" <= c <= "z" or ord(c) >= 128


def is_disguised(token):
    """A letter beside a mark that may be a letter, a mark between letters, or a letter three times, byte by byte."""
    b = [chr(x) for x in token.encode()] + ["\n", "\n"]
    low = lambda c: "a" <= c <= "z" or ord(c) >= 128
    for x, y, z in zip(b, b[1:], b[2:], strict=False):
        if x in LIKE and low(y) or low(x) and y in LIKE and (low(z) or z in MARKS and y in MARKS) or low(x) and y in MARKS and low(z) or low(x) and ord(x) < 128 and x == y == z:
            return True
    return False


def hidden(text):
    """Disguised tokens and runs of three single characters or more."""
    tokens = [x for x in re.split(r"[ \t-\r]+", text) if x]
    single = [len(x.encode()) == 1 and (letter(x) or x in LIKE) or len(x.encode()) == 2 and x.encode()[0] >= 0xC3 for x in tokens]
    out, k = [x for x in tokens if is_disguised(x)], 0
    while k < len(tokens):
        j = k
        while j < len(tokens) and single[j]:
            j += 1
        if j - k >= 3:
            out.append(" ".join(tokens[k:j]))
        k = max(j, k + 1)
    return out


def slow_score(text, lexicon, model):
    low = (text or "").lower()
    found = set()
    spans = [m.span() for m in WORD.finditer(low)]
    for a, z in spans:
        found |= {e for e in t.entries(low[a:z]) if e in lexicon}
    longest = max((len(k.encode()) for k in lexicon if not k.endswith("~")), default=0)
    for i in range(len(spans)):
        for j in range(i + 1, len(spans)):
            gap = low[spans[j - 1][1] : spans[j][0]]
            pieces = [low[a:z] for a, z in spans[i : j + 1]]
            if len(gap) != 1 or len("".join(pieces).encode()) > longest:
                break
            if "".join(pieces) in lexicon and t.readings(" ".join(pieces), model)[:1] == ["".join(pieces)]:
                found.add("".join(pieces))
    for token in hidden(low):
        found |= {e for e in t.token_entries(token, model, longest) if e in lexicon}
    return 1 - (1 - t.BASE_SCORE) * math.prod(1 - lexicon[f] for f in sorted(found))


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(11)
    rows, labels = [], []
    hide = lambda w: r.choice([w, w, w, w.replace("o", "0").replace("i", "1"), " ".join(w), "-".join(w), w[:3] + " " + w[3:], w + w[-1] * 4, w.upper() + "!"])
    for k in range(700):
        words = prose(k, 50).split()
        toxic = k % 3 == 0
        if toxic:
            words.insert(r.randrange(50), hide(r.choice(["scoundrel", "blockhead", "nitwit", "dummkopf"])))
        words.insert(r.randrange(50), r.choice(["", "a b c", "x-y", "co-op", "1st", "n0t", "ooo", "é è", "www.x.y", "3 4 5", "naïve", "don't"]))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return spark.createDataFrame([*rows, (9001, None), (9002, "")], "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"), dict(rows), dict(labels)


def test_every_score(spark, corpus):
    docs, labels, texts, truth = corpus
    model = t.language_model(docs)
    lexicon = t.fit_lexicon(docs, labels, model)
    assert {"scoundrel", "blockhead", "nitwit"} <= set(lexicon)
    got = {r.doc_id: r.score for r in t.score_toxicity(docs, labels).collect()}
    for k, text in {**texts, 9001: None, 9002: ""}.items():
        assert got[k] == pytest.approx(slow_score(text, lexicon, model), abs=1e-12), (k, text)


def test_the_lexicon(spark, corpus):
    """Counts, precisions and ratios of every entry, by hand: no two labelled rows here are near copies."""
    docs, labels, texts, truth = corpus
    model = t.language_model(docs)
    open_rows = [k for k in truth if zlib.crc32(str(k).encode()) % 4 != 2]
    toxic, clean, sizes = Counter(), Counter(), Counter(truth[k] for k in open_rows)
    for k in open_rows:
        low = texts[k].lower()
        held = {e for w in WORD.findall(low) if len(w) > 2 for e in t.entries(w)}
        for token in hidden(low):
            held |= t.token_entries(token, model, best=1)
        (toxic if truth[k] else clean).update(held)
    q, want = sizes[1] / sum(sizes.values()), {}
    log = lambda x, y: x * math.log(x / y) if x else 0.0
    for e in toxic.keys() | clean.keys():
        a, b = toxic[e], clean[e]
        p = a / (a + b + 0.5)
        if 2 * (log(a, (a + b) * q) + log(b, (a + b) * (1 - q))) >= t.LEAST_RATIO and p >= t.LEAST_PRECISION:
            want[e] = p
    got = t.fit_lexicon(docs, labels, model)
    assert set(got) == set(want) and all(got[e] == pytest.approx(want[e], rel=1e-9) for e in want)


def test_packing_stage(spark, odd_docs, tmp_path):
    """The pipeline's last stage: every id of every document in one piece, in sequences without gaps."""
    docs = odd_docs.where("doc_id is not null").withColumn("lang", F.lit("en"))
    check(corpus_pipeline.packing(spark, docs, str(tmp_path)).collect(), {r.doc_id: r.text for r in docs.collect()})
