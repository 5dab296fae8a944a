import random
import re
from collections import Counter

from cartulary.llm.quality import keep_good, score_quality
from tests.llm.conftest import prose

GAP = "[^\x20\x09-\x0d]"


def brute(text):
    w = re.findall(f"{GAP}+", text)
    runs = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if runs[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(GAP, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts(spark):
    r = random.Random(1)
    texts = [prose(k, r.randint(1, 150)) for k in range(40)]
    texts += [" ".join(r.choice("ab c# \n|\t") for _ in range(r.randint(0, 80))) for _ in range(60)] + ["a a a a a", "a b a b a b", "x y  z", "\r\n\x0b\x0c", "é # é # é #"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for x in score_quality(df).collect():
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == brute(texts[x.doc_id]), texts[x.doc_id]
        assert x.base_failed == (x.n_words < 50 or 100 * x.n_repeat_words > 50 * x.n_words)
        assert x.kept == (not x.base_failed and not x.broken_rules)


def test_odd_documents(odd_docs, no_docs):
    got = score_quality(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(x.base_failed and x.n_words == 0 for x in got if x.doc_id in (1, 2, 3))
    assert next(x for x in got if x.doc_id == 5).n_words == 40_000
    kept = keep_good(odd_docs)
    assert kept.columns == odd_docs.columns and keep_good(no_docs).count() == 0


def test_kinds(spark):
    good = " ".join(f"the {w} of" for w in prose(3, 60).split())
    bad = [good.replace(" ", "*** "), good.upper().replace(" ", "!! "), " | ".join(prose(4, 200).split()), "word " * 100, "the and of"]
    df = spark.createDataFrame(list(enumerate([good, *bad])), "doc_id bigint, text string")
    assert [x.doc_id for x in keep_good(df).collect()] == [0]
