import gc
import itertools
import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cartulary.llm.packing import Units, pack_documents, plan_cuts
from cartulary.llm.queries import tokenizer_path
from tests.llm.conftest import prose


def cost(cuts, pos, pen, window):
    at, total, before = dict(zip(pos, pen, strict=True)), 0, 0
    for c in cuts:
        n = c - before
        if n > window:
            return None
        total += (0 if n & (n - 1) == 0 else window - n) + at[c]
        before = c
    return total


@pytest.mark.parametrize("seed", range(20))
def test_cuts_are_the_cheapest(seed):
    r = random.Random(seed)
    pos = list(itertools.accumulate(r.randint(1, 6) for _ in range(11)))
    pen = [r.choice([0, 2, 9]) for _ in pos]
    best = min(c for k in range(len(pos)) for some in itertools.combinations(pos[:-1], k) if (c := cost([*some, pos[-1]], pos, pen, 16)) is not None)
    assert cost(plan_cuts(pos, pen, 16), pos, pen, 16) == best


def check(rows, texts, window=4096):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for doc_id, some in pieces.items():
        ids = np.array([*t.encode(texts[doc_id] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        by_start = defaultdict(list)
        for r in some:
            by_start[r.start].append(r)
            assert r.doc_tokens == len(ids) and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        copies = {len(v) for v in by_start.values()}
        assert sum(r.length for r in some) % len(ids) == 0 and copies
    for some in sequences.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window


def test_odd_documents(spark, odd_docs):
    check(pack_documents(odd_docs, tokenizer_path()).collect(), {r.doc_id: r.text for r in odd_docs.collect()})


def test_little_padding_and_order(spark):
    texts = {i: prose(i, 50 + 37 * i % 900) for i in range(300)}
    rows = pack_documents(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").coalesce(1), tokenizer_path()).collect()
    check(rows, texts)
    assert [r.doc_id for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset))] == sorted(r.doc_id for r in rows)
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    padding = sum(4096 - n for n in list(used.values())[:-1] if n & (n - 1))  # none at a power of two
    assert padding < 0.02 * sum(used.values())


def test_empty_table(no_docs):
    assert pack_documents(no_docs, tokenizer_path()).count() == 0


def test_known_units_take_little_memory():
    """Spark keeps several workers, and each keeps its units from task to task."""
    units, r = Units(tokenizer_path()), random.Random(1)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(100_000)]
    hard = ["it's " + " ".join(words[:500])]  # its words are first met in a text that goes whole
    texts = hard + [" ".join(words[k : k + 1000]) + "." for k in range(0, len(words), 1000)]
    ids = [np.array(units.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    tracemalloc.start()
    try:
        got = [out for k in range(0, len(texts), 20) for out, _ in units.encode(texts[k : k + 20])]
        again = [out for out, _ in units.encode(texts[::-1])][::-1]
        same = got == ids, again == ids
        del got, again
        gc.collect()
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert same == (True, True)
    assert len(units.known) >= len(set(words)) and held < 100 * len(units.known)
