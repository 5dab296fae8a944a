from __future__ import annotations

import random

import pytest

WORDS = [a + b for a in ("al", "be", "co", "du", "er", "fo", "gi") for b in ("na", "me", "ti", "ro", "su", "la", "ki", "po")]


def prose(seed: int, words: int, line: int = 12) -> str:
    r = random.Random(seed)
    some = [r.choice(WORDS) + r.choice(["", "", r.choice(WORDS)]) for _ in range(words)]
    some = [w + ("." if k % 9 == 8 else "") for k, w in enumerate(some)]
    return "\n".join(" ".join(some[k : k + line]) for k in range(0, words, line))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns whose names clash with working columns."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, prose(5, 40_000)), (6, prose(6, 200)), (6, prose(6, 200)), (7, prose(6, 200)), (None, prose(8, 60)), (9, "naïve café 中文 🙂 \x00 'quoted' don't")]
    more = "n int, key string, tokens array<int>, score double, _row string, bucket int, block string, row int, d string, h int, _m int, _gone string, _n_lines int, dedup string, cuts int, item_id int, k string, kept int, n_words string"
    rows = [(i, t, 1, "x", [1], 2.0, "k", 3, "r", 1, "d", 2, 3, "g", 4, "e", 5, 6, "k", 7, "w") for i, t in rows]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, {more}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
