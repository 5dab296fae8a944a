import random
from collections import defaultdict

import pytest

from cartulary.llm.line_dedup import chunk_lines, dedup_lines
from tests.llm.conftest import prose

KINDS = "doc_id bigint, text string"


def words(line):
    return len(line.encode().split())


def brute(rows):
    """The rule over plain dictionaries of line tuples; only the boundary's hash is the operator's own."""
    split = {(d, t): [x for x in t.split("\n") if words(x)] for d, t in rows}
    hashed = {k: chunk_lines([x.encode() for x in v]) for k, v in split.items()}
    where = defaultdict(set)
    for k, lines in split.items():
        for i, j in hashed[k]:
            assert sum(map(words, lines[i : j + 1])) >= 20
            where[tuple(lines[i : j + 1])].add((k[0], k[1], i))
    order = {}
    for d, t in rows:
        order.setdefault(d, set()).add(t)
    assert all(len(v) == 1 for v in order.values()), "ids are unique here, so that the order among texts doesn't matter"
    gone = defaultdict(set)
    for chunk, places in where.items():
        for d, t, i in places - {min(places)}:
            gone[d, t].update(range(i, i + len(chunk)))
    out = {}
    for d, t in rows:
        kept, u, out_now = [], -1, False
        for line in t.split("\n"):
            if words(line):
                u += 1
                out_now = u in gone[d, t]
            if not out_now:
                kept.append(line)
        out[d] = "\n".join(kept)
    return out


def run(spark, rows):
    return {r.doc_id: r for r in dedup_lines(spark.createDataFrame(rows, KINDS)).collect()}


def test_against_brute_force(spark):
    shared = prose(1, 120)
    passage = " ".join(prose(2, 70).split())
    rows = [(k, prose(10 + k, 100)) for k in range(20)]
    rows += [(100 + k, prose(200 + k, 60) + "\n" + (shared if k % 2 else passage) + "\n\n \n" + prose(300 + k, 60)) for k in range(12)]
    rows += [(500, rows[3][1]), (501, rows[3][1] + "\n" + prose(999, 30)), (502, passage + "\n" + passage), (503, "\n".join([prose(77, 30, 30)] * 9))]
    got = run(spark, rows)
    assert {d: r.text for d, r in got.items()} == brute(rows)
    assert sum(passage in r.text for r in got.values()) == 1
    assert got[500].dedup.emptied and not got[3].dedup.emptied and got[3].text == rows[3][1]
    assert got[503].text == prose(77, 30, 30)
    assert all(r.dedup.n_removed == 0 for d, r in got.items() if d < 20)
    assert all(r.text == rows[20 + d - 100][1].replace(passage + "\n\n \n", "").replace(shared + "\n\n \n", "") for d, r in got.items() if 102 <= d < 112)
    assert got[102].dedup.n_single == 3 and got[103].dedup.n_single == 0 and got[103].dedup.n_removed == 12


@pytest.mark.parametrize("lines", [1, 2, 3, 4, 5, 6])
def test_short_passages_in_any_context(spark, lines):
    """Passages of 51 to 60 words in whole lines are found whatever stands around them, and every word of them stays once."""
    r = random.Random(lines)
    rows, planted = [], []
    for k in range(12):
        n = r.randint(51, 60)
        cuts = sorted(r.sample(range(1, n), lines - 1))
        w = prose(4000 + 100 * lines + k, n).split()
        passage = "\n".join(" ".join(w[a:z]) for a, z in zip([0, *cuts], [*cuts, n], strict=True))
        planted.append(passage)
        rows += [(10 * k + c, "\n".join([prose(r.random(), 40, r.randint(3, 30)), passage, prose(r.random(), 40, r.randint(3, 30))])) for c in range(3)]
    got = run(spark, rows)
    assert {d: x.text for d, x in got.items()} == brute(rows)
    for k, passage in enumerate(planted):
        assert got[10 * k].text == rows[3 * k][1]
        for c in (1, 2):
            left = [x for x in passage.split("\n") if x in got[10 * k + c].text.split("\n")]
            assert sum(map(words, left)) < 20, left


def test_every_removed_line_stays_once(spark):
    r = random.Random(5)
    pool = [prose(k, r.randint(4, 50), 60) for k in range(40)]
    rows = [(k, "\n".join(r.choices(pool, k=r.randint(3, 14)))) for k in range(60)]
    got = run(spark, rows)
    assert {d: x.text for d, x in got.items()} == brute(rows)
    assert {x for _, t in rows for x in t.split("\n")} == {x for v in got.values() for x in v.text.split("\n") if x}


def test_one_id_under_several_texts(spark):
    shared, other = prose(1, 150), prose(2, 150)
    rows = [(4, shared), (5, shared), (5, other), (5, other), (6, other + "\n" + prose(3, 30)), (None, other), (None, prose(9, 80))]
    got = sorted((r.doc_id or 99, r.text) for r in dedup_lines(spark.createDataFrame(rows, KINDS)).collect())
    assert got == sorted([(4, shared), (5, ""), (5, other), (5, other), (6, prose(3, 30)), (99, ""), (99, prose(9, 80))])


def test_boundaries_resist_shifts():
    lines = [x.encode() for x in prose(4, 1200).split("\n")]
    keys = set(chunk_lines(lines).values())
    moved = set(chunk_lines([b"new line", *lines[:50], b"another", *lines[50:]]).values())
    assert len(keys & moved) >= len(keys) - 8 and len(keys - moved) <= 8


@pytest.mark.parametrize("kind", ["odd", "none"])
def test_odd_documents(odd_docs, no_docs, kind):
    df = odd_docs if kind == "odd" else no_docs
    out = dedup_lines(df)
    assert out.columns == [*df.columns, "dedup_"]
    rows = out.collect()
    assert len(rows) == df.count()
    if kind == "odd":
        by = {r.doc_id: r for r in rows}
        assert by[1].text is None and by[2].text == "" and not by[1].dedup_.emptied and not by[2].dedup_.emptied
        assert by[7].dedup_.emptied and by[6].text and by[5].dedup_.n_removed == 0
        assert all(r.key == "x" and r._row == "k" for r in rows)


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_filter_decides_nothing(spark, monkeypatch, bits):
    """A full filter, which lets every document through, gives the same texts."""
    from cartulary.llm import common

    monkeypatch.setattr(common, "FILTER_BITS", bits)
    shared = [prose(k, 130, line=7) for k in range(6)]
    rows = [(k, prose(10 + k, 90, line=7) + "\n" + shared[k % 6] + "\n" + prose(300 + k, 90, line=7)) for k in range(30)]
    got = {d: r.text for d, r in run(spark, rows).items()}
    assert got == brute(rows)
    assert got[0] == rows[0][1] and all(len(got[k]) < len(rows[k][1]) - len(shared[k % 6]) + 1 for k in range(6, 30))


def test_long_text_of_short_and_blank_lines(spark):
    text = "\n".join(["a"] * 20_000 + [""] * 20_000 + ["b c"] * 5)
    got = run(spark, [(1, text), (2, "x"), (3, text)])
    assert got[1].text == "\n".join(["a"] + ["b c"] * 5) and got[3].dedup.emptied and got[3].text == ""


