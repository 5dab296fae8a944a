import random

import numpy as np
import pytest

from cartulary.llm.alignment import align
from cartulary.llm.licenses import GAP, LEAST_COVERAGE, MATCH, MISMATCH, TEMPLATES, scan_licenses, settled
from tests.llm.conftest import prose

KINDS = "doc_id bigint, text string"


def scan(spark, rows):
    return scan_licenses(spark.createDataFrame(rows, KINDS)).collect()


def brute(rows):
    """Every template aligned with every whole text, again and again with masked places, without fingerprints, windows or bands."""
    number = {}
    out = []
    split = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.lower()).split()
    coded = lambda t: np.array([number.setdefault(w, len(number) + 1) for w in split(t)])
    bodies = [coded(t) for t in TEMPLATES.values()]
    for d, text in rows:
        b, found = coded(text), []
        for k, body in enumerate(bodies):
            free = b.copy()
            while len(free):
                _, same, i, j = align(body, free, None, None, MATCH, MISMATCH, GAP)
                if same < LEAST_COVERAGE * len(body):
                    break
                found.append((k, len(body), same, i, j))
                free[i : j + 1] = 0
        out += [(d, list(TEMPLATES)[k], same) for k, _, same, _, _ in settled(found)]
    return sorted(out)


def test_every_template_is_found_where_it_is(spark):
    rows, where = [], {}
    for k, (name, text) in enumerate(TEMPLATES.items()):
        before = "İé " + prose(k, 50) + "\n"
        rows.append((k, before + text + "\n" + prose(k + 100, 50)))
        where[k, name] = (len(before), len(before) + len(text.rstrip(".")))
    got = scan(spark, rows)
    assert {(r.doc_id, r.license) for r in got} == set(where) and len(got) == len(where)
    for r in got:
        begin, end = where[r.doc_id, r.license]
        assert r.coverage == 1.0 and r.start_char == begin and abs(r.end_char - end) <= 2


@pytest.mark.parametrize("seed", range(3))
def test_against_exhaustive_alignment(spark, seed):
    """Random edits, one insertion of 1 to 40 words, and copies back to back."""
    r = random.Random(seed)
    names, rows = list(TEMPLATES), []
    for k in range(40):
        parts = [prose(r.random(), r.choice([0, 3, 30, 200]))]
        for _ in range(r.choice([1, 1, 2, 3])):
            words = [w if r.random() > r.choice([0, 0.03, 0.08, 0.15]) else r.choice(["", "other"]) for w in TEMPLATES[r.choice(names)].split()]
            at = r.randrange(len(words))
            words[at:at] = prose(r.random(), r.choice([0, r.randint(1, 40)])).split()
            parts.append(" ".join(words))
            parts += [prose(r.random(), r.randint(1, 30))] * r.randint(0, 1)
        rows.append((k, "\n".join(parts)))
    got = sorted((x.doc_id, x.license, x.matched_words) for x in scan(spark, rows))
    want = brute(rows)
    assert len(want) > 30
    missed = set(want) - set(got)
    assert len(missed) <= 0.03 * len(want) and set(got) - set(want) <= {g for g in got if g[:2] in {m[:2] for m in missed}}, (missed, set(got) - set(want))


def test_probes(spark):
    mit, note = TEMPLATES["MIT"].split(), TEMPLATES["MIT-notice"]
    long_insert = " ".join(mit[:80] + prose(3, 40).split() + mit[80:])
    gpl = TEMPLATES["GPL-3.0-notice"]
    rows = [
        (1, note + "\n" + note), (2, long_insert), (3, f"é {gpl}\n{prose(5, 60)}\n{gpl}"), (4, "free software license under the terms of"),
        (5, f"{note} {TEMPLATES['CC-BY-4.0-notice']} {TEMPLATES['CC-BY-NC-4.0-notice']}"), (6, prose(6, 400)), (7, TEMPLATES["BSD-2-Clause"]), (8, TEMPLATES["BSD-3-Clause"]),
        (9, "terms " * 3 + TEMPLATES["ISC"]), (10, "\n".join([gpl] * 300)), (11, " ".join(w for i, w in enumerate(mit) if i % 17 != 5).upper()),
    ]
    got = sorted((r.doc_id, r.license) for r in scan(spark, rows))
    assert got == sorted(
        [(1, "MIT-notice")] * 2 + [(2, "MIT"), (5, "CC-BY-4.0-notice"), (5, "CC-BY-NC-4.0-notice"), (5, "MIT-notice"), (7, "BSD-2-Clause"), (8, "BSD-3-Clause"), (9, "ISC"), (11, "MIT")]
        + [(3, "GPL-3.0-notice")] * 2 + [(10, "GPL-3.0-notice")] * 300
    )


def test_odd_documents(odd_docs, no_docs):
    assert scan_licenses(odd_docs).count() == 0 and scan_licenses(no_docs).count() == 0
