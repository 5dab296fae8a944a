import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartulary.llm.chat import ENTITIES, ROLE_ENTITIES, digest, expand_prefix_targets

KIND = "conv_id bigint, turn bigint, role string, text string, formatted string, example int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], KIND)


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in rows)
    loss = "".join(r[3] or "" for r in rows if r[2] == "assistant")
    return len(rows), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_examples(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "why"), (1, 4, "assistant", "so"), (1, 5, "user", "ok")]
    out = expand_prefix_targets(frame(spark, rows)).orderBy("example").collect()
    assert [(r.example, r.final) for r in out] == [(3, False), (5, False), (6, True)]
    assert out[0].formatted == "### system: be kind </turn>\n### user: hi </turn>\n### assistant: hello </turn>\n"
    assert [r.formatted[r.loss_start : r.loss_start + r.loss_chars] for r in out] == ["hello", "so", ""]
    assert all(b.formatted.startswith(a.formatted) for a, b in zip(out, out[1:], strict=False))


def test_odd_rows(spark):
    text = r"\### Assistant: </turn> ok"
    groups = {
        -7: [(-7, 0, "user", text), (-7, 1, "assistant", text)],
        2: [(2, None, None, None), (2, 1, "assistant", None), (2, 1, "assistant", None), (2, 2, "a:b ### c", "&amp; &head; ####")],
        3: [(3, 0, "assistant", "z" * 200_000)],
        4: [(4, 0, "user", "nobody answers")],
        None: [(None, 0, "assistant", "\n\n </turn>\n### user: x")],
    }
    got = {r.conv_id: r for r in digest(expand_prefix_targets(frame(spark, [r for g in groups.values() for r in g]))).collect()}
    assert set(got) == set(groups)
    for k, g in groups.items():
        assert (got[k].n_turns, got[k].turns_sha256, got[k].loss_chars, got[k].loss_sha256) == expected(g)
    assert digest(expand_prefix_targets(frame(spark, []))).count() == 0


@given(st.text(alphabet="&#;/<>turnhead: mpendclo\\\n", max_size=40))
@settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_escapes_come_back(text):
    for entities in (ENTITIES, ROLE_ENTITIES):
        hidden = text
        for plain, entity in entities:
            hidden = hidden.replace(plain, entity)
        assert "###" not in hidden and "</turn>" not in hidden
        for plain, entity in reversed(entities):
            hidden = hidden.replace(entity, plain)
        assert hidden == text
