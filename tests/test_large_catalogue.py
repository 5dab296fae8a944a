"""Catalogue documents cut into ranges of bytes: against the JSON library and Spark's own reader."""

import json
import random

import pytest

from cartulary.sources import catalogue, tables


def some(r, depth=0):
    kinds = ["str", "str", "num", "null", "list", "dict"] if depth < 3 else ["str", "num"]
    match r.choice(kinds):
        case "str":
            return "".join(r.choices(['"', "\\", "{", "}", "[", "]", ",", ":", "é", "🙂", "a", "\n", "\\\\", '\\"'], k=r.randint(0, 9)))
        case "num":
            return r.choice([1, -2.5, True])
        case "null":
            return None
        case "list":
            return [some(r, depth + 1) for _ in range(r.randint(0, 3))]
    return {f"k{k}": some(r, depth + 1) for k in range(r.randint(0, 3))}


def document(seed):
    r = random.Random(seed)
    name = lambda k: r.choice(["", "d", '"', "}]", "\\", "é{"]) + str(k)
    return {name(k): [{f"f{i}": some(r) for i in range(r.randint(0, 3))} for _ in range(r.choice([0, 0, 1, 5]))] for k in range(12)}


@pytest.mark.parametrize("seed", range(3))
def test_against_the_json_library(spark, tmp_path, seed):
    want = []
    for k in range(3):
        told = document(10 * seed + k)
        (tmp_path / f"{k}.json").write_text(json.dumps(told, indent=2 * k or None, ensure_ascii=k == 1), encoding="utf-8")
        want += [(name, json.dumps(e, sort_keys=True)) for name, es in told.items() for e in es]
    for size in (37, 400, 1 << 20):
        got = [(r.dataset, json.dumps(json.loads(r.entry), sort_keys=True)) for r in catalogue.split_catalogue(spark, f"file://{tmp_path}", size).collect()]
        assert sorted(got) == sorted(want)


@pytest.mark.parametrize("size", range(1, 12))
def test_every_range(tmp_path, size):
    """The cutting by itself, byte by byte, without Spark."""
    told = document(99) | {"last": [{"a": "\\" * 7 + '"'}]}
    data = json.dumps(told).encode()
    (tmp_path / "x").write_bytes(data)
    got, inside, depth, now = [], False, 0, None
    with open(tmp_path / "x", "rb") as f:
        for at in range(0, len(data), size):
            end = min(at + size, len(data))
            for _, name, entry, *_ in catalogue.cut_range(f, at, end, inside, depth):
                if entry is not None:
                    got.append((now if name is None else name, json.loads(entry)))
                elif name is not None:
                    now = name
            before = catalogue.backslashes_before(f, at)
            f.seek(at)
            turns, outside, within = catalogue.sum_up(catalogue.np.frombuffer(f.read(end - at), "u1"), before)
            depth, inside = depth + (within if inside else outside), inside ^ turns
    assert got == [(n, e) for n, es in told.items() for e in es] and (inside, depth) == (False, 0)


def test_entries_as_spark_reads_them(spark, tmp_path):
    told = {d: [{"subject": f"s{k}", "session": "", "type": "anat", "group": k % 2, "mris": {"t1w": f"a{k}.nii"}} for k in range(40)] for d in ("A", "B")}
    (tmp_path / "c.json").write_text(json.dumps(told, indent=4))
    path = f"file://{tmp_path}/c.json"
    a, b = tables.read_catalogue(spark, path), catalogue.read_large_catalogue(spark, path, size=100)
    assert a.dtypes == b.dtypes and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        catalogue.read_large_catalogue(spark, path, "struct<subject:int>", 100).collect()


@pytest.mark.parametrize("text", ["[]", '{"a": 1}', '{"a": "b"}', '{"a": {"b": 1}}', '{"a": [1]}', '{"a": ["x"]}', '{"a": [[{}]]}', '{"a": [{}]', '{"a": [{"b": "c]}', "null", '"x"', '{"a": [{}]} x', '{"a": [{}]}}'])
def test_other_documents_are_refused(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    for size in (2, 1000):
        with pytest.raises(Exception, match="isn't an object of lists|ends early"):
            catalogue.split_catalogue(spark, f"file://{tmp_path}/x.json", size).collect()


def test_no_documents(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        catalogue.split_catalogue(spark, f"file://{tmp_path}/none")
    (tmp_path / "x.json").write_text("{}")
    assert catalogue.split_catalogue(spark, f"file://{tmp_path}/x.json").isEmpty()
