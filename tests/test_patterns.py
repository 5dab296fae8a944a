import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from cartulary.functions import patterns, scalars

LETTERS = "abAB.-/_ "


def random_glob(r: random.Random) -> str:
    parts = []
    for _ in range(r.randint(1, 5)):
        parts.append(r.choice(["*", "?", "[ab]", "[!a]", "[A-B]", "[.-]", "[", "]", *LETTERS]))
    return "".join(parts)


@pytest.mark.parametrize("seed", range(4))
def test_globs_against_fnmatch(spark, seed):
    """Generated names and globs: the whole name, and the first segments alone."""
    r = random.Random(seed)
    names = sorted({"".join(r.choices(LETTERS, k=r.randint(0, 7))) for _ in range(300)})
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for _ in range(6):
        globs = [random_glob(r) for _ in range(r.randint(0, 3))]
        got = df.select("name", patterns.matches_glob(F.col("name"), globs).alias("whole"), patterns.matches_glob_first_level(F.col("name"), globs).alias("first")).collect()
        for x in got:
            assert x.whole == any(fnmatch.fnmatchcase(x.name, g) for g in globs), (x.name, globs)
            assert x.first == any(fnmatch.fnmatchcase(x.name.split("/")[0], g.split("/")[0]) for g in globs), (x.name, globs)


def test_globs_over_a_tree(spark):
    tree = ["notes.md", "wards/a/scan.img", "wards/a/scan.hdr", "wards/b/scan.img", "archive/1999/wards/scan.img"]
    df = spark.createDataFrame([(x,) for x in tree], "path string")
    got = lambda match, globs: [r.path for r in df.where(match(F.col("path"), globs)).collect()]
    assert got(patterns.matches_glob, ["wards/*.img"]) == ["wards/a/scan.img", "wards/b/scan.img"]
    assert got(patterns.matches_glob, ["*wards*img"]) == ["wards/a/scan.img", "wards/b/scan.img", "archive/1999/wards/scan.img"]
    assert got(patterns.matches_glob_first_level, ["arch*/nothing", "notes.md"]) == ["notes.md", "archive/1999/wards/scan.img"]
    assert got(patterns.matches_glob, []) == got(patterns.matches_glob_first_level, []) == []
    assert df.limit(0).where(patterns.matches_glob(F.col("path"), ["*"])).count() == 0


def test_glob_classes(spark):
    df = spark.createDataFrame([("a.b",), ("axb",), ("a-b",), ("A.b",), ("a\nb",)], "p string")
    got = lambda g: {r.p for r in df.where(patterns.matches_glob(F.col("p"), [g])).collect()}
    assert got("a.b") == {"a.b"}
    assert got("a[.x]b") == {"a.b", "axb"}
    assert got("a[!.x]b") == {"a-b", "a\nb"}
    assert got("a?b") == {"a.b", "axb", "a-b", "a\nb"}
    assert got("a[b") == set()


def test_bad_pattern_is_named():
    assert patterns.compile_patterns({"a": " ", "b": "^x$"}) == {"a": None, "b": "^x$"}
    with pytest.raises(ValueError, match="modality"):
        patterns.compile_patterns({"modality": "("})


def test_patterns_are_those_of_the_plan(spark):
    """Syntax that only Python knows is translated for the plan; what only Java knows is refused before a task meets it."""
    assert patterns.compile_patterns({"subject": "(?P<a>x)"}) == {"subject": "(?P<a>x)"} and patterns.from_start("(?P<a>x)") == "^(?:(x))"
    with pytest.raises(ValueError, match="subject"):
        patterns.compile_patterns({"subject": r"\p{L}x"})
    assert patterns.compile_patterns({"a": "[a-z&&[^b]]"}) == {"a": "[a-z&&[^b]]"}


def test_segments(spark):
    df = spark.createDataFrame([("sub-01/anat/NIfTI/mprage.nii.gz",)], "p string")
    parts = F.split("p", "/")
    row = df.select(
        patterns.match_segments(parts, F.lit(0), "^sub-").alias("a"), patterns.match_segments(parts, F.lit(1), "^anat/NIfTI$").alias("b"),
        patterns.match_segments(parts, F.lit(4), "^x").alias("c"), patterns.match_segments(parts, F.lit(0), "NIfTI").alias("d"),
    ).first()
    assert (row.a.text, row.a.next) == ("sub-01", 1)
    assert (row.b.text, row.b.next) == ("anat/NIfTI", 3)
    assert row.c is None and row.d is None


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.title_case(F.lit("biograph_mmr SKYRA3t")).alias("title"), scalars.latex_escape(F.lit("5% & a_b")).alias("latex"),
        scalars.round_to_half(F.lit(2.89)).alias("half"), scalars.sidecar_path(F.lit("d/a.b.nii.gz")).alias("sidecar"),
        scalars.to_number(F.lit("12d")).alias("odd"), scalars.to_number(F.lit(" 1.5e2 ")).alias("number"), scalars.path_suffix(F.lit("a/.hidden")).alias("suffix"),
        scalars.normalise_nfc(F.lit("é")).alias("nfc"), scalars.truthy(F.lit("0")).alias("zero"),
    ).first()
    assert row.title == "Biograph_Mmr Skyra3T" and row.latex == r"5\% \& a\_b" and row.half == 3.0 and row.sidecar == "d/a.json"
    assert row.odd is None and row.number == 150.0 and row.suffix == "" and row.nfc == "é" and row.zero is False


@pytest.mark.parametrize(("word", "value"), [("Yes", True), ("t", True), ("1", True), (" no", False), ("F", False), ("0", False)])
def test_booleans(spark, word, value):
    assert spark.range(1).select(scalars.parse_bool(F.lit(word)).alias("b")).first().b is value


def test_no_boolean(spark):
    with pytest.raises(Exception, match="not a boolean"):
        spark.range(1).select(scalars.parse_bool(F.lit("maybe")).alias("b")).collect()
