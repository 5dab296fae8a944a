"""Python's patterns in Java: spans and groups of generated patterns, and of each construct, on generated texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cartulary.functions import patterns
from cartulary.functions.pythonregex import Untranslatable, to_java

ALPHABET = ["a", "b", "A", "1", "٣", "é", "_", " ", "\t", "\n", "\r", "\x0b", "\x85", "\u2028", "\xa0", "-", "/", ".", "^", "&", "[", "]", "中", "½", "\u0301"]


def texts(r, n):
    return ["".join(r.choices(ALPHABET, k=r.randint(0, 7))) for _ in range(n)] + ["", "\n", "a\n", "ab\nab", "aa-aa"]


def agree(jvm, pattern, some, search=False):
    told, mine = to_java(pattern), re.compile(pattern)
    java = jvm.java.util.regex.Pattern.compile(told.regex)
    for s in some:
        a, b = mine.match(s), java.matcher(s)
        hit = b.lookingAt()
        assert hit == (a is not None), (pattern, told.regex, s)
        if a:
            assert b.end() == a.end(), (pattern, told.regex, s)
            for g, k in told.groups.items():
                assert b.group(k) == a.group(g), (pattern, told.regex, s, g)
        assert [m.span() for m in mine.finditer(s)][:1] == ([(b.start(), b.end())] if b.reset().find() else []), (pattern, told.regex, s)


EACH = [
    r"(?P<x_1>a)(?P=x_1)", r"(a)?(?(1)b|A)", r"(?P<q>[ab])?-(?(q)a|1)$", r"a\Z", r"a$", r"(?m)^a$", r"(?m)b$", r".+", r"(?s).+", r"\d+\w*\s*", r"\D\W\S", r"[\w-]+", r"[^\W\d]+", r"[^\D]", r"[\s\S]", r"[]a]+", r"[^]a]+", r"[a&&b]+", r"[[a]+", r"\bab?\b", r"\B.", r"(?i)É",
    r"(?i:a)b", r"(?i)a(?-i:b)", r"(?a)\w+", r"(?a:\w)é", r"(?x) a  b # no", r"a{,2}b", r"a{", r"{x}", r"\v\f?", r"\x41\u00e9", r"\101", r"(?#no)a", r"a*+a", r"(?>a|ab)b", r"(?<=a)b", r"(?<!a)b", r"(?=a)\w", r"(?!a)\w", r"(a)|b\1?", r"((a)b?)+\2", r"a|", r"", r"[\]\-^]+", r"\N{LATIN SMALL LETTER A}", r"^sub-.*$", r"^.*_T1w\.nii\.gz$", r"[a-b]{2}?b", r"[^a\S]+", r"(?:a|b)*?1",
]


@pytest.mark.parametrize("pattern", EACH)
def test_each_construct(spark, pattern):
    agree(spark._jvm, pattern, texts(random.Random(pattern), 60))


def made(r, depth=0, groups=None):
    groups = [] if groups is None else groups
    out = ""
    for _ in range(r.randint(1, 3)):
        match r.randrange(11 if depth < 3 else 6):
            case 0 | 1:
                atom = re.escape(r.choice(ALPHABET))
            case 2:
                atom = r.choice([".", r"\w", r"\d", r"\s", r"\W", r"\S", r"\b", "^", "$", r"\B"])
            case 3:
                atom = "[" + r.choice(["", "^"]) + "".join(r.choice([r"\w", r"\d", r"\W", "a-b", r"\s", "-", "&&", r"\]", "é", "1"]) for _ in range(2)) + "]"
            case 4:
                atom = f"\\{r.choice(groups)}" if groups else "a"
            case 5:
                atom = f"(?({r.choice(groups)}){r.choice('ab1')}|{r.choice(['', 'a'])})" if groups else "b"
            case 6 | 7:
                inner = made(r, depth + 1, groups)
                groups.append(made.count)
                made.count += 1
                atom = f"({inner})"
                # numbers are given by opening brackets, so only groups without groups inside are referred to
                if "(" in inner.replace("(?", ""):
                    return out + f"(?:{inner})"
            case 8:
                atom = f"(?{r.choice(['=', '!', 'i:', ':'])}{made(r, depth + 1, [])})"
            case _:
                atom = f"(?:{made(r, depth + 1, groups)}|{made(r, depth + 1, groups)})"
        out += atom + (r.choice(["", "", "*", "+?", "?", "{1,2}", "{,1}"]) if not atom.startswith(("^", "$", "\\b", "\\B")) else "")
    return out


@pytest.mark.parametrize("seed", range(4))
def test_generated_patterns(spark, seed):
    r, done = random.Random(seed), 0
    while done < 60:
        made.count = 1
        pattern = made(r)
        try:
            re.compile(pattern)
        except re.error:
            continue
        try:
            agree(spark._jvm, pattern, texts(r, 8))
        except Untranslatable:
            continue
        done += 1


def test_what_java_lacks(spark):
    with pytest.raises(re.error):
        to_java("(a")
    with pytest.raises(Untranslatable, match="group 1"):
        to_java(r"(a(?(1)b|c))")
    with pytest.raises(ValueError, match="pattern of subject"):
        patterns.compile_patterns({"subject": "(a", "type": ""})
    assert patterns.compile_patterns({"subject": "", "type": "  ", "session": r"(?P<s>\d)\Z"}) == {"subject": None, "type": None, "session": r"(?P<s>\d)\Z"}
    assert to_java(r"(?P<s>\d)\Z").regex == r"([\p{Nd}])\z" and to_java(r"(?P<s>\d)\Z").names == {"s": 1}


def test_in_a_plan(spark):
    r = random.Random(3)
    rows = [(k, t) for k, t in enumerate(texts(r, 80))]
    df = spark.createDataFrame(rows, "k int, t string")
    for pattern in (r"(?P<x>[ab])(?P=x)?", r"(a)?(?(1)b|\w)", r"\w+\Z", r"[^\W\d]+$"):
        got = {x.k for x in df.where(F.col("t").rlike(patterns.from_start(pattern))).collect()}
        assert got == {k for k, t in rows if re.match(pattern, t)}
