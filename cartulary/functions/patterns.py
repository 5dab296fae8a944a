"""Globs and regular expressions as column expressions.

Patterns are matched from the start of the text (a pattern may end early unless
it ends with ``$``); globs match the whole text, and their ``*`` crosses ``/``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartulary.functions.pythonregex import Untranslatable, to_java


def glob_to_regex(glob: str) -> str:
    """A Java and Python regular expression for the whole text; ``*``, ``?``, ``[...]`` and ``[!...]`` as in shells, case kept."""
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        close = glob.find("]", i + 2 + (glob[i + 1 : i + 2] == "!")) if c == "[" else -1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif close > 0:
            body = glob[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            out.append(f"[^{body[1:]}]" if body[0] == "!" else f"[\\{body}]" if body[0] == "^" else f"[{body}]")
            i = close
        else:
            out.append(re.escape(c))
        i += 1
    return f"(?s)^{''.join(out)}\\z"


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def matches_glob(c: Column, globs: Sequence[str]) -> Column:
    """True where any glob matches; false without globs."""
    return any_of([c.rlike(glob_to_regex(g)) for g in globs])


def matches_glob_first_level(c: Column, globs: Sequence[str]) -> Column:
    """True where the first path segment matches the first segment of any glob."""
    return matches_glob(F.split_part(c, F.lit("/"), F.lit(1)), sorted({g.split("/")[0] for g in globs}))


def from_start(regex: str) -> str:
    """A Python pattern as Java's, matched from the start of the text."""
    return f"^(?:{to_java(regex).regex})"


def compile_patterns(patterns: dict[str, str]) -> dict[str, str | None]:
    """Python's patterns as they are; blank ones become None.  One that isn't a regular expression, or that Java can't express, raises ``ValueError`` naming its key, before any plan is built."""
    out: dict[str, str | None] = {}
    for key, p in patterns.items():
        try:
            out[key] = p if p and p.strip() and to_java(p) else None
        except (re.error, Untranslatable) as e:
            raise ValueError(f"pattern of {key}: {e}") from e
    return out


def match_segments(parts: Column, start: Column, regex: str) -> Column:
    """struct<text, next> of the shortest run of path segments from ``start`` (0-based) whose text the pattern matches; null if none."""
    ends = F.when(start < F.size(parts), F.sequence(start + 1, F.size(parts)))
    runs = F.transform(ends, lambda e: F.struct(F.array_join(F.slice(parts, start + 1, e - start), "/").alias("text"), e.alias("next")))
    return F.get(F.filter(runs, lambda r: r["text"].rlike(from_start(regex))), F.lit(0))


def first_match(c: Column, named: Sequence[tuple[str, str]]) -> Column:
    """The name of the first pattern, in the given order, that matches from the start; null if none."""
    out = None
    for name, regex in named:
        hit = c.rlike(from_start(regex))
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return F.lit(None).cast("string") if out is None else out


def included(c: Column, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> Column:
    """Any of ``include`` (all, if there are none), then none of ``exclude``."""
    keep = matches_glob(c, include) if include else F.lit(True)
    return keep & ~matches_glob(c, exclude)
