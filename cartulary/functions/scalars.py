"""Scalar expressions that the built-in functions lack."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The words that mean yes and no.
YES, NO = ("yes", "true", "t", "y", "1"), ("no", "false", "f", "n", "0")
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def title_case(c: Column) -> Column:
    """Each run of letters begins with a capital, the rest of it is lower case, whatever stands before it."""
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1)), F.initcap), "")


def latex_escape(c: Column) -> Column:
    """With a backslash before what LaTeX takes for marks (fixed values)."""
    return F.regexp_replace(c, r"([&%$#_{}])", r"\\$1")


def round_to_half(c: Column) -> Column:
    """To the nearest multiple of 0.5, ties to even halves."""
    return F.bround(c * 2, 0) / 2


def parse_bool(c: Column) -> Column:
    """Of the usual words, by case and space regardless; anything else raises."""
    low = F.lower(F.trim(c))
    return F.when(low.isin(*YES), True).when(low.isin(*NO), False).when(c.isNotNull(), F.raise_error(F.concat(F.lit("not a boolean: "), c)).cast("boolean"))


def to_number(c: Column) -> Column:
    """The number that a cell holds, by a rule that doesn't take suffixes such as 12d; null otherwise."""
    return F.when(c.rlike(NUMBER), F.trim(c).try_cast("double"))


def path_name(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def path_suffix(c: Column) -> Column:
    """The last dotted part of the name, with its dot; empty without one or where the name only begins with a dot."""
    return F.regexp_extract(path_name(c), r"^.+(\.[^.]+)$", 1)


def path_stem(c: Column) -> Column:
    name = path_name(c)
    return F.regexp_replace(name, r"^(.+)\.[^.]+$", "$1")


def path_parent(c: Column) -> Column:
    return F.when(c.contains("/"), F.regexp_replace(c, r"/[^/]*$", "")).otherwise("")


def sidecar_path(c: Column) -> Column:
    """Where the JSON of an image lies: image endings go, then one more dotted part, then ``.json``."""
    bare = F.regexp_replace(c, r"(?i)(\.nii|\.gz)+$", "")
    return F.concat(F.regexp_replace(bare, r"(?<=[^/])\.[^./]+$", ""), F.lit(".json"))


def truthy(c: Column) -> Column:
    """Whether a text counts as present: not null, not empty, not zero."""
    return F.coalesce(~F.trim(c).isin("", "0", "0.0", "false", "[]", "{}"), F.lit(False))


def normalise_nfc(c: Column) -> Column:
    """Unicode composed form, for which there is no built-in function: an Arrow-batched function."""

    def compose(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))

    return F.pandas_udf(compose, "string")(c)
