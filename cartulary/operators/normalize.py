"""Column names, keys and values brought to a schema's standard forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.scalars import to_number


@dataclass(frozen=True)
class Field:
    """A standard column: other names, values (main to aliases) and prefixes that are stripped."""

    name: str
    aliases: Sequence[str] = ()
    values: Mapping[str, Sequence[str]] | None = None
    strip: Sequence[str] = ()


def standard_name(column: str, fields: Sequence[Field]) -> str | None:
    """The field that a column means, by case and space regardless; a field's own name goes before aliases."""
    low = column.strip().lower()
    for f in fields:
        if low == f.name.lower() or low in (a.strip().lower() for a in f.aliases):
            return f.name
    return None


def normalise_columns(df: DataFrame, fields: Sequence[Field], strict: bool = True) -> DataFrame:
    """Columns renamed to their fields; an unknown column is an error, or dropped if not ``strict``."""
    found = {c: standard_name(c, fields) for c in df.columns}
    unknown = [c for c, n in found.items() if n is None]
    if unknown and strict:
        raise ValueError(f"columns that no field knows: {unknown}")
    return df.select(*(F.col(f"`{c}`").alias(n) for c, n in found.items() if n))


def canonical(c: Column, field: Field) -> Column:
    """The main value that a cell means; trimmed if the field has no values; null where it means none."""
    if not field.values:
        return F.trim(c)
    pairs: dict[str, str] = {}
    for main, aliases in field.values.items():
        for a in (main, *aliases):
            pairs.setdefault(a.lower(), main)
    lookup = F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))
    return F.try_element_at(lookup, F.lower(F.trim(c)))


def normalise_values(df: DataFrame, fields: Sequence[Field], strict: bool = True) -> DataFrame:
    """Cells in canonical form; an invalid one raises, or, if not ``strict``, is listed in ``_rejects`` and null."""
    rejects, out = [], df
    for f in fields:
        if f.name not in df.columns:
            continue
        value = canonical(F.col(f.name), f)
        bad = F.col(f.name).isNotNull() & value.isNull()
        if strict:
            value = F.when(bad, F.raise_error(F.concat(F.lit(f"{f.name}: invalid value "), F.col(f.name))).cast("string")).otherwise(value)
        rejects.append(F.when(bad, F.lit(f.name)))
        out = out.withColumn(f"_new_{f.name}", value)
    names = [f.name for f in fields if f.name in df.columns]
    out = out if strict else out.withColumn("_rejects", F.array_compact(F.array(*rejects)))
    return out.drop(*names).withColumnsRenamed({f"_new_{n}": n for n in names})


#: Bounds of numeric fields outside which a value is suspect.
RANGES = {"height": (None, 2.5), "weight": (20.0, 200.0), "age": (0.0, 120.0), "BMI": (10.0, 70.0)}


def check_cell(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """struct<value, bad_number, out_of_range>: n/a and na become empty; only a cell with a digit must be a number."""
    blank = F.lower(F.trim(c)).isin("n/a", "na")
    number = to_number(c)
    out = F.lit(False)
    out = out | (number < low) if low is not None else out
    out = out | (number > high) if high is not None else out
    return F.struct(
        F.when(blank, "").otherwise(F.trim(c)).alias("value"),
        F.coalesce(~blank & c.rlike("[0-9]") & number.isNull(), F.lit(False)).alias("bad_number"),
        F.coalesce(~blank & out, F.lit(False)).alias("out_of_range"),
    )


def strip_prefix(c: Column, patterns: Sequence[str]) -> Column:
    """Lower-cased, trimmed and without the first prefix of ``patterns`` that is there; without patterns only unchanged; null where nothing is left."""
    if not patterns:
        return c
    low = F.lower(F.trim(c))
    cut = [F.regexp_replace(low, p if p.startswith("^") else f"^(?:{p})", "") for p in patterns]
    return F.nullif(F.coalesce(*(F.when(x != low, x) for x in cut), low), F.lit(""))
