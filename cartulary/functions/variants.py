"""JSON settings as VARIANT columns: typed look-ups by path, changes inside objects, flags that are reset all or not at all.

Everything is an expression, so nothing leaves the JVM.  Paths are names joined by dots, each an object's member.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEMBERS = "map<string,variant>"


def members(v: Column) -> Column:
    """The members of an object by name; null where ``v`` is no object."""
    return F.when(kind_of(v) == "OBJECT", v.cast(MEMBERS))


def kind_of(v: Column) -> Column:
    """BOOLEAN, BIGINT, DECIMAL, DOUBLE, STRING, ARRAY, OBJECT, VOID (a JSON null) or, where there is nothing, MISSING."""
    return F.coalesce(F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0), F.lit("MISSING"))


def member(v: Column, path: str) -> Column:
    """What stands at ``path``, as VARIANT; null where there is nothing."""
    for name in path.split("."):
        v = F.try_element_at(members(v), F.lit(name))
    return v


def as_boolean(v: Column) -> Column:
    """A JSON boolean; null for anything else, texts such as "true" included."""
    return F.when(kind_of(v) == "BOOLEAN", F.variant_get(v, "$", "boolean"))


def with_member(v: Column, path: str, value: Column) -> Column:
    """``v`` with ``value`` (VARIANT) at ``path``; objects on the way are kept or, where there is none, made."""
    name, _, rest = path.partition(".")
    held = F.coalesce(members(v), F.create_map().cast(MEMBERS))
    new = with_member(F.try_element_at(held, F.lit(name)), rest, value) if rest else value
    others = F.map_filter(held, lambda k, _: k != name)
    return F.to_variant_object(F.map_concat(others, F.create_map(F.lit(name), new)))


def flags_of(settings: DataFrame, key: str, document: str, flags: Sequence[str]) -> DataFrame:
    """(key, flag, kind, value): what each of ``flags`` is in each row's JSON ``document``; value is null unless it is a boolean."""
    told = settings.select(key, F.try_parse_json(document).alias("v"))
    each = F.array(*(F.struct(F.lit(p).alias("flag"), kind_of(member(F.col("v"), p)).alias("kind"), as_boolean(member(F.col("v"), p)).alias("value")) for p in flags))
    return told.select(key, F.explode(each).alias("f")).select(key, "f.*")


def reset_nested(settings: DataFrame, document: str, flags: Sequence[str], to: bool = False) -> DataFrame:
    """``settings`` with ``flags`` set to ``to`` in the JSON ``document`` where all of them are there and boolean, and ``patched``; other documents, malformed ones too, stay to the byte."""
    v = F.try_parse_json(document)
    good = F.lit(True)
    for p in flags:
        good = good & (kind_of(member(v, p)) == "BOOLEAN")
    new = v
    for p in flags:
        new = with_member(new, p, F.parse_json(F.lit(str(to).lower())))
    patched = F.coalesce(good, F.lit(False))
    return settings.withColumns({document: F.when(patched, F.to_json(new)).otherwise(F.col(document)), "patched": patched})


def merge_documents(defaults: Column, overrides: Column, deep: bool = False, depth: int = 3) -> Column:
    """Two VARIANT objects as one: members of ``overrides`` win; ``deep``: objects on both sides are merged, down to ``depth`` levels."""
    a, b = (F.coalesce(members(v), F.create_map().cast(MEMBERS)) for v in (defaults, overrides))

    def one(x: Column, y: Column) -> Column:
        if deep and depth > 1:
            return F.when((kind_of(x) == "OBJECT") & (kind_of(y) == "OBJECT"), merge_documents(x, y, True, depth - 1)).otherwise(F.coalesce(y, x))
        return F.coalesce(y, x)

    return F.to_variant_object(F.map_zip_with(a, b, lambda _, x, y: one(x, y)))


def typed(v: Column, wanted: Mapping[str, str]) -> Column:
    """struct of the members at paths, each cast to its kind of SQL (``{"stage.k": "bigint"}``); null where it can't be."""
    return F.struct(*(F.try_variant_get(member(v, p), "$", kind).alias(p.replace(".", "_")) for p, kind in wanted.items()))
