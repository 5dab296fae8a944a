"""Lookups and comparisons between tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.functions.scalars import truthy
from cartulary.operators.containment import contains_join, last_containing, maybe_broadcast  # noqa: F401  (joins too)
from cartulary.operators.grouping import last_wins

def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Left join to the last row of each key; left rows without one keep nulls.  Catalyst picks the join by size."""
    return left.join(last_wins(right, keys, order), list(keys), "left")


def fallback_lookup(near: Column, far: Column, fields: Sequence[str]) -> Column:
    """A map of ``fields`` from ``near`` if any of them is there, else from ``far``, else empty; absent fields of a hit are empty."""
    pick = lambda m: F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*(F.coalesce(F.try_element_at(m, F.lit(f)), F.lit("")) for f in fields)))
    hit = lambda m: F.coalesce(F.exists(F.array(*(truthy(F.try_element_at(m, F.lit(f))) for f in fields)), lambda x: x), F.lit(False))
    return F.when(hit(near), pick(near)).when(hit(far), pick(far)).otherwise(F.create_map().cast("map<string,string>"))


def exactly_one(df: DataFrame, keys: Sequence[str], value: str, strict: bool = False) -> DataFrame:
    """The value of each key that has exactly one row; other keys are dropped, or raise if ``strict``."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(value).alias(value))
    if strict:
        counted = counted.withColumn("_n", F.when(F.col("_n") == 1, F.col("_n")).otherwise(F.raise_error(F.lit("a key without exactly one match")).cast("bigint")))
    return counted.where("_n = 1").drop("_n")


def missing_extra(expected: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of one side only, with status missing (expected only) or extra (found only): one full join of distinct keys."""
    a = expected.select(*keys).distinct().withColumn("_a", F.lit(1))
    b = found.select(*keys).distinct().withColumn("_b", F.lit(1))
    return a.join(b, list(keys), "full").where("_a is null or _b is null").select(*keys, F.when(F.col("_b").isNull(), "missing").otherwise("extra").alias("status"))


def select_datasets(names: DataFrame, include: DataFrame | None, exclude: DataFrame | None, key: str) -> DataFrame:
    """``include`` wins; else all but ``exclude``, whose names must exist; else all."""
    if include is not None:
        return names.join(include, key, "left_semi")
    if exclude is None:
        return names
    unknown = [r[0] for r in exclude.join(names, key, "left_anti").limit(10).collect()]
    if unknown:
        raise ValueError(f"excluded but not there: {unknown}")
    return names.join(exclude, key, "left_anti")
