"""Positions within groups, and what is picked by them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "grp") -> DataFrame:
    """0-based place of each row among those with equal keys, by a total order."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("bigint"))


def pivot_entries(df: DataFrame, keys: Sequence[str], kind: str, value: str, order: Sequence[str], first_group_only: bool = False) -> DataFrame:
    """An entry for each (keys, place): a map from kind to value; the k-th value of each kind goes to the k-th entry."""
    placed = group_index(df, [*keys, kind], order)
    placed = placed.where("grp = 0") if first_group_only else placed
    pairs = F.array_sort(F.collect_list(F.struct(F.col(kind), F.col(value))))
    return placed.groupBy(*keys, "grp").agg(F.map_from_entries(pairs).alias("files"))


def map_text(c: Column) -> Column:
    """A map as ``k=v`` pairs in key order, joined by commas."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string"))), ",")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key by a total order, found with partial aggregation instead of a sort of each group."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row of each key by a total order: a later row overwrites an earlier one."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def priority_pick(held: Column, priority: Sequence[str]) -> Column:
    """The first name of ``priority`` that the array holds; null if none."""
    return F.get(F.filter(F.array(*map(F.lit, priority)), lambda m: F.array_contains(held, m)), F.lit(0))
