"""Settings of datasets: merging, selection by flags, and the ledger of finished stages."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_settings(defaults: dict[str, Any], overrides: dict[str, Any], deep: bool = False) -> dict[str, Any]:
    """Overrides win key by key; shallow unless ``deep``, so an overridden block loses its defaults."""
    if not isinstance(defaults, dict) or not isinstance(overrides, dict):
        raise TypeError("settings are dictionaries")
    out = {**defaults, **overrides}
    if deep:
        out |= {k: merge_settings(defaults[k], v, True) for k, v in overrides.items() if isinstance(v, dict) and isinstance(defaults.get(k), dict)}
    return out


def merge_tables(defaults: DataFrame, overrides: DataFrame, key: str, value: str) -> DataFrame:
    """The same over tables of (key, value)."""
    return defaults.withColumnRenamed(value, "_d").join(overrides.withColumnRenamed(value, "_o"), key, "full").select(key, F.coalesce("_o", "_d").alias(value))


def merge_maps(defaults: Column, overrides: Column) -> Column:
    return F.map_zip_with(defaults, overrides, lambda k, d, o: F.coalesce(o, d))


def reset_flags(ledger: DataFrame, flags: Sequence[str], key: str = "dataset") -> DataFrame:
    """``ledger(key, flag, value)``, value as JSON text, with ``flags`` set to false where all of them are there and boolean; a key that lacks one is left alone.

    ``patched`` tells which keys were changed.
    """
    ours = F.col("flag").isin(*flags)
    good = F.count_distinct(F.when(ours & F.col("value").isin("true", "false"), F.col("flag"))) == len(flags)
    state = ledger.groupBy(key).agg((good & (F.count_if(ours) == len(flags))).alias("patched"))
    return ledger.join(state, key).withColumn("value", F.when(F.col("patched") & ours, "false").otherwise(F.col("value")))


def reset_summary(ledger: DataFrame, flags: Sequence[str], key: str = "dataset") -> DataFrame:
    """What ``reset_flags`` would do: keys patched and keys left alone (the dry run)."""
    done = reset_flags(ledger, flags, key).select(key, "patched").distinct()
    return done.agg(F.count_if("patched").alias("n_patched"), F.count_if(~F.col("patched")).alias("n_failed"))


def upsert(table: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``table`` whose keys ``changes`` doesn't have, and all of ``changes``."""
    return table.join(changes, list(keys), "left_anti").unionByName(changes)


def stage_actions(state: DataFrame, done: str = "done", filled: str = "filled", redo: bool = False) -> DataFrame:
    """``state`` (a flag and whether the stage's folder has content) with an action.

    ``skip``: done, or content without the flag, which is left alone; ``reset``: the flag is set but the
    folder is missing or empty, so the flag is cleared and the stage run; ``run``: neither is
    there.  ``redo`` runs again where there is content without the flag (``rerun``).
    """
    d, f = F.coalesce(F.col(done), F.lit(False)), F.coalesce(F.col(filled), F.lit(False))
    action = F.when(d & f, "skip").when(d, "reset").when(f, "rerun" if redo else "skip").otherwise("run")
    return state.withColumn("action", action)


def pending(datasets: DataFrame, ledger: DataFrame, flag: str, key: str = "dataset", redo: bool = False) -> DataFrame:
    """Datasets for which a stage has not been done."""
    if redo:
        return datasets
    done = ledger.where((F.col("flag") == flag) & (F.col("value") == "true")).select(key)
    return datasets.join(done, key, "left_anti")
