"""Plans of preprocessing steps: which file goes where; the work on images itself is a hook."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def folder_of(entry: Mapping[str, Column]) -> Column:
    """``subject.session.type.group``, blank parts included."""
    return F.concat_ws(".", *(F.coalesce(entry[k].cast("string"), F.lit("")) for k in ("subject", "session", "type", "group")))


def named_for(name: Column, modality: Column) -> Column:
    """``x.nii.gz`` as ``x_MODALITY.nii.gz``; another name stays."""
    return F.when(name.endswith(".nii.gz"), F.concat(F.regexp_replace(name, r"\.nii\.gz$", "_"), modality, F.lit(".nii.gz"))).otherwise(name)


def pass_through(entries: DataFrame, settings: Mapping[str, Any]) -> DataFrame:
    """``entries(subject, session, type, group, mris, ...)`` with ``preprocessed``: where each modality's file goes, relative to the preprocessed folder.

    Only for datasets whose images are preprocessed already: ``settings["preprocess"]["alreadyPreprocessed"]`` must be true, else ``ValueError``.
    """
    if (settings.get("preprocess") or {}).get("alreadyPreprocessed") is not True:
        raise ValueError("the dataset is not marked as already preprocessed")
    folder = folder_of({k: F.col(k) for k in ("subject", "session", "type", "group")})
    place = F.transform_values("mris", lambda m, name: F.concat(folder, F.lit("/norm_bet/"), named_for(name, m)))
    return entries.withColumn("preprocessed", place)


def copies_of(entries: DataFrame, root: str, below: str = "Download", modality_paths: str = "download") -> DataFrame:
    """(src, path) of every file that ``pass_through`` gives a place, for ``sources.copying.copy_tree``; path is relative to the tree of all datasets."""
    pairs = entries.select("dataset", modality_paths, F.explode("preprocessed").alias("m", "place"))
    src = F.concat_ws("/", F.lit(root.rstrip("/")), F.col("dataset"), F.lit(below), F.element_at(F.col(modality_paths), F.col("m")))
    return pairs.select(src.alias("src"), F.concat_ws("/", "dataset", "place").alias("path"))
