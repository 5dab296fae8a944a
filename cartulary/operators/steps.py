"""The engine's own steps, by name; a package of further ones can be added with ``Registry.discover``."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.operators.paths import PathRules, parse_paths
from cartulary.operators.registry import exporters, mappers, preprocessors, validators
from cartulary.operators.split import Ratios, assign_splits, label_records
from cartulary.operators.validate import HeaderRules, validate_headers
from cartulary.sources.copying import copy_tree


@mappers.register("segments")
def segments(files: DataFrame, **rules: Any) -> DataFrame:
    """Paths to subject, session, type and modality (settings: those of ``PathRules``)."""
    return parse_paths(files, PathRules(**rules))


@validators.register("headers")
def headers(df: DataFrame, **rules: Any) -> DataFrame:
    """Headers to errors and valid (settings: those of ``HeaderRules``)."""
    return validate_headers(df, HeaderRules(**rules))


@preprocessors.register("pass_through")
def pass_through(records: DataFrame, path: str = "path") -> DataFrame:
    """Records whose prepared file is the raw one."""
    return records.withColumn("preprocessed", F.col(path))


@exporters.register("split")
def split(records: DataFrame, seed: int = 42, **ratios: float) -> DataFrame:
    """Records with the split of their subject (settings: a seed and those of ``Ratios``)."""
    return label_records(records, assign_splits(records, Ratios(**ratios), seed))


@exporters.register("file_tree")
def file_tree(plan: DataFrame, target: str, overwrite: bool = False) -> DataFrame:
    """Copy the files of ``plan(src, path)`` into a tree at ``target``, all or none; the plan again."""
    copy_tree(plan, target, overwrite)
    return plan
