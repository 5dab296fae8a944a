"""Readers of participant tables, catalogues, sidecars and rules."""

from __future__ import annotations

import json
import logging
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.operators.normalize import Field
from cartulary.sources.listing import read_files
from cartulary.sources.stores import read_text, write_text

log = logging.getLogger(__name__)

ENTRY = (
    "struct<subject:string,session:string,type:string,group:int,mris:map<string,string>,download:map<string,string>,"
    "scanner:map<string,map<string,string>>,preprocessed:map<string,string>,demographics:map<string,string>>"
)


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated table with a header; all cells are text."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=False, quote='"', escape='"', mode="PERMISSIVE")


def melt(df: DataFrame, dataset: str, row_id: str = "row_idx") -> DataFrame:
    """(dataset, row_idx, column, value): the form in which tables of different headers can be put together."""
    numbered = df.withColumn(row_id, F.monotonically_increasing_id())
    return numbered.unpivot([row_id], df.columns, "column", "value").select(F.lit(dataset).alias("dataset"), row_id, "column", "value")


def read_catalogue(spark: SparkSession, path: str, entry: str = ENTRY) -> DataFrame:
    """A row for each entry of a JSON catalogue (dataset to list of entries)."""
    text = spark.read.text(path, wholetext=True)
    parsed = text.select(F.from_json("value", f"map<string,array<{entry}>>", {"mode": "FAILFAST"}).alias("m"))
    return parsed.select(F.explode("m").alias("dataset", "entries")).select("dataset", F.explode("entries").alias("e")).select("dataset", "e.*")


def file_path() -> Column:
    """The file that a row was read from, its name as it is: Spark gives it with its spaces and other marks encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """path, fields (a map of texts) of every JSON file below ``path``; a malformed one has null fields."""
    found = read_files(spark, path, "*.json")
    return found.select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"), F.from_json(F.col("content").cast("string"), "map<string,string>").alias("fields"))


def read_infos(spark: SparkSession, root: str, name: str = "info.yaml") -> DataFrame:
    """dataset, info (a map of texts) of the file ``name`` in each folder below ``root``; one that can't be read as a mapping is empty."""

    @F.udf("map<string,string>")  # one small file a dataset
    def parsed(text):
        import yaml

        try:
            told = yaml.safe_load(text)
        except yaml.YAMLError:
            told = None
        return {str(k): "" if v is None else str(v) for k, v in told.items()} if isinstance(told, dict) else {}

    found = read_files(spark, root, name)
    return found.select(F.element_at(F.split("path", "/"), -2).alias("dataset"), parsed(F.col("content").cast("string")).alias("info"))


def root_sidecars(sidecars: DataFrame, modalities: tuple[str, ...] = ("t1w", "t2w", "flair"), keep: tuple[str, ...] = ()) -> DataFrame:
    """modality, fields (and the columns ``keep``) of the sidecars that are named for a modality."""
    stem = F.lower(F.regexp_extract("path", r"([^/]+)\.json$", 1))
    return sidecars.select(*keep, stem.alias("modality"), "fields").where(F.col("modality").isin(*modalities))


def read_settings(path: str, create: bool = False) -> dict[str, Any]:
    """A JSON object from any store that Arrow reads; {} if it is malformed; a missing file is an error unless ``create``."""
    try:
        out = json.loads(read_text(path))
        return out if isinstance(out, dict) else {}
    except FileNotFoundError:
        if not create:
            raise
        write_text(path, "{}")
        return {}
    except (json.JSONDecodeError, UnicodeDecodeError):
        log.exception("%s is malformed", path)
        return {}


def read_yaml(path: str) -> dict[str, Any]:
    """A YAML mapping; {} if the file is missing, malformed or something else."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading rules takes PyYAML") from e
    try:
        told = yaml.safe_load(read_text(path))
    except (OSError, UnicodeDecodeError, yaml.YAMLError):
        log.exception("%s can't be read", path)
        return {}
    return told if isinstance(told, dict) else {}


def read_rules(path: str) -> list[Field]:
    """Fields of a YAML schema: a list ``fields`` of name, aliases, valid_patterns and valid_values; none if it can't be read."""
    told = read_yaml(path)
    out = []
    for f in told.get("fields", []):
        values = {v["main_value"]: v.get("aliases") or [] for v in f.get("valid_values") or []} or None
        out.append(Field(f["name"], f.get("aliases") or (), values, f.get("valid_patterns") or ()))
    return out
