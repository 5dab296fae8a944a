"""The whole preparation of a folder of datasets: one catalogue of entries from files, headers, sidecars and participants.

Each dataset is a folder with settings (``metadata.json``), its files below ``Download`` and, elsewhere, a table of
participants.  The files of all datasets are listed once; each dataset's paths are parsed by its own rules.  A dataset whose rules or
tables are wrong is left out or left without what they would add, and said so in ``problems``; the others go on.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.functions.scalars import path_name, sidecar_path
from cartulary.operators import preprocess
from cartulary.operators.grouping import last_wins, pivot_entries
from cartulary.operators.joins import fallback_lookup
from cartulary.operators.normalize import RANGES, Field, check_cell, normalise_columns, normalise_values, strip_prefix
from cartulary.operators.paths import PathRules, parse_paths
from cartulary.operators.settings import merge_settings
from cartulary.operators.validate import HeaderRules, validate_headers
from cartulary.session import shared_dir
from cartulary.sources import nifti
from cartulary.sources.ledger import FlagLedger
from cartulary.sources.listing import list_files, subdirectories
from cartulary.sources.tables import file_path, read_sidecars, read_tsv, root_sidecars

log = logging.getLogger(__name__)

#: Fields of a sidecar that entries keep, names of files and folders.
SCANNER_FIELDS = ("Manufacturer", "ManufacturersModelName", "MagneticFieldStrength")
SETTINGS, PARTICIPANTS, DOWNLOAD = "metadata.json", "participants.tsv", "Download"
#: Prefixes of keys that a table and a catalogue may write differently.
SUBJECT_PREFIX, SESSION_PREFIX = ("^sub[-_]?",), ("^ses[-_]?",)


@dataclass
class Prepared:
    entries: DataFrame
    headers: DataFrame
    problems: list[tuple[str, str, str]] = field(default_factory=list)


def chosen(names: Sequence[str], overrides: Mapping[str, Any]) -> list[str]:
    """``include`` as it is; else ``names`` less ``exclude``, whose names must be there; else all."""
    if "include" in overrides:
        return list(overrides["include"])
    unknown = [x for x in overrides.get("exclude", ()) if x not in names]
    if unknown:
        raise ValueError(f"excluded but not there: {unknown}")
    return [n for n in names if n not in set(overrides.get("exclude", ()))]


def read_all_settings(spark: SparkSession, root: str, names: Sequence[str], defaults: Mapping[str, Any]) -> dict[str, dict]:
    """Each dataset's settings over the defaults; a malformed file counts as empty; datasets that aren't to be included are left out."""
    found = spark.read.text(f"{root.rstrip('/')}/*/{SETTINGS}", wholetext=True).select(F.element_at(F.split(file_path(), "/"), -2).alias("dataset"), "value")
    told = {}
    for r in found.where(F.col("dataset").isin(list(names))).collect():  # one small file a dataset
        try:
            own = json.loads(r.value)
        except json.JSONDecodeError:
            own = {}
        told[r.dataset] = own if isinstance(own, dict) else {}
    merged = {n: merge_settings(dict(defaults), told.get(n, {})) for n in names}
    return {n: s for n, s in merged.items() if s.get("includeDataset", True)}


def rules_of(settings: Mapping[str, Any]) -> PathRules:
    mapping = settings.get("mapping") or {}
    regex = mapping.get("regex")
    if not regex:
        raise ValueError("no mapping")
    return PathRules(
        subject=regex["subject"], session=regex.get("session") or "", type=regex.get("type") or "", modality=tuple((regex.get("modality") or {}).items()),
        include=mapping.get("includeSub") or (), exclude=mapping.get("excludeSub") or (), first_group_only=bool(mapping.get("mapFirstGroupOnly")),
    )


def map_entries(files: DataFrame, rules: PathRules) -> DataFrame:
    """subject, session, type, group, mris (modality to name), download (modality to path) of ``files(dataset, path)``."""
    keys = ["dataset", "subject", "session", "type"]
    told = pivot_entries(parse_paths(files, rules), keys, "modality", "path", ["path"], rules.first_group_only)
    return told.select(*keys, F.col("grp").cast("int").alias("group"), F.transform_values("files", lambda _, p: path_name(p)).alias("mris"), F.col("files").alias("download"))


def people_of(table: DataFrame, dataset: str, fields: Sequence[Field]) -> DataFrame:
    """dataset, pid, ses, demographics (a map of the cells that aren't blank): the last row of each participant and session."""
    told = normalise_columns(table, fields)
    if "participant_id" not in told.columns:
        raise ValueError("no column of participants")
    for c in told.columns:
        cell = check_cell(F.col(c), *RANGES.get(c, (None, None)))
        bad = F.raise_error(F.concat(F.lit(f"{c}: not a number: "), F.col(c))).cast("string")
        told = told.withColumn(c, F.when(cell["bad_number"], bad).otherwise(cell["value"]) if c in RANGES else cell["value"])
    given = [f for f in fields if f.name in told.columns and f.values]
    blank_ok = [Field(f.name, f.aliases, {**f.values, "": ()}, f.strip) for f in given]
    told = normalise_values(told, blank_ok).withColumn("_at", F.monotonically_increasing_id())
    kept = [c for c in told.columns if c not in ("_at",)]
    cells = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, kept)), F.array(*(F.coalesce(c, F.lit("")) for c in kept))), lambda _, v: v != "")
    session = strip_prefix(F.col("session"), SESSION_PREFIX) if "session" in told.columns else F.lit(None).cast("string")
    out = told.select(F.lit(dataset).alias("dataset"), strip_prefix(F.col("participant_id"), SUBJECT_PREFIX).alias("pid"), session.alias("ses"), cells.alias("demographics"), "_at")
    return last_wins(out, ["dataset", "pid", "ses"], ["_at"]).drop("_at")


def attach_people(entries: DataFrame, people: DataFrame) -> DataFrame:
    """``entries`` with the demographics of their subject, of their session where the table tells sessions; empty where nobody is found."""
    pid, ses = strip_prefix(F.col("e.subject"), SUBJECT_PREFIX), strip_prefix(F.col("e.session"), SESSION_PREFIX)
    same = (F.col("e.dataset") == F.col("p.dataset")) & (pid == F.col("p.pid")) & (F.col("p.ses").isNull() | (ses == F.col("p.ses")))
    joined = entries.alias("e").join(people.alias("p"), same, "left")
    return joined.select("e.*", F.coalesce("p.demographics", F.create_map().cast("map<string,string>")).alias("demographics"))


def attach_scanner(entries: DataFrame, sidecars: DataFrame) -> DataFrame:
    """``entries`` with ``scanner``: for each modality the fields of its own sidecar, else of the dataset's for the modality, else none.  ``sidecars(dataset, path, fields)``."""
    keys = ["dataset", "subject", "session", "type", "group"]
    each = entries.select(*keys, F.explode("download").alias("modality", "file")).withColumn("path", sidecar_path(F.col("file")))
    near = each.join(sidecars.withColumnRenamed("fields", "near"), ["dataset", "path"], "left")
    top = sidecars.where(~F.col("path").contains("/"))
    far = top.select("dataset", F.struct("path", "fields").alias("s")).select("dataset", F.col("s.path").alias("path"), F.col("s.fields").alias("fields"))
    roots = root_sidecars(far.withColumn("path", F.concat(F.lit("/"), "path")).select("path", "fields", "dataset"), keep=("dataset",)).withColumnRenamed("fields", "far")
    both = near.join(roots, ["dataset", "modality"], "left")
    told = both.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("modality", fallback_lookup(F.col("near"), F.col("far"), SCANNER_FIELDS)))).alias("scanner"))
    return entries.join(told, keys, "left")


def attach_headers(entries: DataFrame, root: str, rules: HeaderRules) -> tuple[DataFrame, DataFrame]:
    """(``entries`` with ``nifti_info`` of the files that pass, the headers with their errors); no entry is dropped."""
    keys = ["dataset", "subject", "session", "type", "group"]
    each = entries.select(*keys, F.explode("download").alias("modality", "file"))
    path = F.concat_ws("/", F.lit(root.rstrip("/")), "dataset", F.lit(DOWNLOAD), "file")
    held = each.withColumn("path", path)
    out = f"{shared_dir(entries.sparkSession)}/headers-{uuid.uuid4().hex}"
    validate_headers(nifti.scan_files(held.select("path")), rules).write.parquet(out)
    headers = entries.sparkSession.read.parquet(out)
    good = held.join(headers.where("valid").select("path", F.struct(F.transform("zooms", lambda z: z.cast("double")).alias("downloadVoxelSizes")).alias("info")), "path")
    told = good.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("modality", "info"))).alias("nifti_info"))
    return entries.join(told, keys, "left"), headers


def tried(problems: list, dataset: str, stage: str, work: Callable[[], Any]) -> Any:
    """What ``work`` gives; None, and a line in ``problems``, where it fails."""
    try:
        return work()
    except Exception as e:  # noqa: BLE001  (one dataset's fault leaves the others alone)
        log.warning("%s: %s: %s", dataset, stage, e)
        problems.append((dataset, stage, str(e).split("\n")[0][:300]))
        return None


def prepare(spark: SparkSession, root: str, defaults: Mapping[str, Any] | None = None, overrides: Mapping[str, Any] | None = None, people: str | None = None, fields: Sequence[Field] = (), rules: HeaderRules | None = None, ledger: FlagLedger | None = None) -> Prepared:
    """Entries of every dataset below ``root``, with scanner, header, demographic and preprocessed details.

    ``people``: a folder with a table of participants for each dataset, whose columns are ``fields``; ``rules``: check the volumes' headers
    (they aren't read without); ``ledger``: stages that are done are noted there.
    """
    problems: list[tuple[str, str, str]] = []
    settings = read_all_settings(spark, root, chosen(subdirectories(spark, root, True), overrides or {}), defaults or {})
    path = f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"
    parts = F.split("path", "/")
    listed = list_files(spark, root).where(parts[1] == DOWNLOAD)
    listed.select(parts[0].alias("dataset"), F.array_join(F.slice(parts, 3, F.size(parts)), "/").alias("path")).where("path <> ''").write.partitionBy("dataset").parquet(path)
    files = spark.read.schema("path string, dataset string").parquet(path)
    found: dict[str, DataFrame] = {}
    for name, told in settings.items():
        one = tried(problems, name, "mapping", lambda n=name, s=told: map_entries(files.where(F.col("dataset") == n), rules_of(s)))
        if one is not None:
            found[name] = one.withColumn("preprocessed", F.create_map().cast("map<string,string>"))
            if (told.get("preprocess") or {}).get("preprocessor") == "identity":
                done = tried(problems, name, "preprocess", lambda o=one, s=told: preprocess.pass_through(o, s))
                found[name] = found[name] if done is None else done
    if not found:
        raise ValueError(f"no dataset of {root} can be mapped: {problems}")
    entries = written(reduce(DataFrame.unionByName, found.values()), "entries")
    sidecars = read_sidecars(spark, root)
    inside = F.split(F.substring_index("path", f"/{root.rstrip('/').rpartition('/')[2]}/", -1), "/")
    told = sidecars.where(inside[1] == DOWNLOAD).select(inside[0].alias("dataset"), F.array_join(F.slice(inside, 3, F.size(inside)), "/").alias("path"), "fields")
    entries = attach_scanner(entries, written(told, "sidecars"))
    headers = spark.createDataFrame([], "path string, errors array<string>, valid boolean")
    if rules is not None:
        entries, headers = attach_headers(entries, root, rules)
    everyone = []
    for name in found if people else ():
        one = tried(problems, name, "demographics", lambda n=name: written(people_of(read_tsv(spark, f"{people.rstrip('/')}/{n}/{PARTICIPANTS}"), n, fields), "people"))
        everyone += [] if one is None else [one]
    if everyone:
        entries = attach_people(entries, reduce(DataFrame.unionByName, everyone))
    if ledger is not None:
        flags = [(n, "isDatasetJsonCreated", str(n in found).lower()) for n in settings] + [(n, "isValidationCheckDone", "true") for n in found if rules is not None]
        ledger.update(spark.createDataFrame(flags, "dataset string, flag string, value string"))
    return Prepared(entries, headers, problems)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` from the shared folder: a fault in it shows here, and it isn't made twice."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
