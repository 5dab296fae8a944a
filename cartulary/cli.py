"""Command line: prepare a folder of datasets, export a split of a catalogue, reset the flags of a ledger.

    python -m cartulary.cli prepare --root FOLDER --output FOLDER [--defaults FILE] [--include NAME ... | --exclude NAME ...] [--demographics FOLDER --fields FILE] [--validate] [--ledger FOLDER]
    python -m cartulary.cli split --dataset-json FOLDER --output-json FOLDER [--train-ratio 0.8 --val-ratio 0.1 --test-ratio 0.1 --seed 42] [--dataset-root FOLDER --output-root FOLDER]
    python -m cartulary.cli reset-flags --ledger FOLDER --output FOLDER -k isDownloaded isValidated [-d NAME ...] [--dry-run]

Catalogues and ledgers are folders that Spark reads; results are written as folders and never over what is there.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.operators.settings import reset_flags, reset_summary
from cartulary.operators.split import Ratios, assign_splits, check_splits, distribution_table, label_records
from cartulary.operators.validate import HeaderRules
from cartulary.prepare import prepare
from cartulary.sources.copying import copy_tree
from cartulary.sources.ledger import FlagLedger
from cartulary.sources.sinks import copy_plan, write_catalogue
from cartulary.sources.tables import read_rules, read_settings


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="cartulary")
    commands = out.add_subparsers(dest="command", required=True)
    zero = commands.add_parser("prepare", help="make one catalogue of the entries of every dataset below a folder")
    zero.add_argument("--root", required=True, help="a folder of datasets, each with its settings and its files")
    zero.add_argument("--output", required=True, help="where the catalogue is written, a folder for each dataset")
    zero.add_argument("--defaults", help="settings that datasets may override, a JSON file")
    zero.add_argument("--include", nargs="+", help="only these datasets")
    zero.add_argument("--exclude", nargs="+", help="all datasets but these")
    zero.add_argument("--demographics", help="a folder with a table of participants for each dataset")
    zero.add_argument("--fields", help="the tables' columns, a YAML file")
    zero.add_argument("--validate", action="store_true", help="read and check the volumes' headers and voxels")
    zero.add_argument("--ledger", help="a folder with the ledger of flags, in which finished stages are noted")
    # fixed values: the names of the options of the next two
    one = commands.add_parser("split", help="assign subjects to train, val and test, and write the labelled records")
    one.add_argument("--dataset-json", required=True, help="records (dataset, subject, modality, ...), a JSON object a line")
    one.add_argument("--output-json", required=True)
    for name, share in (("train", 0.8), ("val", 0.1), ("test", 0.1)):
        one.add_argument(f"--{name}-ratio", type=float, default=share)
    one.add_argument("--seed", type=int, default=42)
    one.add_argument("--dataset-root", help="the tree of files that the records name in the map preprocessed")
    one.add_argument("--output-root", help="where to copy those files; a new tree")
    two = commands.add_parser("reset-flags", help="set flags to false for the datasets that have all of them")
    two.add_argument("--ledger", required=True, help="a ledger (dataset, flag, value), a JSON object a line")
    two.add_argument("--output", help="where to write the ledger; not used in a dry run")
    two.add_argument("-d", "--datasets", nargs="*", default=None, help="only these (all)")
    two.add_argument("-k", "--keys", nargs="+", required=True)
    two.add_argument("--dry-run", action="store_true")
    return out


def prepared(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    """Write the catalogue; how many entries each dataset has, and what went wrong."""
    overrides = {k: v for k, v in (("include", a.include), ("exclude", a.exclude)) if v}
    fields = read_rules(a.fields) if a.fields else []
    ledger = FlagLedger(spark, a.ledger) if a.ledger else None
    out = prepare(spark, a.root, read_settings(a.defaults) if a.defaults else {}, overrides, a.demographics, fields, HeaderRules() if a.validate else None, ledger)
    write_catalogue(out.entries, a.output)
    counts = out.entries.groupBy("dataset").agg(F.count("*").alias("n_entries")).orderBy("dataset").collect()
    return [*(r.asDict() for r in counts), *({"dataset": d, "problem": f"{stage}: {why}"} for d, stage, why in out.problems)]


def split(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Write the labelled records; their table of modalities by split.  Subjects in several splits or in none raise."""
    records = spark.read.json(a.dataset_json)
    labelled = label_records(records, assign_splits(records, Ratios(a.train_ratio, a.val_ratio, a.test_ratio), a.seed))
    told = check_splits(records, labelled).first()
    if told.n_overlapping or told.n_unassigned or told.n_records != told.n_labelled:
        raise ValueError(f"the split is wrong: {told}")
    if a.output_root:
        if not a.dataset_root:
            raise ValueError("where are the files that are to be copied? (--dataset-root)")
        plan = copy_plan(labelled, "preprocessed", a.dataset_root, a.output_root)
        copy_tree(plan.select("src", F.substring("dst", len(a.output_root.rstrip("/")) + 2, 1 << 20).alias("path")), a.output_root)
    labelled.write.json(a.output_json)
    return distribution_table(labelled).orderBy(F.col("modality") == "All", "modality")


def flags(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Write the ledger with reset flags, unless it is a dry run; how many datasets are patched and left alone."""
    ledger = spark.read.schema("dataset string, flag string, value string").json(a.ledger)
    chosen = ledger if a.datasets is None else ledger.where(F.col("dataset").isin(a.datasets))
    if not a.dry_run:
        if not a.output:
            raise ValueError("where is the ledger to be written? (--output)")
        done = reset_flags(chosen, a.keys).drop("patched")
        rest = ledger.limit(0) if a.datasets is None else ledger.where(~F.col("dataset").isin(a.datasets))
        done.unionByName(rest).write.json(a.output)
    return reset_summary(chosen, a.keys)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> list[dict]:
    """Run a command; the rows that it prints."""
    a = parser().parse_args(argv)
    if spark is None:
        from cartulary.session import get_session

        spark = get_session()
    told = {"prepare": prepared, "split": split, "reset-flags": flags}[a.command](spark, a)
    rows = told if isinstance(told, list) else [r.asDict() for r in told.collect()]
    for r in rows:
        print(r)
    return rows


if __name__ == "__main__":
    main()
