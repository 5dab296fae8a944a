"""Train, validation and test splits by subject, rarest modality first.

Order within a stratum is that of md5(seed|subject): the same on any cluster and
for any partitioning, and free of a global shuffle of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartulary.operators.ranking import rank_by_digest

SPLITS = ("train", "val", "test")


@dataclass(frozen=True)
class Ratios:
    train: float = 0.8
    val: float = 0.1
    test: float = 0.1

    def __post_init__(self):
        if not math.isclose(self.train + self.val + self.test, 1.0):
            raise ValueError("the ratios must add up to 1")


def digest_of(column: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(column)).cast("binary"))


def assign_splits(records: DataFrame, ratios: Ratios | None = None, seed: int = 42) -> DataFrame:
    """dataset, subject, stratum, split of every subject of ``records(dataset, subject, modality)``; subjects that differ in case only are one.

    A subject's stratum is the modality of its dataset that the fewest subjects
    have; of n subjects of a stratum the first floor(n x train) are for training,
    the next floor(n x val) for validation, the rest for testing.
    """
    ratios = ratios or Ratios()
    held = records.select("dataset", F.lower("subject").alias("subject"), "modality").distinct()
    coverage = held.groupBy("dataset", "modality").agg(F.count("*").alias("coverage"))
    rarest = held.join(coverage, ["dataset", "modality"]).groupBy("dataset", "subject").agg(F.min(F.struct("coverage", "modality"))["modality"].alias("stratum"))
    ranked = rank_by_digest(rarest, ["dataset", "stratum"], digest_of("subject", seed), ["subject"], "_rn", "_n")
    train, val = F.floor(F.col("_n") * F.lit(float(ratios.train))), F.floor(F.col("_n") * F.lit(float(ratios.val)))
    split = F.when(F.col("_rn") <= train, "train").when(F.col("_rn") <= train + val, "val").otherwise("test")
    return ranked.select("dataset", "subject", "stratum", split.alias("split"))


def assign_two_pools(subjects: DataFrame, ratios: Ratios | None = None, seed: int = 42) -> DataFrame:
    """subject, split of ``subjects(subject, pool)`` with pools training and validation.

    Of n subjects round(n x test), half to even, are tested, taken from the
    validation pool; the rest of it validates, topped up from the training pool
    to round(n x val).  More test subjects than the pool holds raise.
    """
    ratios = ratios or Ratios()
    counted = subjects.agg(F.count("*").alias("n"), F.count_if(F.col("pool") == "validation").alias("v"), F.count_if(~F.col("pool").isin("training", "validation")).alias("other")).first()
    if counted.other:
        raise ValueError(f"{counted.other} subjects are in neither pool")
    test, val = round(counted.n * ratios.test), round(counted.n * ratios.val)
    if test > counted.v:
        raise ValueError(f"{test} subjects to test, {counted.v} in the validation pool")
    top_up = max(0, val - (counted.v - test))
    split = (
        F.when((F.col("pool") == "validation") & (F.col("_rn") <= test), "test")
        .when(F.col("pool") == "validation", "val")
        .when(F.col("_rn") <= top_up, "val")
        .otherwise("train")
    )
    return rank_by_digest(subjects.select("subject", "pool"), ["pool"], digest_of("subject", seed), ["subject"], "_rn", "_n").select("subject", "pool", split.alias("split"))


def records_by_subject(records: DataFrame) -> DataFrame:
    """dataset, subject (lower case), n_records, spellings, modalities: the records of each subject, whose spellings may differ in case; no array is longer than what it lists is distinct."""
    return records.groupBy("dataset", F.lower("subject").alias("subject")).agg(
        F.count("*").alias("n_records"), F.array_sort(F.collect_set("subject")).alias("spellings"), F.array_sort(F.collect_set("modality")).alias("modalities")
    )


def modality_order(records: DataFrame) -> DataFrame:
    """dataset, modalities: those of its subjects, the one that the fewest have first."""
    held = records.select("dataset", F.lower("subject").alias("subject"), "modality").distinct()
    coverage = held.groupBy("dataset", "modality").agg(F.count("*").alias("coverage"))
    return coverage.groupBy("dataset").agg(F.array_sort(F.collect_list(F.struct("coverage", "modality")))["modality"].alias("modalities"))


def label_records(records: DataFrame, splits: DataFrame) -> DataFrame:
    """``records`` with the split of their subject."""
    keyed = records.withColumn("_s", F.lower("subject"))
    return keyed.join(splits.select("dataset", F.col("subject").alias("_s"), "split"), ["dataset", "_s"]).drop("_s")


def check_splits(records: DataFrame, labelled: DataFrame) -> DataFrame:
    """One row: subjects in several splits, subjects without one, and rows before and after."""
    per = labelled.groupBy("dataset", F.lower("subject").alias("subject")).agg(F.count_distinct("split").alias("k"))
    before = records.select("dataset", F.lower("subject").alias("subject")).distinct()
    overlap = per.agg(F.count_if(F.col("k") > 1).alias("n_overlapping"))
    lost = before.join(per, ["dataset", "subject"], "left_anti").agg(F.count("*").alias("n_unassigned"))
    rows = records.agg(F.count("*").alias("n_records")).crossJoin(labelled.agg(F.count("*").alias("n_labelled")))
    return overlap.crossJoin(lost).crossJoin(rows)  # four one-row tables


def distribution_table(labelled: DataFrame, skip: tuple[str, ...] = ("seg",)) -> DataFrame:
    """Modality by split: counts, the total, its share in percent of all, and a row All of the sums."""
    counts = [F.count_if(F.col("split") == s).alias(s) for s in SPLITS]
    table = labelled.where(~F.col("modality").isin(*skip)).rollup("modality").agg(*counts, F.count("*").alias("total"), F.grouping("modality").alias("_all"))
    whole = F.max(F.when(F.col("_all") == 1, F.col("total"))).over(Window.partitionBy(F.lit(0)))
    out = table.select(F.when(F.col("_all") == 1, "All").otherwise(F.col("modality")).alias("modality"), *SPLITS, "total", F.round(100.0 * F.col("total") / whole, 1).alias("share"))
    return out
