"""Aggregate reports: each is one pass with partial aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartulary.operators.ranking import ranked


def present(c: Column) -> Column:
    return F.coalesce(c.cast("string") != "", F.lit(False))


def subject_summary(df: DataFrame, subject: str, session: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    """One row: distinct subjects, distinct (subject, session), rows, and rows of each kind."""
    return df.agg(
        F.count_distinct(subject).alias("n_subjects"),
        F.count_distinct(F.struct(subject, session)).alias("n_sessions"),
        F.count("*").alias("n_total"),
        *(F.count_if(F.col(kind) == k).alias(f"n_{k}") for k in kinds),
    )


def catalogue_counts(df: DataFrame, dataset: str, kind: str) -> DataFrame:
    """For each kind: rows, datasets that have any, and the percentage of all rows."""
    per = df.groupBy(dataset, kind).agg(F.count("*").alias("n"))
    out = per.groupBy(kind).agg(F.sum("n").cast("bigint").alias("n_rows"), F.count("*").alias("n_datasets"))
    return out.withColumn("pct", F.round(100.0 * F.col("n_rows") / df.agg(F.count("*")).scalar(), 4))


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """How many rows (of each key) meet each condition."""
    return df.groupBy(*keys).agg(*(F.count_if(c).alias(k) for k, c in conditions.items()))


def combination_counts(df: DataFrame, keys: Mapping[str, Column], within: str) -> DataFrame:
    """Rows of each combination of ``keys``, and of each value of its key ``within`` in all."""
    counted = df.groupBy(*(c.alias(k) for k, c in keys.items())).agg(F.count("*").alias("n"))
    return counted.withColumn("n_within", F.sum("n").over(Window.partitionBy(within)).cast("bigint"))


def category_shares(df: DataFrame, column: str) -> DataFrame:
    """Count of each present value and its percentage of all present ones, values outside any known list included."""
    told = df.where(present(F.col(column))).select(F.col(column).alias("category"))
    return told.groupBy("category").agg(F.count("*").alias("n")).withColumn("pct", F.round(100.0 * F.col("n") / told.agg(F.count("*")).scalar(), 4))


def images_only(df: DataFrame, kind: str, skip: Sequence[str] = ("seg",)) -> DataFrame:
    """``df`` without the kinds that aren't images; rows without a kind stay."""
    return df.where(~F.coalesce(F.col(kind).isin(*skip), F.lit(False)))


def scanner_coverage(df: DataFrame, kind: str, maker: str, strength: str) -> DataFrame:
    """One row: rows with and without scanner details, their coverage in percent, and the makers in order; segmentations aside."""
    known = present(F.col(maker)) | present(F.col(strength))
    return images_only(df, kind).agg(
        F.count("*").alias("n_total"), F.count_if(~known).alias("n_missing"), F.round(100.0 * F.count_if(known) / F.count("*"), 2).alias("coverage"),
        F.array_join(F.array_sort(F.collect_set(F.when(present(F.col(maker)), F.col(maker)))), ", ").alias("makers"),
    )


def scanner_missing(df: DataFrame, kind: str, maker: str, strength: str) -> DataFrame:
    """For each kind: rows, and those without scanner details."""
    known = present(F.col(maker)) | present(F.col(strength))
    return images_only(df, kind).groupBy(kind).agg(F.count("*").alias("n_total"), F.count_if(~known).alias("n_missing"))


def placed(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """A report's rows with their ``place`` in ``order``."""
    return ranked(df, order, "place")


def strength_counts(df: DataFrame, kind: str, strength: str) -> DataFrame:
    """Rows of each present field strength, a text, with its place in numeric order."""
    told = images_only(df, kind).where(present(F.col(strength)))
    return placed(told.groupBy(strength).agg(F.count("*").alias("n")), [F.col(strength).try_cast("double").asc_nulls_last(), strength])


def most_in_group(df: DataFrame, keys: Sequence[str], kind: str) -> DataFrame:
    """For each kind, the most rows that one group of ``keys`` has of it."""
    return df.groupBy(*keys, kind).agg(F.count("*").alias("n")).groupBy(kind).agg(F.max("n").alias("most"))


def distinct_sorted(df: DataFrame, key: str, value: str, group: str) -> DataFrame:
    """For each key: its distinct values in order, and its least group."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("found"), F.min(group).alias("least_group"))


def mean_and_spread(df: DataFrame, column: str, keys: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Mean and population standard deviation."""
    return df.groupBy(*keys).agg(F.count(column).alias("n"), F.round(F.avg(column), digits).alias("mean"), F.round(F.stddev_pop(column), digits).alias("std"))


def nearest_bin(c: Column, width: float = 5.0, bins: int = 20) -> Column:
    """The bin whose centre is nearest; ties go to the lower bin, values beyond the ends to the end bins."""
    return F.least(F.greatest(F.ceil(c / width) - 1, F.lit(0)), F.lit(bins - 1)).cast("int")


def binned(df: DataFrame, value: str, kind: str, kinds: Sequence[str], width: float = 5.0, bins: int = 20) -> DataFrame:
    """Counts by bin (all bins, empty ones too) and kind."""
    counted = df.where(F.col(value).isNotNull()).groupBy(nearest_bin(F.col(value), width, bins).alias("bin")).agg(*(F.count_if(F.col(kind) == k).alias(f"n_{k}") for k in kinds))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(F.broadcast(counted), "bin", "left").na.fill(0)  # no more rows than bins


def median_bin(df: DataFrame, value: str, width: float = 5.0, bins: int = 20) -> DataFrame:
    """The first bin at which the running count reaches half of all."""
    counted = df.where(F.col(value).isNotNull()).groupBy(nearest_bin(F.col(value), width, bins).alias("bin")).agg(F.count("*").alias("n"))
    one = Window.partitionBy(F.lit(0))  # no more rows than bins
    run = counted.select("bin", F.sum("n").over(one.orderBy("bin")).alias("upto"), F.sum("n").over(one).alias("total"))
    return run.where(F.col("upto") * 2 >= F.col("total")).agg(F.min("bin").alias("median_bin"), F.max("total").cast("bigint").alias("n_total"))


def flag_counts(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """(flag, n) rows: how often each is set, and how many rows have any."""
    any_flag = F.exists(F.array(*(F.coalesce(c, F.lit(False)) for c in flags.values())), lambda x: x)
    wide = df.agg(*(F.count_if(c).alias(k) for k, c in flags.items()), F.count_if(any_flag).alias("any"))
    return wide.unpivot([], [*flags, "any"], "flag", "n")


def sampled_metrics(df: DataFrame, at: str, value: str, unit: str = "day") -> DataFrame:
    """Maximum and mean of polled values in each unit of time."""
    return df.groupBy(F.date_trunc(unit, F.col(at)).cast("date").alias(unit)).agg(F.count("*").alias("n"), F.max(value).alias("max_value"), F.round(F.avg(value), 6).alias("mean_value"))
