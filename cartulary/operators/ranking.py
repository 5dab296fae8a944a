"""Ranks and line numbers of groups of any size, without one task that sorts a whole group."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartulary.session import shared_dir

#: A group's digests are dealt into ranges by so many leading hexadecimal digits: at most 4096 a group.
DIGITS = 3


def rank_by_digest(df: DataFrame, keys: Sequence[str], digest: Column, tie: Sequence[str], rank: str, size: str) -> DataFrame:
    """``df`` with each row's ``rank`` (from 1) among its ``keys`` by a hexadecimal ``digest``, then ``tie``, and the group's ``size``.

    Ranges of digests are counted first; a row's rank is its place in its range plus the rows of
    the ranges before, so no task holds more than about a 4096th of a group.  Null keys are a group.
    """
    told = df.select(F.struct("*").alias("row"), *(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), *(F.col(t).alias(f"t{i}") for i, t in enumerate(tie)), digest.alias("digest"))
    told = told.withColumn("part", F.substring("digest", 1, DIGITS))
    names = [f"k{i}" for i in range(len(keys))]
    group = Window.partitionBy(*names)  # no more than 4096 ranges a group
    counted = told.groupBy(*names, "part").agg(F.count("*").alias("n"))
    before = counted.select(*(F.col(c).alias(f"r_{c}") for c in (*names, "part")), (F.sum("n").over(group.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(group).alias("size"))
    same = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in (*names, "part")]
    joined = told.join(before, same)
    place = F.row_number().over(Window.partitionBy(*names, "part").orderBy("digest", *(f"t{i}" for i in range(len(tie)))))
    return joined.select("row", (place + F.col("before")).cast("bigint").alias("rank"), F.col("size").cast("bigint")).select("row.*", F.col("rank").alias(rank), F.col("size").alias(size))


def ranked(df: DataFrame, order: Sequence[Column | str], rank: str = "rank", first: int = 1) -> DataFrame:
    """``df`` with each row's place in ``order`` over the whole table, from ``first``.

    Rows are sorted into ranges, one a partition, and written once to the shared folder; a row's rank is
    its place in its file and the rows of the ranges before, of which there are as many as shuffle partitions.
    No task holds more than a range.  Rows that tie stand in any order, all in one range.
    """
    spark, columns = df.sparkSession, df.columns
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_dir(spark)}/ranks-{uuid.uuid4().hex}"
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    told = dealt.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), F.spark_partition_id().alias("part"))
    told.write.option("maxRecordsPerFile", 0).parquet(path)
    found = spark.read.schema(told.schema).parquet(path).select("row", "part", F.col("_metadata.row_index").alias("at"))
    counted = found.groupBy("part").agg(F.count("*").alias("n"))
    before = counted.select("part", (F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part")) - F.col("n")).alias("before"))  # a row a range
    return found.join(F.broadcast(before), "part").select("row.*", (F.col("at") + F.col("before") + first).cast("bigint").alias(rank))


def numbered_lines(df: DataFrame, order: Sequence[str], line: Column, first: int = 1) -> DataFrame:
    """(line_no, line) of the rows in ``order``: sorted by ranges, numbered range after range."""
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(order)]
    return ranked(df.select(line.alias("line"), *keys), [f"k{i}" for i in range(len(order))], "line_no", first).select("line_no", "line")
