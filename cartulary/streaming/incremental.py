"""Stages over files that keep arriving, and metrics over polled samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def window_metrics(samples: DataFrame, at: str, value: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Count, maximum and mean of ``value`` in tumbling windows; samples later than ``late`` are left out once their window has closed."""
    timed = samples.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late)
    out = timed.groupBy(F.window("_at", width)).agg(F.count("*").alias("n"), F.max(value).alias("max_value"), F.round(F.avg(value), 6).alias("mean_value"))
    return out.select(F.col("window.start").alias("start"), "n", "max_value", "mean_value")


def run_available(stream: DataFrame, stage: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Apply ``stage`` to everything that has arrived since the last run and stop; the checkpoint keeps what has been done."""
    query = stream.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def write_by_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A stage that writes each batch to a folder of its own, so that a repeated batch replaces itself."""

    def stage(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stage
