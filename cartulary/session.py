"""A session with the settings that the engine counts on; cluster settings that are present win."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("cartulary")
    builder = builder.master(master) if master else builder
    for k, v in {**DEFAULTS, **extra}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A folder below ``spark.checkpoint.dir``, which all machines share; where that is unset, a temporary one if all runs in this process, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='cartulary-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    if "://" not in base:  # tasks that open files by themselves need to know the store
        p = spark._jvm.org.apache.hadoop.fs.Path(base)
        base = re.sub("^file:/+", "file:///", p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString())
    return f"{base.rstrip('/')}/cartulary"
