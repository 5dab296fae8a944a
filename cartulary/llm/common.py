"""Helpers shared by the operators: intermediate tables, heavy keys, rows found again, small expression tools."""

from __future__ import annotations

import ctypes
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is heavy when it holds more than one row in this many, so there are never more heavy keys than this.
HEAVY_SHARE = 1000
#: Rows of an Arrow batch while a table is written, at most: texts and sets may be long.
ARROW_ROWS = 1000
#: Bytes of one, about: rows of very long texts are fewer.
ARROW_BYTES = 4 << 20
ARROW_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": ARROW_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": ARROW_BYTES}
#: The limits are settings of the session, so one table is written at a time.
WRITING = threading.RLock()
#: Bits of the table that leaves rows out of a shuffle; it has at most FILTER_BITS / 64 rows whatever the data.
FILTER_BITS = 1 << 24
#: The place of rows without an id: after all others.
NO_ID = 2**63 - 1


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all machines share.

    Where the setting is absent and everything runs in this process (tests), a temporary folder is
    created once and the setting is filled in; on a cluster its absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='cartulary-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/cartulary/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later uses don't recompute it, and a lost executor loses nothing.

    While it is written, Arrow batches have ``ARROW_ROWS`` rows and ``ARROW_BYTES`` bytes at most; threads of one session write one after the other.
    """
    path, conf = work_dir(df.sparkSession, label), df.sparkSession.conf
    with WRITING:
        before = {k: conf.get(k) for k in ARROW_LIMITS}
        for k, most in ARROW_LIMITS.items():
            held = int(before[k].rstrip("b"))
            conf.set(k, str(min(most, held) if held > 0 else most))
        try:
            df.write.parquet(path)
        finally:
            for k, v in before.items():
                conf.set(k, v)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing reads any more."""
    for t in tables:
        fs, p = hadoop_fs(t.sparkSession, t.written_to)
        fs.delete(p, True)


def hadoop_fs(spark: SparkSession, path: str):
    """(file system, path object) of Hadoop for ``path``; used on the driver for file names only."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` where ``value`` is computed once a row however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, after which freed memory goes back to the machine: Spark keeps workers, and idle ones would hold their largest task's."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def give_back() -> None:
    """Return freed memory of this process to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def fresh(columns: list[str], name: str) -> str:
    """``name``, with underscores after it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """row (the whole row, so that no column's name can clash), d and h: what tells one document from another.

    ``d`` is the id, ``NO_ID`` for none; ``h`` is a 64-bit hash of the text, so different texts under
    one id are different documents and repeated rows are one.
    """
    return docs.select(F.struct("*").alias("row"), F.coalesce(F.col(id_column).cast("bigint"), F.lit(NO_ID)).alias("d"), F.xxhash64(text).alias("h"))


def split_by_keys(rows: DataFrame, keys: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """(may, not): ``rows`` whose columns ``on`` may be those of a row of ``keys``, and rows for which they surely aren't.

    One bit a hash: the table is broadcast, its size is bounded by ``FILTER_BITS``, and where the keys
    fill it, more rows are only let through.  The second part needs no join with ``keys``.
    """
    place = lambda: F.xxhash64(*on).bitwiseAND(FILTER_BITS - 1)
    bits = keys.select(place().alias("p")).groupBy(F.shiftright("p", 6).alias("_w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("_b"))
    told = rows.withColumn("_p", place()).withColumn("_w", F.shiftright("_p", 6)).join(F.broadcast(bits), "_w", "left")
    hit = F.expr("coalesce(shiftrightunsigned(_b, cast(_p & 63 as int)) & 1, 0) = 1")
    return told.where(hit).select(*rows.columns), told.where(~hit).select(*rows.columns)


def lookup_join(left: DataFrame, right: DataFrame, key: str, weight: str, total: int, how: str = "left") -> DataFrame:
    """Join to ``right`` (one row a ``key``; ``weight``: how many left rows have that key) without a hot task.

    The fewer than ``HEAVY_SHARE`` keys with more than ``total / HEAVY_SHARE`` left rows are split: their left
    rows are dealt by a hash of the other columns, their right rows are repeated for each part, less than
    2 * ``HEAVY_SHARE`` rows more in all.  Only those keys and numbers of parts are broadcast.
    """
    limit = max(1, total // HEAVY_SHARE)
    parts = F.when(F.col(weight) > limit, F.ceil(F.col(weight) / limit)).otherwise(1).cast("int")
    split = right.where(F.col(weight) > limit).select(key, parts.alias("_parts"))
    others = [F.col(c) for c in left.columns if c != key]
    tagged = left.join(F.broadcast(split), key, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*others), F.col("_parts")), F.lit(0)).cast("int")).drop("_parts")
    spread = right.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return tagged.join(spread, [key, "_part"], how).drop("_part")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over undirected ``edges(src, dst)``.

    Large-star and small-star steps: each replaces edges by edges to the smallest neighbour, never
    makes more edges than there were, and is repeated until nothing changes.  A node's smallest neighbour is
    a partial aggregation; the edges of a node of very many are split where they meet it, so a hub is no
    hot task.  Loops and repeated edges are ignored; without edges the result is empty.
    """
    pair = lambda df: df.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src <> dst").distinct()
    current, seen = materialise(pair(edges), "edges"), None
    while True:
        now = current.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
        both = current.union(current.select("dst", "src"))
        least = both.groupBy("src").agg(F.min("dst").alias("m"), F.count("*").alias("times")).select("src", F.least("src", "m").alias("m"), "times")
        large = lookup_join(both, least, "src", "times", 2 * now[0], "inner").where("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        large = materialise(large.where("src <> dst").distinct(), "stars")
        down = large.groupBy("src").agg(F.min("dst").alias("m"), F.count("*").alias("times"))
        small = lookup_join(large, down, "src", "times", now[0], "inner").select(F.col("dst").alias("src"), F.col("m").alias("dst")).union(down.select("src", "m"))
        before, current = current, materialise(pair(small), "edges")
        discard(before, large)
    stars = current.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return stars.union(current.select("dst", "dst").distinct())
