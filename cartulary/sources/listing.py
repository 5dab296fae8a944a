"""Folders and files as tables of paths."""

from __future__ import annotations

import re
import uuid
from collections import deque
from collections.abc import Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.functions.patterns import glob_to_regex, matches_glob
from cartulary.functions.scalars import path_name
from cartulary.session import shared_dir
from cartulary.sources.stores import entries_of, opened_by_tasks, store_of

#: Entries that a task meets below a folder before it hands the other folders back; folders that a task is given.
MET, FOLDERS = 10_000, 1000
#: Bytes that a task reads, about, and what opening a file counts for; rows and bytes that wait in a task.
TASK_BYTES, OPEN_BYTES, ROWS, HELD_BYTES = 128 << 20, 128 << 10, 1000, 4 << 20

WALKED = "root string, inside string, length bigint, modified bigint"
ARROW = pa.schema([("root", pa.string()), ("inside", pa.string()), ("length", pa.int64()), ("modified", pa.int64())])
CONTENTS = pa.schema([("path", pa.string()), ("length", pa.int64()), ("content", pa.binary())])


def subdirectories(spark: SparkSession, path: str, names_only: bool = False) -> list[str]:
    """Folders directly below ``path``, sorted; an error if that isn't a folder.  Any file system that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(path)
    if not fs.getFileStatus(p).isDirectory():
        raise NotADirectoryError(path)
    found = [s.getPath() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(f.getName() if names_only else f.toString() for f in found)


def roots_of(spark: SparkSession, path: str) -> list[str]:
    """The folders and files that ``path`` names, globs as Hadoop reads them; an error if there are none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    if not found:
        raise FileNotFoundError(path)
    return [s.getPath().toString() for s in found]


def unread(name: str) -> bool:
    """Whether Spark's readers pass a file or folder over for its name."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata")))


def visited(root: str, folder: str, most: int, top: Sequence[re.Pattern] | None) -> Iterator[tuple[str, str, int | None, int | None]]:
    """Rows of ``WALKED`` for what is below a folder of ``root``: files, and once ``most`` entries have been met the folders that are still to be visited, without a length."""
    store, base = store_of(root)
    if not folder and store.get_file_info(base).is_file:
        yield from ((root, "", f.size, (f.mtime_ns or 0) // 1_000_000) for f in [store.get_file_info(base)] if f.size and not unread(f.base_name))
        return
    met, waiting = 0, deque([folder])
    while waiting:
        here = waiting.popleft()
        if met >= most:
            yield root, here, None, None
            continue
        for name, is_dir, size, modified in entries_of(store, f"{base}/{here}" if here else base):
            met += 1
            inside, asked = f"{here}/{name}" if here else name, top is not None and not here
            if asked and not any(p.match(name) for p in top) or unread(name) and not (asked and is_dir):
                continue
            if not is_dir and size:
                yield root, inside, size, modified
            elif is_dir and met >= most:
                yield root, inside, None, None
            elif is_dir:
                waiting.append(inside)


def walk(spark: SparkSession, roots: Sequence[str], top: Sequence[str] | None = None) -> DataFrame:
    """path, inside (relative to its root), length, modified of the files below ``roots`` that Spark would read: neither empty nor hidden.

    Tasks list the folders; a task that has met ``MET`` entries below one hands its other folders back, and they are dealt
    out in the next round.  What is found goes to the shared folder, nothing of it through the driver.  ``top``: patterns, one of which the names directly in the roots match.
    """
    out, most, k = f"{shared_dir(spark)}/listing-{uuid.uuid4().hex}", MET, 0
    patterns = None if top is None else [re.compile(t) for t in top]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for root, folder in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = visited(root, folder, most, patterns)
                while part := list(islice(rows, ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*part, strict=True), ARROW, strict=True)], schema=ARROW)

    todo = spark.createDataFrame([(r, "") for r in roots], "root string, inside string")
    while True:
        todo.mapInArrow(run, WALKED).write.parquet(f"{out}/{k}")
        left = spark.read.schema(WALKED).parquet(f"{out}/{k}").where("length is null").select("root", "inside")
        n, k = left.count(), k + 1
        if not n:
            break
        todo = left.repartition(max(min(n, 4 * spark.sparkContext.defaultParallelism), n // FOLDERS), "root", "inside")
    told = spark.read.schema(WALKED).parquet(*(f"{out}/{i}" for i in range(k))).where("length is not null")
    path = F.when(F.col("inside") == "", F.col("root")).otherwise(F.concat(F.rtrim("root", F.lit("/")), F.lit("/"), "inside"))
    inside = F.when(F.col("inside") == "", path_name(F.col("root"))).otherwise(F.col("inside"))
    return told.select(path.alias("path"), inside.alias("inside"), "length", F.timestamp_millis("modified").alias("modified"))


def found_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``walk`` of a path, of the files whose names match ``glob`` (as Spark's ``pathGlobFilter``)."""
    told = walk(spark, roots_of(spark, path))
    if glob is None:
        return told
    pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    return told.where(path_name(F.col("path")).rlike(f"(?s)^(?:{pattern})\\z"))


def dealt(files: DataFrame) -> DataFrame:
    """``files(path, length)`` over as many tasks as opening and reading them asks for."""
    told = files.agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).first()
    tasks = (told.n * OPEN_BYTES + (told.bytes or 0)) // TASK_BYTES
    return files.repartition(max(1, tasks, min(told.n, files.sparkSession.sparkContext.defaultParallelism)), "path")


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path (relative), length, modified of every file below ``path``; contents are not read.  Tasks list it, or Spark's reader in a store that Arrow doesn't read."""
    if opened_by_tasks(path):
        return found_files(spark, path, glob).select(F.col("inside").alias("path"), "length", "modified")
    root = path.removeprefix("file://").rstrip("/") + "/"
    inside = F.substring_index(F.col("path"), root, -1)
    return binary_files(spark, path, glob).select(inside.alias("path"), "length", F.col("modificationTime").alias("modified"))


def binary_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Spark's table of files; their list is held by the driver."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def read_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path, length, content of every file below ``path``, small ones: tasks list, open and read them, or Spark's reader does in a store that Arrow doesn't read."""
    if not opened_by_tasks(path):
        return binary_files(spark, path, glob).select("path", "length", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), CONTENTS, strict=True)], schema=CONTENTS)

        rows, held = [], 0
        for batch in batches:
            for file, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, name = store_of(file)
                with store.open_input_stream(name, compression=None) as f:
                    rows.append((file, length, f.read()))
                held += len(rows[-1][2])
                if held >= HELD_BYTES or len(rows) >= ROWS:
                    yield told(rows)
                    rows, held = [], 0
        if rows:
            yield told(rows)

    return dealt(found_files(spark, path, glob).select("path", "length")).mapInArrow(run, "path string, length bigint, content binary")


def inventory(spark: SparkSession, root: str, globs: Sequence[str], verify: bool = True) -> DataFrame:
    """path (relative to ``root``), length, modified of the files that a download should bring.

    The root is listed; of its entries only those that match the first segment of a glob are
    listed in depth (by the tasks); their files are then held against the whole globs.  Without
    ``verify`` nothing is listed and the table is empty.
    """
    kind = "path string, length bigint, modified timestamp"
    if not verify or not globs:
        return spark.createDataFrame([], kind)
    fs, p = (lambda q: (q.getFileSystem(spark._jsc.hadoopConfiguration()), q))(spark._jvm.org.apache.hadoop.fs.Path(root))
    top = [glob_to_regex(g.split("/")[0]).replace("\\z", "\\Z") for g in globs]
    if opened_by_tasks(root):
        told = walk(spark, [fs.getFileStatus(p).getPath().toString()], top).select(F.col("inside").alias("path"), "length", "modified")
        return told.where(matches_glob(F.col("path"), globs))
    first = [re.compile(t) for t in top]
    found = [s.getPath() for s in fs.listStatus(p) if any(r.match(s.getPath().getName()) for r in first)]
    if not found:
        return spark.createDataFrame([], kind)
    base = fs.makeQualified(p).toUri().getPath().rstrip("/") + "/"
    files = binary_files(spark, [f.toString() for f in found])
    told = files.select(F.substring_index("path", base, -1).alias("path"), "length", F.col("modificationTime").alias("modified"))
    return told.where(matches_glob(F.col("path"), globs))


def parse_remote_listing(line: Column) -> Column:
    """struct<is_dir, name> of a line of a bucket listing: ``PRE name/`` or date, time, size and a name whose runs of spaces become one."""
    parts = F.split(F.trim(line), r"\s+")
    is_dir = line.contains("PRE")
    after = F.when(is_dir, F.lit(2)).otherwise(F.lit(4))
    name = F.when(F.size(parts) >= after, F.array_join(F.slice(parts, after, F.greatest(F.size(parts) - after + 1, F.lit(0))), " "))
    return F.struct(is_dir.alias("is_dir"), F.when(is_dir, F.rtrim(name, F.lit("/"))).otherwise(name).alias("name"))
