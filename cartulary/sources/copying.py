"""Copies of files as a Spark sink that leaves a whole tree or nothing: ``plan.write.format("file_tree")``.

The plan has a row a file: ``src`` (where it is) and ``path`` (where it goes, relative to the tree).  Tasks copy
into a staging folder beside the target: first under a name of their own, then by a rename to their place, so a task
that is repeated, or runs twice at once, puts the same file there again and half a file is never in place.  When all
tasks are done, the commit renames the staged tree to the target, one step; when one fails for good, the abort removes
it.  A driver that is lost in between leaves a staging folder (a dotted name), never a target.

The rename must be atomic, as on HDFS and local disks; an object store needs a file system layer that gives it.
"""

from __future__ import annotations

import posixpath
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from cartulary.sources.stores import store_of

#: Bytes that are copied at once.
PIECE = 4 << 20


@dataclass
class Copied(WriterCommitMessage):
    files: int
    size: int


class TreeWriter(DataSourceWriter):
    def __init__(self, target: str, overwrite: bool):
        self.target, self.overwrite = target.rstrip("/"), overwrite
        folder, _, name = self.target.rpartition("/")
        self.staging = f"{folder}/.{name}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        store, staging = store_of(self.staging)
        files, size, made = 0, 0, set()
        for folder in ("parts", "tree"):
            store.create_dir(f"{staging}/{folder}", recursive=True)
        for row in iterator:
            place = posixpath.normpath(row.path or "")
            if not row.path or place.startswith(("/", "..")) or place == ".":
                raise ValueError(f"no place in a tree: {row.path!r}")
            part, final = f"{staging}/parts/{uuid.uuid4().hex}", f"{staging}/tree/{place}"
            size += self._copy(row.src, store, part)
            levels = posixpath.dirname(place).split("/")
            for k in range(1, len(levels) + 1):  # one by one, so that a staging folder that an abort has removed doesn't come back
                folder = "/".join(levels[:k])
                if folder and folder not in made:
                    store.create_dir(f"{staging}/tree/{folder}", recursive=False)
                    made.add(folder)
            store.move(part, final)
            files += 1
        return Copied(files, size)

    def _copy(self, src: str, store, part: str) -> int:
        """Copy a file; its bytes, which are as many as the source said."""
        source, path = store_of(src)
        told, done = source.get_file_info(path), 0
        if not told.is_file:
            raise FileNotFoundError(src)
        with source.open_input_stream(path, compression=None) as a, store.open_output_stream(part, compression=None) as b:
            while data := a.read(PIECE):
                b.write(data)
                done += len(data)
        if done != told.size:
            raise OSError(f"{src} has {told.size} bytes, {done} were read")
        return done

    def _exists(self, store, path: str) -> bool:
        from pyarrow import fs

        return store.get_file_info(path).type != fs.FileType.NotFound

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, staging = store_of(self.staging)
        _, target = store_of(self.target)
        store.create_dir(f"{staging}/tree", recursive=True)  # a plan without rows makes an empty tree
        if self._exists(store, target):
            if not self.overwrite:
                self.abort(messages)
                raise FileExistsError(self.target)
            store.move(target, f"{staging}/before")
        try:
            store.move(f"{staging}/tree", target)
        except OSError:
            if self._exists(store, f"{staging}/before"):
                store.move(f"{staging}/before", target)
            raise
        store.delete_dir(staging)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, staging = store_of(self.staging)
        for _ in range(5):  # tasks that were just beginning may make it once more
            if self._exists(store, staging):
                store.delete_dir(staging)
            time.sleep(0.2)


class FileTree(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_tree"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if not {"src", "path"} <= set(schema.names):
            raise ValueError("a plan has the columns src and path")
        return TreeWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make the format ``file_tree`` known to a session."""
    spark.dataSource.register(FileTree)


def copy_tree(plan: DataFrame, target: str, overwrite: bool = False) -> None:
    """Copy the files of ``plan(src, path)`` into a new tree at ``target``, all or none; a tree that is there is an error, or replaced if ``overwrite``."""
    register(plan.sparkSession)
    plan.select("src", "path").write.format("file_tree").mode("overwrite" if overwrite else "append").save(target)
