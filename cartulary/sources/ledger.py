"""A ledger of flags that many writers change: versioned, append-only, published by one atomic step.

A version is a small file that lists folders of changes, in order; the newest change of a dataset's flag holds.
A writer adds a folder of its changes and publishes the next version with that folder at the end.  Only one writer
can create a version's file; the others see that it is there, read the newer version and publish again, so changes
to different flags all survive and of two changes to one flag the later holds.  Changes that depend on what the ledger says are
given as a function and worked out again for each try.  What a lost writer leaves is named by no version.

The version's file is complete before it gets its name, by a rename that fails where the name is taken (a second link
on local disks); an object store needs a file system layer that gives that.
"""

from __future__ import annotations

import json
import os
import random
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHANGES = "dataset string, flag string, value string, gone boolean"
#: Folders of changes that a version may list before an update merges them, tries of a writer, seconds that unnamed folders are kept.
MOST_FOLDERS, TRIES, RETENTION = 64, 20, 7 * 86400

Changes = DataFrame | Callable[[DataFrame], DataFrame]


class FlagLedger:
    def __init__(self, spark: SparkSession, root: str, most: int = MOST_FOLDERS):
        self.spark, self.root, self.most = spark, root.rstrip("/"), most

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def version(self) -> int:
        """The newest version; 0 before the first."""
        fs, p = self._fs("versions")
        return max((int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()), default=0) if fs.exists(p) else 0

    def folders(self, version: int | None = None) -> list[str]:
        """The folders of changes of a version (the newest), in order."""
        v = self.version() if version is None else version
        return json.loads(self.spark.read.text(f"{self.root}/versions/{v:010d}", wholetext=True).first()[0]) if v else []

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], CHANGES)
        told = self.spark.read.schema(CHANGES).parquet(*(f"{self.root}/changes/{f}" for f in folders))
        at = F.array_position(F.array(*map(F.lit, folders)), F.element_at(F.split("_metadata.file_path", "/"), -2))
        newest = told.groupBy("dataset", "flag").agg(F.max_by(F.struct("value", "gone"), at).alias("now"))
        return newest.select("dataset", "flag", "now.value", "now.gone")

    def read(self, version: int | None = None) -> DataFrame:
        """(dataset, flag, value) of a version (the newest)."""
        return self._rows(self.folders(version)).where("not gone").drop("gone")

    def _write(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.select(F.col("dataset").cast("string").alias("dataset"), F.col("flag").cast("string").alias("flag"), F.col("value").cast("string").alias("value"), "gone").write.parquet(f"{self.root}/changes/{name}")
        return name

    def _publish(self, folders: Sequence[str], version: int) -> None:
        """Create a version; ``FileExistsError`` if another writer has."""
        fs, folder = self._fs("versions")
        fs.mkdirs(folder)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        new, final = path(folder, f".{version}-{uuid.uuid4().hex}"), path(folder, f"{version:010d}")
        out = fs.create(new, False)
        out.write(bytearray(json.dumps(list(folders)).encode()))
        out.close()
        try:
            if fs.getScheme() == "file":  # there a rename would take the name from the one that has it
                os.link(new.toUri().getPath(), final.toUri().getPath())
            elif fs.exists(final) or not fs.rename(new, final):
                raise FileExistsError(str(final))
        finally:
            fs.delete(new, False)

    def update(self, changes: Changes) -> int:
        """Set flags: ``changes(dataset, flag, value)``, or a function that makes them from the ledger's rows; the new version.

        One value a flag; a flag given twice with different values raises.
        """
        return self._change(changes, F.lit(False))

    def remove(self, keys: Changes) -> int:
        """Take flags out: ``keys(dataset, flag)``, or a function that makes them from the ledger's rows; the new version."""
        return self._change(keys, F.lit(True))

    def _change(self, changes: Changes, gone) -> int:
        written = None
        for last in range(TRIES - 1, -1, -1):
            before = self.version()
            folders = self.folders(before)
            if written is None or callable(changes):
                rows = changes(self.read(before)) if callable(changes) else changes
                told = rows.select("dataset", "flag", (F.col("value") if "value" in rows.columns else F.lit(None)).cast("string").alias("value"))
                once = told.groupBy("dataset", "flag").agg(F.min("value").alias("value"), F.count_distinct("value").alias("n"))
                twice = F.raise_error(F.concat(F.lit("a flag is given different values: "), "dataset", F.lit("/"), "flag")).cast("string")
                written = self._write(once.select("dataset", "flag", F.when(F.col("n") > 1, twice).otherwise(F.col("value")).alias("value"), gone.alias("gone")))
            if len(folders) >= self.most:
                folders = [self._write(self._rows(folders))]
            try:
                self._publish([*folders, written], before + 1)
                return before + 1
            except FileExistsError:
                if not last:
                    raise
                time.sleep(random.uniform(0, 0.05))
        raise AssertionError

    def vacuum(self, retention: float = RETENTION) -> None:
        """Drop folders of changes older than ``retention`` seconds, longer than any update takes, that no version names."""
        fs, p = self._fs("versions")
        named = {f for s in (fs.listStatus(p) if fs.exists(p) else ()) if s.getPath().getName().isdigit() for f in self.folders(int(s.getPath().getName()))}
        fs, p = self._fs("changes")
        for s in fs.listStatus(p) if fs.exists(p) else ():
            if s.getPath().getName() not in named and s.getModificationTime() < (time.time() - retention) * 1000:
                fs.delete(s.getPath(), True)
