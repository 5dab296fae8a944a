"""Size-tiered compaction of append-only shards under a versioned manifest; DataFrame operations only.

``append`` writes arriving rows as a run: a folder of small immutable Parquet
shards.  ``compact`` puts the runs whose shards are smaller than the target into
tiers of similar size (powers of ``FANOUT``) and, where a tier has ``FANOUT`` runs,
merges them into one run of files of about the target size: the merge reads
whole runs and lowers the number of partitions, so it moves no row over the
network; a run of full-sized files is never rewritten.

Each change writes a new manifest, a small table of runs, and then publishes it:
the version file, complete with the manifest's name, is written under a
temporary name and renamed to its number, which fails if another writer has
taken that number.  So readers see the old version or the new one, and a driver
or executor lost at any point leaves nothing but files that no version names.
The rename must be atomic, which HDFS and local disks give; an object store needs
a file system layer that gives it.  Nothing is deleted by ``append`` and
``compact``, so every version can be read and other writers' files are safe;
``vacuum`` later drops old versions and the files that no version left names, both
only after a retention time that must be longer than the longest job.

Defined results: null ids and texts, repeated rows, texts of any size and
columns of any name are stored and read as they are; an empty arrival adds a
version whose run has no rows; reading a root without versions, or a version
that isn't there, is an error; a failed commit raises ``FileExistsError``;
``append`` and ``compact`` try again on the newer version, ``TRIES`` times.
"""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm.common import hadoop_fs

#: Production parameters: bytes of a merged file, runs that make a tier worth merging, bytes of the smallest tier, runs merged at once.
TARGET_BYTES, FANOUT, TIER_BYTES, MOST_RUNS = 128 << 20, 4, 1 << 20, 256
#: Seconds that versions and files that no version names are kept.
RETENTION = 7 * 86400
TRIES = 10

RUNS = "run string, files bigint, bytes bigint, rows bigint, tier int"


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT):
        self.spark, self.root, self.target, self.fanout = spark, root.rstrip("/"), target_bytes, fanout

    def versions(self) -> list[int]:
        """The numbers of the versions, in order."""
        fs, p = hadoop_fs(self.spark, f"{self.root}/versions")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()) if fs.exists(p) else []

    def version(self) -> int:
        """The newest version; 0 before the first."""
        return max(self.versions(), default=0)

    def _manifest_name(self, version: int) -> str:
        if version not in self.versions():
            raise FileNotFoundError(f"{self.root} has no version {version or ''}")
        return self.spark.read.text(f"{self.root}/versions/{version:010d}").first()[0]

    def manifest(self, version: int | None = None) -> DataFrame:
        """run (a folder below ``data``), files, bytes, rows, tier of the runs of a version (the newest)."""
        name = self._manifest_name(self.version() if version is None else version)
        return self.spark.read.schema(RUNS).parquet(f"{self.root}/manifests/{name}")

    def _write_run(self, rows: DataFrame, kind: str) -> DataFrame:
        """Write ``rows`` as a run; its manifest row."""
        run = f"{kind}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/data/{run}")
        files = self.spark.read.parquet(f"{self.root}/data/{run}").groupBy(F.col("_metadata.file_path")).agg(F.max("_metadata.file_size").alias("bytes"), F.count("*").alias("rows"))
        found = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
        tier = F.when(F.col("bytes") < TIER_BYTES, 0).otherwise(F.floor(F.log(F.col("bytes") / TIER_BYTES) / F.log(F.lit(float(self.fanout)))) + 1)
        r = found.select(F.lit(run).alias("run"), "files", "bytes", "rows", tier.cast("int").alias("tier")).first()
        return self.spark.range(1).select(*(F.lit(r[k]).cast(kind).alias(k) for k, kind in (c.split() for c in RUNS.split(", "))))

    def _publish(self, text: str, name: str) -> None:
        """Create a whole file at once; ``FileExistsError`` if there is one."""
        fs, folder = hadoop_fs(self.spark, f"{self.root}/versions")
        fs.mkdirs(folder)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        new, final = path(folder, f".{name}-{uuid.uuid4().hex}"), path(folder, name)
        out = fs.create(new, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if fs.getScheme() == "file":  # there a rename would overwrite; a second name for the file doesn't
                os.link(new.toUri().getPath(), final.toUri().getPath())
            elif fs.exists(final) or not fs.rename(new, final):
                raise FileExistsError(str(final))
        finally:
            if fs.exists(new):
                fs.delete(new, False)

    def _commit(self, runs: DataFrame, version: int) -> int:
        """Write the manifest, then publish its name under the version's number, which only one writer can."""
        name = f"{version:010d}-{uuid.uuid4().hex}"
        runs.coalesce(1).write.parquet(f"{self.root}/manifests/{name}")
        self._publish(name, f"{version:010d}")
        return version

    def append(self, rows: DataFrame) -> int:
        """Add ``rows`` as a run of small shards, one a partition; the new version."""
        added = self._write_run(rows, "append")
        for last in range(TRIES - 1, -1, -1):
            before = self.version()
            try:
                return self._commit(self.manifest(before).unionByName(added) if before else added, before + 1)
            except FileExistsError:
                if not last:
                    raise
        raise AssertionError

    def _merge(self, now: DataFrame) -> tuple[list[str], list[DataFrame]]:
        """The runs of full tiers, and the manifest rows of what they are merged into."""
        small = now.where((F.col("bytes") < F.col("files") * (self.target // 2)) & (F.col("files") > 0))
        tiers = small.groupBy("tier").agg(F.count("*").alias("n")).where(F.col("n") >= self.fanout).orderBy("tier").collect()
        gone, new = [], []
        for t in tiers:
            taken = small.where(F.col("tier") == t.tier).orderBy("bytes", "run").limit(MOST_RUNS).collect()
            files = -(-sum(r.bytes for r in taken) // self.target)
            if files >= sum(r.files for r in taken):  # a merge helps only where it makes fewer files
                continue
            rows = self.spark.read.parquet(*(f"{self.root}/data/{r.run}" for r in taken))
            new.append(self._write_run(rows.coalesce(files), "merge"))
            gone += [r.run for r in taken]
        return gone, new

    def compact(self) -> int:
        """Merge the tiers that have ``fanout`` runs of small shards until none is left; the newest version."""
        while True:
            gone, new = self._merge(self.manifest())
            if not gone:
                return self.version()
            for last in range(TRIES - 1, -1, -1):
                before = self.version()
                runs = self.manifest(before)
                if runs.where(F.col("run").isin(gone)).count() < len(gone):
                    break  # another writer has merged some of them; what was written here stays unnamed
                runs = runs.where(~F.col("run").isin(gone))
                for one in new:
                    runs = runs.unionByName(one)
                try:
                    self._commit(runs, before + 1)
                    break
                except FileExistsError:
                    if not last:
                        raise

    def vacuum(self, retention: float = RETENTION) -> None:
        """Drop versions that were replaced more than ``retention`` seconds ago, then manifests and runs of that age that no version left names."""
        fs, p = hadoop_fs(self.spark, f"{self.root}/versions")
        limit = (time.time() - retention) * 1000
        versions = self.versions()
        since = {int(s.getPath().getName()): s.getModificationTime() for s in fs.listStatus(p) if s.getPath().getName().isdigit()} if versions else {}
        # a version was replaced when the next one came
        for v, after in zip(versions, versions[1:], strict=False):
            if since[after] < limit:
                fs.delete(hadoop_fs(self.spark, f"{self.root}/versions/{v:010d}")[1], False)
        names = {self._manifest_name(v) for v in self.versions()}
        runs = {r.run for n in names for r in self.spark.read.schema(RUNS).parquet(f"{self.root}/manifests/{n}").select("run").collect()}
        for folder, kept in (("manifests", names), ("data", runs)):
            fs, p = hadoop_fs(self.spark, f"{self.root}/{folder}")
            for s in fs.listStatus(p) if fs.exists(p) else ():
                if s.getPath().getName() not in kept and self._latest(fs, s) < limit:
                    fs.delete(s.getPath(), True)

    @staticmethod
    def _latest(fs, folder) -> float:
        """When a folder or anything in it last changed: a run that is still being written is young."""
        return max([folder.getModificationTime(), *(ShardStore._latest(fs, s) if s.isDirectory() else s.getModificationTime() for s in fs.listStatus(folder.getPath()))])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version."""
        runs = self.manifest(version).orderBy("run").collect()
        return self.spark.read.parquet(*(f"{self.root}/data/{r.run}" for r in [r for r in runs if r.files] or runs))
