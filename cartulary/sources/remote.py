"""Listings of remote stores as a Spark data source: ``spark.read.format("listing")``.

A ``Lister`` is the contract of a store: its top-level prefixes, the parts in which the listing of one can be
read, and the entries of a part as Arrow batches.  The source makes a partition of each part, so prefixes are listed in
parallel, and takes filters: conditions on ``prefix`` decide which prefixes are listed at all, those on other
columns drop entries before they leave the Python worker.  What it can't decide stays with Spark.

    register(spark)
    spark.read.format("listing").option("path", "s3a://bucket/listings").load().where("prefix = 'sub-01'")

``option("lister", "package.module:Class")`` names another store's lister; all options are handed to it.
"""

from __future__ import annotations

import datetime
import importlib
from abc import ABC, abstractmethod
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith
from pyspark.sql.types import StructType

from cartulary.sources.stores import store_of

COLUMNS = "prefix string, name string, is_dir boolean, size bigint, modified timestamp_ntz"
SCHEMA = pa.schema([("prefix", pa.string()), ("name", pa.string()), ("is_dir", pa.bool_()), ("size", pa.int64()), ("modified", pa.timestamp("us"))])


class Lister(ABC):
    """A store that can be listed; instances are pickled to the tasks."""

    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    @abstractmethod
    def prefixes(self) -> Sequence[str]:
        """The top-level names; called once, on the driver."""

    def parts(self, prefix: str) -> Sequence[tuple]:
        """What can be listed by itself of a prefix; called on the driver for the prefixes that no filter rules out."""
        return [()]

    @abstractmethod
    def entries(self, prefix: str, part: tuple) -> Iterator[pa.RecordBatch]:
        """Batches of ``SCHEMA``; called in the tasks."""


class CapturedListing(Lister):
    """Listings that a store's tool has written: a folder ``prefix=NAME`` of text files for each prefix, as ``DataFrame.write.partitionBy("prefix").text`` leaves.

    A line is ``PRE name/`` or date, time, size and name; runs of spaces become one.  Options: ``path``, and
    ``bytes`` of a file that a task reads at most (16 MiB); a line belongs to the task in whose range it begins.
    """

    def prefixes(self) -> Sequence[str]:
        from urllib.parse import unquote

        from pyarrow import fs

        store, root = store_of(self.options["path"])
        found = store.get_file_info(fs.FileSelector(root))
        self.folders = {unquote(f.base_name.removeprefix("prefix=")): f.path for f in found if f.type == fs.FileType.Directory and f.base_name.startswith("prefix=")}
        return sorted(self.folders)

    def parts(self, prefix: str) -> Sequence[tuple]:
        from pyarrow import fs

        store, _ = store_of(self.options["path"])
        step = int(self.options.get("bytes", 16 << 20))
        files = [f for f in store.get_file_info(fs.FileSelector(self.folders[prefix], recursive=True)) if f.is_file and f.size and not f.base_name.startswith(("_", "."))]
        return [(f.path, at, min(at + step, f.size)) for f in sorted(files, key=lambda f: f.path) for at in range(0, f.size, step)]

    def entries(self, prefix: str, part: tuple) -> Iterator[pa.RecordBatch]:
        path, at, end = part
        store, _ = store_of(self.options["path"])
        with store.open_input_file(path) as f:
            f.seek(max(0, at - 1))
            first = f.read(1) if at else b"\n"
            skip = first != b"\n"  # the line that is under way is another task's
            rest = end - at
            held = b""
            while rest > 0 or skip or (held and not held.endswith(b"\n")):
                block = f.read(min(rest, 1 << 20) if rest > 0 else 1 << 12)
                if not block:
                    break
                if rest <= 0 and b"\n" in block:
                    block = block[: block.index(b"\n") + 1]
                if skip and rest <= 0:
                    break  # a line longer than the range
                rest -= len(block)
                held += block
                if skip:
                    cut = held.find(b"\n")
                    held, skip = (held[cut + 1 :], False) if cut >= 0 else (b"", True)
                whole = held.rfind(b"\n") + 1
                if whole:
                    yield parse_lines(held[:whole], prefix)
                    held = held[whole:]
            if held:
                yield parse_lines(held, prefix)


def parse_lines(data: bytes, prefix: str) -> pa.RecordBatch:
    """Entries of the lines of a listing; blank lines are none, a line with too few words has no name."""
    lines = pc.split_pattern(pa.array([data.decode("utf-8", "replace")]), "\n").flatten()
    lines = pc.replace_substring_regex(pc.utf8_trim_whitespace(lines), r"\s+", " ")
    lines = lines.filter(pc.not_equal(lines, ""))
    is_dir = pc.match_substring(lines, "PRE")
    folder = pc.extract_regex(lines, r"^\S+ (?P<name>.*?)/*$")
    file = pc.extract_regex(lines, r"^(?P<at>\S+ \S+) (?P<size>\S+) (?P<name>.+)$")
    size = pc.struct_field(file, "size")
    size = pc.if_else(pc.or_(is_dir, pc.invert(pc.match_substring_regex(size, r"^[0-9]{1,18}$"))), None, size)
    at = pc.strptime(pc.struct_field(file, "at"), "%Y-%m-%d %H:%M:%S", "us", error_is_null=True)
    columns = [pa.array([prefix] * len(lines), pa.string()), pc.if_else(is_dir, pc.struct_field(folder, "name"), pc.struct_field(file, "name")), is_dir, size.cast(pa.int64()), pc.if_else(is_dir, None, at)]
    return pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)


#: Filters as conditions on a column of Arrow values; a null is no hit, as in SQL.
CONDITIONS = {
    EqualTo: lambda c, v: pc.equal(c, v), EqualNullSafe: lambda c, v: pc.is_null(c) if v is None else pc.equal(c, v), In: lambda c, v: pc.is_in(c, pa.array([x for x in v if x is not None], c.type)),
    GreaterThan: lambda c, v: pc.greater(c, v), GreaterThanOrEqual: lambda c, v: pc.greater_equal(c, v), LessThan: lambda c, v: pc.less(c, v), LessThanOrEqual: lambda c, v: pc.less_equal(c, v),
    StringStartsWith: lambda c, v: pc.starts_with(c, v), StringEndsWith: lambda c, v: pc.ends_with(c, v), StringContains: lambda c, v: pc.match_substring(c, v),
}


def value_of(f: Filter):
    v = list(f.value) if isinstance(f, In) else getattr(f, "value", None)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


def hits(f: Filter, column: pa.Array) -> pa.Array:
    if isinstance(f, IsNotNull):
        return pc.is_valid(column)
    v = value_of(f)
    typed = v if v is None or isinstance(v, list | str) else pa.scalar(v, column.type)
    return pc.fill_null(CONDITIONS[type(f)](column, typed), False)


@dataclass
class Part(InputPartition):
    prefix: str
    part: tuple


class ListingReader(DataSourceReader):
    def __init__(self, lister: Lister):
        self.lister, self.on_prefix, self.on_entry = lister, [], []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            if type(f) not in {*CONDITIONS, IsNotNull} or len(f.attribute) != 1:
                yield f
            elif f.attribute[0] == "prefix":
                self.on_prefix.append(f)
            else:
                self.on_entry.append(f)

    def partitions(self) -> Sequence[InputPartition]:
        names = pa.array(self.lister.prefixes(), pa.string())
        for f in self.on_prefix:
            names = names.filter(hits(f, names))
        return [Part(p, part) for p in names.to_pylist() for part in self.lister.parts(p)] or [Part("", ())]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if not partition.prefix and not partition.part:
            return
        for batch in self.lister.entries(partition.prefix, partition.part):
            for f in self.on_entry:
                batch = batch.filter(hits(f, batch.column(f.attribute[0])))
            if batch.num_rows:
                yield batch


class ListingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema: StructType) -> DataSourceReader:
        module, _, name = self.options.get("lister", f"{__name__}:{CapturedListing.__name__}").partition(":")
        return ListingReader(getattr(importlib.import_module(module), name)(self.options))


def register(spark: SparkSession) -> None:
    """Make the format ``listing`` known to a session, and let it take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ListingSource)
