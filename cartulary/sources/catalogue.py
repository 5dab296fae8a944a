"""Catalogue documents of any size: one JSON object of lists of entries, cut into entries byte range by byte range.

Where an entry begins depends on all that stands before: whether a range begins inside a string, and at which depth.
A first pass sums each range up, for both cases: does it turn strings on or off, and by how much does the depth change if it
began outside or inside one.  Adding these up, a few numbers a range, gives every range its state.  In a second pass each
range emits the entries that begin in it, reading on for its last one, and the names of the lists that begin in it; an entry's
list is the last one named before it, in its range or in one before.  So a document needs as many tasks as it has
ranges, and no task holds more than a range and an entry.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.session import shared_dir
from cartulary.sources.stores import store_of
from cartulary.sources.tables import ENTRY

#: Bytes of a range; bytes that are read on for an entry that a range's end cuts.
RANGE_BYTES, STEP = 8 << 20, 1 << 16

QUOTE, BACKSLASH = ord('"'), ord("\\")
DEPTH = np.zeros(256, np.int8)
DEPTH[[ord("{"), ord("[")]] = 1
DEPTH[[ord("}"), ord("]")]] = -1
#: What may stand around the document, between lists, and between the entries of a list.
AROUND, BETWEEN_LISTS, BETWEEN_ENTRIES = (np.isin(np.arange(256), np.frombuffer(s, np.uint8)) for s in (b" \t\r\n{}", b" \t\r\n,:{}[]", b" \t\r\n,{}[]"))


def backslashes_before(f, at: int) -> int:
    """How many backslashes stand directly before byte ``at``."""
    n = 0
    while at > 0:
        size = min(STEP, at)
        f.seek(at - size)
        block = f.read(size)
        here = len(block) - len(block.rstrip(b"\\"))
        n, at = n + here, at - size
        if here < size:
            break
    return n


def quotes_of(data: np.ndarray, before: int) -> np.ndarray:
    """Whether each byte is a quote that no backslash takes away; ``before``: backslashes before the first."""
    quote = data == QUOTE
    if before or (data == BACKSLASH).any():
        place = np.arange(len(data))
        last = np.maximum.accumulate(np.where(data != BACKSLASH, place, -1 - before))  # the last byte that is none
        ahead = np.concatenate([[-1 - before], last[:-1]])
        quote &= (place - 1 - ahead) % 2 == 0
    return quote


def sum_up(data: np.ndarray, before: int) -> tuple[bool, int, int]:
    """(turns strings, change of depth if it begins outside a string, if inside)."""
    odd = np.logical_xor.accumulate(quotes_of(data, before)) if len(data) else np.zeros(0, bool)
    step = DEPTH[data].astype(np.int64)
    return bool(odd[-1]) if len(odd) else False, int(step[~odd].sum()), int(step[odd].sum())


def read_on(f, data: bytes, complete) -> bytes:
    """``data`` and what follows it in the file, until ``complete(data)``."""
    while not complete(data):
        block = f.read(max(STEP, len(data)))
        if not block:
            raise ValueError("the document ends early")
        data += block
    return data


def whole_string(data: bytes) -> int:
    """The bytes of the string that begins ``data``; 0 if it goes on."""
    a = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(quotes_of(a, 0)[1:])
    return int(ends[0]) + 2 if len(ends) else 0


def whole_entry(data: bytes) -> int:
    """The bytes of the object that begins ``data``; 0 if it goes on."""
    a = np.frombuffer(data, np.uint8)
    inside = np.logical_xor.accumulate(quotes_of(a, 0))
    ends = np.flatnonzero(np.cumsum(np.where(inside, 0, DEPTH[a])) == 0)
    return int(ends[0]) + 1 if len(ends) else 0


def cut_range(f, at: int, end: int, inside: bool, depth: int) -> Iterator[tuple]:
    """(place, list, entry, names, lists) of the entries that begin in a range, list being null before the range's first name; last a row without entry: the range's last name, how many names and lists begin in it.

    ``ValueError`` where the document is no object of lists of objects.
    """
    before = backslashes_before(f, at)
    f.seek(at)
    raw = f.read(end - at)
    data = np.frombuffer(raw, np.uint8)
    quote = quotes_of(data, before)
    odd = np.logical_xor.accumulate(quote) ^ inside if len(data) else quote  # from an opening quote to the byte before the closing one
    step = np.where(odd, 0, DEPTH[data]).astype(np.int64)
    after = np.cumsum(step) + depth
    held = after - step  # the depth at which a byte stands
    opening, plain = quote & odd, ~odd & ~quote
    wrong = (held == 0) & ~AROUND[data] | (held == 1) & (~BETWEEN_LISTS[data] | (data == ord("{"))) | (held == 2) & (~BETWEEN_ENTRIES[data] | (data == ord("[")))
    if (plain & wrong).any() or (opening & ((held == 2) | (held == 0))).any() or (after < 0).any():
        raise ValueError("the document isn't an object of lists of objects")
    found = np.flatnonzero((opening & (held == 1)) | (plain & (held == 2) & (data == ord("{"))))
    closing = np.flatnonzero(plain & (after == 2) & (data == ord("}")))  # an entry ends where the depth is 2 again
    name, names = None, 0
    for k in found.tolist():
        if data[k] == QUOTE:
            part = raw[k : k + STEP]
            part = part if whole_string(part) else read_on(reader_from(f, end), raw[k:], whole_string)
            name, names = json.loads(part[: whole_string(part)]), names + 1
            continue
        j = np.searchsorted(closing, k)
        if j < len(closing):
            part = raw[k : closing[j] + 1]
        else:
            part = read_on(reader_from(f, end), raw[k:], whole_entry)
            part = part[: whole_entry(part)]
        yield at + k, name, part.decode("utf-8"), 0, 0
    yield end, name, None, names, int((plain & (held == 1) & (data == ord("["))).sum())


def reader_from(f, at: int):
    f.seek(at)
    return f


def ranges_of(spark: SparkSession, path: str, size: int) -> list[tuple[str, int, int]]:
    """(file, first byte, end) of the ranges of every file at ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(p) or []
    files = [s for f in found for s in (fs.listStatus(f.getPath()) if f.isDirectory() else [f]) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    if not files:
        raise FileNotFoundError(path)
    return [(s.getPath().toString(), at, min(at + size, s.getLen())) for s in files for at in range(0, max(1, s.getLen()), size)]


def over_ranges(spark: SparkSession, rows: list[tuple], work, schema: str) -> DataFrame:
    """``work(file, row)`` for each row, which begins with a file, each in a task of its own; ``work`` gives tuples of ``schema``."""
    names = [c.strip().split()[0] for c in schema.split(",")]
    told = spark.sparkContext.broadcast(rows)  # a few numbers a range

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                row = told.value[i]
                store, path = store_of(row[0])
                held: list[tuple] = []
                with store.open_input_file(path) as f:
                    for out in work(f, row):
                        held.append((i, *out))
                        if len(held) >= 1000:
                            yield pa.RecordBatch.from_pylist([dict(zip(["range", *names], h, strict=True)) for h in held], arrow)
                            held = []
                if held:
                    yield pa.RecordBatch.from_pylist([dict(zip(["range", *names], h, strict=True)) for h in held], arrow)

    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    arrow = pa.schema([("range", pa.int64()), *((n, kinds[c.strip().split()[1]]) for n, c in zip(names, schema.split(","), strict=True))])
    return spark.range(0, len(rows), 1, max(1, len(rows))).mapInArrow(run, f"range bigint, {schema}")


def split_catalogue(spark: SparkSession, path: str, size: int = RANGE_BYTES) -> DataFrame:
    """dataset, file, place (its first byte), entry (its text) of every entry of the documents at ``path``: a file, a folder or a glob."""
    ranges = ranges_of(spark, path, size)

    def summary(f, row):
        _, at, end = row
        before = backslashes_before(f, at)
        f.seek(at)
        yield sum_up(np.frombuffer(f.read(end - at), np.uint8), before)

    sums = {r.range: r for r in over_ranges(spark, ranges, summary, "turns boolean, outside int, inside int").collect()}
    states, inside, depth = [], False, 0
    for i, (file, at, end) in enumerate(ranges):
        if i == 0 or ranges[i - 1][0] != file:
            if i and (inside or depth):
                raise ValueError(f"{ranges[i - 1][0]} ends early")
            inside, depth = False, 0
        states.append((file, at, end, inside, depth))
        depth += sums[i].inside if inside else sums[i].outside
        inside ^= sums[i].turns
    if inside or depth:
        raise ValueError(f"{ranges[-1][0]} ends early")

    def cut(f, row):
        return cut_range(f, *row[1:])

    found = over_ranges(spark, states, cut, "place bigint, name string, entry string, names int, lists int")
    path = f"{shared_dir(spark)}/catalogue-{uuid.uuid4().hex}"
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    ends = {r.range: r for r in found.where("entry is null").select("range", "name", "names", "lists").collect()}  # one a range
    carried, now, open_names = [], None, 0
    for i, (file, *_) in enumerate(ranges):
        if i == 0 or ranges[i - 1][0] != file:
            now, open_names = None, 0
        carried.append((i, file, now))
        now = now if ends[i].name is None else ends[i].name
        open_names += ends[i].names - ends[i].lists
        if open_names not in (0, 1) or (open_names and (i + 1 == len(ranges) or ranges[i + 1][0] != file)):
            raise ValueError(f"{file} isn't an object of lists")
    told = spark.createDataFrame(carried, "range bigint, file string, before string")
    out = found.where("entry is not null").join(told, "range")
    return out.select(F.coalesce("name", "before").alias("dataset"), "file", "place", "entry")


def read_large_catalogue(spark: SparkSession, path: str, entry: str = ENTRY, size: int = RANGE_BYTES) -> DataFrame:
    """``tables.read_catalogue`` for documents of any size: a row for each entry; an entry that isn't of the kind ``entry`` raises."""
    told = split_catalogue(spark, path, size)
    return told.select("dataset", F.from_json("entry", entry, {"mode": "FAILFAST"}).alias("e")).select("dataset", "e.*")
