"""Which texts contain which needles: plain substrings, each text read once for all needles by an Aho-Corasick automaton.

The distinct needles go to the tasks as broadcast variables of ``PASS_BYTES`` at most; more needles than that take
further passes over the texts, dealt by a hash.  A task builds automata of ``SHARD_CHARS`` characters of needles, one
after the other, and runs ``CHUNK_BYTES`` of texts through each, so its memory is bounded by the two and its
time follows the length of the texts and the number of hits.  Nothing is shuffled to find the pairs: only the pairs
meet the needles' own rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of needles sent to the tasks at once, characters of needles in an automaton, bytes of texts that wait while automata change.
PASS_BYTES, SHARD_CHARS, CHUNK_BYTES = 64 << 20, 2 << 20, 64 << 20
#: The most rows of a side that is broadcast; beyond it rows meet by shuffle.
BROADCAST_ROWS = 50_000

Wanted = tuple[str, ...]


def maybe_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if it has no more than ``most`` rows; counting stops there."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def shards_of(wanted: Sequence[Wanted], most: int) -> Iterator[Sequence[Wanted]]:
    """Runs of ``wanted`` whose parts have about ``most`` characters together, one at least."""
    first, size = 0, 0
    for i, parts in enumerate(wanted):
        n = sum(map(len, parts))
        if i > first and size + n > most:
            yield wanted[first:i]
            first, size = i, 0
        size += n
    if first < len(wanted):
        yield wanted[first:]


class Finder:
    """An automaton over all parts of some ``wanted``; a text has one if it contains each of its parts."""

    def __init__(self, wanted: Sequence[Wanted]):
        import ahocorasick

        self.wanted = wanted
        number = {p: i for i, p in enumerate(dict.fromkeys(p for parts in wanted for p in parts))}
        self.everywhere = {number[""]} if "" in number else set()
        self.automaton = ahocorasick.Automaton()
        for p, i in number.items():
            if p:
                self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        # each of ``wanted`` is looked at where its longest part is found, which tends to be the rarest
        self.by_part: dict[int, list[tuple[int, frozenset[int]]]] = {}
        for k, parts in enumerate(wanted):
            longest = max(parts, key=len)
            self.by_part.setdefault(number[longest], []).append((k, frozenset(number[p] for p in parts)))

    def find(self, text: str) -> list[int]:
        there = set(self.everywhere)
        if len(self.automaton):
            there.update(i for _, i in self.automaton.iter(text))
        return [k for i in there for k, needed in self.by_part.get(i, ()) if needed <= there]


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def scan(batches: Iterator[pa.RecordBatch], wanted: Sequence[Wanted], n_parts: int, shard_chars: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """For batches of (text, row): (row, the parts) for every text and each of ``wanted`` that it has."""
    shards = list(shards_of(wanted, shard_chars))
    one = Finder(shards[0]) if len(shards) == 1 else None
    for held in chunks(batches, 0 if one else chunk_bytes):
        for shard in shards:
            finder = one or Finder(shard)
            for batch in held:
                rows, hits = [], []
                for i, text in enumerate(batch.column(0)):
                    t = text.as_py()
                    if t is not None:
                        found = finder.find(t)
                        rows += [i] * len(found)
                        hits += found
                if rows:
                    parts = [pa.array([finder.wanted[k][p] for k in hits], pa.string()) for p in range(n_parts)]
                    yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(rows)), *parts], ["row", *(f"p{p}" for p in range(n_parts))])


def containing(texts: DataFrame, needles: DataFrame, text: str, parts: Sequence[str], carry: Sequence[str] | None = None, pass_bytes: int = PASS_BYTES, shard_chars: int = SHARD_CHARS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """row (a struct of the columns ``carry``, all by default) and p0, p1, ... for every text and distinct ``parts`` of ``needles`` all of which it contains.

    A null text has no part; needles with a null part are nowhere; an empty part is in every text that isn't null.
    """
    spark = texts.sparkSession
    told = needles.select(*(F.col(p).alias(f"p{i}") for i, p in enumerate(parts))).dropna().distinct()
    size = told.agg(F.sum(sum((F.octet_length(f"p{i}") for i in range(len(parts))), F.lit(0)))).first()[0] or 0
    passes = size // pass_bytes + 1
    rows = texts.select(F.col(text).alias("text"), F.struct(*(F.col(c) for c in (texts.columns if carry is None else carry))).alias("row"))
    schema = T.StructType([rows.schema["row"], *(T.StructField(f"p{i}", T.StringType()) for i in range(len(parts)))])
    found = None
    for k in range(passes):
        some = told.where(F.pmod(F.xxhash64(*told.columns), F.lit(passes)) == k) if passes > 1 else told
        wanted = spark.sparkContext.broadcast(sorted(tuple(r) for r in some.collect()))  # no more than about PASS_BYTES
        part = rows.mapInArrow(lambda batches, w=wanted: scan(batches, w.value, len(parts), shard_chars, chunk_bytes), schema)
        found = part if found is None else found.unionByName(part)
    return found


def contains_join(texts: DataFrame, needles: DataFrame, text: str, needle: str, carry: Sequence[str] | None = None, most: int = BROADCAST_ROWS, **limits: int) -> DataFrame:
    """Pairs where ``text`` contains ``needle``: the texts' columns ``carry`` (all by default) and all of the needles', which are broadcast if they are no more than ``most`` rows."""
    found = containing(texts, needles, text, [needle], carry, **limits)
    theirs = needles.select(F.struct("*").alias("needle"), F.col(needle).alias("p0"))
    return found.join(maybe_broadcast(theirs, most), "p0").select("row.*", "needle.*")


def last_containing(paths: DataFrame, wanted: DataFrame, path: str, parts: Sequence[str], order: Sequence[Column | str], **limits: int) -> DataFrame:
    """``wanted`` with the last path, in ``order``, that contains every one of its ``parts``; null where none does.

    The best path of each task and of distinct parts is kept before anything is shuffled.
    """
    told = paths.select(F.col(path).alias("path"), F.struct(*order).alias("order"))
    names = [f"p{i}" for i in range(len(parts))]
    found = containing(told, wanted, "path", parts, **limits)
    best = found.groupBy(*names).agg(F.max(F.struct("row.order", "row.path")).alias("best")).select(*names, F.col("best.path").alias("last"))
    mine = wanted.select(F.struct("*").alias("row"), *(F.col(p).alias(n) for p, n in zip(parts, names, strict=True)))
    return mine.join(best, names, "left").select("row.*", F.col("last").alias(path))
