"""Benchmark decontamination: rare n-gram seeds join training passages to test items, Smith-Waterman scores them.

1. One scan of the documents gives the runs of ``SEED_WORDS`` words (with their
   places) that test items may hold: a bitmap of bounded size over the items'
   runs travels with the tasks and leaves most others out; it decides nothing
   else.  The size of the benchmark changes neither the number of scans nor what
   a task or the driver holds.
2. The corpus counts of the items' runs say which of an item are rare beside its
   others: those are its seeds.  Runs are joined to seeds by shuffle; runs that
   hold more than a thousandth of all rows are split.
3. Seeds of one item that stand close together in a document make a candidate:
   a window of the document and a band of diagonals.  Windows are cut from the
   texts of candidate documents and aligned within their band, which is as wide as
   any reported alignment, so a document of any length costs memory for its
   windows only and an item of any length is scored exactly.

Words are letters and digits of the lower-cased text.  An alignment scores +2 a
match, -1 a mismatch or gap; a pair is reported if that reaches ``least`` of the
score of a whole copy.

Defined results: null or empty texts and items match nothing; an item of fewer
words than a seed is one seed of its own and matches texts of just those words;
equal items are reported each, several texts under one item id as one, by the
better; different texts under one document id are reported each, rows that
repeat id and text once; a document without an id has a null one; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.llm.alignment import align
from cartulary.llm.common import NO_ID, discard, keyed, lookup_join, materialise, split_by_keys, tidy
from cartulary.llm.wordhash import NOT_WORD, ROLL, Words, mix, spans

SEED_WORDS = 3
#: An item's seeds are its rare runs: all but those that occur more than RARE_TIMES as often as its median run does (or RARE_FLOOR).
RARE_TIMES, RARE_FLOOR = 4, 8
#: A window is aligned if it holds so many of an item's seeds (one, if the item has no more).
SHARED_SEEDS = 2
#: Bits of the map of the items' runs: 4 MB whatever the benchmark.
MAP_BITS = 1 << 25
LEAST_SCORE = 0.5

MATCHES = "d bigint, h bigint, item_id bigint, score double, matched_words bigint, item_words bigint, first_word bigint, last_word bigint"


def slack(words: int, least: float) -> int:
    """How far from the diagonals of its seeds an alignment of an item of ``words`` words runs at most: each step aside costs one of the 2 points a word that a whole copy has, and ``least`` of those are left."""
    return math.ceil(2 * words * (1 - least))


def word_hashes(texts: list[str]) -> Words:
    return Words([t.lower().encode("utf-8", "surrogatepass") for t in texts], NOT_WORD)


def runs_of(h: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``SEED_WORDS`` words; of a shorter text, of all its words."""
    n = min(SEED_WORDS, len(h))
    if not n:
        return h
    return mix(sum(h[k : len(h) - n + 1 + k] * ROLL[k] for k in range(n)))


def batch(kinds: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def hashed_items(items: DataFrame) -> DataFrame:
    """q (a number of its own), item_id, n, words (64-bit hashes), runs array<struct<run, first, last>> of the test items that have words."""
    run = pa.struct([("run", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
    kinds = {"q": pa.int64(), "item_id": pa.int64(), "n": pa.int32(), "words": pa.binary(), "runs": pa.list_(run)}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            out = []
            for q, item_id, text in zip(*(c.to_pylist() for c in some.columns), strict=True):
                h = word_hashes([text]).hash
                if len(h):
                    places: dict[int, list[int]] = {}
                    for i, r in enumerate(runs_of(h).view(np.int64).tolist()):
                        places.setdefault(r, [i, i])[1] = i
                    out.append((q, item_id, len(h), h.tobytes(), [{"run": r, "first": x, "last": y} for r, (x, y) in places.items()]))
            yield batch(kinds, out)

    told = items.where("text is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct().select(F.monotonically_increasing_id().alias("q"), "item_id", "text")
    return materialise(told.mapInArrow(tidy(scan), "q bigint, item_id bigint, n int, words binary, runs array<struct<run: bigint, first: int, last: int>>"), "items")


def run_map(runs: DataFrame) -> bytes:
    """A bit for each hash of ``runs(run)``; at most MAP_BITS / 64 rows reach the driver."""
    p = runs.select(F.col("run").bitwiseAND(MAP_BITS - 1).alias("p"))
    words = p.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b")).toPandas()
    out = np.zeros(MAP_BITS // 64, dtype="<i8")
    out[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64)
    return out.tobytes()


def find_runs(docs: DataFrame, mapped: bytes) -> DataFrame:
    """d, h, run, place of the runs of ``docs(d, h, text)`` that the map lets through."""
    kinds = {"d": pa.int64(), "h": pa.int64(), "run": pa.int64(), "place": pa.int64()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(mapped, np.uint8)
        for some in batches:
            d, h, column = (some.column(0).to_numpy(), some.column(1).to_numpy(), some.column(2))
            for a, z in spans(column):
                words = word_hashes(column[a:z].to_pylist())
                for n in range(1, SEED_WORDS + 1):
                    runs, at = words.grams(n)
                    if n < SEED_WORDS:  # only whole texts may be that short
                        keep = np.isin(at, words.bounds[np.flatnonzero(np.diff(words.bounds) == n)])
                        runs, at = runs[keep], at[keep]
                    p = runs & np.uint64(MAP_BITS - 1)
                    hit = (bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 > 0
                    runs, at = runs[hit], at[hit]
                    t = words.text[at]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (d[a + t], h[a + t], runs.view(np.int64), at - words.bounds[t])], names=list(kinds))

    return docs.mapInArrow(tidy(scan), "d bigint, h bigint, run bigint, place bigint")


def rare_seeds(items: DataFrame, hits: DataFrame) -> DataFrame:
    """run, times (rows of ``hits`` that have it), at array<struct<q, n, first, last, need>>: the items of which it is a seed."""
    counts = hits.groupBy("run").agg(F.count("*").alias("times"))
    runs = items.select("q", "n", F.inline("runs"))
    held = runs.groupBy("run").agg(F.count("*").alias("items"))
    told = runs.join(held, "run").join(counts, "run", "left").withColumn("times", F.coalesce("times", F.lit(0)))
    cost = F.col("times") * F.col("items")  # pairs that the run would make
    usual = told.groupBy("q").agg(F.median(cost).alias("usual"))
    rare = told.join(usual, "q").where(cost <= RARE_TIMES * F.greatest("usual", F.lit(RARE_FLOOR)))
    need = rare.groupBy("q").agg(F.least(F.count("*"), F.lit(SHARED_SEEDS)).cast("int").alias("need"))
    return rare.join(need, "q").where("times > 0").groupBy("run").agg(F.first("times").alias("times"), F.collect_list(F.struct("q", "n", "first", "last", "need")).alias("at"))


def find_windows(pairs: DataFrame) -> DataFrame:
    """d, h, q, n, low, high of the bands of diagonals in which close seeds of ``pairs(d, h, q, n, need, run, place, first, last)`` lie.

    A pair's places come in order; a cluster ends where none follows within n words, and one of
    more than 3n words is cut, with 2n words in common, which no reported alignment exceeds.
    """
    kinds = {"d": pa.int64(), "h": pa.int64(), "q": pa.int64(), "n": pa.int32(), "low": pa.int64(), "high": pa.int64()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], []  # held: run, place, first, last

        def close() -> None:
            d, h, q, n, need = now
            if len({r[0] for r in held}) >= need:
                out.append((d, h, q, n, min(p - last for _, p, _, last in held), max(p - first for _, p, first, _ in held)))

        for some in batches:
            for d, h, q, n, need, *hit in zip(*(c.to_pylist() for c in some.columns), strict=True):
                if now != (d, h, q, n, need):
                    if held:
                        close()
                    now, held = (d, h, q, n, need), []
                elif hit[1] - held[-1][1] > n + SEED_WORDS:
                    close()
                    held = []
                elif hit[1] - held[0][1] > 3 * n:
                    close()
                    held = [x for x in held if x[1] > held[-1][1] - 2 * n]
                held.append(hit)
            yield batch(kinds, out)
            out.clear()
        if held:
            close()
        yield batch(kinds, out)

    told = pairs.select("d", "h", "q", "n", "need", "run", "place", "first", "last").distinct()
    return told.repartition("d", "h", "q").sortWithinPartitions("d", "h", "q", "place", "run").mapInArrow(tidy(scan), "d bigint, h bigint, q bigint, n int, low bigint, high bigint")


def cut_windows(docs: DataFrame, windows: DataFrame, least: float) -> DataFrame:
    """``windows`` with first and part: their first word's place in the document and their words' hashes."""
    kinds = {"d": pa.int64(), "h": pa.int64(), "q": pa.int64(), "low": pa.int64(), "high": pa.int64(), "first": pa.int64(), "part": pa.binary()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            for d, h, text, at in zip(*(c.to_pylist() for c in some.columns), strict=True):
                words, out, size = word_hashes([text]).hash, [], 0
                for w in at:
                    low, high = w["low"] - slack(w["n"], least), w["high"] + slack(w["n"], least)
                    first = max(0, low)
                    part = words[first : max(first, w["n"] + high)]
                    out.append((d, h, w["q"], low - first, high - first, first, part.tobytes()))
                    size += len(part)
                    if size > 500_000:
                        yield batch(kinds, out)
                        out, size = [], 0
                yield batch(kinds, out)

    by_doc = windows.groupBy("d", "h").agg(F.collect_list(F.struct("q", "n", "low", "high")).alias("at"))
    may, _ = split_by_keys(docs, windows, ["d", "h"])
    return may.join(by_doc.hint("shuffle_hash"), ["d", "h"]).select("d", "h", "text", "at").mapInArrow(tidy(scan), "d bigint, h bigint, q bigint, low bigint, high bigint, first bigint, part binary")


def score_windows(parts: DataFrame, least: float) -> DataFrame:
    """The alignments of ``parts(d, h, item_id, n, words, low, high, first, part)`` that reach ``least`` (columns of ``MATCHES``)."""
    kinds = {"d": pa.int64(), "h": pa.int64(), "item_id": pa.int64(), "score": pa.float64(), "matched_words": pa.int64(), "item_words": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            out = []
            for d, h, item_id, n, words, low, high, first, part in zip(*(c.to_pylist() for c in some.columns), strict=True):
                score, same, x, y = align(np.frombuffer(words, np.uint64), np.frombuffer(part, np.uint64), low, high)
                if score >= least * 2 * n:
                    out.append((d, h, item_id, score / (2 * n), same, n, first + x, first + y))
            yield batch(kinds, out)

    return parts.select("d", "h", "item_id", "n", "words", "low", "high", "first", "part").mapInArrow(tidy(scan), MATCHES)


def matches(docs: DataFrame, items: DataFrame, least: float) -> DataFrame:
    """The best alignment of each of ``docs(d, h, text)`` and test item that reaches ``least`` (columns of ``MATCHES``)."""
    told = docs.where("text is not null")
    known = hashed_items(items)
    hits = materialise(find_runs(told, run_map(known.select(F.explode("runs.run").alias("run")))), "runs")
    seeds = materialise(rare_seeds(known, hits), "seeds")
    pairs = lookup_join(hits, seeds, "run", "times", hits.count(), "inner").select("d", "h", "run", "place", F.inline("at"))
    windows = materialise(find_windows(pairs), "windows")
    discard(hits, seeds)
    parts = cut_windows(told, windows, least)
    wanted = known.join(windows.groupBy("q").agg(F.count("*").alias("times")), "q").select("q", "item_id", "n", "words", "times")
    found = score_windows(lookup_join(parts, wanted, "q", "times", windows.count(), "inner"), least)
    columns = [c.split()[0] for c in MATCHES.split(", ")][3:]
    best = F.max_by(F.struct(*columns), F.struct(F.col("score"), -F.col("first_word"))).alias("b")
    return found.groupBy("d", "h", "item_id").agg(best).select("d", "h", "item_id", "b.*")


def find_contamination(docs: DataFrame, items: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """doc_id, item_id, score, matched_words, item_words, first_word, last_word: the best alignment of each document and test item that reaches ``least``."""
    found = matches(keyed(docs).select("d", "h", F.col("row.text").alias("text")), items, least)
    return found.select(F.nullif("d", F.lit(NO_ID)).alias("doc_id"), *found.columns[2:])


def drop_contaminated(docs: DataFrame, items: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents that match no test item."""
    rows = keyed(docs)
    found = matches(rows.select("d", "h", F.col("row.text").alias("text")), items, least)
    bad = materialise(found.select("d", "h").distinct(), "contaminated")
    may, kept = split_by_keys(rows, bad, ["d", "h"])
    return kept.unionByName(may.join(bad.hint("shuffle_hash"), ["d", "h"], "left_anti")).select("row.*")
