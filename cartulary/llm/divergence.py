"""Source divergence audit: a byte-level tokenizer, exact term counts, integer divergences between the sources of a language.

Tokenizing reads a block's UTF-8 buffers as one array of bytes: a lookup table
tells word bytes from others and lower-cases A-Z, the edges between them are the
terms.  Every slice gets its xxHash64 (computed for all short slices at once);
slices of one hash are one term only after their bytes are compared, and slices
that merely share a hash are told apart.  A sparse matrix (CSR) of documents by terms then
gives, by ``reduceat``, occurrences and documents of each term in each group.

Counts of blocks are summed by Spark.  A language keeps the terms of ``LEAST_DOCS``
documents or more.  Its kept entries (source, term, count) are dealt into buckets of
about ``ENTRIES`` by term; each bucket is a CSR matrix of sources by terms,
whose divergences for one source against the rows of all others are one ``reduceat``.  All numbers
are integers: ``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))``, divided digit by digit
so that nothing overflows, and ``floor((p - q)^2 / (p + q))``.

Terms that a source lacks all have one p, so a bucket works on the entries that there are, not on every source and term.
The pairs of a language's sources are the result itself and grow with their square;
a task holds those of ``TILE`` sources, a bucket being read again for every further ``TILE``.

Defined results: a null text, language or source is an empty one; a text without terms counts
as a document of its group; a group without terms, and a language without kept terms, has
divergences of 0 to the other sources and no terms; repeated rows are documents of their own; texts of any length are read whole, in
blocks cut between terms; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartulary.llm.common import lookup_join, materialise, tidy

LEAST_DOCS, SCALE, TOP_TERMS = 10, 10**9, 10
#: Bytes of text tokenized at once; entries of a bucket.
BLOCK_BYTES, ENTRIES = 4 << 20, 1 << 15
#: Sources that a task compares with all of their language.
TILE = 256
#: Bytes looked through at once for a place where a long text can be cut.
STEP = 1 << 16

#: What a byte is in a term: itself, a lower-case letter for A-Z, 0 for a byte of no term.
LOWER = np.zeros(256, dtype=np.uint8)
LOWER[0x80:] = np.arange(0x80, 0x100)
LOWER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
LOWER[ord("A") : ord("Z") + 1] = LOWER[ord("a") : ord("z") + 1]

U = np.uint64
#: Fixed values of xxHash64.
P1, P2, P3, P4, P5 = U(0x9E3779B185EBCA87), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0x85EBCA77C2B2AE63), U(0x27D4EB2F165667C5)


def turn(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U(r)) | (x >> U(64 - r))


def slice_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of every slice: those under 32 bytes together, longer ones by the library."""
    out = np.empty(len(start), dtype=np.uint64)
    short = length < 32
    for n in np.unique(length[short]):  # slices of one length take the same steps
        at = np.flatnonzero(length == n)
        rows = data[start[at][:, None] + np.arange(n)]
        h = np.full(len(at), P5 + U(n), dtype=np.uint64)
        for k in range(0, n - n % 8, 8):
            lane = np.ascontiguousarray(rows[:, k : k + 8]).view("<u8")[:, 0]
            h = turn(h ^ (turn(lane * P2, 31) * P1), 27) * P1 + P4
        k = n - n % 8
        if n - k >= 4:
            lane = np.ascontiguousarray(rows[:, k : k + 4]).view("<u4")[:, 0].astype(np.uint64)
            h = turn(h ^ (lane * P1), 23) * P2 + P3
            k += 4
        for j in range(k, n):
            h = turn(h ^ (rows[:, j].astype(np.uint64) * P5), 11) * P1
        h = (h ^ (h >> U(33))) * P2
        h = (h ^ (h >> U(29))) * P3
        out[at] = h ^ (h >> U(32))
    raw = data.tobytes() if not short.all() else b""
    for i in np.flatnonzero(~short):
        out[i] = xxhash.xxh64_intdigest(raw[start[i] : start[i] + length[i]])
    return out


def group_slices(data: np.ndarray, start: np.ndarray, length: np.ndarray, hashes=slice_hashes) -> tuple[np.ndarray, np.ndarray]:
    """(term of each slice, first slice of each term): slices of equal bytes are one term.

    Slices of one hash are held against the first of them, byte by byte; where one differs, the hash's slices are grouped by their bytes.
    """
    _, first, term = np.unique(hashes(data, start, length), return_index=True, return_inverse=True)
    rep = first[term]
    same = length == length[rep]
    for n in np.unique(length[same]):
        at = np.flatnonzero(same & (length == n))
        for some in np.array_split(at, len(at) * n // (8 << 20) + 1):
            same[some] = (data[start[some][:, None] + np.arange(n)] == data[start[rep[some]][:, None] + np.arange(n)]).all(axis=1)
    if not same.all():
        mixed = np.isin(term, np.unique(term[~same]))
        known: dict[bytes, int] = {}
        firsts = list(first)
        for i in np.flatnonzero(mixed):
            b = data[start[i] : start[i] + length[i]].tobytes()
            if b not in known:
                known[b] = len(firsts)
                firsts.append(i)
            term[i] = known[b]
        used, term = np.unique(term, return_inverse=True)
        first = np.asarray(firsts)[used]
    return term, first


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, where each begins and the last ends) of a string column, without copying it; a null is empty."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, ends - ends[0]


def blocks(low: np.ndarray, bounds: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of bytes of about ``most`` that end where a text ends or, in a long text, where no term goes on."""
    at, end = 0, int(bounds[-1])
    while at < end:
        stop = min(at + most, end)
        if stop < end:
            last = int(bounds[np.searchsorted(bounds, stop, side="right") - 1])
            if last > at:
                stop = last
            else:
                final = int(bounds[np.searchsorted(bounds, at, side="right")])
                while stop < final and not len(gap := np.flatnonzero(low[stop : min(stop + STEP, final)] == 0)):
                    stop = min(stop + STEP, final)
                stop += int(gap[0]) if stop < final else 0
        yield at, stop
        at = stop


def block_terms(low: np.ndarray, bounds: np.ndarray, at: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, document) of every term in a range of the lower-cased bytes."""
    word = low[at:stop] != 0
    inner = bounds[(bounds > at) & (bounds < stop)] - at
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    begins[inner] = word[inner]  # terms don't go on from one text into the next
    ends[inner - 1] = word[inner - 1]
    start = np.flatnonzero(begins) + at
    return start, np.flatnonzero(ends) + at + 1 - start, np.searchsorted(bounds, start, side="right") - 1


def count_block(low, start, length, doc, group_of, seen) -> tuple | None:
    """(group, term, occurrences, documents) of a block's terms by group.  ``seen``: document to terms that its earlier blocks had, so that it counts once for each."""
    if not len(start):
        return None
    term, first = group_slices(low, start, length)
    n_terms = len(first)
    cell, n = np.unique(doc * n_terms + term, return_counts=True)  # a CSR matrix of documents by terms, row by row
    row, column = cell // n_terms, cell % n_terms
    new = np.ones(len(cell), dtype=np.int64)
    for d in seen:
        for i in np.flatnonzero(row == d):
            f = first[column[i]]
            b = low[start[f] : start[f] + length[f]].tobytes()
            new[i] = b not in seen[d]
            seen[d].add(b)
    key = group_of[row] * n_terms + column
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.diff(key, prepend=-1))
    counts, docs = np.add.reduceat(n[order], heads), np.add.reduceat(new[order], heads)
    f = first[key[heads] % n_terms]
    offsets = np.concatenate([[0], np.cumsum(length[f])])
    raw = low[np.repeat(start[f] - offsets[:-1], length[f]) + np.arange(offsets[-1])]
    terms = pa.LargeStringArray.from_buffers(len(f), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw))
    return key[heads] // n_terms, terms.cast(pa.string()), counts, docs


COUNTS = "lang string, source string, term string, n bigint, docs bigint"
SCHEMA = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def count_terms(batches: Iterator[pa.RecordBatch], most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, term, n, docs) of each block of texts, and a row of an empty term for each group of a batch."""
    for batch in batches:
        langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        pairs = [(a or "", b or "") for a, b in zip(langs, sources, strict=True)]
        groups = sorted(set(pairs))
        number = {g: i for i, g in enumerate(groups)}
        group_of = np.fromiter((number[p] for p in pairs), np.int64, len(pairs))
        zeros = pa.array(np.zeros(len(groups), np.int64))
        lang, source = (pa.array([g[k] for g in groups], pa.string()) for k in (0, 1))
        yield pa.record_batch([lang, source, pa.array([""] * len(groups)), zeros, zeros], schema=SCHEMA)
        raw, bounds = text_bytes(batch.column(0))
        low = LOWER[raw]
        seen: dict[int, set[bytes]] = {}
        for at, stop in blocks(low, bounds, most):
            open_ended = int(np.searchsorted(bounds, stop, side="left"))
            cut = open_ended - 1 if bounds[min(open_ended, len(bounds) - 1)] != stop else -1  # the document that the block's end cuts
            seen = {d: s for d, s in seen.items() if bounds[d + 1] > at}
            if cut >= 0:
                seen.setdefault(cut, set())
            counted = count_block(low, *block_terms(low, bounds, at, stop), group_of, seen)
            if counted is None:
                continue
            g, terms, n, docs = counted
            yield pa.record_batch([lang.take(pa.array(g)), source.take(pa.array(g)), terms, pa.array(n), pa.array(docs)], schema=SCHEMA)


def share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 2) / total)``, three decimal digits at a time, so that no product leaves 64 bits; ``total`` counts N + 2 V."""
    above = np.asarray(count, dtype=np.int64) + 2
    out, rest = above // total, above % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


FOUND = "lang string, source string, part string, item string, value bigint"
FOUND_SCHEMA = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def compare_sources(entries: pa.Table, groups: pa.Table, top: int = TOP_TERMS, tile: int = TILE) -> pa.Table:
    """Divergences of a bucket over its terms: of each source to each other of one tile, and of the best terms of the tile's sources to their language.

    ``entries``: source, term, n (in the source), in_lang (in the language), in any order; ``groups``: every source of the
    language with total (its N) and lang_total (the language's), n_kept (V), and the number of the tile: so many sources of them in
    byte order.
    """
    if not groups.num_rows:
        return FOUND_SCHEMA.empty_table()
    lang = groups["lang"][0].as_py()
    names = sorted(groups["source"].to_pylist(), key=str.encode)
    place = {s: i for i, s in enumerate(names)}
    at = np.fromiter((place[s] for s in groups["source"].to_pylist()), np.int64, len(names))
    total = np.zeros(len(names), np.int64)
    total[at] = groups["total"].to_numpy()
    first = groups["tile"][0].as_py() * tile
    chosen_sources = np.arange(first, min(first + tile, len(names)))
    n_kept, whole = groups["n_kept"][0].as_py(), groups["lang_total"][0].as_py() + 2 * groups["n_kept"][0].as_py()
    total = total + 2 * n_kept
    apart = np.arange(len(names))[:, None] != chosen_sources[None, :]
    i, j = np.nonzero(apart)
    others = [names[k] for k in chosen_sources[j]]
    if n_kept == 0:
        return found_table(lang, names, i, "pair", others, np.zeros(len(i), np.int64))
    # a CSR matrix: entries by source, terms in byte order
    terms = entries["term"].to_pylist()
    words = sorted(set(terms), key=str.encode)
    number = {w: i for i, w in enumerate(words)}
    row = np.fromiter((place[s] for s in entries["source"].to_pylist()), np.int64, len(terms))
    column = np.fromiter((number[w] for w in terms), np.int64, len(terms))
    order = np.lexsort((column, row))
    row, column = row[order], column[order]
    p = share(entries["n"].to_numpy()[order], total[row]) if len(row) else np.zeros(0, np.int64)
    q = share(entries["in_lang"].to_numpy()[order], whole) if len(row) else p
    absent = share(np.zeros(len(names), np.int64), total)
    size = np.bincount(row, minlength=len(names))
    heads = np.flatnonzero(np.diff(row, prepend=-1))
    filled = row[heads]

    def row_sums(values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(names), np.int64)
        if len(heads):
            out[filled] = np.add.reduceat(values, heads)
        return out

    starts = np.concatenate([[0], np.cumsum(size)])
    other, has = np.empty(len(words), np.int64), np.empty(len(words), np.int64)

    def spread(source: int) -> None:
        """``other``: the source's p of every term; ``has``: which of them it has."""
        mine = slice(starts[source], starts[source + 1])
        other[:], has[:] = absent[source], 0
        other[column[mine]], has[column[mine]] = p[mine], 1

    one, both, shared, back = (np.zeros((len(names), len(chosen_sources)), np.int64) for _ in range(4))
    for k, source in enumerate(chosen_sources.tolist()):
        spread(source)
        d, h = distance(p, other[column]), has[column]
        one[:, k], both[:, k], shared[:, k] = row_sums(d), row_sums(d * h), row_sums(h)
    # the other way: the tile's own entries against every source
    mine = slice(starts[first], starts[min(first + tile, len(names))])
    tile_row, tile_column, tile_p = row[mine], column[mine], p[mine]
    tile_heads = np.flatnonzero(np.diff(tile_row, prepend=-1))
    for source in range(len(names)) if len(tile_heads) else ():
        spread(source)
        back[source, tile_row[tile_heads] - first] = np.add.reduceat(distance(tile_p, other[tile_column]), tile_heads)
    neither = len(words) - size[:, None] - size[None, chosen_sources] + shared
    value = one + back - both + neither * distance(absent[:, None], absent[None, chosen_sources])
    pairs = found_table(lang, names, i, "pair", others, value[i, j])

    above = np.flatnonzero((p > q) & (row >= first) & (row < first + tile))
    f = distance(p[above], q[above])
    best = np.lexsort((column[above], -f, row[above]))  # by source, then value, then term
    owner = row[above][best]
    ranks = np.arange(len(best)) - np.repeat(np.flatnonzero(np.diff(owner, prepend=-1)), np.diff(np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))))
    best = best[ranks < top]
    chosen = above[best]
    return pa.concat_tables([pairs, found_table(lang, names, row[chosen], "term", [words[k] for k in column[chosen]], f[best])])


def found_table(lang, names, rows, part, items, values) -> pa.Table:
    n = len(values)
    return pa.table([pa.array([lang] * n, pa.string()), pa.array([names[k] for k in rows], pa.string()), pa.array([part] * n, pa.string()), pa.array(items, pa.string()), pa.array(values, pa.int64())], schema=FOUND_SCHEMA)


def audit_sources(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, entries: int = ENTRIES, tile: int = TILE) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank: how far each source's use of terms is from each other source's, and its most typical terms."""
    told = docs.select(text, lang, source).mapInArrow(tidy(count_terms), COUNTS)
    counts = materialise(told.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    groups = counts.select("lang", "source").distinct()
    by_term = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("in_docs")).where(F.col("in_docs") >= least_docs)
    kept = materialise(counts.where("term <> ''").join(by_term.select("lang", "term", "in_lang"), ["lang", "term"]).select("lang", "source", "term", "n", "in_lang"), "kept")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("entries"))
    per_lang = by_term.groupBy("lang").agg(F.count("*").alias("n_kept"), F.sum("in_lang").alias("lang_total"))
    weights = totals.groupBy("lang").agg(F.sum("entries").alias("entries"))
    langs = groups.groupBy("lang").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles")).join(per_lang, "lang", "left").join(weights, "lang", "left").na.fill(0, ["n_kept", "lang_total", "entries"])
    langs = materialise(langs.withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.col("entries") / entries)).cast("int")), "langs")
    n = kept.count()
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    dealt = lookup_join(kept, langs, "lang", "entries", n, "inner").withColumn("bucket", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int")).withColumn("tile", every("tiles")).select("lang", "bucket", "tile", "source", "term", "n", "in_lang")
    of_group = groups.join(totals.select("lang", "source", "total"), ["lang", "source"], "left").na.fill(0, ["total"])
    of_group = of_group.join(langs.select("lang", "n_kept", "lang_total", "buckets", "tiles"), "lang").withColumn("bucket", every("buckets")).withColumn("tile", every("tiles")).drop("buckets", "tiles")
    keys = ["lang", "bucket", "tile"]
    found = dealt.groupBy(*keys).cogroup(of_group.groupBy(*keys)).applyInArrow(lambda a, b: compare_sources(a, b, top, tile), FOUND)
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    return summed.select("*", rank.cast("int").alias("rank")).where((F.col("part") == "pair") | (F.col("rank") <= top))
