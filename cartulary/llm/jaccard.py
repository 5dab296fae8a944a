"""Exact n-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of hashes of its distinct five-word runs.  Documents with
equal sets form a class; classes whose sets have a Jaccard similarity of
``PERCENT`` or more are linked, and linked classes form components.

A set of n tokens that links to another shares at least o = ceil(0.75 n) tokens
with it, so under any common order of tokens the first n - o + l tokens of both
share at least l.  Both uses below rest on that and lose no link:

1. Elimination.  In hash order, with l growing with n, a set of which too few
   prefix tokens occur in other prefixes has no link.  Tokens are packed into
   binary blocks by hash range; a token met twice within a block of documents
   travels once.
2. Rare first.  The sets left get exact token counts among themselves; those
   with fewer than o shared tokens go as well.  In order of counts each set
   takes the l whose candidates cost least to find and verify: its prefix is
   lengthened by l - 1 and a pair must share min(l, l') prefix tokens.

Candidates are verified in rounds, none of which expands a group of
copies into its pairs.  First each set is compared with one pivot, a set that
shares most of its prefix.  Sets of one pivot that are still in different
components are then compared in blocks, as bits over the pivot's tokens, less
those that the pivot rules out: x and y share at most min(|x&p|, |y&p|) +
min(|x-p|, |y-p|) tokens.  Only pairs without a common pivot are enumerated.

Defined results: null, empty and wordless texts have empty sets and link to
nothing; a text of fewer than five words is one run; texts of any length are
whole; rows that repeat an id keep a row each, with the component of their own
text (classes are told apart by their sets, never by ids); a null id names no
component (its row has the least id of its component, or null without one); an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm.common import NO_ID, components, discard, keyed, lookup_join, materialise, split_by_keys, tidy
from cartulary.llm.wordhash import ROLL, SPACE, Words, mix, spans

RUN_WORDS, PERCENT = 5, 75
#: Tokens, and sets, of a block of documents.
BLOCK_TOKENS, BLOCK_SETS = 250_000, 65_000
#: Sets that are unpacked at a time.
SLICE = 512
#: The longest extension of a rare-first prefix, and the cost of verifying a candidate in prefix entries.
MOST_MATCHES, VERIFY_COST = 8, 8.0
#: Rows of a side of a token's join that a task has at most.
PAIR_ROWS = 2048
#: Bytes of texts whose tokens make up a bucket of hash range, which a task holds at once, and buckets of a partition.
BUCKET_BYTES, BUCKETS = 4 << 20, 8


def overlap(n):
    """The least overlap of a set of ``n`` tokens with one that it links to."""
    return (PERCENT * n + 99) // 100


def first_matches(n):
    """Shared prefix tokens asked for in the elimination, by set size; it doesn't fall as ``n`` grows."""
    return 1 + n // 8


def token_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct run hashes of each text."""
    words = Words([t.encode("utf-8", "surrogatepass").lower() for t in texts], SPACE)
    runs, at = words.grams(RUN_WORDS)
    bounds = np.searchsorted(words.text[at], np.arange(len(texts) + 1)) if len(at) else np.zeros(len(texts) + 1, np.int64)
    out = []
    for t in range(len(texts)):
        n = words.bounds[t + 1] - words.bounds[t]
        if n >= RUN_WORDS:
            out.append(np.unique(runs[bounds[t] : bounds[t + 1]]))
        elif n:
            h = words.hash[words.bounds[t] : words.bounds[t + 1]]
            out.append(mix(np.add.reduce(h * ROLL[:n], keepdims=True)))
        else:
            out.append(runs[:0])
    return out


def set_key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def batch_of(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in kinds.items()], names=list(kinds))


def split_by_bucket(tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, numbers) of the runs of sorted ``tokens`` that fall in one bucket of hash range."""
    bucket = ((tokens >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cut = np.flatnonzero(np.diff(bucket)) + 1
    return np.concatenate([[0], cut, [len(tokens)]]), bucket[np.concatenate([[0], cut])] if len(tokens) else bucket


def bucket_count(spark: SparkSession, size: int) -> tuple[int, int]:
    """(buckets, partitions) for texts of ``size`` bytes: both grow with the texts alone, so that neither a bucket nor a partition does."""
    buckets = max(1, -(-size // BUCKET_BYTES))
    return buckets, max(min(int(spark.conf.get("spark.sql.shuffle.partitions")), buckets), buckets // BUCKETS)


def eliminate(docs: DataFrame, buckets: int, partitions: int) -> tuple[DataFrame, DataFrame]:
    """(sets, alive): d, h, n, key of every one of ``docs(d, h, text)``; and the keys of sets that may have a link."""
    #: kind 0: a document, owner being its set's place in the block; 1: places and counts of shared tokens; 2: tokens and the places of their sets.
    kinds = {"kind": pa.int32(), "bucket": pa.int32(), "block": pa.int64(), "owner": pa.int32(), "d": pa.int64(), "h": pa.int64(), "n": pa.int64(), "key": pa.binary(), "index": pa.binary(), "data": pa.binary()}
    schema = "kind int, bucket int, block bigint, owner int, d bigint, h bigint, n bigint, key binary, index binary, data binary"
    shared_here, no_set = 65_535, 65_534

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        places: dict[bytes, int] = {}
        prefixes: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            out: dict[str, list] = {k: [] for k in kinds}

            def put(kind, bucket, owner=None, d=None, h=None, n=None, key=None, index=None, data=None):
                for c, v in zip(out.values(), (kind, bucket, block, owner, d, h, n, key, index, data), strict=True):
                    c.append(v)

            for k, (d, h, n, key, owner) in enumerate(rows):
                put(0, k % buckets, owner, d, h, n, key)
            if prefixes:
                tokens = np.concatenate(prefixes)
                index = np.repeat(np.arange(len(prefixes)), [len(p) for p in prefixes])
                order = np.argsort(tokens, kind="stable")
                tokens, index = tokens[order], index[order]
                start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
                times = np.diff(start, append=len(tokens))
                met = np.bincount(index[np.repeat(times > 1, times)], minlength=len(prefixes))
                who = np.flatnonzero(met)
                put(1, block % buckets, index=who.astype("<u2").tobytes(), data=met[who].astype("<u4").tobytes())
                # a token that is shared here needs no owner: it only tells other blocks that it is not alone
                mark = np.where(times > 1, shared_here, index[start]).astype("<u2")
                tokens = tokens[start]
                bounds, numbers = split_by_bucket(tokens, buckets)
                for a, z, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), numbers.tolist(), strict=True):
                    put(2, b, index=mark[a:z].tobytes(), data=tokens[a:z].tobytes())
            return batch_of(out, kinds)

        for batch in batches:
            ids, hashes, column = batch.columns
            for a, z in spans(column):
                for d, h, tokens in zip(ids[a:z].to_pylist(), hashes[a:z].to_pylist(), token_sets(column[a:z].to_pylist()), strict=True):
                    n = len(tokens)
                    if not n:
                        rows.append((d, h, 0, None, no_set))
                    else:
                        key = set_key(tokens)
                        if key not in places:
                            places[key] = len(prefixes)
                            prefixes.append(tokens[: n - overlap(n) + first_matches(n)])
                            held += len(prefixes[-1])
                        rows.append((d, h, n, key, places[key]))
                    if held >= BLOCK_TOKENS or len(rows) >= BLOCK_SETS:
                        yield flush()
                        block += 1
                        rows, places, prefixes, held = [], {}, [], 0
        if rows:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents and local counts as they are; of each bucket, the counts of tokens that other blocks share, by block."""
        counts: list[tuple[np.ndarray, np.ndarray]] = []  # (block and place, shared tokens)

        def close(some: list[tuple[int, bytes, bytes]]) -> None:
            tokens = np.concatenate([np.frombuffer(t, "<u8") for _, _, t in some])
            owner = np.concatenate([np.frombuffer(i, "<u2") for _, i, _ in some])
            block = np.repeat(np.array([b for b, _, _ in some]), [len(t) // 8 for _, _, t in some])
            order = np.argsort(tokens, kind="stable")
            tokens, owner, block = tokens[order], owner[order], block[order]
            start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            times = np.diff(start, append=len(tokens))
            known = np.maximum.reduceat(owner == shared_here, start)
            live = np.repeat((times > 1) | known, times) & (owner != shared_here)
            where = np.unique(np.stack([block[live], owner[live].astype(np.int64)]), axis=1, return_counts=True)
            counts.append(where)

        def told() -> pa.RecordBatch:
            out: dict[str, list] = {k: [] for k in kinds}
            for where, n in counts:
                cut = np.concatenate([[0], np.flatnonzero(np.diff(where[0])) + 1, [len(n)]])
                for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True) if len(n) else ():
                    for c, v in zip(out.values(), (1, 0, int(where[0, x]), None, None, None, None, None, where[1, x:y].astype("<u2").tobytes(), n[x:y].astype("<u4").tobytes()), strict=True):
                        c.append(v)
            counts.clear()
            return batch_of(out, kinds)

        now, some = None, []
        for batch in batches:
            kind = batch.column(0).to_numpy()
            yield batch.filter(pa.array(kind < 2))
            for i in np.flatnonzero(kind == 2).tolist():
                bucket = batch.column(1)[i].as_py()
                if bucket != now and some:
                    close(some)
                    some = []
                    if sum(len(n) for _, n in counts) > 500_000:
                        yield told()
                now = bucket
                some.append((batch.column(2)[i].as_py(), batch.column(8)[i].as_py(), batch.column(9)[i].as_py()))
        if some:
            close(some)
        yield told()

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """With the rows of a block together, counts first: which documents may have a link."""
        out_kinds = {"d": pa.int64(), "h": pa.int64(), "n": pa.int64(), "key": pa.binary(), "alive": pa.bool_()}
        now, counts = None, np.zeros(BLOCK_SETS + 1, dtype=np.int64)
        for batch in batches:
            out: dict[str, list] = {k: [] for k in out_kinds}
            for kind, block, owner, d, h, n, key, index, data in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5, 6, 7, 8, 9)), strict=True):
                if block != now:
                    now = block
                    counts[:] = 0
                if kind == 1:
                    counts[np.frombuffer(index, "<u2")] += np.frombuffer(data, "<u4")
                    continue
                alive = n > 0 and counts[owner] >= first_matches(overlap(n))
                for c, v in zip(out.values(), (d, h, n, key, bool(alive)), strict=True):
                    c.append(v)
            yield batch_of(out, out_kinds)

    told = docs.select("d", "h", F.coalesce("text", F.lit("")).alias("text"))
    met = told.mapInArrow(tidy(scan), schema).repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(meet), schema)
    judged = met.repartition(partitions, "block").sortWithinPartitions("block", F.desc("kind")).mapInArrow(tidy(decide), "d bigint, h bigint, n bigint, key binary, alive boolean")
    sets = materialise(judged, "sets-of-documents")
    return sets.drop("alive"), sets.where("alive").select("key").distinct()


def shared_sets(docs: DataFrame, wanted: DataFrame, buckets: int, partitions: int) -> DataFrame:
    """doc, n, ell, tokens (shared ones, rare first), prefix of the sets ``wanted(doc, d, h)``, found in ``docs(d, h, text)``, that have enough shared tokens."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"doc": pa.int64(), "tokens": pa.binary()}
        for batch in batches:
            ids, column = batch.columns
            for a, z in spans(column):
                out: dict[str, list] = {k: [] for k in kinds}
                for doc, tokens in zip(ids[a:z].to_pylist(), token_sets(column[a:z].to_pylist()), strict=True):
                    for c, v in zip(out.values(), (doc, tokens.tobytes()), strict=True):
                        c.append(v)
                yield batch_of(out, kinds)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sets that stand together as blocks, so that what a block tells a bucket is a few rows and not one a set."""
        from pyspark import TaskContext

        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            blocks = np.empty(batch.num_rows, np.int64)
            for i, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
                blocks[i] = block
                held += n // 8
                if held >= BLOCK_TOKENS:
                    block, held = block + 1, 0
            yield pa.RecordBatch.from_arrays([pa.array(blocks), *batch.columns], ["block", "doc", "tokens"])

    may, _ = split_by_keys(docs.where("text is not null"), wanted, ["d", "h"])
    found = may.join(wanted.hint("shuffle_hash"), ["d", "h"]).select("doc", "text")  # once for each row that repeats id and text
    once = found.mapInArrow(tidy(extract), "doc bigint, tokens binary").dropDuplicates(["doc"])
    sets = materialise(once.mapInArrow(tidy(deal), "block bigint, doc bigint, tokens binary"), "sets")

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"bucket": pa.int32(), "block": pa.int64(), "tokens": pa.binary(), "times": pa.binary()}
        for batch in batches:
            block = batch.column(0).to_numpy()
            tokens = batch.column(1)
            for b in np.unique(block).tolist():
                mine = np.flatnonzero(block == b).tolist()
                for k in range(0, len(mine), SLICE):
                    t, n = np.unique(np.concatenate([np.frombuffer(tokens[i].as_py(), "<u8") for i in mine[k : k + SLICE]]), return_counts=True)
                    bounds, numbers = split_by_bucket(t, buckets)
                    n = n.astype("<u4")
                    out: dict[str, list] = {x: [] for x in kinds}
                    for a, z, bucket in zip(bounds[:-1].tolist(), bounds[1:].tolist(), numbers.tolist(), strict=True):
                        for c, v in zip(out.values(), (bucket, b, t[a:z].tobytes(), n[a:z].tobytes()), strict=True):
                            c.append(v)
                    yield batch_of(out, kinds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"block": pa.int64(), "tokens": pa.binary(), "times": pa.binary()}

        def close(some: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
            tokens = np.concatenate([np.frombuffer(t, "<u8") for _, t, _ in some])
            times = np.concatenate([np.frombuffer(n, "<u4").astype(np.int64) for _, _, n in some])
            block = np.repeat(np.array([b for b, _, _ in some]), [len(t) // 8 for _, t, _ in some])
            order = np.argsort(tokens, kind="stable")
            tokens, times, block = tokens[order], times[order], block[order]
            start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            total = np.repeat(np.add.reduceat(times, start), np.diff(start, append=len(tokens)))
            keep = total > 1
            tokens, total, block = tokens[keep], total[keep], block[keep]
            order = np.argsort(block, kind="stable")
            tokens, total, block = tokens[order], total[order], block[order]
            out: dict[str, list] = {k: [] for k in kinds}
            cut = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
            for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True) if len(block) else ():
                for c, v in zip(out.values(), (int(block[a]), tokens[a:z].tobytes(), np.minimum(total[a:z], 2**32 - 1).astype("<u4").tobytes()), strict=True):
                    c.append(v)
            return batch_of(out, kinds)

        now, some = None, []
        for batch in batches:
            for bucket, block, t, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now and some:
                    yield close(some)
                    some = []
                now = bucket
                some.append((block, t, n))
        if some:
            yield close(some)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"doc": pa.int64(), "n": pa.int64(), "ell": pa.int32(), "tokens": pa.binary(), "prefix": pa.list_(pa.int64())}
        now, parts, table = None, [], None
        for batch in (whole.slice(a, SLICE) for whole in batches for a in range(0, whole.num_rows, SLICE)):
            out: dict[str, list] = {k: [] for k in kinds}
            for block, kind, doc, tokens, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != now:
                    now, parts, table = block, [], None
                t = np.frombuffer(tokens, "<u8")
                if kind == 0:
                    parts.append((t, np.frombuffer(times, "<u4")))
                    continue
                if table is None:
                    known = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
                    often = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.uint32)
                    known, one = np.unique(known, return_index=True)
                    table = (known, often[one])
                known, often = table
                n, need = len(t), overlap(len(t))
                at = np.minimum(np.searchsorted(known, t), max(0, len(known) - 1))
                shared = known[at] == t if len(known) else np.zeros(n, dtype=bool)
                alone = n - int(shared.sum())
                if n - alone < need:
                    continue
                mine, df = t[shared], often[at[shared]].astype(np.float64)
                order = np.lexsort((mine, df))
                mine, df = mine[order], df[order]
                reach = n - need - alone  # shared tokens in the prefix of ell, less ell
                upto = np.concatenate([[0], np.cumsum(df - 1)])
                most = min(MOST_MATCHES, need)
                cost = [upto[reach + ell] * (1 + VERIFY_COST / ell) for ell in range(1, most + 1)]
                ell = 1 + int(np.argmin(cost))
                row = (doc, n, ell, mine.tobytes(), mine[: reach + ell].view(np.int64).tolist())
                for c, v in zip(out.values(), row, strict=True):
                    c.append(v)
            yield batch_of(out, kinds)

    told = sets.select("block", "tokens").mapInArrow(tidy(tell), "bucket int, block bigint, tokens binary, times binary")
    counted = told.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(count), "block bigint, tokens binary, times binary")
    counted = counted.select("block", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("doc"), "tokens", "times")
    both = counted.unionByName(sets.select("block", F.lit(1).alias("kind"), "doc", "tokens", F.lit(None).cast("binary").alias("times")))
    chosen = both.repartition(partitions, "block").sortWithinPartitions("block", "kind").mapInArrow(tidy(choose), "doc bigint, n bigint, ell int, tokens binary, prefix array<bigint>")
    shared = materialise(chosen, "shared-sets")
    discard(sets)
    return shared


def verify(pairs: DataFrame, shapes: bool = False) -> DataFrame:
    """x, y, common, linked of ``pairs(x, nx, tx, y, ny, ty)``; with ``shapes`` also x as seen from y: which of y's tokens it has, and its other tokens.

    Without ``shapes``, pairs also have src and dst, which are passed on.
    """
    kinds = {"x": pa.int64(), "y": pa.int64(), "common": pa.int64(), "linked": pa.bool_()}
    kinds |= {"bits": pa.binary(), "rest": pa.binary()} if shapes else {"src": pa.int64(), "dst": pa.int64()}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, nx, tx, y, ny, ty, *passed = batch.columns
            out: dict[str, list] = {k: [] for k in kinds}
            for i, (a, n, b, m) in enumerate(zip(x.to_pylist(), nx.to_pylist(), y.to_pylist(), ny.to_pylist(), strict=True)):
                p, q = np.frombuffer(tx[i].as_py(), "<u8"), np.frombuffer(ty[i].as_py(), "<u8")
                if shapes:
                    p, q = np.sort(p), np.sort(q)
                    has = np.isin(q, p, assume_unique=True)
                    common = int(has.sum())
                    more = (np.packbits(has).tobytes(), p[~np.isin(p, q, assume_unique=True)].tobytes())
                else:
                    common, more = len(np.intersect1d(p, q, assume_unique=True)), tuple(c[i].as_py() for c in passed)
                for c, v in zip(out.values(), (a, b, common, 100 * common >= PERCENT * (n + m - common), *more), strict=True):
                    c.append(v)
            yield batch_of(out, kinds)

    more = "bits binary, rest binary" if shapes else "src bigint, dst bigint"
    told = pairs.select("x", "nx", "tx", "y", "ny", "ty", *(() if shapes else ("src", "dst")))
    return told.mapInArrow(tidy(compare), f"x bigint, y bigint, common bigint, linked boolean, {more}")


def compare_within(shapes: DataFrame) -> DataFrame:
    """(src, dst): different components that sets of one pivot link.

    ``shapes(pivot, doc, n, common, c, c_pivot, bits, rest)``: one of such a pair is
    outside the pivot's component.  Those sets are compared, in blocks, with
    blocks of all sets of the pivot: overlaps inside the pivot are counts of common
    bits.  A task has one block of each; a pivot of many sets has many blocks.
    """
    counted = shapes.groupBy("pivot").agg(F.count("*").alias("m"), F.count_if(F.col("c") != F.col("c_pivot")).alias("k")).where("k > 0")
    blocks = lambda n, small, most, large: F.greatest(F.ceil(n / large), F.least(F.lit(most).cast("bigint"), F.ceil(n / small)))
    sized = counted.select("pivot", "m", blocks(F.col("m"), 64, 32, 2048).alias("bm"), blocks(F.col("k"), 64, 8, 512).alias("bk"))
    rows = lookup_join(shapes, sized, "pivot", "m", shapes.count()).where("bm is not null")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    part = lambda n: F.pmod(F.xxhash64("doc"), n)
    columns = ("n", "common", "c", "bits", "rest")
    data = rows.select("pivot", part(F.col("bm")).alias("i"), every(F.col("bk")).alias("j"), F.lit(False).alias("asks"), *columns)
    asks = rows.where("c <> c_pivot").select("pivot", every(F.col("bm")).alias("i"), part(F.col("bk")).alias("j"), F.lit(True).alias("asks"), *columns)

    def compare(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy()
        found: dict[str, list] = {"src": [], "dst": []}
        if asks.any() and not asks.all():
            n, common, c = (group.column(k).to_numpy() for k in ("n", "common", "c"))
            bits, rest = group.column("bits").to_pylist(), group.column("rest").to_pylist()
            held = np.array([len(r) // 8 for r in rest]) + common
            wide = np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1)
            q, d = np.flatnonzero(asks), np.flatnonzero(~asks)
            extra = np.zeros((len(q), len(d)), dtype=np.int32)
            tokens = [np.frombuffer(r, "<u8") for r in rest]
            qt, dt = np.concatenate([tokens[k] for k in q]), np.concatenate([tokens[k] for k in d])
            qi, di = np.repeat(np.arange(len(q)), [len(tokens[k]) for k in q]), np.repeat(np.arange(len(d)), [len(tokens[k]) for k in d])
            order = np.argsort(dt, kind="stable")
            dt, di = dt[order], di[order]
            lo, hi = np.searchsorted(dt, qt, side="left"), np.searchsorted(dt, qt, side="right")
            for k in np.flatnonzero(hi > lo).tolist():
                extra[qi[k], di[lo[k] : hi[k]]] += 1
            for k, a in enumerate(q.tolist()):
                may = d[(c[d] != c[a]) & (100 * np.minimum(n[d], n[a]) >= PERCENT * np.maximum(n[d], n[a]))]
                most = np.minimum(common[may], common[a]) + np.minimum(held[may] - common[may], held[a] - common[a])
                may = may[(100 + PERCENT) * most >= PERCENT * (n[may] + n[a])]
                if len(may):
                    both = np.bitwise_count(wide[may] & wide[a]).sum(axis=1, dtype=np.int64) + extra[k, np.searchsorted(d, may)]
                    hit = may[(100 + PERCENT) * both >= PERCENT * (n[may] + n[a])]
                    others = np.unique(c[hit])
                    found["src"] += [int(c[a])] * len(others)
                    found["dst"] += others.tolist()
        return pa.table({k: pa.array(v, pa.int64()) for k, v in found.items()})

    return data.unionByName(asks).groupBy("pivot", "i", "j").applyInArrow(compare, "src bigint, dst bigint")


def with_sets(pairs: DataFrame, sets: DataFrame, unique_x: bool = False) -> DataFrame:
    """``pairs(x, y)`` with sizes and tokens of both."""
    total, told = pairs.count(), pairs
    for c in ("x", "y"):
        side = sets.select(F.col("doc").alias(c), F.col("n").alias(f"n{c}"), F.col("tokens").alias(f"t{c}"))
        if unique_x and c == "x":
            pairs = pairs.join(side, c)
            continue
        side = side.join(told.groupBy(c).agg(F.count("*").alias("times")), c)
        pairs = lookup_join(pairs, side, c, "times", total, "inner").drop("times")
    return pairs


def merged(groups: DataFrame, c: str, links: DataFrame) -> DataFrame:
    """``groups`` with its component column ``c`` after joining the components that ``links(src, dst)`` link."""
    if links.isEmpty():
        return groups
    more = components(links).select(F.col("node").alias(c), F.col("component").alias("_to"))
    return groups.join(more, c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")


def meet_in_blocks(x: DataFrame, y: DataFrame, on: list[str], most: int | None = None) -> DataFrame:
    """``x.join(y, on)`` where a key of more than ``most`` (``PAIR_ROWS``) rows of a side is joined in blocks: each row goes to one part of its own side and to all parts of the other, so that no task has more than ``most`` of both."""
    key, most = F.struct(*on), most or PAIR_ROWS
    both = x.groupBy(key.alias("_key")).agg(F.count("*").alias("nx")).join(y.groupBy(key.alias("_key")).agg(F.count("*").alias("ny")), "_key")
    both = materialise(both.withColumn("px", F.ceil(F.col("nx") / most)).withColumn("py", F.ceil(F.col("ny") / most)), "sizes-of-keys")
    dealt = []
    for side, n, mine, theirs in ((x, "nx", "px", "py"), (y, "ny", "py", "px")):
        rows = lookup_join(side.withColumn("_key", key), both, "_key", n, side.count(), "inner")
        part = F.pmod(F.xxhash64(*(F.col(c) for c in side.columns)), F.col(mine)).cast("bigint").alias(f"_{mine}")
        rows = rows.select(*side.columns, part, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(theirs) - 1)).alias(f"_{theirs}"))
        dealt.append(rows)
    return dealt[0].join(dealt[1], [*on, "_px", "_py"]).drop("_px", "_py")


def group_sets(sets: DataFrame) -> DataFrame:
    """doc, c: the component of each of ``sets(doc, n, ell, tokens, prefix)``."""
    entries = materialise(sets.select(F.explode("prefix").alias("token"), "doc", "n", "ell", (F.octet_length("tokens") / 8 / F.col("n")).alias("fill")), "entries")
    total = entries.count()
    best = F.min(F.struct((1 - F.col("fill")).alias("alone"), F.col("doc").alias("doc")))
    tokens = materialise(entries.groupBy("token").agg(F.count("*").alias("times"), best.alias("b")).where("times > 1").select("token", "times", F.col("b.doc").alias("pivot")), "tokens")
    near = lookup_join(entries.select("token", "doc"), tokens, "token", "times", total).where("pivot is not null and pivot <> doc")
    # of the pivots that share half as much with a set as its best does, it takes the one that most sets could take
    votes = materialise(near.groupBy("doc", "pivot").agg(F.count("*").alias("k")), "votes")
    taken = materialise(votes.groupBy("pivot").agg(F.count("*").alias("times")), "votes-of-pivots")
    ranked = lookup_join(votes, taken, "pivot", "times", votes.count())
    enough = ranked.join(votes.groupBy("doc").agg(F.max("k").alias("most")), "doc").where("2 * k >= most")
    first = materialise(enough.groupBy("doc").agg(F.max(F.struct("times", "k", (-F.col("pivot")).alias("p")))["p"].alias("p")).select(F.col("doc").alias("x"), (-F.col("p")).alias("y")), "pivots")
    hot = first.groupBy("y").agg(F.count("*").alias("times"))
    tried = materialise(verify(with_sets(first, sets, unique_x=True), shapes=True), "tried")
    linked = tried.where("linked").select(F.col("x").alias("src"), F.col("y").alias("dst"))
    groups = components(linked)

    about = sets.select("doc", "n", "ell").join(tried.select(F.col("x").alias("doc"), F.col("y").alias("pivot"), "common", "bits", "rest"), "doc", "left")
    about = about.join(groups.select(F.col("node").alias("doc"), F.col("component").alias("c")), "doc", "left").withColumn("c", F.coalesce("c", "doc"))
    about = materialise(about, "sets-in-groups")
    discard(tokens, votes, taken, tried)
    pivots = materialise(about.select(F.col("doc").alias("pivot"), F.col("c").alias("c_pivot")).join(hot.withColumnRenamed("y", "pivot"), "pivot"), "pivot-groups")
    shapes = materialise(lookup_join(about.where("pivot is not null"), pivots, "pivot", "times", first.count()).drop("times"), "shapes")
    within = materialise(compare_within(shapes).distinct(), "links-within")
    now = materialise(merged(about.select("doc", "n", "ell", "pivot", "c"), "c", within), "groups")
    discard(shapes, pivots, about, first)
    rows = materialise(entries.select("token", "doc").join(now, "doc"), "entries-in-groups")
    mixed = rows.groupBy("token").agg(F.count("*").alias("times"), F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 <> c2").select("token", "times", "c1")
    mixed = materialise(mixed, "mixed-tokens")
    before, rows = rows, materialise(lookup_join(rows, mixed, "token", "times", total).where("c1 is not null"), "mixed-entries")
    discard(before, entries)
    # sets of sizes that may link are of the same size class or of neighbouring ones
    size = F.floor(F.log("n") / F.log(F.lit(100 / PERCENT))).cast("int")
    side = lambda s, *more: rows.select("token", size.alias("size"), *(F.col(k).alias(f"{s}_{k}") for k in ("doc", "n", "ell", "pivot", "c", *more)))
    x, y = side("x", "c1").where("x_c <> x_c1").drop("x_c1"), side("y", "c1")
    x = x.withColumn("size", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)))
    met = meet_in_blocks(x, y, ["token", "size"]).where(
        (F.col("x_c") != F.col("y_c"))
        & ((F.col("y_c") == F.col("y_c1")) | (F.col("x_doc") < F.col("y_doc")))
        & (100 * F.least("x_n", "y_n") >= PERCENT * F.greatest("x_n", "y_n"))
        & F.coalesce((F.col("x_pivot") != F.col("y_pivot")) & (F.col("x_pivot") != F.col("y_doc")) & (F.col("y_pivot") != F.col("x_doc")), F.lit(True))
    )
    ordered = lambda k: (F.when(F.col("x_doc") < F.col("y_doc"), F.col(f"x_{k}")).otherwise(F.col(f"y_{k}")), F.when(F.col("x_doc") < F.col("y_doc"), F.col(f"y_{k}")).otherwise(F.col(f"x_{k}")))
    (x, y), (src, dst) = ordered("doc"), ordered("c")
    pairs = met.groupBy(x.alias("x"), y.alias("y")).agg(F.count("*").alias("k"), F.first(F.least("x_ell", "y_ell")).alias("ell"), F.first(src).alias("src"), F.first(dst).alias("dst"))
    pairs = materialise(pairs.where("k >= ell").select("x", "y", "src", "dst"), "pairs")
    discard(rows, mixed, within)
    if pairs.isEmpty():
        return now.select("doc", "c")
    more = materialise(verify(with_sets(pairs, sets)).where("linked").select("src", "dst").distinct(), "links-between")
    return merged(now.select("doc", "c"), "c", more)


def grouped(docs: DataFrame) -> DataFrame:
    """d, h, n, component (least id of the documents linked to it), keeper (d and h of the first of them) of each of ``docs(d, h, text)``; the last two are null for empty sets."""
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    buckets, partitions = bucket_count(docs.sparkSession, size)
    all_sets, alive = eliminate(docs, buckets, partitions)
    keyed_sets = all_sets.where("n > 0").groupBy("key").agg(F.min(F.struct("d", "h")).alias("least"), F.count("*").alias("times"))
    # written, the numbers stay: every later use reads the same
    classes = materialise(keyed_sets.withColumn("doc", F.monotonically_increasing_id()), "classes")
    sets = shared_sets(docs, classes.join(alive, "key").select("doc", "least.d", "least.h"), buckets, partitions)
    named = classes.join(group_sets(sets), "doc", "left").where("times > 1 or c is not null").select("key", "times", F.coalesce("c", "doc").alias("c"), "least")
    named = materialise(named, "named-classes")
    firsts = named.groupBy("c").agg(F.count("*").alias("classes"), F.min("least").alias("first"))
    firsts = lookup_join(named.select("c", "key", "times"), firsts, "c", "classes", named.count(), "inner").where("times > 1 or classes > 1")
    firsts = materialise(firsts.select("key", "times", "first"), "firsts-of-classes")
    out = lookup_join(all_sets, firsts, "key", "times", all_sets.count())
    keeper = F.when(F.col("n") > 0, F.coalesce("first", F.struct("d", "h")))
    return out.select("d", "h", "n", keeper.alias("keeper")).withColumn("component", F.nullif("keeper.d", F.lit(NO_ID)))


def link_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``; see the module's text."""
    out = grouped(keyed(docs).select("d", "h", F.col("row.text").alias("text")))
    doc_id = F.nullif("d", F.lit(NO_ID))
    return out.select(doc_id.alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", doc_id).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id (and text hash, where texts share it); rows that repeat it stay."""
    rows = keyed(docs)
    out = grouped(rows.select("d", "h", F.col("row.text").alias("text")))
    gone = materialise(out.where("keeper.d <> d or keeper.h <> h").select("d", "h").distinct(), "not-kept")
    may, kept = split_by_keys(rows, gone, ["d", "h"])
    return kept.unionByName(may.join(gone.hint("shuffle_hash"), ["d", "h"], "left_anti")).select("row.*")
