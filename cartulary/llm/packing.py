"""Order-preserving packing of tokenised documents into fixed windows.

Each input partition is one token stream: its documents in order of ``doc_id``,
each followed by an end token.  Windows are consecutive pieces of the stream of
at most ``window`` tokens.  A dynamic programme picks the cuts among document
ends, sentence ends and, inside very long sentences, every ``FORCED_STEP``
tokens.  A window costs its padding (none where its length is a power of two)
plus a penalty for the kind of cut that ends it.  The best predecessor of a cut
is the minimum over a sliding range of earlier cuts, held in a monotone queue.

Nothing is shuffled: a partition is packed by the task that reads it, the
programme restarts after about ``BLOCK_TOKENS`` tokens at a document end, and
memory holds one block.  ``sequence_id`` joins the partition number and a
running number, so a repeated task gives the same ids.

Defined results: a null text is an empty text, an empty text is the end token
alone, a text longer than a window spans several, repeated rows are packed once
each, an empty table gives no rows, and columns other than id and text are not
read.  A null id is kept as null.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import give_back, tidy
from cartulary.llm.wordhash import BYTE, mix, place, spans

SENTENCE_PENALTY, FORCED_PENALTY = 12, 64
FORCED_STEP, LONG_SENTENCE = 256, 512
BLOCK_TOKENS = 1_000_000
CACHE_UNITS = 800_000
#: Units tokenised in one call, and bytes of texts encoded at once: what a worker holds besides its cache.
LEARN_UNITS, ENCODE_BYTES = 10_000, 400_000
#: After so many encoded pieces freed memory goes back to the machine.
TRIM_EVERY = 4
SENTENCE = re.compile(r" (?<=[.!?] )|\n")

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def plan_cuts(pos: list[int], pen: list[int], window: int) -> list[int]:
    """The cheapest cuts of tokens 0..pos[-1]; ``pos`` ascends, each step at most ``window``; the last is always cut.

    best[i] = pen[i] + min over j with pos[i] - pos[j] <= window of best[j] + padding(pos[i] - pos[j])
    """
    best, back = [0], [0]
    at = [0, *pos]
    where = {0: 0}
    powers = [1 << k for k in range(window.bit_length()) if 1 << k < window]
    queue = deque([(0, 0)])  # (best[j] + at[j], j), ascending; the front is the cheapest in range
    for i in range(1, len(at)):
        p = at[i]
        while at[queue[0][1]] < p - window:
            queue.popleft()
        cost, j = queue[0]
        cost += window - p
        for n in powers:
            k = where.get(p - n)
            if k is not None and best[k] < cost:
                cost, j = best[k], k
        cost += pen[i - 1]
        best.append(cost)
        back.append(j)
        where[p] = i
        key = cost + p
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, i))
    cuts, i = [], len(at) - 1
    while i:
        cuts.append(at[i])
        i = back[i]
    return cuts[::-1]


class Units:
    """Token ids of texts, looked up by unit: a run of letters, a run of marks, or a digit.

    The tokenizer cuts a text into such units before anything else, so a text's
    ids are its units' ids in order.  Units are told apart by 64-bit hashes over
    a whole chunk of texts at once; those not met before are tokenised in one
    call, whose ids are told apart by the tokens that end a unit.  Texts with
    characters for which the cut is less simple (apostrophes, control
    characters, letters beyond Latin, special tokens) go to the tokenizer whole,
    sentence by sentence.
    """

    KIND = np.full(256, 2, dtype=np.uint8)
    KIND[128:] = 1
    for _c in b"abcdefghijklmnopqrstuvwxyz":
        KIND[_c] = 1
    for _c in b"0123456789":
        KIND[_c] = 3
    for _c in b" \t\n\r\v\f":
        KIND[_c] = 0
    HARD = np.zeros(256, dtype=bool)
    HARD[0xCA:] = HARD[0xC2] = HARD[0x27] = HARD[0x7F] = True
    HARD[:9] = HARD[14:32] = True

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; more threads would each keep memory
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)  # ascending; arrays, since a dictionary takes ten times their memory
        self.number = np.zeros(0, dtype=np.int32)  # the unit of each of them
        self.pool = np.zeros(1 << 16, dtype="<u4")
        self.first = np.zeros(1 << 16, dtype=np.int64)  # unit k has pool[first[k]:first[k + 1]]

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """The units of hashes, -1 for those not met before."""
        if not len(self.known):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.number[at], -1).astype(np.int64)

    def learn(self, hashes: np.ndarray, units: list[str]) -> None:
        n = len(self.known)
        for k in range(0, len(units), LEARN_UNITS):
            self._tokenise(n + k, units[k : k + LEARN_UNITS])
        order = np.argsort(hashes)
        into = np.searchsorted(self.known, hashes[order])
        self.known = np.insert(self.known, into, hashes[order])
        self.number = np.insert(self.number, into, n + order)

    def _tokenise(self, n: int, units: list[str]) -> None:
        """Ids of the units ``n`` and following."""
        ids = np.array(self.tokenizer.encode(" ".join(units), add_special_tokens=False).ids, dtype="<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(units):
            raise ValueError("the tokenizer joins or splits units in another way")
        used = int(self.first[n])
        while used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while n + len(units) + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        self.pool[used : used + len(ids)] = ids
        self.first[n + 1 : n + 1 + len(units)] = used + stops

    def whole(self, text: str) -> tuple[bytes, list[int]]:
        parts = [e.ids for e in self.tokenizer.encode_batch(SENTENCE.split(text), add_special_tokens=False)]
        return np.array([x for p in parts for x in p], dtype="<u4").tobytes(), [len(p) for p in parts]

    def encode(self, texts: list[str]) -> list[tuple[bytes, list[int]]]:
        """For each text: ids as bytes, and the token counts of its sentences."""
        if len(self.known) > CACHE_UNITS:
            self.forget()
        low = [t.lower().encode() for t in texts]
        b = np.frombuffer(b"\n".join(low) + b"\n", dtype=np.uint8)
        bounds = np.concatenate([[0], np.cumsum(np.fromiter((len(t) + 1 for t in low), np.int64, len(low)))])
        odd = self.HARD[b]
        odd[1:] |= (b[:-1] == 0xC3) & ((b[1:] == 0x97) | (b[1:] == 0xB7)) | (b[:-1] == 0x3C) & (b[1:] == 0x7C)
        hard = np.unique(np.searchsorted(bounds, np.flatnonzero(odd), side="right") - 1).tolist()

        kind = self.KIND[b]
        new = np.ones(len(b) + 1, dtype=bool)
        new[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 3)
        start = np.flatnonzero(new[:-1] & (kind > 0))
        end = np.flatnonzero(new[1:] & (kind > 0)) + 1
        if len(start):
            at = np.arange(start[0], len(b)) - np.repeat(start, np.diff(start, append=len(b)))
            terms = BYTE[b[start[0] :]] * place(int(at.max()) + 1)[at]
            terms[kind[start[0] :] == 0] = 0
            hashes, one, which = np.unique(mix(np.add.reduceat(terms, start - start[0])), return_index=True, return_inverse=True)
        else:
            hashes, one, which = np.zeros(0, np.uint64), start, start
        found = self.look_up(hashes)
        if len(missing := np.flatnonzero(found < 0)):
            k = one[missing]
            inside = np.searchsorted(bounds, start[k], side="right") - 1
            easy = ~np.isin(inside, hard)
            joined = b.tobytes()
            here, k = missing[easy], k[easy]
            if len(here):
                n = len(self.known)
                self.learn(hashes[here], [joined[x:y].decode() for x, y in zip(start[k].tolist(), end[k].tolist(), strict=True)])
                found[here] = np.arange(n, n + len(here))
        unit = found[which]
        if hard:
            owner = np.searchsorted(bounds, start, side="right") - 1
            again = np.flatnonzero((unit < 0) & ~np.isin(owner, hard))
            if len(again):  # first met in a text that goes whole
                seen = {}
                joined = b.tobytes()
                for i in again.tolist():
                    seen.setdefault(int(hashes[which[i]]), joined[start[i] : end[i]].decode())
                self.learn(np.fromiter(seen, np.uint64, len(seen)), list(seen.values()))
                unit[again] = self.look_up(hashes[which[again]])
            unit[unit < 0] = 0
        size = np.diff(self.first)[unit] if len(unit) else unit
        upto = np.concatenate([[0], np.cumsum(size)])
        flat = self.pool[np.repeat(self.first[unit] - upto[:-1], size) + np.arange(upto[-1])] if len(unit) else self.pool[:0]
        after, last = b[end % len(b)], b[end - 1]
        stop = (after == 0x0A) | (after == 0x20) & ((last == 0x2E) | (last == 0x21) | (last == 0x3F))
        unit_bounds = np.searchsorted(start, bounds)
        stops = np.flatnonzero(stop)
        stop_bounds = np.searchsorted(stops, unit_bounds)
        out, hard_set = [], set(hard)
        for t in range(len(texts)):
            if t in hard_set:
                out.append(self.whole(texts[t]))
                continue
            x, y = upto[unit_bounds[t]], upto[unit_bounds[t + 1]]
            places = upto[stops[stop_bounds[t] : stop_bounds[t + 1]] + 1]
            out.append((flat[x:y].tobytes(), np.diff(places, prepend=x, append=y).tolist()))
        return out


@lru_cache(maxsize=1)
def units_of(path: str) -> Units:
    """The units known to this worker process, kept from task to task."""
    return Units(path)


def cut_points(sentences: list[int]) -> tuple[list[int], list[int]]:
    """Token offsets after which one may cut within a document, and their penalties; the last is the document's end (with the end token)."""
    pos, pen, p = [], [], 0
    for n in sentences:
        if n > LONG_SENTENCE:
            pos += range(p + FORCED_STEP, p + n - 1, FORCED_STEP)
            pen += [FORCED_PENALTY] * (len(pos) - len(pen))
        if n:
            p += n
            pos.append(p)
            pen.append(SENTENCE_PENALTY)
    if pos:
        pos[-1], pen[-1] = p + 1, 0
    else:
        pos, pen = [1], [0]
    return pos, pen


def pack_documents(docs: DataFrame, tokenizer_path: str, eos_id: int = 2, window: int = 4096) -> DataFrame:
    """A row for each piece of a document in a window (columns of ``PIECES``); see the module's text."""
    end = int(eos_id).to_bytes(4, "little")

    def pack_block(block: list[tuple[int, bytes, list[int]]], first_sequence: int) -> tuple[dict[str, list], int]:
        pos, pen, base = [], [], 0
        for _, ids, sentences in block:
            p, q = cut_points(sentences)
            pos += [base + x for x in p]
            pen += q
            base += len(ids) // 4
        out: dict[str, list] = {k.split()[0]: [] for k in PIECES.split(", ")}
        cuts, begin, k, base = plan_cuts(pos, pen, window), 0, 0, 0
        for doc_id, ids, _ in block:
            n, at = len(ids) // 4, 0
            while at < n:
                stop = min(n, cuts[k] - base)
                row = (doc_id, at, stop - at, zlib.crc32(ids[4 * at : 4 * stop]), n, first_sequence + k, base + at - begin)
                for c, v in zip(out.values(), row, strict=True):
                    c.append(v)
                at = stop
                if base + at == cuts[k]:
                    begin, k = cuts[k], k + 1
            base += n
        return out, first_sequence + len(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        give_back()
        tokens, block, size, done = units_of(tokenizer_path), [], 0, 0
        sequence = TaskContext.get().partitionId() << 40
        schema = pa.schema([(k.split()[0], pa.int64()) for k in PIECES.split(", ")])

        def rows(out: dict[str, list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], schema=schema)

        for batch in batches:
            ids_column, text_column = batch.columns
            for a, z in spans(text_column, ENCODE_BYTES):
                texts = text_column[a:z].to_pylist()
                for doc_id, (ids, sentences) in zip(ids_column[a:z].to_pylist(), tokens.encode(texts), strict=True):
                    block.append((doc_id, ids + end, sentences))
                    size += len(ids) // 4 + 1
                    if size >= BLOCK_TOKENS:
                        out, sequence = pack_block(block, sequence)
                        block, size = [], 0
                        yield rows(out)
                        give_back()
                done += 1
                if done % TRIM_EVERY == 0:
                    give_back()
        if block:
            yield rows(pack_block(block, sequence)[0])

    told = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return told.sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(tidy(run), PIECES)
