"""Toxicity: noisy-channel deobfuscation, then a learned lexicon scores the restored text.

Three models, all fitted here:

* a character language model, trigrams of letters counted over every document;
* a channel: a written character stands for letters it resembles (1 for i or l,
  @ for a), marks and spaces may be insertions or set words apart, and a repeated
  letter may stand for one;
* a lexicon of words and word beginnings that labelled toxic documents hold far
  more often than clean ones, fitted on a bounded sample of labelled rows
  (``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN``), near copies counted once.

A token that looks disguised becomes a lattice of letters, of which Viterbi
search under the language model keeps the ``BEST`` likeliest readings, of one or
several words, each of which is looked up.  Neighbouring words that together are
an entry of the lexicon count as that word if the likeliest reading joins them.  The
score of a text is 1 - (1 - base) x product over its lexicon entries of
(1 - their precision); a text without any has the base rate.

Plain words are matched by vectorised hashes; only disguised tokens are decoded
one by one, each distinct one once a worker.  The models are bounded: the
trigram table by the alphabet, the lexicon by ``LEXICON_SIZE``.

Defined results: null and empty texts get the base score; texts of any length
are read whole; repeated rows, and several texts under one id, are scored each; a
row without an id is scored and never held out; labels without an id or without
a value are passed over; without labels of both kinds the
lexicon is empty and every text gets the base score; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import materialise
from cartulary.llm.wordhash import BYTE, NOT_WORD, ROLL, SPACE, Words, mix, place, spans

#: At most so many labelled rows of each kind are fitted on, chosen by a hash of their ids.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2500, 5000
LEXICON_SIZE = 4000
#: Lexicon entries are whole words and their first so many bytes.
PREFIXES = (4, 5, 6)
#: A log-likelihood ratio that a chance entry doesn't reach, and the least precision of an entry.
LEAST_RATIO, LEAST_PRECISION = 24.0, 0.8
BASE_SCORE = 0.02
#: Labelled rows count as copies of one another if in so many random orders the same run of so many words comes first.
ALIKE, ALIKE_WORDS = 4, 5
BEST = 6
#: Letters of a window in which a long token is decoded, at least; tokens up to so many characters are remembered.
LEAST_WINDOW, REMEMBERED = 64, 128
THRESHOLD = 0.3

#: What a written character may stand for; None: nothing.
CHANNEL = {
    "0": ("o",), "1": ("i", "l"), "2": ("z",), "3": ("e",), "4": ("a",), "5": ("s",), "6": ("g", "b"), "7": ("t",), "8": ("b",), "9": ("g",),
    "@": ("a",), "$": ("s",), "!": ("i", "l"), "|": ("l", "i"), "+": ("t",), "(": ("c",), "€": ("e",), "£": ("l",),
    "*": (None, "a", "e", "i", "o", "u"), "#": (None, "a", "e", "i", "o", "u"), "%": (None,),
    ".": (None,), "-": (None,), "_": (None,), "~": (None,), "^": (None,), "'": (None,), ",": (None,), "/": (None,), "\\": (None,), "=": (None,), ":": (None,), "​": (None,), "‌": (None,), "‍": (None,), "­": (None,),
}
#: Log costs: a character that stands for another letter, an inserted mark, a repetition read as one letter.
SUBSTITUTED, INSERTED, REPEATED, KEPT_REPEAT = -1.0, -0.7, -0.5, -3.0
#: Log cost of a mark or space that sets words apart.
APART = 0.0

#: A letter set apart from itself more than once, read as written twice.
AGAIN = re.compile(r"([^\W\d_])([\W_])(?:\1\2)+\1")

ALPHABET = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýßœ"
CODES = len(ALPHABET) + 1

_letter = np.zeros(256, dtype=bool)
_letter[128:] = True
_letter[[*b"abcdefghijklmnopqrstuvwxyz"]] = True
_mark = np.zeros(256, dtype=bool)
_mark[[*b"0123456789@$!|+(*#%.-_~^=:/\\"]] = True
_digit_like = np.zeros(256, dtype=bool)
_digit_like[[*b"0123456789@$!|+(*#"]] = True

TABLE = np.zeros(0x250, dtype=np.uint8)
for _k, _c in enumerate(ALPHABET):
    TABLE[ord(_c)] = _k + 1


def letter_codes(text: str) -> np.ndarray:
    """Codes of the characters; 0 for whatever isn't in the alphabet."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    return TABLE[np.where(points < len(TABLE), points, 0)]


def count_trigrams(docs: DataFrame) -> DataFrame:
    """(gram, n): letter trigrams of all texts, words being set apart by a 0; summed in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES**3, dtype=np.int64)
        for batch in batches:
            for a, z in spans(batch.column(0), 500_000):
                c = letter_codes(" " + " ".join(batch.column(0)[a:z].to_pylist()).lower() + " ").astype(np.int32)
                c = c[np.concatenate([[True], (c[1:] > 0) | (c[:-1] > 0)])]
                total += np.bincount((c[:-2] * CODES + c[1:-1]) * CODES + c[2:], minlength=CODES**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["gram", "n"])

    parts = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "gram bigint, n bigint")
    return parts.groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame) -> np.ndarray:
    """log P(third | first two), as an array [CODES, CODES, CODES]; no more rows than the alphabet has trigrams reach the driver."""
    counts = np.zeros(CODES**3)
    for r in count_trigrams(docs).toLocalIterator():
        counts[r.gram] = r.n
    counts = counts.reshape(CODES, CODES, CODES)
    two = counts.sum(axis=0)
    pairs = (two + 0.5) / (two + 0.5).sum(axis=1, keepdims=True)
    return np.log((counts + 5 * pairs[None, :, :]) / (counts.sum(axis=2, keepdims=True) + 5))


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of equal characters: the letters it may stand for ('' for none) and their costs."""
    token, out, i, last = AGAIN.sub(r"\1\2\1", token), [], 0, ""
    while i < len(token):
        j = i
        while j < len(token) and token[j] == token[i]:
            j += 1
        c, n = token[i], j - i
        if c == " ":
            options = [("", INSERTED), (" ", APART)]
        elif c in CHANNEL:
            options = [("", INSERTED) if x is None else (x, SUBSTITUTED) for x in CHANNEL[c]]
            if None in CHANNEL[c]:
                options.append((" ", APART))
            if n > 1:
                options += [(x * 2, 2 * SUBSTITUTED) for x in CHANNEL[c] if x]
        elif c.isalpha():
            options = [(c, 0.0)] if n == 1 else [(c, REPEATED), (c * 2, 0.0 if n == 2 else REPEATED)]
            if n == 2:
                options[0] = (c, KEPT_REPEAT)
            if c not in ALPHABET:
                plain = unicodedata.normalize("NFKD", c)[0].lower()
                if plain in ALPHABET:
                    options.append((plain, SUBSTITUTED))
        else:
            options = [("", INSERTED), (" ", APART)]
        if any(x.strip() for x, _ in options):
            if c == last:  # the same letter again after a mark or space
                options.append(("", REPEATED))
            last = c
        out.append(options)
        i = j
    return out


def readings(token: str, model: np.ndarray) -> list[str]:
    """The ``BEST`` likeliest letter strings of a written token."""
    return search(lattice(token), model)


def token_entries(token: str, model: np.ndarray, longest: int = 0, best: int = BEST) -> set[str]:
    """What the lexicon may hold of the words of the ``best`` readings of a token of any length.

    A long one is read in windows that overlap by half, more than ``longest`` letters; a word that
    a window's edge cuts is whole in the window beside it, or longer than any entry, so that only its beginning counts.
    """
    steps = lattice(token)
    letters = [i for i, options in enumerate(steps) if any(x.strip() for x, _ in options) and ("", REPEATED) not in options]
    half = max(LEAST_WINDOW // 2, longest + 1)
    out: set[str] = set()
    for begin in range(0, max(1, len(letters) - half), half):
        opened, closed = begin == 0, begin + 2 * half >= len(letters)
        part = steps[0 if opened else letters[begin] : None if closed else letters[begin + 2 * half]]
        for reading in search(part, model)[:best]:
            held = reading.split()
            for n, w in enumerate(held):
                if n or opened:
                    out.update(entries(w)[n == len(held) - 1 and not closed :])
    return out


def search(steps: list[list[tuple[str, float]]], model: np.ndarray) -> list[str]:
    """The ``BEST`` likeliest strings of a lattice, by Viterbi search over (last two letters), several paths a state."""
    paths: dict[tuple[int, int], list[tuple[float, str]]] = {(0, 0): [(0.0, "")]}
    for options in steps:
        after: dict[tuple[int, int], list[tuple[float, str]]] = {}
        for (x, y), held in paths.items():
            for letters, cost in options:
                a, b, more = x, y, cost
                for c in letters:
                    k = int(TABLE[ord(c)]) if ord(c) < len(TABLE) else 0
                    more += model[a, b, k]
                    a, b = b, k
                after.setdefault((a, b), []).extend((s + more, text + letters) for s, text in held)
        paths = {k: sorted(v, reverse=True)[:BEST] for k, v in after.items()}
    ended = sorted(((s + model[x, y, 0], text) for (x, y), held in paths.items() for s, text in held), reverse=True)
    return list(dict.fromkeys(t for _, t in ended if t))[:BEST]


def joined_words(words: Words, hashes: np.ndarray, longest: int) -> Iterator[tuple[int, int]]:
    """(first word, how many) of neighbouring words, a byte apart, that together are one of the words of sorted ``hashes``, of ``longest`` bytes at most."""
    size = words.end - words.start
    if not len(size) or not len(hashes):
        return
    apart = np.concatenate([words.start[1:] - words.end[:-1], [2]])
    last_of_text = np.concatenate([words.text[1:] != words.text[:-1], [True]])
    linked = (apart == 1) & ~last_of_text
    mult = place(longest + 1)

    def terms(which: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Sums of the hash terms of words that begin ``shift`` bytes into a joined word."""
        n = size[which]
        begin = np.concatenate([[0], np.cumsum(n)[:-1]])
        at = np.arange(int(n.sum())) - np.repeat(begin, n)
        return np.add.reduceat(BYTE[words.bytes[np.repeat(words.start[which], n) + at]] * mult[np.repeat(shift, n) + at], begin)

    first = np.flatnonzero(linked & (size < longest))
    total, k = size[first], 1
    sums = terms(first, np.zeros(len(first), np.int64)) if len(first) else None
    while len(first):
        keep = linked[first + k - 1]
        first, total, sums = first[keep], total[keep], sums[keep]
        keep = total + size[first + k] <= longest
        first, total, sums = first[keep], total[keep], sums[keep]
        if not len(first):
            return
        sums = sums + terms(first + k, total)
        total, k = total + size[first + k], k + 1
        h = mix(sums)
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        yield from ((int(i), k) for i in first[hashes[at] == h])


def disguised(words: Words, texts: list[bytes]) -> list[tuple[int, str]]:
    """(text, token) for tokens that mix letters with marks or digits or repeat letters, and for runs of single letters."""
    b, found = words.bytes, []
    if not len(words.start):
        return found
    letter, like = _letter[b], _digit_like[b]
    flag = np.zeros(len(b), dtype=bool)
    flag[:-1] = like[:-1] & letter[1:]
    flag[:-1] |= letter[:-1] & like[1:] & (np.concatenate([letter[2:], [False]]) | np.concatenate([_mark[b][2:] & _mark[b][1:-1], [False]]))
    inner = letter[:-2] & _mark[b][1:-1] & letter[2:]
    flag[:-2] |= inner
    flag[:-2] |= letter[:-2] & (b[:-2] == b[1:-1]) & (b[1:-1] == b[2:]) & (b[:-2] < 128)
    hit = np.add.reduceat(flag, words.start) > 0
    for k in np.flatnonzero(hit).tolist():
        s, e = int(words.start[k]), int(words.end[k])
        found.append((int(words.text[k]), b[s:e].tobytes().decode(errors="replace")))
    single = (words.end - words.start <= 2) & (letter[words.start] | _digit_like[b[words.start]]) & ((words.end - words.start == 1) | (b[words.start] >= 0xC3))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], single, [False]]).astype(np.int8)))
    for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        for t in range(int(words.text[i]), int(words.text[j - 1]) + 1):
            x, y = max(i, int(words.bounds[t])), min(j, int(words.bounds[t + 1]))
            if 3 <= y - x:
                found.append((t, " ".join(b[words.start[k] : words.end[k]].tobytes().decode(errors="replace") for k in range(x, y))))
    return found


def entries(word: str) -> list[str]:
    """What the lexicon may hold of a word: the word, and its beginnings with a ``~``."""
    w = word.encode()
    return [word, *(w[:n].decode(errors="ignore") + "~" for n in PREFIXES if len(w) > n)]


def alike_keys(words: Words, texts: int) -> list[int]:
    """A hash of each text that near copies share: of the least of its runs' hashes in ``ALIKE`` orders; of all its words, if they are fewer than a run."""
    runs, at = words.grams(ALIKE_WORDS)
    bounds = np.searchsorted(words.text[at], np.arange(texts + 1)) if len(at) else np.zeros(texts + 1, np.int64)
    out = []
    for t in range(texts):
        some = runs[bounds[t] : bounds[t + 1]]
        if len(some):
            least = np.array([mix(some ^ ROLL[k]).min() for k in range(ALIKE)])
        else:
            least = words.hash[words.bounds[t] : words.bounds[t + 1]]
        out.append(int(mix((least * ROLL[: len(least)]).sum(keepdims=True))[0].view(np.int64)))
    return out


def fit_lexicon(docs: DataFrame, labels: DataFrame, model: np.ndarray) -> dict[str, float]:
    """Entry to precision, from a bounded sample of the labelled rows outside the held-out fold."""
    open_rows = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2).where("doc_id is not null and toxic is not null")
    totals = {bool(r.t): r.n for r in open_rows.groupBy((F.col("toxic") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    if not totals.get(True) or not totals.get(False):
        return {}
    told = open_rows.select("doc_id", (F.col("toxic") > 0).alias("toxic")).distinct()
    picked = [told.where(c).orderBy(F.xxhash64("doc_id")).limit(n) for c, n in (("toxic", SAMPLE_TOXIC), ("not toxic", SAMPLE_CLEAN))]
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked[0].union(picked[1])), "doc_id").select("toxic", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, column = batch.columns
            for a, z in spans(column):
                low = [t.lower().encode() for t in column[a:z].to_pylist()]
                words = Words(low, NOT_WORD)
                alike, held = alike_keys(words, len(low)), []
                for t in range(len(low)):
                    s, e = words.start[words.bounds[t] : words.bounds[t + 1]], words.end[words.bounds[t] : words.bounds[t + 1]]
                    held.append({f for w in {words.bytes[x:y].tobytes().decode(errors="ignore") for x, y in zip(s, e, strict=True)} if len(w) > 2 for f in entries(w)})
                for t, token in disguised(Words(low, SPACE), low):
                    held[t].update(token_entries(token, model, best=1))
                names = ["toxic", "alike", "held"]
                yield pa.RecordBatch.from_arrays([toxic[a:z], pa.array(alike, pa.int64()), pa.array([sorted(x) for x in held], pa.list_(pa.string()))], names=names)

    rows = materialise(sample.mapInArrow(features, "toxic boolean, alike bigint, held array<string>"), "labelled").dropDuplicates(["toxic", "alike"])
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    nt, nc = sizes.get(True, 0), sizes.get(False, 0)
    if not nt or not nc:
        return {}
    q = nt / (nt + nc)
    clean_weight = totals[False] / nc * nt / totals[True]
    t, c = F.col("t"), F.col("c")
    log = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
    counted = rows.select("toxic", F.explode("held").alias("entry")).groupBy("entry").agg(F.sum(F.col("toxic").cast("int")).cast("double").alias("t"), F.sum((~F.col("toxic")).cast("int")).cast("double").alias("c"))
    judged = counted.select("entry", "t", (t / (t + clean_weight * c + 0.5)).alias("p"), (2 * (log(t, (t + c) * q) + log(c, (t + c) * (1 - q)))).alias("g"))
    best = judged.where((F.col("g") >= LEAST_RATIO) & (F.col("p") >= LEAST_PRECISION)).orderBy(F.desc("g"), "entry").limit(LEXICON_SIZE)
    return {r.entry: r.p for r in best.collect()}


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``; see the module's text."""
    model = language_model(docs)
    lexicon = fit_lexicon(docs, labels, model)

    def table(some: dict[str, float]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        keys = sorted(some)
        h = Words([k.encode() for k in keys], SPACE).hash if keys else np.zeros(0, np.uint64)
        order = np.argsort(h)
        return h[order], np.array([some[k] for k in keys])[order], [keys[k] for k in order]

    whole = table({k: p for k, p in lexicon.items() if not k.endswith("~")})
    begun = {n: table({k[:-1]: p for k, p in lexicon.items() if k.endswith("~") and len(k[:-1].encode()) == n}) for n in (3, *PREFIXES)}
    longest = max((len(k.encode()) for k in whole[2]), default=0)
    memory: dict[str, tuple[tuple[str, float], ...]] = {}

    def decoded(token: str) -> tuple[tuple[str, float], ...]:
        if token in memory:
            return memory[token]
        out = tuple((f, lexicon[f]) for f in sorted(token_entries(token, model, longest)) if f in lexicon)
        if len(token) <= REMEMBERED:
            if len(memory) > 200_000:
                memory.clear()
            memory[token] = out
        return out

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.columns
            for a, z in spans(column, 1_000_000):
                low = [t.lower().encode() for t in column[a:z].to_pylist()]
                found: list[dict[str, float]] = [{} for _ in low]
                words = Words(low, NOT_WORD)
                size = words.end - words.start
                for n, (keys, p, names) in [(0, whole), *begun.items()]:
                    if not len(keys):
                        continue
                    h = words.prefix_hashes(n) if n else words.hash
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    for k in np.flatnonzero((keys[at] == h) & (size > n)).tolist():
                        found[words.text[k]][names[at[k]] + ("~" if n else "")] = p[at[k]]
                for k, n in joined_words(words, whole[0], longest):
                    pieces = [words.bytes[words.start[i] : words.end[i]].tobytes().decode(errors="replace") for i in range(k, k + n)]
                    word = "".join(pieces)
                    if word in lexicon and readings(" ".join(pieces), model)[:1] == [word]:
                        found[words.text[k]][word] = lexicon[word]
                for t, token in disguised(Words(low, SPACE), low):
                    found[t].update(decoded(token))
                scores = [1 - (1 - BASE_SCORE) * math.prod(1 - p for p in f.values()) for f in found]
                yield pa.RecordBatch.from_arrays([ids[a:z], pa.array(scores, pa.float64())], names=["doc_id", "score"])

    told = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    scored = told.mapInArrow(score, "doc_id bigint, score double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
