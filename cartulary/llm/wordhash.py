"""Vectorised 64-bit hashes of the words of many texts at once (numpy, used inside tasks)."""

from __future__ import annotations

import numpy as np

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_place = _rng.integers(0, 2**63, 4096, dtype=np.uint64) * U(2) + U(1)
ROLL = _rng.integers(0, 2**63, 64, dtype=np.uint64) * U(2) + U(1)

#: The separators of the word pattern [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: For words of letters and digits: every other ASCII byte separates; bytes above ASCII belong to words.
NOT_WORD = np.ones(256, dtype=bool)
NOT_WORD[128:] = False
for _c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789":
    NOT_WORD[_c] = False


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads all bits."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def place(n: int) -> np.ndarray:
    """Multipliers by byte position in a word, made longer where a word needs it."""
    global _place
    while len(_place) < n:
        rng = np.random.Generator(np.random.PCG64(len(_place)))
        _place = np.concatenate([_place, rng.integers(0, 2**63, len(_place), dtype=np.uint64) * U(2) + U(1)])
    return _place


class Words:
    """Words of a list of byte strings: hash, first byte, end byte and text number of each word."""

    def __init__(self, texts: list[bytes], separator: np.ndarray = SPACE):
        joined = b"\n".join(texts) + b"\n"
        b = self.bytes = np.frombuffer(joined, dtype=np.uint8)
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_start = np.concatenate([[0], np.cumsum(lengths)])
        word = ~separator[b]
        edge = np.diff(word.view(np.int8), prepend=np.int8(0))
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.text = np.searchsorted(self.text_start, self.start, side="right") - 1
        self.bounds = np.searchsorted(self.start, self.text_start)  # words of text i: bounds[i]:bounds[i+1]
        self._word = word
        self.hash = self._hashes()

    def _hashes(self, longest: int | None = None) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        b, word = self.bytes, self._word
        first = self.start[0]
        at = np.arange(first, len(b)) - np.repeat(self.start, np.diff(self.start, append=len(b)))
        mult = place(int(at.max()) + 1)
        terms = BYTE[b[first:]] * mult[at]
        terms[~word[first:]] = 0
        if longest:
            terms[at >= longest] = 0
        return mix(np.add.reduceat(terms, self.start - first))

    def prefix_hashes(self, n: int) -> np.ndarray:
        """Hashes of the first ``n`` bytes of each word."""
        return self._hashes(n)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first word) of every run of ``n`` words within one text, in order."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        h = np.zeros(m, dtype=np.uint64)
        for k in range(n):
            h += self.hash[k : k + m] * ROLL[k]
        at = np.flatnonzero(self.text[:m] == self.text[n - 1 :])
        return mix(h[at]), at


def spans(column, limit: int = 500_000):
    """Slices (first, last) of an Arrow string column of about ``limit`` bytes, one text at least."""
    import pyarrow.compute as pc

    first, size = 0, 0
    for i, n in enumerate(pc.binary_length(column).to_pylist()):
        n = n or 0
        if size and size + n > limit:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(column):
        yield first, len(column)
