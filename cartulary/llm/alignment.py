"""Local alignment of word hashes in a band of diagonals, two rows at a time (numpy, used inside tasks)."""

from __future__ import annotations

import numpy as np


def align(a: np.ndarray, b: np.ndarray, low: int | None = None, high: int | None = None, match: int = 2, mismatch: int = -1, gap: int = -1) -> tuple[int, int, int, int]:
    """(score, matches, first, last place in ``b``) of the best local (Smith-Waterman) alignment of ``a`` and ``b``.

    Only places j of ``b`` with low <= j - i <= high are set beside place i of ``a``; all, without
    bounds.  Memory grows with the band, not with the product of the lengths.  (0, 0, 0, -1) if nothing matches.
    """
    low = 1 - len(a) if low is None else low
    high = len(b) - 1 if high is None else high
    low, high = max(low, 1 - len(a)), min(high, len(b) - 1)
    if low > high:
        return 0, 0, 0, -1
    width = high - low + 1
    # what stands beside a[i] is padded[i : i + width]; places outside b match nothing
    places = np.arange(low, high + len(a))
    inside = (places >= 0) & (places < len(b))
    padded = b[np.clip(places, 0, len(b) - 1)]
    steps = -gap * np.arange(width)
    order = np.arange(width)
    score, begun, same = np.zeros(width + 1, np.int64), np.zeros(width + 1, np.int64), np.zeros(width + 1, np.int64)
    best = (0, 0, 0, -1)
    for i in range(len(a)):
        hit = (padded[i : i + width] == a[i]) & inside[i : i + width]
        diagonal = score[:width] + np.where(hit, match, mismatch)
        above = score[1:] + gap
        take = diagonal >= above
        row = np.maximum(np.where(take, diagonal, above), 0)
        going = score[:width] > 0
        start = np.where(take, np.where(going, begun[:width], places[i : i + width]), begun[1:])
        count = np.where(take, np.where(going, same[:width], 0) + hit, same[1:])
        shifted = row + steps
        most = np.maximum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == most, order, 0))
        score[:width] = most - steps
        begun[:width], same[:width] = start[source], count[source]
        c = int(score[:width].argmax())
        if score[c] > best[0]:
            best = (int(score[c]), int(same[c]), int(begun[c]), int(places[i + c]))
    return best
