"""Sets of word shingles of whole texts, hashed in NumPy."""

from __future__ import annotations

import numpy as np

from terrafold.llm.common import POWERS, mixed

#: Words in a shingle.
WORDS = 5
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: White space: blank and the characters 9 to 13.
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
#: One odd factor for each place in a shingle.
PLACE = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64) | 1 for i in range(1, WORDS + 1)], np.uint64)


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a chunk, and where each document's words start and end."""
    inside = ~BLANK[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1 : len(raw)]
    begin = np.flatnonzero(starts)
    over = np.ones(len(raw) + 1, bool)  # a word may end before this place
    over[:-1] = ~inside | first[:-1]
    ends = np.flatnonzero(over[1:] & inside) + 1
    hashes = mixed(POWERS.between(POWERS.prefix(LOWER[raw]), begin, ends))
    return hashes, np.searchsorted(begin, offsets)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document; all words if fewer than five."""
    hashes, at = words(raw, offsets)
    n = len(hashes) - WORDS + 1
    if n > 0:
        total = np.zeros(n, np.uint64)
        for j in range(WORDS):
            total += hashes[j : j + n] * PLACE[j]
        total = mixed(total)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= WORDS:
            out.append(np.unique(total[a : b - WORDS + 1]))
        elif b > a:
            few = (hashes[a:b] * PLACE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mixed(np.array([few], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sets_of(texts: list[bytes]) -> list[np.ndarray]:
    """Shingle sets of single texts."""
    offsets = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    return shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offsets)
