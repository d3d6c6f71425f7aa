"""The public pre-token pattern of byte-level BPE, cut for whole batches with NumPy.

``public_tokenizers.PATTERN`` sees runs of letters, digits, white space and other characters,
lets one blank join the run after it, and splits off English contractions. Here the runs of
a batch are found at once from a table of character classes; ``starts`` is tested against
the pattern itself over every code point.
"""

from __future__ import annotations

import functools

import numpy as np
import regex

from terrafold.llm.common import POWERS

LETTER, DIGIT, SPACE, OTHER = range(4)


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point, as the pattern's own engine sees it."""
    points = np.r_[0:0xD800, 0xE000:0x110000].astype(np.uint32)
    text = points.astype("<u4").tobytes().decode("utf-32-le")
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, text):
            table[points[m.start() : m.end()]] = kind
    return table


def starts(points: np.ndarray, kinds: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, given code points, their classes and the documents' starts."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n + 3, bool)
    new[documents] = True
    new[n:] = True
    run = np.ones(n + 1, bool)
    run[1:n] = kinds[1:] != kinds[:-1]
    run |= new[: n + 1]
    start = run.copy()
    # The last character of white space before something else stands alone or, a blank, joins it.
    after = np.flatnonzero(run[1:n] & (kinds[: n - 1] == SPACE) & ~new[1:n]) + 1
    start[after - 1] = True
    start[after[points[after - 1] == 32]] = False
    quote = np.flatnonzero(points[: n - 1] == 39)
    quote = quote[start[quote] & ~new[quote + 1]]
    quote = quote[kinds[quote + 1] == LETTER]
    if len(quote):
        first = points[quote + 1]
        second = np.where(new[quote + 2], 0, points[np.minimum(quote + 2, n - 1)])
        one = np.isin(first, [ord(c) for c in "stmd"])
        two = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
        for chosen, length in ((quote[one], 2), (quote[two], 3)):
            start[chosen + 1] = False
            rest = chosen + length
            rest = rest[~new[rest]]
            start[rest[kinds[rest] == LETTER]] = True
    return np.flatnonzero(start[:n])


class Pieces:
    """Pre-tokens of a chunk of documents: their byte ranges and the distinct ones."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        """``raw``: the chunk's bytes, ``offsets``: each document's range in it, from 0."""
        self.raw = raw
        table = classes()
        if not len(raw) or int(raw.max()) < 128:
            begin = starts(raw, table[raw], offsets[:-1][offsets[:-1] < len(raw)])
        else:
            points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
            at = np.flatnonzero((raw & 0xC0) != 0x80)  # where each code point's bytes start
            begins = offsets[:-1][offsets[:-1] < len(raw)]
            begin = at[starts(points, table[points], np.searchsorted(at, begins))]
        self.begin = begin
        self.end = np.append(begin[1:], len(raw)) if len(begin) else begin
        #: Of each document, the first of its pre-tokens, and the end.
        self.first = np.searchsorted(begin, offsets)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Index of one pre-token of each distinct kind, and each pre-token's kind."""
        begin, end = self.begin, self.end
        if not len(begin):
            return begin, begin
        keys = POWERS.between(POWERS.prefix(self.raw), begin, end)
        _, chosen, kind = np.unique(keys, return_index=True, return_inverse=True)
        length, same = end - begin, chosen[kind]
        padded = np.concatenate([np.zeros(8, np.uint8), self.raw, np.zeros(8, np.uint8)])
        words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        short = np.minimum(length, 8).astype(np.uint64)
        mask = ~np.uint64(0) >> ((np.uint64(8) - short) * np.uint64(8))
        head = words[begin + 8] & mask
        tail = words[end] & ~(~np.uint64(0) >> (short * np.uint64(8) - np.uint64(1)) >> np.uint64(1))
        if (length != length[same]).any() or (head != head[same]).any() or (tail != tail[same]).any():
            seen: dict[bytes, int] = {}  # two kinds with one hash
            kind = np.array([seen.setdefault(self.piece(i), len(seen)) for i in range(len(begin))])
            chosen = np.unique(kind, return_index=True)[1]
        return chosen, kind

    def piece(self, i: int) -> bytes:
        return self.raw[self.begin[i] : self.end[i]].tobytes()


def flat_ids(pieces: Pieces, encode) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a whole chunk, and where each document's ids start and the last end.

    ``encode`` gives the ids of distinct pre-tokens, each as little-endian 32-bit numbers.
    """
    chosen, kind = pieces.distinct()
    if not len(chosen):
        return np.zeros(0, np.uint32), np.zeros(len(pieces.first), np.int64)
    raw = pieces.raw.tobytes()
    found = encode([raw[b:e] for b, e in zip(pieces.begin[chosen].tolist(), pieces.end[chosen].tolist(), strict=True)])
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    pool = np.frombuffer(b"".join(found), "<u4")
    at = np.cumsum(sizes) - sizes
    count = sizes[kind]
    stop = np.cumsum(count)
    ids = pool[np.arange(stop[-1]) + np.repeat(at[kind] - (stop - count), count)]
    return ids, np.append(0, stop)[pieces.first]
