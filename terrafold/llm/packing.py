"""Packing by minimum bin slack over the multiset of remaining lengths.

A document's ids are cut every ``size`` ids; whole pieces are sequences of their own. What
remains of each document is one of ``size - 1`` lengths, so the multiset of remaining
lengths is a short histogram at any corpus size. The driver fills windows from it: the
largest length left and, by subset sums over a bitset, the lengths that come closest to
the capacity; backtracking gives how many of each, and the window repeats as often as the
counts allow. Rows find their place by their rank within their length. Windows that no
multiset fills are strung together and cut at the capacity, the last one at powers of two,
so nothing is padded.
"""

from __future__ import annotations

import base64
import functools
import gc
import json
import re
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from terrafold.llm.common import as_bytes, chunks, gapless_ranks, keep, part_ids, small_batches, small_side
from terrafold.llm.pretokens import Pieces, flat_ids

#: Ranks of the vocabulary, and the file that holds it too and names its added tokens.
VOCABULARY, ADDED = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
SIZE = 1024
#: The id that ends a document.
END = 0

PIECES = "piece_id long, doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, tail binary"
OUTPUT = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tail binary"


class Encoder:
    """Ids of pre-tokens, remembered up to a bound, and of the tokens added to the vocabulary."""

    def __init__(self, path: str, added: dict[bytes, int], max_pieces: int = 200_000):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added = added
        # The longest of two that start at one place counts.
        names = sorted(added, key=len, reverse=True)
        self.pattern = re.compile(b"|".join(map(re.escape, names))) if names else None
        self.known: dict[bytes, bytes] = {}
        self.max_pieces = max_pieces

    def encode(self, piece: bytes) -> bytes:
        found = self.known.get(piece)
        if found is None:
            # A pre-token is one pre-token by itself too, so this cuts it no further.
            ids = self.library.encode_ordinary(piece.decode("utf-8"))
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(piece) <= 64:
                if len(self.known) >= self.max_pieces:
                    self.known.clear()
                self.known[piece] = found
        return found

    def encode_all(self, pieces: list[bytes]) -> list[bytes]:
        return list(map(self.encode, pieces))

    def occurrences(self, raw: bytes, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """Added tokens within documents, left to right without overlaps: start, end, id."""
        if self.pattern is None or not self.pattern.search(raw):
            return []
        bounds = offsets.tolist()
        return [
            (m.start(), m.end(), self.added[m.group()])
            for a, b in zip(bounds[:-1], bounds[1:], strict=True)
            for m in self.pattern.finditer(raw, a, b)
        ]

    def ids(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a chunk, and where each document's start and the last end."""
        cuts = self.occurrences(raw.tobytes(), offsets)
        if not cuts:
            return flat_ids(Pieces(raw, offsets), self.encode_all)
        bounds = np.unique(np.concatenate([offsets, [c[0] for c in cuts], [c[1] for c in cuts]]))
        ids, at = flat_ids(Pieces(raw, bounds), self.encode_all)
        size, token = np.diff(at), np.full(len(bounds) - 1, -1, np.int64)
        for start, _, number in cuts:
            token[np.searchsorted(bounds, start)] = number
        size = np.where(token >= 0, 1, size)
        starts = np.append(0, np.cumsum(size))
        out = np.empty(starts[-1], np.uint32)
        for i, number in enumerate(token):
            out[starts[i] : starts[i + 1]] = number if number >= 0 else ids[at[i] : at[i + 1]]
        return out, starts[np.searchsorted(bounds, offsets)]


def added_tokens(path: str) -> dict[bytes, int]:
    """Added tokens of a tokenizers file and their ids; plain ones only."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)["added_tokens"]
    for t in found:
        if t["lstrip"] or t["rstrip"] or t["single_word"]:
            raise ValueError(f"{path}: added token {t['content']!r} strips or wants word borders")
    return {t["content"].encode("utf-8"): t["id"] for t in found}


@functools.cache
def encoder(path: str, added: str) -> Encoder:
    """One per worker process."""
    made = Encoder(path, added_tokens(added))
    gc.freeze()
    return made


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def cut_documents(docs: DataFrame, path: str, added: str, size: int = SIZE) -> DataFrame:
    """Pieces of at most ``size`` ids of every document, with the ids of the last one."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        library, used = encoder(path, added), 0
        for batch in batches:
            raw, offsets = as_bytes(batch.column(1))
            for lo, hi in chunks(offsets):
                own = offsets[lo : hi + 1]
                ids, at = library.ids(raw[own[0] : own[-1]], own - own[0])
                row, start, length, check, total, tail = [], [], [], [], [], []
                for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                    document = np.append(ids[a:b], np.uint32(END))
                    for s in range(0, len(document), size):
                        part = document[s : s + size]
                        row.append(lo + i)
                        start.append(s)
                        length.append(len(part))
                        check.append(crc(part))
                        total.append(len(document))
                        tail.append(part.astype("<u4").tobytes() if len(part) < size else None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part_ids(len(row), used)), batch.column(0).take(pa.array(row, pa.int64()))]
                    + [pa.array(x, pa.int64()) for x in (start, length, check, total)]
                    + [pa.array(tail, pa.binary())],
                    ["piece_id", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "tail"],
                )
                used += len(row)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES.format(id=id_type))


@dataclass
class Plan:
    """Where each rank of each length goes; its size depends on the capacity alone."""

    size: int
    #: One row for each length of each window: length, first rank, times in a window, window
    #: or position of the first copy, step from copy to copy, offset in it, whether strung.
    rows: list[tuple[int, int, int, int, int, int, bool]] = field(default_factory=list)
    windows: int = 0
    #: Ids in the windows that are strung together and cut.
    strung: int = 0

    def ends(self) -> np.ndarray:
        """Cuts after the last whole sequence of the string: a descending binary sum."""
        rest, at, cuts = self.strung % self.size, self.strung - self.strung % self.size, []
        for bit in reversed(range(self.size.bit_length())):
            if rest >> bit & 1:
                at += 1 << bit
                cuts.append(at)
        return np.array(cuts, np.int64)


def fullest(count: dict[int, int], lengths: list[int], capacity: int) -> dict[int, int]:
    """The multiset of lengths with the largest sum within the capacity; longer ones first."""
    mask, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in lengths:
        left = min(count[length], capacity // length)
        times = 1
        while left:
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= (reach << (length * times)) & mask
            left -= times
            times *= 2
        if reach >> capacity & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + times
            at -= length * times
    return used


def plan(histogram: dict[int, int], size: int = SIZE) -> Plan:
    """Fill windows of ``size`` from counts of lengths from 1 to ``size``."""
    out, count, at = Plan(size), dict(histogram), dict.fromkeys(histogram, 0)
    strung = []
    lengths = sorted((k for k, n in count.items() if n > 0), reverse=True)
    while lengths:
        seed = lengths[0]
        count[seed] -= 1
        used = fullest(count, [k for k in lengths if k <= size - seed and count[k] > 0], size - seed)
        count[seed] += 1
        used[seed] = used.get(seed, 0) + 1
        copies = min(count[k] // n for k, n in used.items())
        filled = sum(k * n for k, n in used.items()) == size
        offset = 0
        for length, times in sorted(used.items(), reverse=True):
            place = (length, at[length], times, out.windows if filled else 0, 1, offset, not filled)
            (out.rows if filled else strung).append((place, copies, used))
            at[length] += copies * times
            count[length] -= copies * times
            offset += length * times
        out.windows += copies * filled
        lengths = [k for k in lengths if count[k] > 0]
    out.rows = [place for place, _, _ in out.rows]
    position, last = 0, None
    for place, copies, used in strung:
        total = sum(k * n for k, n in used.items())
        if used is not last:
            base, last = position, used
            position += copies * total
        out.rows.append((*place[:3], base, total, place[5], True))
    out.strung = position
    return out


def place(ranked: DataFrame, chosen: Plan) -> DataFrame:
    """Sequence and offset of every piece; pieces of the string get their position there."""
    rows = sorted(chosen.rows)
    table = np.array([r[:6] for r in rows], np.int64).reshape(-1, 6)
    strung = np.array([r[6] for r in rows], bool)
    keys = (table[:, 0] << 52) + table[:, 1]
    schema = StructType(list(ranked.schema.fields)).add("sequence_id", "long").add("offset", "long").add("position", "long")

    def run(frames):
        for f in frames:
            rank, length = f["rank"].to_numpy(np.int64), f["length"].to_numpy(np.int64)
            i = np.searchsorted(keys, (length << 52) + rank, "right") - 1
            copy, slot = np.divmod(rank - table[i, 1], table[i, 2])
            offset = table[i, 5] + slot * length
            at = table[i, 3] + copy * table[i, 4]
            yield f.assign(sequence_id=at, offset=offset, position=np.where(strung[i], at + offset, -1))

    return ranked.mapInPandas(run, schema)


def cut_string(pieces: DataFrame, chosen: Plan, id_type: str) -> DataFrame:
    """Cut the pieces of the string at the ends of its sequences."""
    size, first, ends = chosen.size, chosen.windows, chosen.ends()
    whole = chosen.strung // chosen.size

    def run(frames):
        for f in frames:
            out = []
            for row in f.itertuples(index=False):
                ids, at, done = np.frombuffer(row.tail, "<u4"), int(row.position), 0
                while done < len(ids):
                    here = at + done
                    if here < whole * size:
                        sequence, begin = divmod(here, size)
                        stop, begin = (sequence + 1) * size, sequence * size
                    else:
                        k = int(np.searchsorted(ends, here, "right"))
                        sequence, stop = whole + k, int(ends[k])
                        begin = int(ends[k - 1]) if k else whole * size
                    part = ids[done : done + stop - here]
                    out.append((row.doc_id, row.start + done, len(part), crc(part), row.doc_tokens, first + sequence, here - begin, part.tobytes()))
                    done += len(part)
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tail"])

    return pieces.select("doc_id", "start", "doc_tokens", "position", "tail").mapInPandas(run, OUTPUT.format(id=id_type))


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE, added: str | None = None) -> DataFrame:
    """Pieces of all documents in sequences of at most ``size`` ids.

    ``path`` is a rank file, ``added`` a tokenizers file of the same vocabulary that names the
    tokens added to it; one that stands in a text is its id, as the tokenizers library gives it.

    Takes ``doc_id`` and ``text``; other columns are left out. A row is a document: null or
    empty text is the end id alone, repeated rows are packed each, a text of any length is
    cut whole. An empty table packs to none. Full sequences hold ``size`` ids; at most
    ``log2(size)`` shorter ones exist, each of a power of two. Every id lies in one piece.
    """
    path, added = path or public_tokenizers.path(VOCABULARY), added or public_tokenizers.path(ADDED)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    small_batches(docs)
    cut = keep(cut_documents(docs, path, added, size), "cut")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    chosen = plan(histogram, size)
    narrow = cut.select("piece_id", "doc_id", "start", "length", "ids_crc32", "doc_tokens")
    placed = place(gapless_ranks(narrow, "length", "rank", "piece_id"), chosen)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if not chosen.strung:
        return placed.select(*columns)
    placed = keep(placed, "placed")
    strung = small_side(placed.filter("position >= 0").select("piece_id", "position"), "16")
    pieces = cut.select("piece_id", "doc_id", "start", "doc_tokens", "tail").join(strung, "piece_id")
    return placed.filter("position < 0").select(*columns).unionByName(cut_string(pieces, chosen, id_type).select(*columns))
