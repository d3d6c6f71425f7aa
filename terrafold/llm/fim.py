"""Fill-in-middle by piece tables: no text is copied until an output is wanted.

A document is a list of descriptors (buffer, start, length) over two immutable buffers, the
texts of the batch and the sentinels. Cutting splits descriptors, an arrangement is a
permutation of the cut parts with sentinel descriptors between them, hashes read descriptor
by descriptor. Restoring cuts an output at its sentinels, drops them and applies the inverse
permutation. Where lines end, and how many code points stand before a byte, is counted for a
whole chunk at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructType

from terrafold.llm.common import as_bytes, chunks, small_batches

#: The buffers that descriptors point into.
TEXT, MARKS = 0, 1
#: Order in which the parts (0 prefix, 1 middle, 2 suffix) stand in an output, each after its
#: sentinel; of the second form two sentinels stand before the first part.
FORMS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
ADDED = "fim_form string, fim_output string, fim_pieces array<struct<buffer:int,start:long,length:long>>"

Piece = tuple[int, int, int]


@dataclass(frozen=True)
class Scheme:
    """How documents are cut and arranged; percentages of documents are by hash."""

    seed: int = 7
    #: Percent of documents that are arranged at all, and of these the suffix-first ones.
    arranged: int = 100
    suffix_first: int = 50
    prefix: str = "<P>"
    middle: str = "<M>"
    suffix: str = "<S>"

    def __post_init__(self):
        names = self.sentinels
        inside = any(not a or a in b for i, a in enumerate(names) for j, b in enumerate(names) if i != j)
        # A sentinel that can overlap one could be read where text and sentinel meet.
        overlap = any(a[-n:] == b[:n] for a in names for b in names for n in range(1, min(len(a), len(b))))
        if inside or overlap:
            raise ValueError(f"sentinels must not be empty, hold or overlap one another: {self}")

    @property
    def sentinels(self) -> tuple[bytes, bytes, bytes]:
        """Of prefix, middle and suffix."""
        return self.prefix.encode(), self.middle.encode(), self.suffix.encode()

    @property
    def marks(self) -> tuple[bytes, list[Piece]]:
        """The sentinel buffer and the descriptor of each sentinel in it."""
        sizes = [len(s) for s in self.sentinels]
        return b"".join(self.sentinels), [(MARKS, sum(sizes[:i]), n) for i, n in enumerate(sizes)]

    def draws(self, doc_id) -> tuple[int, int, int, int]:
        """Four numbers below 2**32 that depend on the seed and the id alone; a null id is empty."""
        name = "" if doc_id is None else str(doc_id)
        digest = hashlib.sha256(f"{self.seed}:{name}".encode()).digest()
        return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def cut(pieces: list[Piece], *places: int) -> list[list[Piece]]:
    """Split a list of descriptors at ascending distances from its start."""
    parts, own, at, rest = [], [], 0, list(reversed(pieces))
    for place in (*places, None):
        while rest and (place is None or at + rest[-1][2] <= place):
            piece = rest.pop()
            own.append(piece)
            at += piece[2]
        if place is not None and rest and at < place:
            buffer, start, length = rest.pop()
            own.append((buffer, start, place - at))
            rest.append((buffer, start + place - at, length - (place - at)))
            at = place
        parts.append(own)
        own = []
    return parts


def arrange(parts: list[list[Piece]], form: str, marks: list[Piece]) -> list[Piece]:
    """The parts in the order of the form, each after its sentinel."""
    order = FORMS[form]
    return [piece for part in order for piece in (marks[part], *parts[part])]


def restore(output: bytes, form: str, scheme: Scheme) -> list[Piece]:
    """Descriptors over an output that give the text it was made from."""
    if form == "plain":
        return [(TEXT, 0, len(output))]
    order, places, at = FORMS[form], [], 0
    for part in order:
        at = output.index(scheme.sentinels[part], at)
        places += [at, at + len(scheme.sentinels[part])]
        at = places[-1]
    # What stands before the first sentinel is nothing; then part and sentinel take turns.
    parts = cut([(TEXT, 0, len(output))], *places)[2::2]
    inverse = np.argsort(order)
    return [piece for i in inverse for piece in parts[i]]


def read(pieces: list[Piece], text, marks) -> Iterator[memoryview]:
    """The bytes of a list of descriptors, one by one."""
    buffers = memoryview(text), memoryview(marks)
    for buffer, start, length in pieces:
        yield buffers[buffer][start : start + length]


def digest(pieces: list[Piece], text, marks) -> str:
    out = hashlib.sha256()
    for part in read(pieces, text, marks):
        out.update(part)
    return out.hexdigest()


def tables(raw: np.ndarray, offsets: np.ndarray, ids: list, scheme: Scheme) -> Iterator[tuple[int, str, int | None, int | None, list[Piece]]]:
    """Of every document of a chunk: lines, form, code points of prefix and middle, descriptors."""
    newline = np.flatnonzero(raw == 10)
    first = np.searchsorted(newline, offsets)
    points = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
    data, (_, marks) = raw.tobytes(), scheme.marks
    suspect = any(s in data for s in scheme.sentinels)
    for i, doc_id in enumerate(ids):
        start, end = int(offsets[i]), int(offsets[i + 1])
        whole = first[i + 1] - first[i]
        n = int(whole + (end > start and data[end - 1] != 10))
        h1, h2, h3, h4 = scheme.draws(doc_id)
        pieces = [(TEXT, start, end - start)]
        marked = suspect and any(data.find(s, start, end) >= 0 for s in scheme.sentinels)
        if start == end or marked or h3 % 100 >= scheme.arranged:
            yield n, "plain", None, None, pieces
            continue
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        after = [start if not k else int(newline[first[i] + k - 1]) + 1 if k <= whole else end for k in (low, high)]
        form = "spm" if h4 % 100 < scheme.suffix_first else "psm"
        parts = cut(pieces, *(a - start for a in after))
        prefix = int(points[after[0]] - points[start])
        yield n, form, prefix, int(points[after[1]] - points[after[0]]), arrange(parts, form, marks)


def in_chunks(batch: pa.RecordBatch, scheme: Scheme) -> Iterator[tuple[bytes, int, list[tuple]]]:
    """Bytes, first row and tables of each chunk of a batch with ``doc_id`` and the text last."""
    raw, offsets = as_bytes(batch.column(batch.num_columns - 1))
    ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
    for lo, hi in chunks(offsets):
        own = offsets[lo : hi + 1]
        part = raw[own[0] : own[-1]]
        yield part.tobytes(), lo, list(tables(part, own - own[0], ids[lo:hi], scheme))


def with_outputs(docs: DataFrame, scheme: Scheme = Scheme(), text: str = "text") -> DataFrame:
    """Add ``fim_form``, ``fim_output`` and ``fim_pieces`` (its descriptors) to the rows.

    Takes ``doc_id`` and a text column; null text is empty and plain. A text that holds a
    sentinel stays plain. Repeated rows are alike, a text of any length is one document, an
    empty table stays empty; existing columns of these three names are replaced. Starts in
    buffer 0 are bytes of the row's text, in buffer 1 of the three sentinels in a row.
    """
    added = ["fim_form", "fim_output", "fim_pieces"]
    rest = [c for c in docs.columns if c not in added]
    schema = StructType([docs.schema[c] for c in rest] + StructType.fromDDL(ADDED).fields)
    pieces_type = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))

    def run(batches):
        marks, _ = scheme.marks
        for batch in batches:
            narrow = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column(text)], ["doc_id", "text"])
            for data, lo, rows in in_chunks(narrow, scheme):
                outputs, descriptors, begin = [], [], 0
                for _, _, _, _, pieces in rows:
                    outputs.append(b"".join(read(pieces, data, marks)).decode("utf-8"))
                    descriptors.append([(b, s - begin if b == TEXT else s, n) for b, s, n in pieces])
                    begin += sum(n for b, _, n in pieces if b == TEXT)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(lo, len(rows)) for c in rest),
                        pa.array([r[1] for r in rows], pa.string()),
                        pa.array(outputs, pa.string()),
                        pa.array([[dict(zip(("buffer", "start", "length"), p, strict=True)) for p in d] for d in descriptors], pieces_type),
                    ],
                    [*rest, *added],
                )

    small_batches(docs)
    return docs.select(*(f"`{c}`" for c in rest)).mapInArrow(run, schema)


def with_texts(outputs: DataFrame, scheme: Scheme = Scheme(), name: str = "restored") -> DataFrame:
    """Rebuild each text from ``fim_output`` and ``fim_form`` alone, as column ``name``."""
    rest = [c for c in outputs.columns if c != name]

    def run(batches):
        for batch in batches:
            made = []
            for output, form in zip(batch.column("fim_output").to_pylist(), batch.column("fim_form").to_pylist(), strict=True):
                data = output.encode("utf-8")
                made.append(b"".join(read(restore(data, form, scheme), data, b"")).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(made, pa.string())], [*rest, name])

    schema = StructType([outputs.schema[c] for c in rest]).add(name, StringType())
    small_batches(outputs)
    return outputs.select(*(f"`{c}`" for c in rest)).mapInArrow(run, schema)


def digests(docs: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """Lines, form, sizes and digests of every document's output and of the text rebuilt from it.

    Takes ``doc_id`` and ``text``; other columns are left out. Null text is empty: plain, no
    lines. A row in gives a row out, repeated rows too; a null id draws as an empty one; an
    empty table gives none.
    """

    def run(batches):
        marks, _ = scheme.marks
        for batch in batches:
            for data, lo, rows in in_chunks(batch, scheme):
                outputs, restored = [], []
                for _, form, _, _, pieces in rows:
                    outputs.append(digest(pieces, data, marks))
                    output = b"".join(read(pieces, data, marks))
                    restored.append(digest(restore(output, form, scheme), output, b""))
                n, forms, prefix, middle, _ = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, len(rows)),
                        pa.array(n, pa.int64()),
                        pa.array(forms, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(outputs, pa.string()),
                        pa.array(restored, pa.string()),
                    ],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
                )

    small_batches(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    )
