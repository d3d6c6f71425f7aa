"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

A sequence of tokens is the BPE encoding of its bytes exactly if every two neighbours are
the encoding of their own bytes. So a non-deterministic transducer reads bytes, guesses
where tokens end and checks each new token against the one before. :class:`Transducer`
makes it deterministic as texts need it: a state holds every guess still alive with the
tokens it has not emitted, a step emits what all guesses share. A guess dies at the latest
after the bytes of the longest token, which bounds the lookahead. States are dropped when
there are too many; they come back when needed, so memory is bounded and results are not
touched. The pre-tokens of a chunk are read in sorted order: each goes on from where it
parts from the one before, so a prefix that many share is read once.
"""

from __future__ import annotations

import base64
import functools
import gc
import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructType

from terrafold.llm.common import as_bytes, chunks
from terrafold.llm.pretokens import Pieces, flat_ids

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes of text whose pre-tokens are sorted together; the more, the longer the shared prefixes.
SORTED_BYTES = 4 << 20


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merged(piece: bytes, rank: dict[bytes, int], least: int = 1) -> list[int]:
    """Plain BPE of a short piece: join the neighbours of least rank, leftmost first.

    Stops at ``least`` parts.
    """
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > least:
        best = min(range(len(parts) - 1), key=lambda i: rank.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in rank:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [rank[p] for p in parts]


def common_prefix(a: bytes, b: bytes) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class Transducer:
    """Encodes pre-tokens by a rank table."""

    def __init__(self, path: str, max_states: int = 100_000, max_pieces: int = 400_000):
        self.rank = ranks(path)
        self.token = {v: k for k, v in self.rank.items()}
        self.max_states, self.max_pieces = max_states, max_pieces
        self.pieces: dict[bytes, bytes] = {}
        # The trie of all tokens that BPE can make: the children of its root, by byte; a node is
        # (its children, token or -1).
        self.trie: dict[int, tuple[dict, int]] = {}
        # Of each such token, the two that its last merge joins.
        self.halves: dict[int, tuple[int, int]] = {}
        for piece, token in self.rank.items():
            if len(piece) > 1:
                halves = merged(piece, self.rank, 2)
                if len(halves) != 2:
                    continue
                self.halves[token] = halves[0], halves[1]
            children = self.trie
            for byte in piece[:-1]:
                children = children.setdefault(byte, ({}, -1))[0]
            children[piece[-1]] = (children[piece[-1]][0] if piece[-1] in children else {}, token)
        self.pair: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states but the start.

        A state is the last token emitted and the bytes read since. With it go the guesses
        still alive, as (offset in those bytes, children of a trie node), and for every offset where a
        token may end that token and the offset where it starts.
        """
        self.states = [(-1, b"", ((0, self.trie),), {0: (-1, 0)})]
        self.number = {(-1, b""): 0}
        self.missed: set[tuple[int, int]] = set()
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens are the encoding of their bytes."""
        known = self.pair.get((left, right))
        if known is None:
            if len(self.pair) > 400_000:
                self.pair.clear()
            known = self.pair[left, right] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        """Undo the merges next to the border, latest first; none may lose to one across it.

        A merge across, of the parts at the border at some time, wins if its rank is less
        than that of the merge that next changes one of the two (a tie goes to the left).
        """
        rank, token, halves, limit = self.rank, self.token, self.halves, 1 << 60
        while True:
            if rank.get(token[left] + token[right], 1 << 60) < limit:
                return False
            split_left, split_right = halves.get(left), halves.get(right)
            if split_left is None and split_right is None:
                return True
            if split_right is None or split_left is not None and left > right:
                left, limit = split_left[1], left
            else:
                right, limit = split_right[0], right + 1

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Make the state after a byte, and what all its guesses emit."""
        last, bytes_read, guesses, ends = self.states[state]
        n, alive, ended = len(bytes_read) + 1, [], None
        for offset, following in guesses:
            node = following.get(byte)
            if node is None:
                continue
            children, token = node
            if token >= 0 and ended is None:
                before = ends[offset][0]
                if before < 0 or self.fits(before, token):
                    ended = token, offset
            if children:
                alive.append((offset, children))
        alive.append((n, self.trie))
        # The offset up to which all guesses have the same tokens.
        shared = alive[0][0]
        ends = ends | {n: ended}
        for offset, _ in alive:
            while offset != shared:
                if offset > shared:
                    offset = ends[offset][1]
                else:
                    shared = ends[shared][1]
        out, at = [], shared
        while at:
            token, at = ends[at]
            out.append(token)
        key = ends[shared][0], bytes_read[shared:] + bytes((byte,)) if shared < n else b""
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            kept = {shared}
            for offset, _ in alive:
                while offset not in kept:
                    kept.add(offset)
                    offset = ends[offset][1]
            moved = {o - shared: (ends[o][0], ends[o][1] - shared) for o in kept}
            self.states.append((*key, tuple((o - shared, children) for o, children in alive), moved))
            self.steps.append({})
        found = self.steps[state][byte] = number, tuple(reversed(out))
        return found

    def stream(self, data: bytes) -> list[int]:
        """Tokens of one pre-token of any length, each added as soon as it is certain.

        A transition becomes part of the table when it is missed for the second time; near
        the end of a pre-token, a first miss is answered by following the guesses themselves.
        """
        if len(self.states) > self.max_states:
            self.reset()
        state, steps, done, missed = 0, self.steps, [], self.missed
        for i, byte in enumerate(data):
            found = steps[state].get(byte)
            if found is None:
                if len(data) - i <= 48 and (state, byte) not in missed:
                    missed.add((state, byte))
                    return done + self.follow(state, data[i:])
                if len(self.states) > 2 * self.max_states:
                    # Only in one very long pre-token: start the table anew with this state.
                    kept = self.states[state]
                    self.reset()
                    steps, state = self.steps, self.number.setdefault(kept[:2], 1)
                    missed = self.missed
                    if state:
                        self.states.append(kept)
                        steps.append({})
                found = self.step(state, byte)
            state, out = found
            if out:
                done += out
        return done + self.follow(state, b"")

    def follow(self, state: int, data: bytes) -> list[int]:
        """Tokens from a state to the end of ``data``, without making states."""
        _, bytes_read, guesses, ends = self.states[state]
        n, trie, pair = len(bytes_read), self.trie, self.pair.get
        if data:
            ends = dict(ends)
        for byte in data:
            n += 1
            alive, open_ = [], True
            for offset, following in guesses:
                node = following.get(byte)
                if node is not None:
                    children, token = node
                    if open_ and token >= 0:
                        before = ends[offset][0]
                        fits = before < 0 or pair((before, token))
                        if self.fits(before, token) if fits is None else fits:
                            ends[n] = token, offset
                            open_ = False
                    if children:
                        alive.append((offset, children))
            alive.append((n, trie))
            guesses = alive
        out = []
        while n:
            token, n = ends[n]
            out.append(token)
        return out[::-1]

    def sorted_streams(self, pieces: list[bytes], many: int = 16) -> Iterator[list[int]]:
        """Tokens of pre-tokens in ascending order; a prefix shared with the one before is kept.

        What ``many`` of them share becomes part of the table. The rest of a pre-token follows
        transitions that are there and then, for at most 48 bytes, the guesses themselves. Of
        every byte of the last pre-token the state after it is kept with the number of tokens
        emitted, and beyond the table the guesses still alive.
        """
        trie, pair, before = self.trie, self.pair.get, b""
        states, counts, done, base = [0], [0], [], None
        for k, data in enumerate(pieces):
            n, shared, before = len(data), common_prefix(before, data), data
            if base is None or shared <= base:
                # Within the table.
                shared = min(shared, len(states) - 1)
                del states[shared + 1 :], counts[shared + 1 :], done[counts[shared] :]
                base, steps = None, self.steps
                frequent = common_prefix(data, pieces[k + many - 1]) if k + many <= len(pieces) else 0
                if len(self.states) > self.max_states:
                    self.reset()
                    states, counts, done, shared, steps = [0], [0], [], 0, self.steps
                state = states[-1]
                for i in range(shared, n):
                    found = steps[state].get(data[i])
                    if found is None:
                        if i >= frequent and n - i <= 48:
                            base = i
                            break
                        if len(self.states) > 2 * self.max_states:
                            break
                        found = self.step(state, data[i])
                    state, out = found
                    if out:
                        done += out
                    states.append(state)
                    counts.append(len(done))
                else:
                    yield done + self.follow(state, b"")
                    continue
                if base is None:  # one very long pre-token; it starts the table anew
                    yield self.stream(data)
                    self.reset()
                    states, counts, done, before = [0], [0], [], b""
                    continue
                _, bytes_read, guesses, ends = self.states[state]
                first, kept, ends, shared = len(bytes_read), [guesses], dict(ends), base
            else:
                del kept[shared - base + 1 :]
            guesses = kept[-1]
            # Whatever stands in ``ends`` for later bytes is overwritten before it is read.
            for i in range(shared, n):
                byte, at, alive, open_ = data[i], first + i - base + 1, [], True
                for offset, following in guesses:
                    node = following.get(byte)
                    if node is not None:
                        children, token = node
                        if open_ and token >= 0:
                            last = ends[offset][0]
                            fits = last < 0 or pair((last, token))
                            if self.fits(last, token) if fits is None else fits:
                                ends[at] = token, offset
                                open_ = False
                        if children:
                            alive.append((offset, children))
                alive.append((at, trie))
                guesses = alive
                kept.append(guesses)
            out, at = [], first + n - base
            while at:
                token, at = ends[at]
                out.append(token)
            yield done + out[::-1]

    def encode_all(self, pieces: list[bytes]) -> list[bytes]:
        """Tokens of distinct pre-tokens as unsigned 32-bit numbers; short ones are remembered."""
        known, rank = self.pieces, self.rank
        out = list(map(known.get, pieces))
        missing = []
        for i, found in enumerate(out):
            if found is None:
                whole = rank.get(pieces[i])
                if whole is None:
                    missing.append(i)
                else:
                    out[i] = known[pieces[i]] = struct.pack("<I", whole)
        missing.sort(key=pieces.__getitem__)
        for i, tokens in zip(missing, self.sorted_streams([pieces[i] for i in missing]), strict=True):
            out[i] = struct.pack(f"<{len(tokens)}I", *tokens)
            if len(pieces[i]) <= 64:
                known[pieces[i]] = out[i]
        if len(known) >= self.max_pieces:
            known.clear()
        return out

    def encode(self, piece: bytes) -> bytes:
        """Tokens of one pre-token as unsigned 32-bit numbers; short ones are remembered."""
        known = self.pieces.get(piece)
        if known is None:
            whole = self.rank.get(piece)
            tokens = (whole,) if whole is not None else self.stream(piece)
            known = struct.pack(f"<{len(tokens)}I", *tokens)
            if len(piece) <= 64:
                if len(self.pieces) >= self.max_pieces:
                    self.pieces.clear()
                self.pieces[piece] = known
        return known


class Utf8:
    """Incremental UTF-8: bytes in any portions in, text out, never half a character."""

    def __init__(self):
        self.left, self.pending, self.low, self.high = 0, b"", 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        """Text of all characters complete so far; a broken sequence becomes U+FFFD."""
        if not self.left and data.isascii():
            return data.decode("ascii")
        tail = self._tail(data)
        whole, self.pending = self.pending + data, b""
        if tail:
            whole, self.pending = whole[:-tail], whole[-tail:]
        return whole.decode("utf-8", "replace")

    def _tail(self, data: bytes) -> int:
        """Run the state machine over the last bytes; how many wait for more."""
        recent = (self.pending + data)[-3:]
        start = next((i for i in range(len(recent) - 1, -1, -1) if recent[i] & 0xC0 != 0x80), None)
        self.left = 0
        if start is None:
            return 0
        lead = recent[start]
        need = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 1
        have = len(recent) - start
        if have >= need:
            return 0
        if have > 1:  # the second byte's range depends on the first
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
            if not low <= recent[start + 1] <= high:
                return 0
        self.left = need - have
        return have

    def end(self) -> str:
        """What an unfinished character at the end becomes."""
        out, self.pending, self.left = self.pending.decode("utf-8", "replace"), b"", 0
        return out


@functools.cache
def transducer(path: str) -> Transducer:
    """One per worker process."""
    made = Transducer(path)
    gc.freeze()  # the tables stay; the collector need not walk them
    return made


@functools.cache
def token_bytes(path: str) -> list[bytes]:
    table = ranks(path)
    out = [b""] * (max(table.values()) + 1)
    for piece, token in table.items():
        out[token] = piece
    return out


def decode_stream(portions: Iterable[Iterable[int]], path: str) -> Iterator[str]:
    """Text of ids that arrive in portions."""
    table, machine = token_bytes(path), Utf8()
    for ids in portions:
        yield machine.feed(b"".join(map(table.__getitem__, ids)))
    yield machine.end()


def encode_documents(docs: DataFrame, path: str, text: str = "text", portion: int = 1 << 16) -> DataFrame:
    """Add ``ids`` (array of int) and ``decoded`` (the text that they decode to) to the rows.

    Null text counts as empty and has no ids. Empty tables stay empty, repeated rows are
    encoded each, a text of any length is one document; existing columns of these two names
    are replaced. ``path`` is a rank file.
    """
    rest = [c for c in docs.columns if c not in ("ids", "decoded")]
    schema = StructType([docs.schema[c] for c in rest]).add("ids", ArrayType(IntegerType())).add("decoded", "string")

    def run(batches):
        for batch in batches:
            for ids, at, lo, hi in encoded_chunks(batch.column(text), path):
                part = pa.array(ids.view(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), part)
                texts = ["".join(decode_stream(portions(ids[a:b], portion), path)) for a, b in zip(at[:-1], at[1:], strict=True)]
                columns = [batch.column(c).slice(lo, hi - lo) for c in rest]
                yield pa.RecordBatch.from_arrays([*columns, lists, pa.array(texts, pa.string())], [*rest, "ids", "decoded"])

    return docs.select(*rest).mapInArrow(run, schema)


def portions(ids: np.ndarray, size: int) -> Iterator[list[int]]:
    for a in range(0, len(ids), size):
        yield ids[a : a + size].tolist()


def encoded_chunks(column: pa.Array, path: str):
    """Ids of the texts of a column, chunk by chunk, with the range of rows of each chunk."""
    encode = transducer(path).encode_all
    raw, offsets = as_bytes(column)
    for lo, hi in chunks(offsets, SORTED_BYTES):
        own = offsets[lo : hi + 1]
        ids, at = flat_ids(Pieces(raw[own[0] : own[-1]], own - own[0]), encode)
        yield ids, at, lo, hi


def round_trip_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode and decode every document; digests of ids and of decoded bytes.

    Takes ``doc_id`` and ``text``; other columns are left out. Null text is empty: 0 tokens,
    digests of nothing. A row in gives a row out, repeated rows too. ``round_trip`` tells
    whether the decoded bytes are the text's.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        for batch in batches:
            raw, offsets = as_bytes(batch.column(1))
            out = []
            for ids, at, lo, hi in encoded_chunks(batch.column(1), path):
                for row, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True), lo):
                    own, digest = ids[a:b], hashlib.sha256()
                    for text in decode_stream(portions(own, 1 << 16), path):
                        digest.update(text.encode("utf-8"))
                    source = hashlib.sha256(raw[offsets[row] : offsets[row + 1]]).hexdigest()
                    out.append((b - a, hashlib.sha256(own.astype("<u4").tobytes()).hexdigest(), digest.hexdigest(), source))
            n, ids_sha, decoded_sha, source = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(ids_sha, pa.string()),
                    pa.array(decoded_sha, pa.string()),
                    pa.array([x == y for x, y in zip(decoded_sha, source, strict=True)], pa.bool_()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    )
