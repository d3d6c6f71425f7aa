"""Removal of repeated strings by blockwise suffix sorting with cover-sample ranks.

A suffix takes part only if something like it is elsewhere. Of every string of the asked
length one anchor is chosen by its content, the least hash among its substrings of a quarter
of that length; equal strings
have equal anchors at equal distances. So all suffixes that can be equal meet in the bucket of
their anchor, and anchors that occur once drop out before any text moves. A bucket holds the
bytes around its anchor's occurrences; a task sorts one block of buckets at a time, in bounded
memory. Within a block, ranks of a cover sample (every eighth column, a difference cover of
suffixes that the anchor aligns) are precomputed by doubling; a suffix is then ordered by its
bucket, two sample ranks and the bytes before and after the samples, never by comparing long
common prefixes. The order is on bytes and ranks, so no hash decides what is removed.

Texts are read where they lie; only anchors, bytes around repeated ones and spans move.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import POWERS, as_bytes, chunks, keep, mixed, small_batches, small_side, split_by_bits, unused

#: Contexts that a sorted block holds; a bucket above the other bound goes by window digests.
BLOCK, HOT = 8192, 50_000
#: Columns between cover samples.
STEP = 8


@dataclass(frozen=True)
class Repeats:
    """What counts as repeated: strings of ``length`` bytes, found by anchors of ``gram`` bytes.

    ``length`` is a multiple of 8. Of the maximal repeated runs of a text those with fewer
    than ``words`` whole words stay unless they have ``always`` bytes. With ``across`` a string
    counts only if another document has it; what repeats within one document alone stays.
    """

    length: int = 400
    gram: int = 100
    words: int = 0
    always: int = 0
    across: bool = False

    def __post_init__(self):
        if self.length % STEP or not STEP <= self.gram <= self.length - STEP:
            raise ValueError(f"length must be a multiple of {STEP} and gram within it: {self}")

    @property
    def places(self) -> int:
        """Places of an anchor in a string."""
        return self.length - self.gram + 1

    @property
    def left(self) -> int:
        """Bytes before an anchor that strings with it can reach."""
        return self.places - 1

    @property
    def width(self) -> int:
        return self.left + self.length

    @property
    def ranked(self) -> int:
        """Length of the ranks that order suffixes; two of them cover a string."""
        return STEP << ((self.length - STEP) // STEP).bit_length() - 1


#: Of the query, and of the pipeline: passages of over 50 words, one of them cut by an edge,
#: that several documents have.
LONG, PASSAGES = Repeats(), Repeats(length=240, gram=48, words=50, always=400, across=True)


def sliding(values: np.ndarray, width: int, ufunc) -> np.ndarray:
    """``ufunc`` (minimum or maximum) over every ``width`` neighbours, by blocks."""
    n = len(values)
    fill = np.iinfo(values.dtype).max if ufunc is np.minimum else 0
    padded = np.full(-(-n // width) * width + width, fill, values.dtype)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    ahead = ufunc.accumulate(grid, axis=1).ravel()
    back = ufunc.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return ufunc(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(raw: np.ndarray, offsets: np.ndarray, kind: Repeats = LONG) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``raw`` of the anchors of all strings that lie within a document; hashes."""
    n = len(raw) - kind.gram + 1
    if n < kind.places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n)
    sums = POWERS.prefix(raw)
    hashes = mixed((sums[kind.gram :] - sums[:n]) * POWERS.down[:n])
    value = (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = sliding(value, kind.places, np.minimum)
    end = offsets[np.minimum(np.searchsorted(offsets, at, "right"), len(offsets) - 1)]
    least[at + kind.length > end] = 0  # the string would leave its document
    back = np.concatenate([np.zeros(kind.left, np.uint32), least])
    chosen = np.flatnonzero((sliding(back, kind.places, np.maximum)[:n] == value))
    return chosen, hashes[chosen]


def anchored(docs: DataFrame, kind: Repeats = LONG) -> DataFrame:
    """Text digest, length and anchors of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            raw, offsets = as_bytes(batch.column(1))
            for lo, hi in chunks(offsets):
                own = offsets[lo : hi + 1]
                part, base = raw[own[0] : own[-1]], own - own[0]
                chosen, hashes = anchors(part, base, kind)
                first = np.searchsorted(chosen, base)
                document = np.searchsorted(base, chosen, "right") - 1
                lists = pa.array(first.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([hashlib.sha256(part[a:b]).digest() for a, b in zip(base[:-1], base[1:], strict=True)], pa.binary()),
                        pa.array(np.diff(base)),
                        pa.ListArray.from_arrays(lists, pa.array(hashes.view(np.int64))),
                        pa.ListArray.from_arrays(lists, pa.array((chosen - base[document]).astype(np.int32))),
                    ],
                    ["doc_id", "digest", "n_bytes", "hashes", "places"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, digest binary, n_bytes long, hashes array<long>, places array<int>"
    )


def text_digest():
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))


def context(text: bytes, place: int, kind: Repeats = LONG) -> tuple[bytes, int]:
    """The bytes that strings with this anchor can reach, and how many stand before it."""
    low = max(0, place - kind.left)
    return text[low : place + kind.length], place - low


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true values: first and last index."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist(), strict=True))


def windows(left: int, size: int, kind: Repeats = LONG) -> tuple[int, int]:
    """Distances from an anchor back to the starts of strings that a context holds: first, last."""
    return max(0, kind.length - (size - left)), left


def contexts(texts: DataFrame, kind: Repeats = LONG) -> DataFrame:
    """One row for each distinct context of a text's repeated anchors."""

    def run(batches):
        for batch in batches:
            rows = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for text_id, text, places, hashes in zip(*columns, strict=True):
                seen = defaultdict(list)
                for place, h in zip(places, hashes, strict=True):
                    seen[h, *context(text, place, kind)].append(place)
                rows += [(h, text_id, own, left, ctx) for (h, ctx, left), own in seen.items()]
            for a in range(0, len(rows), BLOCK) if rows else ():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(x, t)
                        for x, t in zip(
                            zip(*rows[a : a + BLOCK], strict=True),
                            (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.binary()),
                            strict=True,
                        )
                    ],
                    ["hash", "text_id", "places", "left", "ctx"],
                )

    chosen = texts.select("text_id", "text", "places", "hashes")
    return chosen.mapInArrow(run, "hash long, text_id long, places array<int>, left int, ctx binary")


def cover_ranks(table: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """For every sample column, the rank of each row's next ``length`` bytes."""
    rows, width = table.shape
    words = np.ascontiguousarray(table).view(">u8").astype(np.uint64)
    ranks = {c: words[:, c // STEP] for c in range(0, width - STEP + 1, STEP)}
    size = STEP
    while size < length:
        longer = {}
        for c in ranks:
            if c + size in ranks:
                first, second = ranks[c], ranks[c + size]
                if size == STEP:
                    first = np.unique(first, return_inverse=True)[1]
                    second = np.unique(second, return_inverse=True)[1]
                longer[c] = np.unique(first.astype(np.int64) * rows + second, return_inverse=True)[1]
        ranks, size = longer, 2 * size
    return ranks


def sort_block(
    bucket: np.ndarray, table: np.ndarray, low: np.ndarray, high: np.ndarray, kind: Repeats = LONG, owners: np.ndarray | None = None
) -> np.ndarray:
    """Which suffixes of distinct contexts are equal to another one over ``kind.length`` bytes.

    ``table`` has the contexts with their anchors in column ``kind.left``; a row's suffixes start
    from ``low`` to ``high`` columns before it. ``owners`` are the least and greatest text that
    has a context; only suffixes of different texts are then equal. Returns a flag for each
    row and distance.
    """
    rows = len(table)
    out = np.zeros((rows, kind.places), bool)
    if rows < 2:
        return out
    width = -(-(kind.width + STEP) // STEP) * STEP
    padded = np.zeros((rows, width), np.uint8)
    padded[:, : kind.width] = table
    ranks = cover_ranks(padded, kind.ranked)
    for d in range(kind.places):
        live = np.flatnonzero((low <= d) & (d <= high))
        if len(live) < 2:
            continue
        start, end = kind.left - d, kind.left - d + kind.length
        first = -(-start // STEP) * STEP
        last = end // STEP * STEP - kind.ranked
        head = np.ascontiguousarray(padded[live, start : start + 8]).view(">u8")[:, 0]
        tail = np.ascontiguousarray(padded[live, end - 8 : end]).view(">u8")[:, 0]
        middle = ranks[first][live].astype(np.uint64) * np.uint64(rows) + ranks[last][live].astype(np.uint64)
        own = bucket[live].astype(np.uint64)
        # Sort by a mix of the four keys; neighbours are then compared on the keys themselves.
        order = np.argsort(mixed(mixed(mixed(own) + middle) + head) + mixed(tail), kind="stable")
        keys = [k[order] for k in (own, middle, head.astype(np.uint64), tail.astype(np.uint64))]
        same = np.logical_and.reduce([k[1:] == k[:-1] for k in keys])
        equal = np.zeros(len(live), bool)
        equal[:-1] |= same
        equal[1:] |= same
        if owners is not None:
            first = np.flatnonzero(np.append(True, ~same))
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(live))))
            least, most = (f.reduceat(o[live[order]], first) for f, o in zip((np.minimum, np.maximum), owners, strict=True))
            equal &= (least < most)[group]
        out[live[order[equal]], d] = True
    return out


def repeated_spans(hashes: np.ndarray, rows: list[tuple], kind: Repeats = LONG) -> list[tuple[int, int, int]]:
    """Spans (text id, start, end) that whole buckets prove repeated.

    ``rows``: (text id, places, left, context) of each row, ``hashes`` its bucket.
    """
    known: dict[tuple, int] = {}
    own = np.array([known.setdefault((h, r[2], r[3]), len(known)) for h, r in zip(hashes.tolist(), rows, strict=True)])
    times = np.bincount(own, weights=[len(r[1]) for r in rows]).astype(np.int64)
    table = np.zeros((len(known), kind.width), np.uint8)
    bucket, low, high = (np.zeros(len(known), np.int64) for _ in range(3))
    for (h, left, ctx), i in known.items():
        bucket[i] = h
        low[i], high[i] = windows(left, len(ctx), kind)
        table[i, kind.left - left : kind.left - left + len(ctx)] = np.frombuffer(ctx, np.uint8)
    owners = None
    if kind.across:
        texts = np.array([r[0] for r in rows], np.int64)
        owners = np.full((2, len(known)), texts.max())
        owners[1] = -1
        np.minimum.at(owners[0], own, texts)
        np.maximum.at(owners[1], own, texts)
        times = 1 + (owners[0] < owners[1])
    flags = sort_block(np.unique(bucket, return_inverse=True)[1], table, low, high, kind, owners)
    for i in np.flatnonzero(times > 1):
        flags[i, low[i] : high[i] + 1] = True
    found = [runs(f) for f in flags]
    return [
        (text_id, place - b, place - a + kind.length)
        for k, (text_id, places, _, _) in zip(own.tolist(), rows, strict=True)
        for a, b in found[k]
        for place in places
    ]


def bucket_spans(rows: DataFrame, kind: Repeats = LONG) -> DataFrame:
    """Sort the buckets, block by block, and say which spans of which texts repeat."""

    def answer(hashes, rows):
        spans = repeated_spans(hashes, rows, kind)
        for a in range(0, len(spans), 1 << 16):
            columns = list(zip(*spans[a : a + (1 << 16)], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["text_id", "start", "end"]
            )

    def run(batches):
        held_hashes, held = np.zeros(0, np.int64), []
        for batch in batches:
            held_hashes = np.append(held_hashes, batch.column(0).to_numpy())
            held += list(zip(*(batch.column(i).to_pylist() for i in range(1, 5)), strict=True))
            while len(held) > BLOCK:
                # Cut between buckets; one above the block is read to its end.
                edge = np.flatnonzero(held_hashes[1:] != held_hashes[:-1]) + 1
                inside = edge[edge <= BLOCK]
                if not len(edge):
                    break
                cut = int(inside[-1] if len(inside) else edge[0])
                yield from answer(held_hashes[:cut], held[:cut])
                held_hashes, held = held_hashes[cut:], held[cut:]
        if held:
            yield from answer(held_hashes, held)

    dealt = rows.select("hash", "text_id", "places", "left", "ctx").repartition("hash").sortWithinPartitions("hash")
    return dealt.mapInArrow(run, "text_id long, start long, end long")


def window_spans(texts: DataFrame, kind: Repeats = LONG) -> DataFrame:
    """The same for hot anchors, whose buckets are too large to sort: digests of all windows.

    Windows are counted before they shuffle, so a passage that is everywhere weighs on no
    task; the digests that repeat come back by broadcast or by a join that Spark may split.
    """

    def run(batches):
        for batch in batches:
            for text_id, text, places in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                starts = sorted({p - d for p in places for d in range(kind.places) if p - d >= 0 and p - d + kind.length <= len(text)})
                for a in range(0, len(starts), 1 << 14):
                    part = starts[a : a + (1 << 14)]
                    marks = [hashlib.sha256(text[s : s + kind.length]).digest() for s in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([text_id] * len(part), pa.int64()), pa.array(part, pa.int64()), pa.array(marks, pa.binary())],
                        ["text_id", "start", "mark"],
                    )

    found = texts.select("text_id", "text", F.col("hot").alias("places")).mapInArrow(run, "text_id long, start long, mark binary")
    found = keep(found, "windows")
    counted = found.groupBy("mark").agg(F.count("*").alias("n"), F.min("text_id").alias("x"), F.max("text_id").alias("y"))
    twice = keep(counted.filter("x <> y" if kind.across else "n > 1").select("mark"), "marks")
    again = found.join(small_side(twice, "48"), "mark", "left_semi")
    return again.select("text_id", "start", (F.col("start") + kind.length).alias("end"))


def spans_by_text(docs: DataFrame, hot: int = HOT, kind: Repeats = LONG) -> DataFrame:
    """Spans to remove of each text that has any, by the text's digest."""
    small_batches(docs)
    signed = keep(anchored(docs, kind).filter(F.col("n_bytes") >= kind.length), "anchors")
    texts = signed.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.max("n_bytes").alias("n_bytes"))
    texts = keep(texts.withColumn("text_id", F.monotonically_increasing_id()), "texts")
    one = small_side(texts.select("digest", "rep", "text_id"), "64")
    single = signed.join(one, "digest").filter(F.col("doc_id").eqNullSafe(F.col("rep")))
    zipped = single.select("text_id", F.explode(F.arrays_zip("hashes", "places")).alias("x"))
    occurrences = zipped.select("text_id", F.col("x.hashes").alias("hash"), F.col("x.places").alias("place"))
    shared = occurrences.groupBy("hash").agg(F.count("*").alias("m"), F.min("text_id").alias("x"), F.max("text_id").alias("y"))
    shared = shared.filter("x <> y" if kind.across else "m > 1")
    shared = keep(shared.select("hash", (F.col("m") > hot).alias("is_hot")), "shared")
    met = occurrences.join(small_side(shared, "12"), "hash")
    pair = F.struct("place", "hash")
    gathered = met.groupBy("text_id").agg(
        F.collect_set(F.when(~F.col("is_hot"), pair)).alias("cold"), F.collect_set(F.when(F.col("is_hot"), F.col("place"))).alias("hot")
    )
    wanted = gathered.join(texts.select("text_id", "digest", "rep"), "text_id")
    wanted = keep(wanted.select("digest", "rep", "text_id", F.col("cold.place").alias("places"), F.col("cold.hash").alias("hashes"), "hot"), "wanted")
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), text_digest().alias("own"))
    # Places grow with the texts, so this joins by a shuffle; texts without any do not move.
    own, _ = split_by_bits(own, "own", wanted.select(F.col("digest").alias("own")))
    joined = own.join(wanted, (F.col("doc_id").eqNullSafe(F.col("rep"))) & (F.col("own") == F.col("digest")))
    spans = bucket_spans(contexts(joined, kind), kind)
    if shared.filter("is_hot").limit(1).count():
        spans = spans.unionByName(window_spans(joined.filter("size(hot) > 0"), kind))
    copied = texts.filter("copies > 1").select("text_id", F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))
    everything = spans.unionByName(copied).groupBy("text_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return keep(everything.join(texts.select("text_id", "digest"), "text_id").select("digest", "spans"), "spans")


def whole_words(text: bytes, start: int, end: int) -> int:
    """Words that lie within ``text[start:end]`` from their first to their last byte."""
    part = text[start:end]
    n = len(part.split())
    if n and start and not part[:1].isspace() and not text[start - 1 : start].isspace():
        n -= 1
    if n and end < len(text) and not part[-1:].isspace() and not text[end : end + 1].isspace():
        n -= 1
    return n


def kept_bytes(text: bytes, spans: list[dict] | None, kind: Repeats = LONG) -> tuple[bytes, int, int]:
    """What stays of a text, how many bytes go, and in how many maximal runs."""
    merged: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    if kind.words:
        merged = [m for m in merged if m[1] - m[0] >= kind.always or whole_words(text, *m) >= kind.words]
    if not merged:
        return text, 0, 0
    bounds = [0, *[x for span in merged for x in span], len(text)]
    stays = b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
    return stays, len(text) - len(stays), len(merged)


def with_spans(docs: DataFrame, spans: DataFrame, name: str) -> DataFrame:
    """``docs`` with each text's spans, null where it has none; texts without any do not move."""
    own, digest = unused(docs, "_digest", "_md5")
    some, rest = split_by_bits(docs.withColumn(own, text_digest()), own, spans.select(F.col("digest").alias(own)))
    found = some.join(spans.toDF(digest, name), F.col(own) == F.col(digest), "left").drop(own, digest)
    return found.unionByName(rest.drop(own).withColumn(name, F.lit(None).cast(spans.schema["spans"].dataType)))


def removal(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """What is removed of every row of ``docs`` (``doc_id``, ``text``).

    Null text is empty; texts below 400 bytes lose nothing; a repeated row is elsewhere too,
    so both lose every byte from 400 up. Other columns are left out; an empty table gives none.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                stays, removed, n = kept_bytes(text, spans)
                out.append((len(text), removed, n, hashlib.sha256(stays).hexdigest()))
            a, b, c, sha = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (a, b, c)), pa.array(sha, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    narrow = docs.select("doc_id", "text")
    joined = with_spans(narrow, spans_by_text(narrow, hot), "_spans")
    rows = joined.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), "_spans")
    return rows.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, hot: int = HOT, kind: Repeats = PASSAGES) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text``; the other columns as they are.

    A character that a cut parts goes as a whole. ``n_chars``, if there, is counted anew.
    Null text stays null; every row stays, if with an empty text. Repeated rows both lose
    all that ``kind`` takes; an empty table stays empty.
    """
    (name,) = unused(docs, "_spans")
    joined = with_spans(docs, spans_by_text(docs.select("doc_id", "text"), hot, kind), name)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        def one(text, s):
            return None if text is None or s is None else kept_bytes(text.encode("utf-8"), json.loads(s), kind)[0].decode("utf-8", "ignore")

        return pd.Series([one(t, s) for t, s in zip(texts, spans, strict=True)], dtype="object")

    text = F.when(F.col(name).isNull(), F.col("text")).otherwise(cut(F.when(F.col(name).isNotNull(), F.col("text")), F.to_json(name)))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[f"`{c}`" for c in docs.columns])
