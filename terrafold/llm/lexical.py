"""Ranked lexical search as exact inner products over sparse ball trees.

A document is a sparse vector of integers over the terms that queries hold, a query one of
integer weights; the score is their inner product. A task gathers blocks of documents and
builds a tree over each: a node has the sparse centroid of its documents, the radius that
covers them and along each term how far they reach above the centroid, so no document of it
scores above ``q.c + |q| r`` nor above ``q.(c + reach)``. Each query opens nodes best
first and stops when the best bound left is below its worst kept score. Bounds are in floating
point and rounded up by more than their error; leaves are scored in integers.

Texts are read once and stay where they lie. What moves is, for every document, the counts of
terms that queries hold, and of each task's best documents ``k`` for every query. Queries are
handled in waves of bounded size, and only a wave's terms reach the driver.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.common import POWERS, as_bytes, chunks, keep, mixed, small_batches

#: Documents kept for each query.
K = 10
#: Bytes of query texts in a wave, queries that meet a tree at once.
WAVE_BYTES, TOGETHER = 4 << 20, 256
#: Documents of a tree and of a leaf; about so many documents give the first worst scores.
BLOCK, LEAF, SAMPLE = 4096, 64, 20_000
#: Relative margin above the rounding errors of a bound, and of a squared radius.
MARGIN, SQUARE = 1e-9, 1e-10
NO_ID = np.iinfo(np.int64).max

#: Every byte as terms see it: A-Z small, other ASCII outside terms a blank.
SEEN = np.arange(256, dtype=np.uint8)
SEEN[ord("A") : ord("Z") + 1] += 32
SEEN[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32


def term_ranges(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Small-letter bytes of a chunk, where its terms begin and end, each document's first term."""
    seen = SEEN[raw]
    inside = seen > 32
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | border[1 : len(raw)]
    over = np.ones(len(raw) + 1, bool)
    over[:-1] = ~inside | border[:-1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(over[1:] & inside) + 1
    return seen, begin, end, np.searchsorted(begin, offsets)


def terms_of(text: str | None) -> list[bytes]:
    """Terms of one text."""
    raw = np.frombuffer((text or "").encode("utf-8"), np.uint8)
    seen, begin, end, _ = term_ranges(raw, np.array([0, len(raw)]))
    data = seen.tobytes()
    return [data[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


class Vocabulary:
    """Numbers of the terms that queries hold; found by hash, confirmed byte by byte."""

    def __init__(self, terms: list[bytes]):
        data = np.frombuffer(b"".join(terms), np.uint8)
        end = np.cumsum([len(t) for t in terms]).astype(np.int64)
        begin = end - np.array([len(t) for t in terms], np.int64)
        hashes = mixed(POWERS.between(POWERS.prefix(data), begin, end))
        order = np.argsort(hashes, kind="stable")
        self.terms, self.hashes, self.number = terms, hashes[order], order.astype(np.int32)
        self.unique = bool((self.hashes[1:] != self.hashes[:-1]).all())
        self.size = np.array([len(t) for t in terms], np.int64)
        self.head, self.tail = self._ends(data, begin, end)

    @staticmethod
    def _ends(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last eight bytes of each range, shorter ones filled with zeros."""
        padded = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        short = np.minimum(end - begin, 8).astype(np.uint64)
        mask = ~np.uint64(0) >> ((np.uint64(8) - short) * np.uint64(8))
        return eight[begin + 8] & mask, eight[end] >> ((np.uint64(8) - short) * np.uint64(8))

    def numbers(self, seen: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each term, -1 if no query holds it."""
        out = np.full(len(begin), -1, np.int32)
        if not len(begin) or not len(self.terms):
            return out
        if not self.unique:
            known, data = {t: i for i, t in enumerate(self.terms)}, seen.tobytes()
            return np.array([known.get(data[a:b], -1) for a, b in zip(begin.tolist(), end.tolist(), strict=True)], np.int32)
        hashes = mixed(POWERS.between(POWERS.prefix(seen), begin, end))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        some = np.flatnonzero(self.hashes[at] == hashes)
        number, begin, end = self.number[at[some]], begin[some], end[some]
        head, tail = self._ends(seen, begin, end)
        same = (self.size[number] == end - begin) & (self.head[number] == head) & (self.tail[number] == tail)
        for i in np.flatnonzero(same & (end - begin > 16)).tolist():
            same[i] = self.terms[number[i]] == seen[begin[i] : end[i]].tobytes()
        out[some[same]] = number[same]
        return out


def counted(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``n`` terms of every document, and how often it holds each term of the vocabulary."""
    size = max(len(vocabulary.terms), 1)

    def run(batches):
        for batch in batches:
            raw, offsets = as_bytes(batch.column(1))
            for lo, hi in chunks(offsets):
                own = offsets[lo : hi + 1]
                seen, begin, end, first = term_ranges(raw[own[0] : own[-1]], own - own[0])
                number = vocabulary.numbers(seen, begin, end)
                document = np.repeat(np.arange(hi - lo), np.diff(first))
                keys, times = np.unique((document * size + number)[number >= 0], return_counts=True)
                bounds = pa.array(np.searchsorted(keys, np.arange(hi - lo + 1) * size).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(np.diff(first).astype(np.int64)),
                        pa.ListArray.from_arrays(bounds, pa.array((keys % size).astype(np.int32))),
                        pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))),
                    ],
                    ["doc_id", "n", "terms", "tf"],
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<int>")


@dataclass
class Rows:
    """Sparse integer rows: row i has ``index[at[i]:at[i + 1]]`` and the values there."""

    at: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def take(self, rows: np.ndarray) -> Rows:
        size = self.at[rows + 1] - self.at[rows]
        at = np.append(0, np.cumsum(size))
        place = np.arange(at[-1]) + np.repeat(self.at[rows] - at[:-1], size)
        return Rows(at, self.index[place], self.value[place])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """Inner products with a dense vector; no row is empty."""
        return np.add.reduceat(self.value * dense[self.index], self.at[:-1])


class BallTree:
    """Nodes over documents in an order in which every node's documents stand together."""

    def __init__(self, rows: Rows, width: int, leaf: int = LEAF):
        self.leaf, self.width = leaf, width
        self.low: list[int] = []
        self.high: list[int] = []
        self.radius: list[float] = []
        self.children: list[tuple[int, ...]] = []
        self.centers: list[tuple[np.ndarray, np.ndarray]] = []
        self.order: list[np.ndarray] = []
        self.done = 0
        floats = Rows(rows.at, rows.index, rows.value.astype(np.float64))
        square = np.add.reduceat(floats.value**2, floats.at[:-1])
        self._node(floats, square, np.arange(len(square)))
        self.order = np.concatenate(self.order)
        self.rows = rows.take(self.order)

    @staticmethod
    def _far(rows: Rows, square: np.ndarray, center: np.ndarray) -> tuple[np.ndarray, float]:
        """Squared distances to a dense centre, and more than their rounding error."""
        own = float((center**2).sum())
        return square - 2 * rows.dot(center) + own, SQUARE * (float(square.max()) + own)

    def _node(self, rows: Rows, square: np.ndarray, members: np.ndarray) -> int:
        number, n = len(self.low), len(members)
        center = np.bincount(rows.index, rows.value, self.width) / n
        far, error = self._far(rows, square, center)
        some = np.flatnonzero(center)
        self.low.append(self.done)
        self.high.append(0)
        self.radius.append(math.sqrt(max(float(far.max()), 0.0) + error))
        self.children.append(())
        self.centers.append((some, center[some]))
        parts = ()
        if n > self.leaf and far.max() > error:
            to = []
            for _ in range(2):
                pivot = int(far.argmax())
                one = rows.take(np.array([pivot]))
                far = self._far(rows, square, np.bincount(one.index, one.value, self.width))[0]
                to.append(far)
            order = np.argsort(to[0] - to[1], kind="stable")
            # By the nearer of two far documents, if that leaves neither side with next to nothing.
            cut = int((to[0] <= to[1]).sum())
            cut = cut if 0.1 * n <= cut <= 0.9 * n else n // 2
            parts = (order[:cut], order[cut:])
        if parts:
            self.children[number] = tuple(self._node(rows.take(p), square[p], members[p]) for p in parts)
        else:
            self.order.append(members)
            self.done += n
        self.high[number] = self.done
        return number

    def bounds(self, queries: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """For every query (dense, over ``columns``) and node, above all scores in the node."""
        place = np.full(self.width, -1)
        place[columns] = np.arange(len(columns))
        centers, most = (np.zeros((len(self.low), len(columns))) for _ in range(2))
        for i, (index, value) in enumerate(self.centers):
            own = place[index]
            centers[i, own[own >= 0]] = value[own >= 0]
        leaf = np.zeros(self.done, np.int64)
        for i, parts in enumerate(self.children):
            if not parts:
                leaf[self.low[i] : self.high[i]] = i
        own = place[self.rows.index]
        some = own >= 0
        # The greatest value of each term in a node: centroid and reach together.
        np.maximum.at(most, (np.repeat(leaf, np.diff(self.rows.at))[some], own[some]), self.rows.value[some].astype(np.float64))
        for i in reversed(range(len(self.low))):
            for child in self.children[i]:
                np.maximum(most[i], most[child], out=most[i])
        norm = np.sqrt((queries**2).sum(1))
        ball = queries @ centers.T + norm[:, None] * np.array(self.radius)[None, :]
        return np.minimum(ball, queries @ most.T) * (1 + MARGIN) + 1.0


class Best:
    """The ``k`` best documents of every query so far, by score, then id."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.score = np.zeros((n, k), np.int64)
        self.found = np.full((n, k), NO_ID, np.int64)

    def worst(self, query: int) -> int:
        """A document below this score cannot count; one at it may."""
        return max(int(self.score[query, -1]), int(self.floor[query]), 1)

    def offer(self, query: int, score: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.worst(query)
        if good.any():
            scores = np.append(self.score[query], score[good])
            found = np.append(self.found[query], ids[good])
            order = np.lexsort((found, -scores))[: self.k]
            self.score[query], self.found[query] = scores[order], found[order]


def search(tree: BallTree, ids: np.ndarray, queries: list[tuple[np.ndarray, np.ndarray]], best: Best) -> int:
    """Offer every query the documents that can count; how many leaves were scored."""
    scored, own = 0, ids[tree.order]
    for lo in range(0, len(queries), TOGETHER):
        part = queries[lo : lo + TOGETHER]
        columns = np.unique(np.concatenate([q[0] for q in part]))
        dense = np.zeros((len(part), len(columns)), np.int64)
        for i, (index, weight) in enumerate(part):
            dense[i, np.searchsorted(columns, index)] = weight
        tops = tree.bounds(dense.astype(np.float64), columns)
        whole = np.zeros(tree.width, np.int64)
        for i in range(len(part)):
            top, query = tops[i], lo + i
            heap, ready = [(-top[0], 0)], False
            while heap:
                above, node = heapq.heappop(heap)
                if -above < best.worst(query):
                    break
                if tree.children[node]:
                    for child in tree.children[node]:
                        if top[child] >= best.worst(query):
                            heapq.heappush(heap, (max(above, -top[child]), child))
                    continue
                if not ready:
                    whole[columns], ready = dense[i], True
                a, b = tree.low[node], tree.high[node]
                at = tree.rows.at[a : b + 1]
                leaf = Rows(at - at[0], tree.rows.index[at[0] : at[-1]], tree.rows.value[at[0] : at[-1]])
                best.offer(query, leaf.dot(whole), own[a:b])
                scored += 1
        whole[columns] = 0
    return scored


def document_values(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """A term's part of a document's score before the query's weight."""
    m = 100 - 75 + (75 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def best_of_tasks(kept: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], width: int, totals: tuple[int, int], floor: np.ndarray, k: int) -> DataFrame:
    """Of every task the ``k`` best documents for each query that reach its floor."""
    documents, length = totals

    def blocks(batches):
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= BLOCK:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches):
        best = Best(len(queries), k, floor)
        for table in blocks(batches):
            ids = table.column("doc_id").combine_chunks().fill_null(NO_ID).to_numpy()
            terms, tf = (table.column(c).combine_chunks() for c in ("terms", "tf"))
            at = terms.offsets.to_numpy().astype(np.int64)
            base = at[0]
            index = terms.values.to_numpy()[base : at[-1]].astype(np.int64)
            times = tf.values.to_numpy()[tf.offsets[0].as_py() : tf.offsets[-1].as_py()].astype(np.int64)
            n = np.repeat(table.column("n").to_numpy(), np.diff(at))
            rows = Rows(at - base, index, document_values(times, n, documents, length))
            search(BallTree(rows, width), ids, queries, best)
        query, place = np.nonzero(best.score)
        found = best.found[query, place]
        yield pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int64()), pa.array(found, mask=found == NO_ID), pa.array(best.score[query, place])], ["query", "doc_id", "score"]
        )

    wanted = kept.filter("size(terms) > 0").select("doc_id", "n", "terms", "tf")
    return wanted.mapInArrow(run, "query long, doc_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def weight(documents: int, df: int) -> int:
    """Of a term that ``df`` of all documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def search_wave(docs: DataFrame, items: list[tuple[int, str]], k: int, sample: int) -> DataFrame:
    """Best documents of a wave of items."""
    spark = docs.sparkSession
    held = [Counter(terms_of(text)) for _, text in items]
    terms = sorted({t for own in held for t in own})
    number = {t: i for i, t in enumerate(terms)}
    kept = keep(counted(docs, Vocabulary(terms)), "terms")
    documents, length = kept.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r["term"]: r["count"] for r in kept.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    queries = []
    for own in held:
        index = np.array(sorted(number[t] for t in own), np.int64)
        queries.append((index, np.array([own[terms[i]] * weight(documents, df.get(i, 0)) for i in index.tolist()], np.int64)))
    floor = np.zeros(len(items), np.int64)
    totals = documents, max(length, 1)
    if documents > 2 * sample:
        some = kept.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(1 << 30)) < int((1 << 30) * sample / documents))
        first = ranked(best_of_tasks(some, queries, len(terms), totals, floor, k), k).filter(F.col("rank") == k)
        for r in first.collect():
            floor[r["query"]] = r["score"]
    best = ranked(best_of_tasks(kept, queries, len(terms), totals, floor, k), k)
    names = F.broadcast(spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "query long, item_id long"))
    return best.join(names, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def top_documents(docs: DataFrame, items: DataFrame, k: int = K, wave_bytes: int = WAVE_BYTES, sample: int = SAMPLE) -> DataFrame:
    """The ``k`` documents of highest score above 0 for every item, ties to the smaller id.

    ``docs`` have ``doc_id`` and ``text``, ``items`` have ``item_id`` and ``text``; other columns
    are left out. Null or termless texts find nothing and are not found; documents that repeat
    are found each, a null id comes after all others; of items that repeat an id the one of
    least text asks, an item without an id asks nothing. Empty tables give no rows.

    Items are dealt by a hash into waves of about ``wave_bytes`` of text, each a search of
    its own. About ``sample`` documents give every query a first worst score; all documents are
    searched whatever it is.
    """
    small_batches(docs)
    one = items.filter("item_id is not null and text is not null").groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min("text").alias("text"))
    size = one.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    waves = max(1, -(-size // wave_bytes))
    out = None
    for i in range(waves):
        part = one.filter(F.pmod(F.xxhash64("item_id"), F.lit(waves)) == i).orderBy("item_id").collect()
        if part:
            found = search_wave(docs, [(r["item_id"], r["text"]) for r in part], k, sample)
            out = found if out is None else out.union(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
