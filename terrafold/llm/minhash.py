"""Near duplicates by banded MinHash, verified with odd sketches and then exactly.

Documents with equal shingle sets form a class; classes are compared. 384 minima per class
make 64 bands of 6; classes that share a band are candidates. An odd sketch folds the same
minima into 1024 parity bits: two sketches' XOR count estimates how many minima differ, and
most chance candidates end there. What is left is confirmed on the full sets.

A bucket of a band first tests its members against the least one. Where links do not yet
join a bucket's members, a block of members compares sketches across components and fetches
its members' texts once, and confirms in place, most similar first, skipping what its links
have joined. A pair is tested in its first common band only. So no group is turned into all
its pairs, and no link between components is lost.

A pair of similarity 0.75 shares no band with a chance of 4 in a million, and the sketch
limit, similarity 0.60 by estimate, is over five standard errors below.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import as_bytes, chunks, keep, mixed, part_ids, small_batches, small_side, unused
from terrafold.llm.components import components
from terrafold.llm.shingles import sets_of, shingle_sets

BANDS, ROWS = 64, 6
HASHES = BANDS * ROWS
SKETCH_BITS = 1024
SKETCH_WORDS = SKETCH_BITS // 64
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Similarity by sketch below which a candidate is dropped, and its XOR count.
ESTIMATE = 0.60
MOST_FLIPS = int(SKETCH_BITS / 2 * (1 - np.exp(-2 * (2 * HASHES * (1 - ESTIMATE)) / SKETCH_BITS)))
#: Members of a bucket, and bytes of their texts, that one comparison block holds.
BLOCK, BLOCK_BYTES = 1024, 16 << 20
_random = np.random.Generator(np.random.PCG64(7))
XORS = _random.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)
FACTORS = (_random.integers(0, 1 << 31, HASHES, np.uint64) * 2 + 1).astype(np.uint32)
BAND_FACTORS = _random.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)


def minima(values: np.ndarray) -> np.ndarray:
    """The least value of a set under each hash function."""
    low = (values >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(low), 256):
        np.minimum(out, ((low[a : a + 256, None] ^ XORS) * FACTORS).min(0), out=out)
    return out


def bands(minimum: np.ndarray) -> np.ndarray:
    """A key for each band of each row of minima."""
    summed = (minimum.astype(np.uint64) * BAND_FACTORS).reshape(-1, BANDS, ROWS).sum(2, dtype=np.uint64)
    return mixed(summed + np.arange(BANDS, dtype=np.uint64))


def odd_sketches(minimum: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the minima: sample i with value m flips one bit that both name."""
    rows = len(minimum)
    named = mixed((minimum.astype(np.uint64) << np.uint64(16)) + np.arange(HASHES, dtype=np.uint64))
    bit = (named >> np.uint64(54)).astype(np.int64) + np.arange(rows)[:, None] * SKETCH_BITS
    flips = np.bincount(bit.ravel(), minlength=rows * SKETCH_BITS).reshape(rows, SKETCH_BITS) & 1
    return np.packbits(flips.astype(np.uint8), axis=1).view(np.uint64)


def similarity(flips: np.ndarray) -> np.ndarray:
    """Jaccard similarity by the XOR count of two odd sketches."""
    rest = np.maximum(1 - 2 * flips / SKETCH_BITS, 1e-9)
    return 1 + SKETCH_BITS / (4 * HASHES) * np.log(rest)


def signatures(docs: DataFrame) -> DataFrame:
    """Set size, set digest, text digest, bands and odd sketch of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["row_id", "doc_id", "n_shingles", "n_bytes", "digest", "text_sha", "bands", "sketch"]

    def run(batches):
        used = 0
        for batch in batches:
            raw, offsets = as_bytes(batch.column(1))
            for lo, hi in chunks(offsets, most=2048):
                own = offsets[lo : hi + 1]
                part = raw[own[0] : own[-1]]
                sets = shingle_sets(part, own - own[0])
                some = [s for s in sets if len(s)]
                minimum = np.array([minima(s) for s in some], np.uint32).reshape(-1, HASHES)
                full = np.array([len(s) > 0 for s in sets])
                at = pa.array(np.append(0, np.cumsum(full)).astype(np.int32))
                lists = []
                for table, width in ((bands(minimum), BANDS), (odd_sketches(minimum), SKETCH_WORDS)):
                    flat = pa.array(table.reshape(-1).view(np.int64))
                    lists.append(pa.ListArray.from_arrays(pa.array(np.asarray(at) * np.int32(width)), flat))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part_ids(hi - lo, used)),
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.diff(own)),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([hashlib.sha256(raw[a:b]).digest() for a, b in zip(own[:-1], own[1:], strict=True)], pa.binary()),
                        *lists,
                    ],
                    names,
                )
                used += hi - lo

    return docs.select("doc_id", "text").mapInArrow(
        run, f"row_id long, doc_id {id_type}, n_shingles long, n_bytes long, digest binary, text_sha binary, bands array<long>, sketch array<long>"
    )


def flips(left: str, right: str):
    """XOR count of two sketch columns."""
    return F.expr(" + ".join(f"bit_count({left}[{i}] ^ {right}[{i}])" for i in range(SKETCH_WORDS)))


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose set sizes and sketches allow a link."""
    side = lambda c: classes.select(F.col("cid").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    near = f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)"
    return both.filter(near).filter(flips("s_a", "s_b") <= MOST_FLIPS).select("a", "b")


def full_texts(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """A text of each class in ``wanted`` (column ``cid``)."""
    wanted = keep(classes.join(wanted, "cid", "left_semi").select("cid", "rep_doc", "rep_sha"), "wanted")
    text = F.coalesce("text", F.lit("")).cast("binary")
    own = docs.select("doc_id", text.alias("text")).join(small_side(wanted, "56"), F.col("doc_id").eqNullSafe(F.col("rep_doc")))
    # Rows that repeat a doc_id with another text are not the class's.
    return keep(own.filter(F.unhex(F.sha2("text", 256)) == F.col("rep_sha")).select("cid", "text").dropDuplicates(["cid"]), "texts")


def enough(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two full sets reach the similarity."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    texts = full_texts(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct(), classes, docs)
    both = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")

    def run(frames):
        last, held = None, None
        for f in frames:
            out = []
            for a, b, text_b, text_a in f.itertuples(index=False):
                if a != last:
                    last, held = a, sets_of([text_a])[0]
                if enough(held, sets_of([text_b])[0]):
                    out.append((a, b))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return both.select("a", "b", "text_b", "text_a").mapInPandas(run, "a long, b long")


def open_blocks(members: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Blocks of bucket members that links have not joined, with their likely pairs.

    The hub is left out. A bucket of many members, or of long texts, is dealt out in pairs of
    blocks of about ``BLOCK`` members and ``BLOCK_BYTES`` of text at most. A row has the pairs
    of a block, most similar first, as two byte strings of ids.
    """
    labelled = members.filter("cid <> hub").join(labels.select(F.col("v").alias("cid"), "l"), "cid", "left")
    labelled = keep(labelled.join(classes.select("cid", "n_bytes"), "cid").select("key", "cid", F.coalesce("l", "cid").alias("comp"), "n_bytes"), "members")
    found = labelled.groupBy("key").agg(
        F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("m"), F.sum("n_bytes").alias("total")
    )
    parts = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("total") / BLOCK_BYTES)).cast("int")
    open_ = keep(found.filter("x <> y").select("key", parts.alias("blocks")), "open")
    own = labelled.drop("n_bytes").join(small_side(open_, "16"), "key").join(classes.select("cid", "n_shingles", "sketch", "bands"), "cid")
    own = own.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    names = ["key", "low", "high", "block", "cid", "comp", "n_shingles", "sketch", "bands"]

    def compare(g: pd.DataFrame) -> list[tuple]:
        key, low, high = (g[c].iloc[0] for c in ("key", "low", "high"))
        sketch = np.stack(g["sketch"].to_numpy()).astype(np.int64).view(np.uint64)
        band = np.stack(g["bands"].to_numpy()).astype(np.int64)
        cid, comp, n, block = (g[c].to_numpy(np.int64) for c in ("cid", "comp", "n_shingles", "block"))
        found = []
        for i in range(len(g) - 1):
            ok = comp[i + 1 :] != comp[i]
            ok &= 100 * np.minimum(n[i + 1 :], n[i]) >= PERCENT * np.maximum(n[i + 1 :], n[i])
            if low != high:
                ok &= block[i + 1 :] != block[i]
            j = np.flatnonzero(ok) + i + 1
            flipped = np.bitwise_count(sketch[j] ^ sketch[i]).sum(1)
            j, flipped = j[flipped <= MOST_FLIPS], flipped[flipped <= MOST_FLIPS]
            # Only the first band that the two share tests them.
            first = band[i][(band[j] == band[i]).argmax(1)] == key
            if first.any():
                found.append(np.stack([np.full(first.sum(), cid[i]), cid[j[first]], flipped[first].astype(np.int64)]))
        if not found:
            return []
        pairs = np.concatenate(found, axis=1)
        pairs = pairs[:, np.argsort(pairs[2], kind="stable")]
        return [(key, low, high, pairs[0].tobytes(), pairs[1].tobytes())]

    def run(frames):
        rest = None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            where = f[["key", "low", "high"]].to_numpy()
            cuts = np.flatnonzero((where[1:] != where[:-1]).any(1)) + 1
            yield from answer(f, cuts)
            rest = f.iloc[cuts[-1] if len(cuts) else 0 :]
        if rest is not None and len(rest):
            yield from answer(rest, np.array([len(rest)]))

    def answer(f, cuts):
        rows = [r for a, b in zip([0, *cuts[:-1]], cuts, strict=True) for r in compare(f.iloc[a:b])] if len(cuts) else []
        if rows:
            yield pd.DataFrame(rows, columns=["key", "low", "high", "a", "b"])

    dealt = own.select(*names).repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInPandas(run, "key long, low int, high int, a binary, b binary")


def confirmed_in_blocks(blocks: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links that join what is apart in each block; every member's text comes once a block."""

    def named(frames):
        for f in frames:
            ids = [np.unique(np.frombuffer(a + b, np.int64)) for a, b in zip(f["a"], f["b"], strict=True)]
            sizes = [len(x) for x in ids]
            yield pd.DataFrame({c: np.repeat(f[c].to_numpy(), sizes) for c in ("key", "low", "high")} | {"cid": np.concatenate(ids)})

    needed = keep(blocks.mapInPandas(named, "key long, low int, high int, cid long"), "needed")
    texts = needed.join(full_texts(needed.select("cid").distinct(), classes, docs), "cid")

    def confirm(where: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(where) and len(held):
            text, sets = dict(zip(held["cid"], held["text"], strict=True)), {}
            parent: dict[int, int] = {}

            def root(x):
                while x in parent:
                    x = parent[x]
                return x

            def own(x):
                if x not in sets:
                    sets[x] = sets_of([text[x]])[0]
                return sets[x]

            for row in where.itertuples(index=False):
                for x, y in zip(np.frombuffer(row.a, np.int64).tolist(), np.frombuffer(row.b, np.int64).tolist(), strict=True):
                    if root(x) != root(y) and enough(own(x), own(y)):
                        parent[root(x)] = root(y)
                        out.append((min(x, y), max(x, y)))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    place = ["key", "low", "high"]
    return blocks.groupBy(*place).cogroup(texts.groupBy(*place)).applyInPandas(confirm, "a long, b long")


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of rows, classes of equal sets, and the component of linked classes."""
    small_batches(docs)
    signed = keep(signatures(docs), "signatures")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id", "text_sha"))
    grouped = signed.filter("digest is not null").groupBy("digest").agg(least.alias("rep"))
    chosen = keep(
        grouped.select("digest", F.col("rep.row_id").alias("cid"), F.col("rep.doc_id").alias("rep_doc"), F.col("rep.text_sha").alias("rep_sha")), "classes"
    )
    own = signed.select(F.col("row_id").alias("cid"), "n_shingles", "n_bytes", "bands", "sketch")
    classes = own.join(small_side(chosen.drop("digest"), "56"), "cid")
    keyed = classes.select("cid", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("cid").alias("hub"), F.max("cid").alias("last")).filter("hub <> last")
    shared = keep(shared.select("key", "hub"), "shared")
    members = keep(keyed.join(small_side(shared, "16"), "key"), "members")
    involved = members.select("cid").distinct()
    classes = keep(classes.join(involved, "cid", "left_semi"), "involved")
    pairs = members.filter("cid <> hub").select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()
    links = keep(confirmed(keep(likely(pairs, classes), "likely"), classes, docs), "links")
    labels = components(links)
    blocks = keep(open_blocks(members, labels, classes), "blocks")
    if blocks.limit(1).count():
        links = keep(links.union(confirmed_in_blocks(blocks, classes, docs)), "links")
        labels = components(links)
    return signed, chosen, labels


def labelled(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signatures, and for each set digest its component: least row and doc_id."""
    signed, chosen, labels = linked(docs)
    grouped = chosen.join(labels.withColumnRenamed("v", "cid"), "cid", "left").withColumn("l", F.coalesce("l", "cid"))
    heads = grouped.groupBy("l").agg(F.min(F.struct(F.col("rep_doc").isNull().alias("none"), "rep_doc", "cid")).alias("head"))
    of_class = grouped.join(heads, "l").select("digest", F.col("head.rep_doc").alias("component_id"), F.col("head.cid").alias("head_row"))
    return signed, keep(of_class, "components")


def groups(docs: DataFrame) -> DataFrame:
    """Component of every row of ``docs`` (``doc_id``, ``text``).

    ``n_shingles`` is the size of the row's set, ``component_id`` the least ``doc_id``
    reachable over links, ``kept`` whether that is the row's own. Null text or text without
    words has an empty set and stays alone. Rows that repeat a ``doc_id`` are rows like
    others; null ids come last in a component. Other columns are left out; an empty table
    gives none.
    """
    signed, of_class = labelled(docs)
    out = signed.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every component, the one of least ``doc_id``; the columns of ``docs``.

    Rows without words stay. Of rows equal in ``doc_id`` and text one stays.
    """
    signed, of_class = labelled(docs)
    rows = signed.select("doc_id", "row_id", "digest", "text_sha").join(of_class, "digest", "left")
    rows = rows.filter("digest is null or row_id = head_row").select("doc_id", "text_sha", F.isnull("digest").alias("_wordless"))
    theirs, sha, wordless, own = unused(docs, "_id", "_sha", "_wordless", "_own_sha")
    signs = keep(rows.distinct(), "kept").toDF(theirs, sha, wordless)
    text_sha = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    found = docs.withColumn(own, text_sha).join(
        small_side(signs, "48"), F.col("doc_id").eqNullSafe(F.col(theirs)) & (F.col(own) == F.col(sha))
    )
    columns = [f"`{c}`" for c in docs.columns]
    repeated = signed.filter("digest is not null").groupBy("doc_id", "text_sha").count().filter("count > 1")
    if not repeated.limit(1).count():
        return found.select(*columns)
    once = found.filter(~F.col(wordless)).dropDuplicates(["doc_id", own])
    return once.unionByName(found.filter(wordless)).select(*columns)
