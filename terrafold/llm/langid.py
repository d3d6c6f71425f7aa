"""Language of a text by the nearest of several centroids per language.

A text is a normalised TF-IDF vector over hashed byte 1-, 2- and 3-grams of its letters. A
bounded sample of labelled rows is clustered per language (spherical k-means); a text gets
the language of the centroid with the largest cosine. A text further from every centroid
than labelled texts of its length ever are is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import CHUNK_BYTES, as_bytes, chunks, small_batches, unused
from terrafold.llm.pretokens import LETTER, classes

#: Labelled rows that the classifier is fitted on, all languages together.
SAMPLE_ROWS = 2000
#: Centroids of each language.
CLUSTERS = 4
#: Dimensions: single bytes, hashed pairs, hashed triples.
ONE, TWO, THREE = 256, 2048, 4096
DIMENSIONS = ONE + TWO + THREE
#: Labelled rows of each power of two of bytes that are looked at for the least cosines.
CLASS_ROWS = 40
#: Labelled texts of about a length from which its least cosine is taken.
ENOUGH = 20
#: A text is rejected below this share of the least cosine of labelled texts of its length.
MARGIN = 0.55

#: What a byte counts as: letters in lower case, parts of other characters, blank.
FOLD = np.full(256, 32, np.uint8)
FOLD[0x80:] = np.arange(0x80, 0x100)
FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """n-gram counts of every document of a chunk, one row each."""
    rows = len(offsets) - 1
    out = np.zeros((rows, DIMENSIONS), np.int64)
    start, end = int(offsets[0]), int(offsets[-1])
    for low in range(start, end, CHUNK_BYTES // 2):
        high = min(low + CHUNK_BYTES // 2, end)
        b = FOLD[raw[low : min(high + 2, end)]].astype(np.uint32)
        n = high - low
        row = (np.searchsorted(offsets, np.arange(low, high), "right") - 1) if rows > 1 else np.zeros(n, np.int64)
        stop = offsets[row + 1] - low  # the n-gram ends before its document does
        at = np.arange(n)
        letter = b[:n] != 32
        grams = [(letter, b[:n])]
        if len(b) > 1:
            m = min(n, len(b) - 1)
            pair = (b[:m] * np.uint32(0x9E3779B1) + b[1 : m + 1] * np.uint32(0x85EBCA77)) * np.uint32(0xC2B2AE3D)
            ok = (at[:m] + 2 <= stop[:m]) & (letter[:m] | (b[1 : m + 1] != 32))
            grams.append((ok, ONE + (pair >> np.uint32(21))))
        if len(b) > 2:
            m = min(n, len(b) - 2)
            triple = (b[:m] * np.uint32(0x9E3779B1) + b[1 : m + 1] * np.uint32(0x85EBCA77) + b[2 : m + 2] * np.uint32(0x27D4EB2F)) * np.uint32(0xC2B2AE3D)
            ok = (at[:m] + 3 <= stop[:m]) & (b[1 : m + 1] != 32)
            grams.append((ok, ONE + TWO + (triple >> np.uint32(20))))
        for ok, bins in grams:
            m = len(ok)
            index = row[:m][ok] * DIMENSIONS + bins[ok]
            out += np.bincount(index, minlength=rows * DIMENSIONS).reshape(rows, DIMENSIONS)
    return out


def vectors(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF; a text without n-grams is the zero vector."""
    v = np.log1p(count.astype(np.float32)) * idf
    norm = np.sqrt((v * v).sum(1, keepdims=True))
    return v / np.where(norm > 0, norm, 1)


def has_letter(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each document holds a letter of any script."""
    lower = raw | np.uint8(32)
    plain = np.append(0, np.cumsum((lower >= ord("a")) & (lower <= ord("z"))))
    out = plain[offsets[1:]] > plain[offsets[:-1]]
    for i in np.flatnonzero(~out):
        own = raw[offsets[i] : offsets[i + 1]]
        if len(own) and own.max() >= 0x80:
            points = np.frombuffer(own.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
            out[i] = bool((classes()[points] == LETTER).any())
    return out


def size_class(count: np.ndarray) -> np.ndarray:
    """Texts of a like number of letters: powers of two."""
    return np.log2(np.maximum(count[:, :ONE].sum(1), 1)).astype(int)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    #: Least cosine that is not rejected, by :func:`size_class`.
    least: np.ndarray

    def classify(self, raw: np.ndarray, offsets: np.ndarray):
        """Language, cosine and rejection of every document of a chunk."""
        known = has_letter(raw[offsets[0] : offsets[-1]], offsets - offsets[0])
        if not len(self.centroids):
            return np.array(["und"] * len(known), object), np.zeros(len(known)), ~known
        count = counts(raw, offsets)
        cosine = vectors(count, self.idf) @ self.centroids.T
        best = cosine.argmax(1)
        score = np.clip(cosine[np.arange(len(best)), best].astype(float), 0, 1)
        language = np.array(self.languages, object)[best]
        far = score < self.least[np.minimum(size_class(count), len(self.least) - 1)]
        language[~known] = "und"
        return language, np.where(known, score, 0.0), ~known | far


def cluster(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread-out first centroids; at most ``k`` of them."""
    centers = [v.mean(0)]
    for _ in range(min(k, len(v)) - 1):
        centers.append(v[(v @ np.array(centers).T).max(1).argmin()])
    c = np.array(centers)
    for _ in range(rounds):
        c /= np.maximum(np.sqrt((c * c).sum(1, keepdims=True)), 1e-12)
        near = (v @ c.T).argmax(1)
        c = np.array([v[near == j].mean(0) for j in range(len(c)) if (near == j).any()])
    return c / np.maximum(np.sqrt((c * c).sum(1, keepdims=True)), 1e-12)


def held_out(doc_id="doc_id"):
    """Rows whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, clusters: int = CLUSTERS) -> Model:
    """Fit on about ``rows`` labelled rows that are not held out, as many of each language.

    Lengths that are rare among these get up to ``CLASS_ROWS`` rows more, which count for
    the least cosines only.
    """
    length = F.floor(F.log2(F.greatest(F.coalesce(F.octet_length("text"), F.lit(0)), F.lit(1)))).cast("int")
    labelled = docs.filter(~held_out() & F.col("lang").isNotNull())
    numbers = labelled.groupBy("lang", length.alias("length")).count().collect()
    per: dict = {}
    for r in numbers:
        per[r["lang"]] = per.get(r["lang"], 0) + r["count"]
    if not per:
        return Model(np.ones(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32), [], np.zeros(1))
    quota = max(1, rows // len(per))
    share = F.create_map(*[x for k, n in per.items() for x in (F.lit(k), F.lit(min(1.0, quota / n)))])
    of_length: dict[int, list[float]] = {}
    for r in numbers:
        both = of_length.setdefault(r["length"], [0, 0.0])
        both[0] += r["count"]
        both[1] += r["count"] * min(1.0, quota / per[r["lang"]])
    more = {k: min(1.0, CLASS_ROWS / n) for k, (n, expected) in of_length.items() if expected < CLASS_ROWS} or {-1: 0.0}
    extra = F.coalesce(F.create_map(*[x for k, v in more.items() for x in (F.lit(k), F.lit(v))])[length], F.lit(0.0))
    uniform = lambda name: F.pmod(F.xxhash64("doc_id", F.lit(name)), F.lit(1 << 40)) / float(1 << 40)
    in_fit = uniform("fit") < share[F.col("lang")]

    def sparse(batches):
        for batch in batches:
            raw, offsets = as_bytes(batch.column(2))
            for lo, hi in chunks(offsets, CHUNK_BYTES // 2, 128):
                count = counts(raw, offsets[lo : hi + 1])
                at = [np.flatnonzero(c) for c in count]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array([a.astype("<u2").tobytes() for a in at], pa.binary()),
                        pa.array([c[a].astype("<u4").tobytes() for a, c in zip(at, count, strict=True)], pa.binary()),
                    ],
                    ["lang", "in_fit", "bins", "counts"],
                )

    drawn = labelled.filter(in_fit | (uniform("length") < extra)).select("lang", in_fit.alias("in_fit"), "text")
    drawn = drawn.mapInArrow(sparse, "lang string, in_fit boolean, bins binary, counts binary")
    rows_ = sorted((r["lang"], bytes(r["bins"]), bytes(r["counts"]), r["in_fit"]) for r in drawn.collect() if r["bins"])
    got, rare = ([g[:3] for g in rows_ if g[3] == which] for which in (True, False))
    count = np.zeros((len(got), DIMENSIONS), np.int64)
    for i, (_, bins, numbers) in enumerate(got):
        count[i, np.frombuffer(bins, "<u2")] = np.frombuffer(numbers, "<u4")
    idf = (np.log((1 + len(got)) / (1 + (count > 0).sum(0))) + 1).astype(np.float32)
    v, language = vectors(count, idf), np.array([g[0] for g in got])
    centroids, names = [], []
    for name in sorted(set(language)):
        own = cluster(v[language == name], clusters)
        centroids.append(own)
        names += [str(name)] * len(own)
    if not names:
        return Model(idf, np.zeros((0, DIMENSIONS), np.float32), [], np.zeros(1))
    centers = np.concatenate(centroids).astype(np.float32)
    nearest, size = [(v @ centers.T).max(1)], [size_class(count)]
    for _, bins, numbers_ in rare:
        one = np.zeros((1, DIMENSIONS), np.int64)
        one[0, np.frombuffer(bins, "<u2")] = np.frombuffer(numbers_, "<u4")
        nearest.append((vectors(one, idf) @ centers.T).max(1))
        size.append(size_class(one))
    return Model(idf, centers, names, least_cosines(np.concatenate(nearest), np.concatenate(size)))


def least_cosines(nearest: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The least cosine that is not rejected for each class of length.

    A class takes the least of labelled texts of its own and the neighbouring classes, if
    these are ``ENOUGH``, or else that of the nearest class that has enough (of two, the
    lower). If no class has, nothing is known and nothing rejected.
    """
    classes_ = range(size.max() + 2)
    own = {k: MARGIN * around.min() for k in classes_ if len(around := nearest[abs(size - k) <= 1]) >= ENOUGH}
    if not own:
        return np.zeros(len(classes_))
    return np.array([min((abs(k - j), least) for j, least in own.items())[1] for k in classes_])


def classify(docs: DataFrame, model: Model, new: tuple[str, ...] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``docs`` with prediction, score and rejection (named by ``new``), one row for each row.

    Only ``text`` is looked at, whole. Null text and text without any letter is ``und``,
    score 0 and rejected. A tie of centroids goes to the first in order of languages; equal
    texts get equal results. Columns of these three names are replaced, others are kept; an
    empty table stays empty.
    """
    small_batches(docs)
    rest = [c for c in docs.columns if c not in new]
    columns = [f"`{c}`" for c in rest]
    schema = type(docs.schema)([docs.schema[c] for c in rest])
    for name, kind in zip(new, ("string", "double", "boolean"), strict=True):
        schema = schema.add(name, kind)

    def run(batches):
        for batch in batches:
            raw, offsets = as_bytes(batch.column("text"))
            for lo, hi in chunks(offsets, CHUNK_BYTES // 2, 128):
                language, score, rejected = model.classify(raw, offsets[lo : hi + 1])
                own = [batch.column(c).slice(lo, hi - lo) for c in rest]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(language.tolist(), pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], [*rest, *new]
                )

    return docs.select(*columns).mapInArrow(run, schema)


def predictions(docs: DataFrame) -> DataFrame:
    """Fit and classify: the prediction of every document, by held-out or not."""
    model = fit(docs)
    found = classify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def keep_known(docs: DataFrame) -> DataFrame:
    """Rows whose language is recognised; the columns of ``docs``."""
    names = unused(docs, "_lang", "_score", "_rejected")
    found = classify(docs, fit(docs), tuple(names))
    return found.filter(~F.col(names[2])).select(*[f"`{c}`" for c in docs.columns])
