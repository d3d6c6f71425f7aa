"""Repeated strings and near duplicates against brute force."""

from __future__ import annotations

import random

import fixtures_llm as X
import numpy as np
import pytest

from terrafold.llm import minhash, suffix
from terrafold.llm.components import components


@pytest.mark.parametrize("hot", [suffix.HOT, 1])
def test_repeated_strings(spark, hot):
    draw = random.Random(1)
    passage = "".join(draw.choices("abcdefgh é€\n", k=700))
    rows = [(i, "".join(draw.choices("abcdefgh é", k=draw.randint(0, 900)))) for i in range(20)]
    rows += [(20 + i, rows[i][1] + passage[i : 420 + 13 * i] + rows[-i][1]) for i in range(1, 15)]
    rows += [(40, "ab" * 700), (41, passage), (42, passage), (43, "y" * 400), (44, "y" * 399), (45, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = X.removed([(t or "").encode() for _, t in rows])
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix.removal(df, hot).collect()}
    assert [got[i] for i, _ in rows] == want


def test_repeated_strings_of_documents(spark):
    docs = X.texts(spark)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix.removal(spark.read.parquet(f"{X.SF}/documents.parquet")).collect()}
    assert [got[i] for i in docs] == X.removed([t.encode() for t in docs.values()])


def test_repeated_strings_edges(spark):
    got = sorted(tuple(r)[1:] for r in suffix.removal(X.edge(spark)).collect())
    assert got == sorted(X.removed([(t or "").encode() for _, t, *_ in X.EDGE_ROWS]))
    assert suffix.removal(X.nothing(spark)).count() == 0
    kept = suffix.without_repeats(X.edge(spark))
    assert kept.columns == X.edge(spark).columns
    assert kept.count() == len(X.EDGE_ROWS)
    assert kept.filter("_hits <=> doc_id and n_chars <=> length(text)").count() == len(X.EDGE_ROWS)


@pytest.mark.parametrize("hot", [suffix.HOT, 1])
@pytest.mark.parametrize("kind", [suffix.PASSAGES, suffix.Repeats(64, 16, 8, 90, True), suffix.Repeats(64, 16, 8, 90), suffix.Repeats(256, 40), suffix.Repeats(264, 200)])
def test_passages(spark, kind, hot):
    """Repeated passages of 30 to 70 words, below 400 bytes, within texts of their own."""
    draw = random.Random(3)
    word = lambda: "".join(draw.choices("abcdefghijklmé", k=draw.randint(2, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in range(30, 71, 5)]
    texts = [f"{text(40)} {p} {text(30)}" for p in passages for _ in range(2)] + [text(100), "", "z" * 900, None]
    texts += [f"{text(5)}{passages[-1]}{text(5)}", passages[-2], "z" * 350]
    # Repeated within one text alone, and within one and in another.
    inner = text(80)
    texts += [f"{inner} {text(9)} {inner}", f"{passages[0]} {passages[0]} {text(3)} {passages[4]} {passages[4]}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["text"] for r in suffix.without_repeats(df, hot, kind).collect()}
    want = X.without_passages([t or "" for t in texts], kind.length, kind.words, kind.always, kind.across)
    assert [got[i] or "" for i in range(len(texts))] == want
    if kind is suffix.PASSAGES:
        long = [i for i, p in enumerate(passages) if len(p.split()) > 50]
        assert long and all(len(passages[i].encode()) < 400 for i in long)
        assert not [t for t in got.values() for i in long if t and passages[i] in t]
        assert got[len(texts) - 2] == texts[-2]


def test_near_duplicates_of_documents(spark):
    rows = list(X.texts(spark).items())
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.groups(spark.read.parquet(f"{X.SF}/documents.parquet")).collect()}
    want = X.near_components(rows)
    assert [got[i] for i, _ in rows] == [(len(X.shingles(t)), c, c == i) for (i, t), c in zip(rows, want, strict=True)]


@pytest.mark.parametrize("size", [minhash.BLOCK_BYTES, 2000])
def test_chains_within_a_bucket(spark, monkeypatch, size):
    """Texts that link to their neighbours only, and many that share a passage but no link."""
    monkeypatch.setattr(minhash, "BLOCK_BYTES", size)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 8 : i * 8 + 100])) for i in range(30)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(100 + i, passage + " " + " ".join(f"q{i}x{j}" for j in range(60))) for i in range(40)]
    draw = random.Random(2)
    base = [f"b{i}" for i in range(120)]
    for i in range(40):
        copy = list(base)
        for _ in range(draw.randint(1, 5)):
            copy[draw.randrange(120)] = f"z{i}"
        rows.append((200 + i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in minhash.groups(df).collect()}
    assert [got[i] for i, _ in rows] == X.near_components(rows)


def test_near_duplicate_edges(spark):
    rows = [(i, t) for i, t, *_ in X.EDGE_ROWS]
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in minhash.groups(X.edge(spark)).collect())
    want = sorted((str(i), len(X.shingles(t)), str(c)) for (i, t), c in zip(rows, X.near_components(rows), strict=True))
    assert got == want
    assert minhash.groups(X.nothing(spark)).count() == 0
    one = minhash.keep_one(X.edge(spark))
    assert one.columns == X.edge(spark).columns
    assert sorted(str(r["doc_id"]) for r in one.collect()) == sorted(["1", "2", "3", "4", "5", "6", "8", "None", "9"])


def test_odd_sketch_estimates_similarity():
    draw = np.random.default_rng(0)
    for share in (0.75, 0.9):
        off = []
        for _ in range(40):
            common = draw.integers(0, 1 << 63, int(2000 * share), np.uint64)
            a, b = (np.unique(np.append(common, draw.integers(0, 1 << 63, int(1000 * (1 - share)), np.uint64))) for _ in range(2))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            sketch = minhash.odd_sketches(np.array([minhash.minima(a), minhash.minima(b)]))
            off.append(minhash.similarity(np.bitwise_count(sketch[0] ^ sketch[1]).sum()) - true)
        assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.04


def test_components(spark):
    draw = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(draw.randint(200, 260), draw.randint(200, 260)) for _ in range(40)]
    parent = {x: x for l in links for x in l}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["v"]: r["l"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in got} and set(got) == {x for a, b in links if a != b for x in (a, b)}
