"""Ranked search, licence scans and fill-in-middle against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import fixtures_llm as X
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrafold.llm import fim, lexical, licenses

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def plain_ranks(docs, items, k=10):
    held = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        asked, scores = Counter(TERM.findall(lower(text))), []
        for i, c in held:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // total
            s = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t, times in asked.items()
                if t in c
            )
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def found(df):
    return sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("sample, wave", [(lexical.SAMPLE, lexical.WAVE_BYTES), (40, 700)])
def test_ranked_search(spark, monkeypatch, sample, wave):
    monkeypatch.setattr(lexical, "LEAF", 4)
    draw = random.Random(5)
    words = ["the", "of", "é", "Zebra", "x1", "a" * 40, "b" * 17, "b" * 18, *(f"w{i}" for i in range(60))]
    text = lambda n: " ,.\n"[draw.randrange(4)].join(draw.choices(words, weights=[20, 9] + [1] * (len(words) - 2), k=n))
    docs = [(i, text(draw.randint(1, 60))) for i in range(300)]
    docs += [(300 + i, docs[i % 3][1]) for i in range(30)] + [(400, None), (401, ""), (402, "?? !"), (403, "zebra " * 3000)]
    items = [(i, text(draw.randint(1, 25))) for i in range(12)] + [(50, None), (51, " ."), (52, "absent words"), (53, "ZEBRA zebra x1")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    q = spark.createDataFrame(items, "item_id long, text string")
    assert found(lexical.top_documents(d, q, sample=sample, wave_bytes=wave)) == sorted(plain_ranks(docs, items))


def test_ranked_search_edges(spark):
    items = spark.createDataFrame([(1, "word7 and1 tail", 2), (1, "zzz", 2), (None, "tail", 2), (2, "mail", 2)], "item_id long, text string, doc_id long")
    rows = [(i, t) for i, t, *_ in X.EDGE_ROWS]
    got = lexical.top_documents(X.edge(spark), items).collect()
    want = plain_ranks(rows, [(1, "word7 and1 tail"), (2, "mail")])
    assert sorted((r["item_id"], r["rank"], str(r["doc_id"]), r["score"]) for r in got) == sorted((a, b, str(c), d) for a, b, c, d in want)
    assert lexical.top_documents(X.nothing(spark), items).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical.top_documents(X.edge(spark), none).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical.top_documents(X.edge(spark), none).count() == 0


def test_tree_prunes_and_bounds_hold():
    draw = np.random.default_rng(1)
    groups = [draw.integers(0, 40, 12) + 50 * g for g in range(8)]
    lists = [np.unique(np.append(draw.choice(groups[i % 8], 6), 450 + i % 40)) for i in range(1000)]
    at = np.append(0, np.cumsum([len(x) for x in lists]))
    rows = lexical.Rows(at, np.concatenate(lists), draw.integers(1, 900_000, at[-1]))
    tree = lexical.BallTree(rows, 500, 16)
    query = np.zeros((1, 500))
    query[0, groups[3][:5]] = draw.integers(1, 9000, 5)
    tops = tree.bounds(query, np.arange(500))[0]
    scores = tree.rows.dot(query[0].astype(np.int64))
    assert all(scores[a:b].max() <= t for a, b, t in zip(tree.low, tree.high, tops, strict=True))
    best = lexical.Best(1, 10, np.zeros(1, np.int64))
    index = np.flatnonzero(query[0])
    scored = lexical.search(tree, np.arange(1000), [(index, query[0, index].astype(np.int64))], best)
    assert scored < 0.5 * sum(not c for c in tree.children)
    want = sorted(zip(-rows.dot(query[0].astype(np.int64)), range(1000), strict=True))[:10]
    assert list(zip(-best.score[0], best.found[0], strict=True)) == want


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_base(text):
    words = WORD.findall(lower(text))
    hits = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in hits]
    return len(words), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({l for _, l in hits}))


LICENSED = [
    "Licensed under the Apache License, Version 2.0. MIT-License! mit license",
    "GNU General\nPublic (License) v3; cc by cc by-nc 4.0 ccby bcc by",
    "emit license", "mit licenses", "éMIT license", "mit license", "the mit", "license", "", None,
    "x" * 3000 + " CC BY " * 500,
    "// SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND CC-BY-4.0\nrest or more",
    "SPDX-License-Identifier: Foo-1.0 or",
    "SPDX-License-Identifier: (MIT",
    "SPDX-License-Identifier:",
    "Released under MIT or Apache-2.0. And so on",
    "Released under the terms of nobody",
]


def test_license_scan(spark):
    df = spark.createDataFrame(list(enumerate(LICENSED)), "doc_id long, text string").coalesce(1)
    rows = {r["doc_id"]: r for r in licenses.labelled(df).collect()}
    for i, text in enumerate(LICENSED):
        assert tuple(rows[i])[1:6] == plain_base(text), text
        assert set(rows[i]["base_labels"].split(",")) - {""} <= set(rows[i]["labels"].split(","))
        assert 0 <= rows[i]["score"] <= 1
    assert rows[11]["labels"] == "cc-by,gpl,mit" and rows[11]["score"] == 0.3
    assert rows[11]["expressions"] == ["( MIT OR GPL-2.0-only WITH Classpath-exception-2.0 ) AND CC-BY-4.0"]
    assert (rows[12]["labels"], rows[12]["score"], rows[12]["expressions"]) == ("foo-1.0", 1.0, ["Foo-1.0"])
    assert (rows[13]["labels"], rows[13]["score"]) == ("mit", 1.0)
    assert (rows[14]["labels"], rows[14]["score"]) == ("", 0.0)
    assert (rows[15]["labels"], rows[15]["score"]) == ("apache,mit", 0.2)
    assert (rows[16]["labels"], rows[16]["score"]) == ("", 0.0)


def test_license_scan_of_documents(spark):
    docs = X.texts(spark, "/root/testdata/sf0.01")
    got = {r["doc_id"]: tuple(r)[1:6] for r in licenses.labelled(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    assert got == {i: plain_base(t) for i, t in docs.items()}
    assert any(n for _, n, *_ in got.values())


def test_license_scan_edges(spark):
    out = licenses.with_findings(X.edge(spark))
    assert out.columns == [*X.edge(spark).columns, "n_words", "findings"] and out.count() == len(X.EDGE_ROWS)
    assert licenses.labelled(X.edge(spark)).count() == len(X.EDGE_ROWS)
    assert licenses.labelled(X.nothing(spark)).count() == 0
    assert licenses.with_findings(licenses.with_findings(X.edge(spark))).columns == out.columns


OPERANDS = {"MIT": 0.2, "Apache-2.0": 0.3, "MPL-2.0": 0.5, "GPL-3.0": 0.8}


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.sampled_from(sorted(OPERANDS)), lambda e: st.tuples(e, st.sampled_from(["and", "or"]), e), max_leaves=8))
def test_expressions(tree):
    def text(e):
        return e if isinstance(e, str) else f"({text(e[0])}) {e[1].upper()} ( {text(e[2])})"

    def asks(e):
        return OPERANDS[e] if isinstance(e, str) else (max if e[1] == "and" else min)(asks(e[0]), asks(e[2]))

    data = text(tree).encode()
    assert licenses.evaluate(licenses.tokens(data, 0, len(data)), False)[1] == asks(tree)


@pytest.mark.parametrize(
    "text, asks",
    [("MIT or GPL-2.0 and MPL-2.0", 0.2), ("GPL-2.0 and MIT or MPL-2.0", 0.5), ("GPL-2.0 with X or MPL-2.0", 0.4), ("MIT and GPL-2.0 with X", 0.4), ("MIT )", 0.2), ("MIT GPL-2.0", 0.2)],
)
def test_precedence(text, asks):
    assert licenses.evaluate(text.split(), False)[1] == asks


def plain_fim(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(lines)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        form, out, sizes = "plain", text, (None, None)
    else:
        form = "spm" if h4 % 100 < 50 else "psm"
        out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
        sizes = len(prefix), len(middle)
    return n, form, *sizes, out


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("rows", [1, 4])
def test_fill_in_middle(spark, rows):
    draw = random.Random(6)
    texts = ["".join(draw.choices("ab\n\n é😀<", k=draw.randint(0, 80))) for _ in range(150)]
    texts += [None, "", "\n", "\n\n\n", "no line end", "a<P>b", "<S>", "x\n<M", "<P", ">\n<\n" * 50, "line é\n" * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(rows)
    got = {r["doc_id"]: tuple(r)[1:] for r in fim.digests(df).collect()}
    for i, text in enumerate(texts):
        *front, out = plain_fim(i, text)
        assert got[i] == (*front, sha(out), sha(text))
    assert {f for _, f, *_ in got.values()} == {"plain", "psm", "spm"}


def test_fill_in_middle_outputs(spark):
    """Outputs, their descriptors and the way back, over the edge rows."""
    out = fim.with_outputs(X.edge(spark))
    assert out.columns == [*X.edge(spark).columns, "fim_form", "fim_output", "fim_pieces"]
    rows = fim.with_texts(out).collect()
    assert len(rows) == len(X.EDGE_ROWS)
    for r in rows:
        assert r["fim_output"] == plain_fim(r["doc_id"], r["text"])[-1]
        assert r["restored"] == (r["text"] or "")
        buffers = (r["text"] or "").encode(), b"<P><M><S>"
        assert b"".join(buffers[p["buffer"]][p["start"] : p["start"] + p["length"]] for p in r["fim_pieces"]).decode() == r["fim_output"]
    assert fim.with_texts(fim.with_outputs(X.nothing(spark))).count() == 0
    assert fim.digests(X.nothing(spark)).count() == 0 and fim.digests(X.edge(spark)).count() == len(X.EDGE_ROWS)


def test_sentinels_that_could_be_misread():
    for names in ({"prefix": ""}, {"prefix": "<M>x"}, {"middle": "aba"}, {"prefix": "xy", "suffix": "yz"}):
        with pytest.raises(ValueError):
            fim.Scheme(**names)


@given(st.lists(st.integers(0, 30), max_size=6), st.integers(0, 30), st.integers(0, 30))
def test_cutting_splits_descriptors(sizes, a, b):
    buffer = bytes(range(200))
    pieces = [(fim.TEXT, 30 * i, n) for i, n in enumerate(sizes)]
    whole = b"".join(fim.read(pieces, buffer, b""))
    a, b = sorted((min(a, len(whole)), min(b, len(whole))))
    parts = [b"".join(fim.read(p, buffer, b"")) for p in fim.cut(pieces, a, b)]
    assert parts == [whole[:a], whole[a:b], whole[b:]]
