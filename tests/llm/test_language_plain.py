"""Languages against a plain Python version of the nearest centroid."""

from __future__ import annotations

import math
from collections import Counter

import fixtures_llm as X
import regex

from terrafold.llm import langid


def grams(text: str) -> Counter:
    """n-grams of folded bytes, counted one by one."""
    folded = []
    for b in text.encode("utf-8"):
        small = b + 32 if 65 <= b <= 90 else b
        folded.append(small if 97 <= small <= 122 or b >= 0x80 else 32)
    out, cut = Counter(), lambda value, bits: (value * 0xC2B2AE3D & 0xFFFFFFFF) >> bits
    for i, a in enumerate(folded):
        if a != 32:
            out[a] += 1
        if i + 1 < len(folded) and (a != 32 or folded[i + 1] != 32):
            out[langid.ONE + cut(a * 0x9E3779B1 + folded[i + 1] * 0x85EBCA77, 21)] += 1
        if i + 2 < len(folded) and folded[i + 1] != 32:
            out[langid.ONE + langid.TWO + cut(a * 0x9E3779B1 + folded[i + 1] * 0x85EBCA77 + folded[i + 2] * 0x27D4EB2F, 20)] += 1
    return out


def test_predictions_equal_plain_python(spark):
    docs = spark.read.parquet(f"{X.SF}/documents.parquet")
    model = langid.fit(docs)
    assert len(model.languages) == len(model.centroids) and set(model.languages) == {r[0] for r in docs.select("lang").distinct().collect() if r[0]}
    texts = X.texts(spark) | {-1: "", -2: "12 34 !!", -3: "Ωμέγα ñ"}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in langid.classify(rows, model).collect()}
    centers = model.centroids.astype(float).tolist()
    for doc_id, text in texts.items():
        r = got[doc_id]
        if not regex.search(r"\p{L}", text):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        count = grams(text)
        v = {k: math.log1p(n) * float(model.idf[k]) for k, n in count.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        cosines = [sum(x * c[k] for k, x in v.items()) / norm for c in centers]
        best = max(range(len(cosines)), key=lambda i: cosines[i])
        assert abs(r["score"] - min(max(cosines[best], 0.0), 1.0)) < 1e-5
        others = [c for i, c in enumerate(cosines) if model.languages[i] != model.languages[best]]
        if cosines[best] - max(others) > 1e-5:
            assert r["lang_pred"] == model.languages[best]
        letters = sum(n for k, n in count.items() if k < langid.ONE)
        least = float(model.least[min(int(math.log2(max(letters, 1))), len(model.least) - 1)])
        if abs(cosines[best] - least) > 1e-5:
            assert r["rejected"] == (cosines[best] < least)
