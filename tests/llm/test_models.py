"""Languages, fingerprints, pseudonyms, exact search and shards."""

from __future__ import annotations

import datetime
import hashlib
import math
import re
import zlib

import fixtures_llm as X
import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.llm import langid, pii, sharding, simhash, topk


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    own = [r for r in rows if r["held_out"]]
    assert {r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows} == {True}
    assert sum(r["lang"] == r["lang_pred"] for r in own) >= 0.99 * len(own) > 0
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_rare_lengths_are_rejected_too(spark):
    docs = spark.read.parquet(f"{X.SF}/documents.parquet")
    model = langid.fit(docs)
    assert (model.least > 0).all()
    draw = np.random.default_rng(7)
    thai = ["".join(map(chr, draw.integers(0x0E01, 0x0E2E, n))) for n in (1, 2, 60_000)]
    got = langid.classify(spark.createDataFrame(list(enumerate(thai)), "doc_id long, text string"), model).collect()
    assert all(r["rejected"] for r in got)
    nearest, size = np.array([0.5] * 20 + [0.3] * 20 + [0.1]), np.array([8] * 20 + [12] * 20 + [20])
    least = langid.least_cosines(nearest, size) / langid.MARGIN
    assert np.allclose(least[[0, 8, 10, 12, 20]], [0.5, 0.5, 0.3, 0.3, 0.3]) and not langid.least_cosines(nearest[:5], size[:5]).any()


def test_language_rejects_what_is_far_from_all(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    rows = [(1, "Ψάχνω για μια λέξη που δεν υπάρχει στα ελληνικά κείμενα " * 20), (2, "1234 ... !!"), (3, None), (4, "é")]
    got = {r["doc_id"]: r for r in langid.classify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[1]["rejected"] and got[2]["rejected"] and got[3]["rejected"]
    assert [got[i]["lang_pred"] == "und" for i in (1, 2, 3, 4)] == [False, True, True, False]
    kept = langid.classify(docs, model).filter("not rejected").count()
    assert kept >= 0.995 * docs.count()


def test_language_edges(spark):
    df = X.edge(spark)
    rows = langid.predictions(df).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in X.EDGE_ROWS)
    assert all((r["lang_pred"] == "und") == (r["score"] == 0 and r["rejected"]) for r in rows if r["lang_pred"] == "und")
    kept = langid.keep_known(df)
    assert kept.columns == df.columns and kept.filter("rejected <=> doc_id").count() == kept.count()
    assert langid.predictions(X.nothing(spark)).count() == 0
    alone = spark.createDataFrame([(1, "no label here")], "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    assert [r["lang_pred"] for r in langid.predictions(alone).collect()] == ["und"]


def simple_fingerprint(text):
    """Votes with plain integers; hashes are left to Spark, so words are passed with theirs."""
    votes, total = [0] * 128, 0
    for w, h1, h2 in text:
        weight = min(len(w), 8) ** 2
        total += weight
        for k in range(64):
            votes[k] += weight * ((h1 >> k) & 1)
            votes[64 + k] += weight * ((h2 >> k) & 1)
    halves = [sum(1 << k for k in range(64) if 2 * votes[64 * j + k] > total) for j in (0, 1)]
    return "".join(f"{h:016x}" for h in halves)


def test_fingerprints_of_documents(spark):
    docs = X.texts(spark)
    order = sorted(docs, reverse=True)
    edited = {}
    for i, doc in enumerate(order):
        text, other = docs[doc], docs[order[(i + 1) % len(order)]]
        cut = len(text) // 3
        edited[doc] = text[: len(text) - cut] + other[:cut]
    words = sorted({w for t in (*docs.values(), *edited.values()) for w in re.split(r"[ \t\n\x0b\f\r]+", t.lower())})
    hashed = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("a"), F.xxhash64("w", F.lit(1)).alias("b"))
    known = {r["w"]: (r["w"], r["a"], r["b"]) for r in hashed.collect()}
    plain = lambda t: simple_fingerprint([known[w] for w in re.split(r"[ \t\n\x0b\f\r]+", t.lower())])
    rows = {r["doc_id"]: r for r in simhash.fingerprints(spark.read.parquet(f"{X.SF}/documents.parquet")).collect()}
    assert set(rows) == set(docs)
    like = lambda a, b: 1 - bin(int(a, 16) ^ int(b, 16)).count("1") / 128
    for i, doc in enumerate(order):
        r, after = rows[doc], rows[order[(i + 1) % len(order)]]
        assert r["n_chars"] == len(docs[doc])
        assert r["edited_sha256"] == hashlib.sha256(edited[doc].encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (plain(docs[doc]), plain(edited[doc]))
        assert r["near_edited"] == pytest.approx(like(r["fingerprint"], r["edited_fingerprint"]))
        assert r["near_next"] == pytest.approx(like(r["fingerprint"], after["fingerprint"]))


def test_fingerprint_edges(spark):
    rows = simhash.fingerprints(X.edge(spark)).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in X.EDGE_ROWS)
    assert {r["fingerprint"] for r in rows if r["n_chars"] == 0} == {"0" * 32}
    assert simhash.fingerprints(X.nothing(spark)).count() == 0
    one = simhash.fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert [r["edited_sha256"] for r in one] == [hashlib.sha256(b"abcdab").hexdigest()]


def test_neighbours_within_a_radius(spark):
    draw = np.random.default_rng(1)
    base = [int.from_bytes(draw.bytes(16), "big") for _ in range(30)]
    values = base + [b ^ sum(1 << int(k) for k in draw.choice(128, n, replace=False)) for b in base for n in (1, 3, 4, 6)]
    names = [f"{v:032x}" for v in values]
    df = spark.createDataFrame([(n,) for n in [*names, names[0], None]], "fingerprint string")
    got = {(r["query"], r["found"], r["distance"]) for r in simhash.within(df, df, 3).collect()}
    assert got == {(a, b, d) for a in names for b in names if (d := bin(int(a, 16) ^ int(b, 16)).count("1")) <= 3}


def test_neighbours_of_documents(spark):
    base = [f"word{i * 7 % 101} and{i}" for i in range(200)]
    texts = {i: " ".join(base[: 199 - i % 5]) for i in range(0, 400, 37)} | {i: f"other text {i % 3}" for i in range(0, 500, 50)} | {700: "alone here", 701: None, 800: ""}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: r for r in simhash.fingerprints(df).collect()}
    number = {i: int(r["fingerprint"], 16) for i, r in rows.items()}
    some = 0
    for i, r in rows.items():
        near = sorted((d, j) for j in rows if j != i and (d := (number[i] ^ number[j]).bit_count()) <= simhash.RADIUS)
        copies = [j for d, j in near if d == 0]
        nearest = (max(copies) if copies and min(copies) > i else near[0][1]) if near else None
        assert (r["n_neighbours"], r["nearest_doc_id"]) == ((len(near), nearest) if i % 100 == 0 else (None, None)), i
        some += bool(near) and i % 100 == 0
    assert some > 3 and rows[700]["n_neighbours"] == 0 and rows[800]["nearest_doc_id"] == 701


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def pseudonyms(spark, values, key="k"):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r["p"] for r in df.select("v", pii.pseudonym(F.col("v"), key).alias("p")).collect()]


def test_networks_permute_their_domain(spark):
    pairs = spark.range(35).select(F.col("id") % 5, F.floor(F.col("id") / 5)).toDF("a", "b")
    new = pairs.select(pii.feistel(F.col("a"), F.col("b"), 5, 7, "k", "t").alias("p")).collect()
    assert {(r["p"]["a"], r["p"]["b"]) for r in new} == {(a, b) for a in range(5) for b in range(7)}
    all_digits = [f"{i:03d}" for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in all_digits], "v string").select(pii.permuted(F.col("v"), "k", "t").alias("p"))
    assert {r["p"] for r in df.collect()} == set(all_digits)


def test_every_date_stays_a_date(spark):
    days = [datetime.date(1900, 1, 1) + datetime.timedelta(i) for i in range(73049)]
    for form in ("%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y"):
        got = pseudonyms(spark, [d.strftime(form) for d in days])
        new = [datetime.datetime.strptime(v, form).date() for v in got]
        assert set(new) == set(days)
        assert all((a.month, a.day) == (2, 29) for a, b in zip(new, days, strict=True) if (b.month, b.day) == (2, 29))


def test_formats_and_checks(spark):
    values = ["4111111111111111", "4111 1111 1111 1111", "4111111111111112", "123-45-6789", "000-12-3456", "1.2.3.4", "255.255.255.255",
              "+1 (743) 555-3824", "(743) 555-3824", "anna.b_9@mail7.example.com", "2023-02-31"]
    got = dict(zip(values, pseudonyms(spark, values), strict=True))
    shape = lambda s: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", s)))
    assert all(shape(a) == shape(b) for a, b in got.items() if "." not in a or "@" in a)
    changed = {a for a, b in got.items() if a != b}
    assert changed == set(values) - {"4111111111111112", "000-12-3456", "2023-02-31"}
    assert luhn(got["4111111111111111"]) and luhn(re.sub(" ", "", got["4111 1111 1111 1111"]))
    assert re.sub(" ", "", got["4111 1111 1111 1111"]) == got["4111111111111111"]
    assert all(0 <= int(x) <= 255 for x in got["1.2.3.4"].split("."))
    assert got["+1 (743) 555-3824"].startswith("+1 (") and got["anna.b_9@mail7.example.com"].endswith(".com")
    assert pseudonyms(spark, values, "other")[0] != got[values[0]]


def test_texts_keep_everything_else(spark):
    text = "Call +1 (743) 555-3824, or 227.5.221.1. Ids 7536784127813051, v1.2.3.4.5, x4111111111111111. a@b, anna@mail.example.com!"
    df = spark.createDataFrame([(1, text), (2, "anna@mail.example.com"), (3, None), (4, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.protect(df, count="n").collect()}
    new = got[1]["text"]
    for value in ("555-3824", "227.5.221.1", "anna@mail"):
        assert value not in new
    for value in ("7536784127813051", "v1.2.3.4.5", "x4111111111111111", "a@b,"):
        assert (value in new) != (value == "7536784127813051" and luhn(value))
    assert got[2]["text"] in new and got[1]["n"] == 3 + luhn("7536784127813051")
    assert (got[3]["text"], got[4]["text"], got[3]["n"]) == (None, "", 0)


def test_values_next_to_marks_are_found(spark):
    marks = ["...", "###", "-", "(", "é", "=", "\n", ".", "..."]
    values = ["anna@mail.example.com", "227.5.221.1", "4111111111111111", "+1 (743) 555-3824"]
    df = spark.createDataFrame([(i, f"end{m} {m}{v}{m} {v}") for i, (m, v) in enumerate((m, v) for m in marks for v in values)], "doc_id long, text string")
    got = [r["text"] for r in pii.protect(df).collect()]
    assert not [t for t in got if any(v in t for v in values)]
    chain = spark.createDataFrame([(1, "a." * 200_000)], "doc_id long, text string")
    assert pii.protect(chain).first()["text"] == "a." * 200_000


def hidden(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n"]) for r in pii.protect(df, count="n").collect()}
    return [got[i] for i in range(len(texts))]


def test_cards_and_telephones_next_to_other_numbers(spark):
    card, tel, other_tel, dinner = "4111 1111 1111 1111", "555-123-4567", "555-987-6543", "3056 930902 5904"
    cases = {
        f"{card} 123": [card], f"{card} 12/26": [card], f"1 {card}": [card], f"2024-{card.replace(' ', '-')}-1": [card.replace(" ", "-")],
        f"{tel} {other_tel}": [tel, other_tel], f"{tel} 1234": [tel], f"{tel} {card} {tel}": [tel, card], f"{card} {card} 10.1.2.3": [card, "10.1.2.3"],
        f"12 {dinner} 2020-02-03": [dinner, "2020-02-03"], "12345 67890 12345 555-123-4567": [tel], "41111111 11111111": ["41111111 11111111"],
        f"{tel} 41111111 11111111": [tel, "41111111"], "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1": ["4 1 1 1 1"], f"555 123 {card}": [card], "7 4222 222 222 222": ["4222 222"],
    }
    for (text, values), (new, n) in zip(cases.items(), hidden(spark, cases), strict=True):
        assert not [v for v in values if v in new] and n >= len(values), (text, new, n)
        assert re.sub(r"\d", "9", new) == re.sub(r"\d", "9", text) or "." in text
    alone, beside = (t for t, _ in hidden(spark, [card, f"1 {card} 12/26"]))
    assert beside == f"1 {alone} 12/26"
    numbers = ["7 4111 1111 1111 1112 123", "12345 67890 12345", "1 2 3 4 5 6 7", "9" * 50]
    assert [t for t, _ in hidden(spark, numbers)] == numbers
    long = " ".join(["7"] * 50_000)
    assert re.sub(r"\d", "7", hidden(spark, [long])[0][0]) == long


def test_day_first_dates_and_grouped_telephones(spark):
    values = ["31/12/2024", "29/02/2024", "12/31/2024", "05/06/2024", "+44 20 7946 0958", "+33 1 23 45 67 89", "+34 612 345 678",
              "+49 151 23456789", "+1 5551234567", "+44 (0)20 7946 0958", "+39-06-1234-5678"]
    got = hidden(spark, [f"on {v}, or {v}." for v in values])
    for v, (new, n) in zip(values, got, strict=True):
        assert v not in new and n == 2 and re.sub(r"\d", "9", new) == re.sub(r"\d", "9", f"on {v}, or {v}."), (v, new, n)
        assert not v.startswith("+") or new.startswith("on " + re.match(r"\+\d+", v)[0])
    kept = ["31/13/2024", "31/02/2023", "29/02/2023", "00/12/2024", "+12 34", "2 +2024 5"]
    assert [t for t, _ in hidden(spark, kept)] == kept
    days = [d for i in range(73049) if (d := datetime.date(1900, 1, 1) + datetime.timedelta(i)).day > 12]
    new = [datetime.datetime.strptime(v, "%d/%m/%Y").date() for v in pseudonyms(spark, [d.strftime("%d/%m/%Y") for d in days])]
    assert set(new) == set(days)
    assert hidden(spark, ["+44 20 7946 0958 4111 1111 1111 1111"])[0][0].endswith(hidden(spark, ["4111 1111 1111 1111"])[0][0])


def test_pseudonym_edges(spark):
    df = X.edge(spark)
    out = pii.protect(df)
    assert out.columns == df.columns and out.filter("_hits <=> doc_id and _new <=> doc_id").count() == len(X.EDGE_ROWS)
    assert out.filter("text like '%555-3824%' or text like '%anna.b@%'").count() == 0
    assert pii.protected(X.nothing(spark)).count() == 0


def simple_top(rows, k=topk.K):
    whole = lambda c: int(c) * 64 if abs(c) >= 2.0**53 else math.floor(64 * c)
    good = [(i, [whole(c) for c in v]) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    out = set()
    for q, v in good:
        if q % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v))[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(found, 1)}
    return out


@pytest.mark.parametrize("block", [topk.BLOCK, 64])
def test_top_products(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "PER_PIVOT", block // 2)
    draw = np.random.default_rng(3)
    centers = draw.normal(size=(6, 8)) * 3
    rows = [(i, (centers[i % 6] + draw.normal(size=8) * 0.3).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[i][1]) for i in range(40)] + [(2000, None), (2020, [1.0, None]), (2040, [float("nan")] * 8), (None, [1.0] * 8)]
    rows += [(3000, [1.0, 2.0]), (3001, [2.0, 2.0]), (3020, []), (3040, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("qg", F.lit(1))
    got = {tuple(r) for r in topk.top_products(df, "vec_id % 20 = 0").collect()}
    assert got == simple_top(rows)


@pytest.mark.parametrize("block", [topk.BLOCK, 32])
def test_top_products_of_large_components(spark, monkeypatch, block):
    """Finite components of any size take part, and sums beyond 2**53 are exact."""
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "PER_PIVOT", block)
    draw = np.random.default_rng(9)
    rows = [(i, [0.0, *(draw.normal(size=6) * 3).tolist()]) for i in range(200)]
    rows += [(300 + i, [0.0, 2.0**24 + i, *draw.normal(size=5).tolist()]) for i in range(30)]
    rows += [(401 + i, [0.0, 0.0, 2.0**40, -(2.0**30), 1.0 + i / 64, 0.0, 0.5]) for i in range(5)]
    # Nobody has anything where these are largest of all.
    rows += [(501, [1e300, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0]), (502, [-1.7e308, 5.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    rows = [(i, v) for i, v in rows if not (i % 20 == 0 and i >= 400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = simple_top(rows)
    assert max(s for *_, s in want) > 2**60 and all(abs(s) < 2**63 for *_, s in want)
    assert {tuple(r) for r in topk.top_products(df, "vec_id % 20 = 0").collect()} == want


def test_a_score_that_is_no_long_is_an_error(spark):
    rows = [(0, [2.0**40, 1.0]), (1, [2.0**40, 1.0]), (2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="the score of vectors 0 and 1 is no long"):
        topk.top_products(df, "vec_id % 20 = 0").collect()
    assert (topk.exact_products(np.array([[2.0**30 - 1] * 16]), np.array([[2.0**30 - 1] * 16])) == topk.HIGH).all()
    assert (topk.exact_products(np.array([[-1e300, 0.0]]), np.array([[1e300, 0.0], [0.0, 7.0]])) == [[topk.LOW, 0]]).all()


def test_top_products_of_embeddings(spark):
    df = spark.read.parquet(f"{X.SF}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    assert {tuple(r) for r in topk.top_products(df, "vec_id % 20 = 0").collect()} == simple_top(rows)
    assert topk.top_products(df.limit(0), "vec_id % 20 = 0").count() == 0


def check_shards(rows, texts, shards, slack):
    by = {}
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None
        by.setdefault(r["shard"], []).append(r)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    sizes = [sum(r["size"] for r in by.get(s, [])) for s in range(shards)]
    assert max(abs(s - sum(sizes) / shards) for s in sizes) <= slack
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts)


def test_shards_of_documents(spark):
    texts = X.texts(spark)
    rows = sharding.shard(spark.read.parquet(f"{X.SF}/documents.parquet")).collect()
    check_shards(rows, texts.values(), 24, max(len(t.encode()) for t in texts.values()) + 8)


def test_a_third_of_all_rows_is_one_text(spark):
    rows = [(i, "same text " * 10 if i % 3 == 0 else f"text {i} " * 10) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_shards(sharding.shard(df, 4).collect(), [t for _, t in rows], 4, 0.05 * 6000 * 100 / 4)


def test_shard_edges(spark):
    rows = sharding.shard(X.edge(spark), 3).collect()
    check_shards(rows, [r[1] for r in X.EDGE_ROWS], 3, 6000)
    assert sharding.shard(X.nothing(spark)).count() == 0
