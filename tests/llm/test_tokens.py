"""Tokens: the transducer, the streaming decoder, unigram counts and packing."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import fixtures_llm as X
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from terrafold.llm import bpe, packing, unigram

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def public():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts):
    out = []
    for ids, at, _, _ in bpe.encoded_chunks(pa.array(texts, pa.string()), PATH):
        out += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    return out


def test_documents_encode_like_the_public_library(spark, public):
    texts = list(X.texts(spark).values())
    assert encoded(texts) == [public.encode_ordinary(t) for t in texts]


def test_every_code_point_splits_like_the_pattern(public):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"x{chr(c)}y {chr(c)} 1{chr(c)}2!\n" for c in points[i : i + 4000]) for i in range(0, len(points), 4000)]
    assert encoded(texts) == [public.encode_ordinary(t) for t in texts]


def test_odd_strings(public):
    draw, alphabet = random.Random(3), list(" '\n\t a'sretvlmdSé1२!.€😀\x85\xa0  ''")
    texts = ["".join(draw.choices(alphabet, k=draw.randint(0, 30))) for _ in range(5000)] + ["a" * 3000, "ab" * 900, "<|endoftext|>"]
    assert encoded(texts) == [public.encode_ordinary(t) for t in texts]


def test_forgotten_states_change_nothing(public):
    small = bpe.Transducer(PATH, max_states=20, max_pieces=5)
    for word in ("unbelievable", "thshtionhe", "anthropomorphically", "q" * 500, "aé€😀" * 40, "unbelievable"):
        for _ in range(3):
            assert np.frombuffer(small.encode(word.encode()), "<u4").tolist() == public.encode_ordinary(word)


@pytest.mark.parametrize("states, many", [(100_000, 16), (100_000, 2), (30, 2), (30, 16)])
def test_sorted_pre_tokens_share_prefixes(public, states, many):
    draw = random.Random(8)
    parts = ["th", "sh", "un", "believ", "ation", "é", "ñ", "q", "ing", "🙂", "zzz", "anthrop"]
    words = sorted({"".join(draw.choices(parts, k=draw.randint(1, 6))).encode() for _ in range(3000)} | {b"x" * 400, b"xy" * 300, b"x" * 399})
    small = bpe.Transducer(PATH, max_states=states, max_pieces=100)
    for _ in range(2):
        got = list(small.sorted_streams(words, many))
        assert got == [public.encode_ordinary(w.decode()) for w in words]
    mixed = draw.sample(words, len(words))
    assert [np.frombuffer(x, "<u4").tolist() for x in small.encode_all(mixed)] == [public.encode_ordinary(w.decode()) for w in mixed]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40), st.lists(st.integers(1, 5), max_size=40))
def test_bytes_in_portions(text, sizes):
    data, machine, out, at = text.encode("utf-8", "ignore"), bpe.Utf8(), "", 0
    for n in [*sizes, len(data)]:
        out += machine.feed(data[at : at + n])
        at += n
    assert out + machine.end() == data.decode("utf-8")


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=12))
def test_broken_bytes_become_marks(data):
    machine = bpe.Utf8()
    assert "".join(machine.feed(data[i : i + 1]) for i in range(len(data))) + machine.end() == data.decode("utf-8", "replace")


def test_round_trip_query(spark, public):
    rows = bpe.round_trip_digests(X.edge(spark)).collect()
    got = sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows)
    want = []
    for _, text, *_ in X.EDGE_ROWS:
        ids = public.encode_ordinary(text or "")
        want.append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert all(r["round_trip"] for r in rows)
    assert bpe.round_trip_digests(X.nothing(spark)).count() == 0


def test_encode_documents_keeps_other_columns(spark, public):
    rows = bpe.encode_documents(X.edge(spark).withColumnRenamed("score", "ids"), PATH).collect()
    assert all(r["ids"] == public.encode_ordinary(r["text"] or "") and r["decoded"] == (r["text"] or "") for r in rows)


def test_unigram_counts(spark):
    scores = unigram.pieces(public_tokenizers.path(unigram.VOCABULARY))

    def plain(word):
        best = [(0, 0)]
        for end in range(1, len(word) + 1):
            size = len(word[end - 1].encode())
            top = (best[-1][0] + size * unigram.BYTE_SCORE, best[-1][1] - size)
            for start in range(end):
                if word[start:end] in scores:
                    top = max(top, (best[start][0] + scores[word[start:end]], best[start][1] - 1))
            best.append(top)
        return -best[-1][1]

    rows = list(X.texts(spark).values())[:12]
    known = {w: plain(unigram.MARK + w) for t in rows for w in t.split()}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_tokens"], r["n_words"]) for r in unigram.token_counts(df).collect()}
    for i, text in enumerate(rows):
        words = [w.decode() for w in text.encode().split()]
        assert got[i] == (sum(known.get(w) or plain(unigram.MARK + w) for w in words), len(words))
    assert unigram.token_counts(X.edge(spark)).count() == len(X.EDGE_ROWS)
    assert unigram.token_counts(X.nothing(spark)).count() == 0


def check_packing(rows, ids_of, size):
    """Every id in one piece, sequences gapless and full or of a power of two."""
    documents, sequences = {}, {}
    for r in rows:
        documents.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for doc_id, own in documents.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            ids = ids_of[doc_id]
            part = np.array(ids[at : at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids_of[doc_id])
    short = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == size or at & (at - 1) == 0
        short += at != size
    assert short <= size.bit_length()


def test_packing_documents(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = X.texts(spark)
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}
    rows = packing.pack(spark.read.parquet(f"{X.SF}/documents.parquet")).collect()
    assert set(ids) == {r["doc_id"] for r in rows}
    check_packing(rows, ids, 1024)


def test_packing_added_tokens(spark):
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end} x\n{end}", f"x{end}", "<|endof", "text|>", f"é{end}  {end[:-1]}", "", f"\n{end}\n"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    check_packing(packing.pack(df, size=16).collect(), ids, 16)


def test_packing_equal_lengths_are_strung(spark):
    df = spark.createDataFrame([(i, "one two three four") for i in range(50)], "doc_id long, text string")
    rows = packing.pack(df, size=16).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [*library.encode("one two three four", add_special_tokens=False).ids, 0]
    check_packing(rows, dict.fromkeys(range(50), ids), 16)
    assert packing.pack(X.nothing(spark)).count() == 0
    assert packing.pack(X.edge(spark)).count() >= len(X.EDGE_ROWS)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 60), max_size=20))
def test_plan_places_every_rank_once(histogram):
    plan = packing.plan(histogram, 32)
    for length, n in histogram.items():
        own = sorted(r for r in plan.rows if r[0] == length)
        assert own[0][1] == 0 and len(own) <= n
    filled = sum(k * n for k, n in histogram.items())
    assert filled == plan.windows * 32 + plan.strung


def test_fullest_is_best_subset():
    draw = random.Random(5)
    for _ in range(200):
        count = {draw.randint(1, 20): draw.randint(1, 3) for _ in range(4)}
        capacity = draw.randint(1, 40)
        used = packing.fullest(count, sorted(count, reverse=True), capacity)
        sums = {0}
        for k, n in count.items():
            sums = {s + k * i for s in sums for i in range(n + 1) if s + k * i <= capacity}
        assert sum(k * n for k, n in used.items()) == max(sums)
        assert all(n <= count[k] for k, n in used.items())
