"""The pipeline, stage by stage, against plain versions on each stage's own input."""

from __future__ import annotations

import fixtures_llm as X
import public_tokenizers
from test_tokens import check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from terrafold.llm import pii
from terrafold.llm.common import keep
from terrafold.llm.queries import QUERIES


def test_stages(spark):
    docs = spark.read.parquet(f"{X.SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = keep(stage(spark, docs, X.SF), f"test-{name}")
        seen[name] = before, docs
        if name != "packing":
            assert docs.columns == columns
            assert docs.filter("n_chars <> length(text)").count() == 0
    before, after = seen["language"]
    kept = {r["doc_id"] for r in after.collect()}
    assert all(any(c.isalpha() for c in t or "") for i, t in before if i in kept) and len(kept) >= 0.99 * len(before)
    before, after = seen["near_duplicates"]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(i for (i, _), c in zip(before, X.near_components(before), strict=True) if i == c)
    before, after = seen["repeated_strings"]
    texts = {r["doc_id"]: r["text"] for r in after.collect()}
    for (doc_id, _), stays in zip(before, X.without_passages([t for _, t in before], 240, 50, 400, True), strict=True):
        assert texts[doc_id] == stays
    before, after = seen["pseudonyms"]
    assert {r["doc_id"] for r in after.collect()} == {i for i, _ in before}
    before, after = seen["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in before}
    check_packing(after.collect(), ids, 1024)


def test_stage_edges(spark):
    """Nulls, repeated rows, busy column names, no ``n_chars`` and no rows at all."""
    for docs in (X.edge(spark), X.edge(spark).drop("n_chars"), X.nothing(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = keep(stage(spark, docs, X.SF), f"edge-{name}")
            assert docs.columns == columns or name == "packing"
    assert docs.count() == 0


def test_pseudonym_key_is_a_setting(spark):
    docs = spark.createDataFrame([(1, "call +1 (743) 555-3824 now", 26)], "doc_id long, text string, n_chars long")
    sample = corpus_pipeline.no_names(spark, docs, X.SF).first()["text"]
    spark.conf.set(corpus_pipeline.KEY_SETTING, "another key")
    try:
        other = corpus_pipeline.no_names(spark, docs, X.SF).first()["text"]
    finally:
        spark.conf.unset(corpus_pipeline.KEY_SETTING)
    assert sample == pii.protect(docs).first()["text"] != other


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
