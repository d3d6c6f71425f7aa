"""From raw documents to packed sequences: five stages, each kept before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.llm import langid, minhash, packing, pii, suffix
from terrafold.llm.common import keep


#: Spark setting with the key of the pseudonyms; without it they have the public sample key.
KEY_SETTING = "spark.terrafold.pseudonyms.key"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null, empty and letterless texts go."""
    return langid.keep_known(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates; of repeated rows one stays.

    Empty and null texts are near nothing and stay.
    """
    return minhash.keep_one(docs)


def no_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words that stand elsewhere too; every row stays."""
    return suffix.without_repeats(docs)


def no_names(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms for personal data; null stays null, ``n_chars`` is counted anew."""
    out = pii.protect(docs, key=spark.conf.get(KEY_SETTING, pii.KEY))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts in sequences of 1024 ids; null is empty, other columns are left out."""
    return packing.pack(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("repeated_strings", no_repeats),
    ("pseudonyms", no_names),
    ("packing", packed),
]

#: Tokens, sketches and suffixes are not SQL; tests hold the run against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``.

    A table of any size, none included, with any further columns; each stage says what it
    does with nulls and repeated rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
