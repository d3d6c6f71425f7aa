"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrafold.llm import bpe, fim, langid, lexical, licenses, minhash, packing, pii, sharding, simhash, suffix, topk, unigram

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query and, where SQL can say it, its oracle."""

    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_byte_bpe")
def byte_bpe(spark, sf_dir):
    """Every text encoded and decoded again."""
    return bpe.round_trip_digests(documents(spark, sf_dir))


@query("op8_packing")
def packed(spark, sf_dir):
    """All documents in sequences of 1024 ids."""
    return packing.pack(documents(spark, sf_dir))


@query("op3_language_id")
def language(spark, sf_dir):
    """The language of every text."""
    return langid.predictions(documents(spark, sf_dir))


_NEAR_DUPLICATES = """
WITH RECURSIVE split AS (
    SELECT doc_id, [w FOR w IN regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'
    ) IF w <> ''] AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM split
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.r
), least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""


@query("op4_near_duplicates", _NEAR_DUPLICATES)
def near_duplicates(spark, sf_dir):
    """The group of every document."""
    return minhash.groups(documents(spark, sf_dir))


@query("op10_sharding")
def sharded(spark, sf_dir):
    """All documents in 24 shards of near equal bytes."""
    return sharding.shard(documents(spark, sf_dir))


@query("op7_fingerprints")
def fingerprinted(spark, sf_dir):
    """Fingerprints of every text and of its edited text."""
    return simhash.fingerprints(documents(spark, sf_dir))


@query("op9_pseudonyms")
def pseudonymised(spark, sf_dir):
    """Every text with personal data replaced by pseudonyms."""
    return pii.protected(documents(spark, sf_dir))


@query("op2_repeated_strings")
def unrepeated(spark, sf_dir):
    """What repeated strings of 400 bytes take out of every text."""
    return suffix.removal(documents(spark, sf_dir))


_TOP_PRODUCTS = """
WITH whole AS (
    SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query("op5_top_products", _TOP_PRODUCTS)
def top_products(spark, sf_dir):
    """The 20 best candidates of every twentieth vector."""
    return topk.top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 20 = 0")


@query("op6_token_counts")
def counted(spark, sf_dir):
    """Tokens of every text under a unigram vocabulary."""
    return unigram.token_counts(documents(spark, sf_dir))


_LEXICAL = r"""
WITH doc_terms AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), item_terms AS (
    SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), lengths AS (SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
tf AS (SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY doc_id, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM tf, totals GROUP BY term, n_docs
), asked AS (SELECT item_id, term, count(*) AS times FROM item_terms GROUP BY item_id, term),
scored AS (
    SELECT item_id, doc_id,
        CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // total))))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id), totals GROUP BY item_id, doc_id
), placed AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""


@query("op11_ranked_search", _LEXICAL)
def ranked_documents(spark, sf_dir):
    """The ten best documents for every benchmark item."""
    return lexical.top_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op12_license_scan")
def licensed(spark, sf_dir):
    """Licence notices and expressions of every text."""
    return licenses.labelled(documents(spark, sf_dir))


_INFILLED = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
        sha256('7:' || doc_id) AS h FROM documents
), numbers AS (
    SELECT doc_id, text, lines, CAST(len(lines) AS BIGINT) AS n,
        [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) FOR i IN range(4)] AS h,
    FROM drawn
), placed AS (
    SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
            WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), parts AS (
    SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle, array_to_string(lines[b + 1:], '') AS suffix
    FROM placed
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""


@query("op13_fill_in_middle", _INFILLED)
def infilled(spark, sf_dir):
    """Every text cut, arranged for filling in its middle, and rebuilt."""
    return fim.digests(documents(spark, sf_dir))
