"""SimHash fingerprints of 128 bits, and their neighbours by permuted block tables.

Every word votes with its hash on each bit, with a weight that grows with its length and its
occurrences. Votes are summed two bits to a 64-bit counter, so 64 integer sums make the 128
totals inside one hash aggregation that combines before it shuffles. DataFrame functions only.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.common import keep, small_side
from terrafold.llm.pii import let

BITS = 128
#: Letters of a word that count for its weight, the square of that number.
LONGEST = 8
#: Two counters in one number: a bit and the bit 32 places above.
LANES = 0x0000000100000001
#: Documents with an id divisible by this are searched for neighbours.
QUERY_EVERY = 100
#: Bits in which a neighbour's fingerprint may differ.
RADIUS = 3
#: Rows over which the fingerprints of a bucket are dealt.
SLICES = 32
#: Sorts null ids behind all others in descending order.
LEAST = -(1 << 63)


def weight(word: Column) -> Column:
    length = F.least(F.length(word), F.lit(LONGEST))
    return (length * length).cast("long")


def votes() -> list[Column]:
    """Aggregates over ``h1``, ``h2`` and ``w``: votes for each bit, and all votes."""
    sums = [F.expr(f"sum(w * (shiftright({h}, {k}) & {LANES}L))").alias(f"{h}_{k}") for h in ("h1", "h2") for k in range(32)]
    return [*sums, F.sum("w").alias("votes")]


def half(name: str) -> Column:
    """64 bits of the fingerprint from the sums of one hash."""
    low = " | ".join(f"if(2 * ({name}_{k} & 4294967295L) > votes, {1 << k}L, 0L)" for k in range(32))
    high = " | ".join(f"if(2 * shiftrightunsigned({name}_{k}, 32) > votes, shiftleft(1L, {k + 32}), 0L)" for k in range(32))
    return F.expr(f"({low}) | ({high})")


def with_fingerprints(texts: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``f1`` and ``f2``, the halves of the fingerprint of ``text``, for each ``keys``."""
    words = texts.select(*keys, F.explode(F.split(F.lower(text), r"\s+")).alias("word"))
    hashed = words.select(*keys, F.xxhash64("word").alias("h1"), F.xxhash64("word", F.lit(1)).alias("h2"), weight(F.col("word")).alias("w"))
    return hashed.groupBy(*keys).agg(*votes()).select(*keys, half("h1").alias("f1"), half("h2").alias("f2"))


def spelled(f1: Column, f2: Column) -> Column:
    """A fingerprint as 32 hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f2), 16, "0")))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Share of equal bits."""
    return 1 - flips(a, b) / float(BITS)


def in_ranges(docs: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Ranges of descending ids in column ``b``, and the largest id of each range.

    There are as many ranges as shuffle partitions; approximate quantiles cut them.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = docs.withColumn("k", F.coalesce(F.col("doc_id"), F.lit(LEAST)).cast("long"))
    at = [i / n for i in range(1, n)] or [0.5]
    cuts = keyed.agg(F.percentile_approx("k", at, 20 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    b = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c > F.col("k"))) if cuts else F.lit(0)
    keyed = keyed.withColumn("b", b)
    heads = sorted((r["b"], r["h"]) for r in keyed.groupBy("b").agg(F.max("k").alias("h")).collect())
    return keyed, heads


def edited(docs: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Every document with its place in descending order and its edited text.

    The order is by ``doc_id``, then by text. The document after a range's last is the first
    of the next range: rows with that id are copied there as guests that end it.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed, heads = in_ranges(rows)
    before = {heads[(i + 1) % len(heads)][1]: heads[i][0] for i in range(len(heads))}
    if not before:
        before = {0: 0}
    place = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    guests = keyed.filter(F.col("k").isin(list(before))).withColumn("b", place[F.col("k")])
    both = keyed.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    order = Window.partitionBy("b").orderBy("guest", F.desc("k"), "text")
    placed = both.withColumn("next", F.lead("text").over(order)).withColumn("seq", F.row_number().over(order)).filter("not guest")
    placed = placed.withColumn("n_chars", F.length("text").cast("long")).withColumn("cut", F.floor(F.col("n_chars") / 3).cast("int"))
    new = F.expr("concat(substring(text, 1, CAST(n_chars AS int) - cut), substring(next, 1, cut))")
    return placed.select("b", "seq", "doc_id", "n_chars", "text", new.alias("edited")), heads


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    Takes ``doc_id`` and ``text``; other columns are left out. Null text is empty; a text
    without words has a fingerprint of zeros. Equal texts have equal fingerprints. Rows that
    share a ``doc_id`` follow each other in order of text, a null ``doc_id`` comes last; a
    single row is its own next document; an empty table gives none. Counters hold texts of
    up to 67 million long words.

    Where ``doc_id`` is divisible by ``QUERY_EVERY``, ``n_neighbours`` counts all other
    documents whose fingerprint differs in at most ``RADIUS`` bits, and ``nearest_doc_id`` is
    the nearest: of a tie the least id, or, if the document itself has the least of its
    copies, the greatest of them. Elsewhere both are null.
    """
    placed, heads = edited(docs)
    place = ["b", "seq"]
    with_digest = placed.withColumn("sha", F.sha2("edited", 256))
    two = F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t"))
    )
    texts = with_digest.select(*place, "doc_id", "n_chars", "sha", F.explode(two).alias("x"))
    texts = texts.select(*place, "doc_id", "n_chars", "sha", "x.which", "x.t")
    marked = with_fingerprints(texts, "t", [*place, "doc_id", "n_chars", "sha", "which"])
    pick = lambda c, w: F.max(F.when(F.col("which") == w, F.col(c)))
    rows = keep(
        marked.groupBy(*place, "doc_id", "n_chars", "sha").agg(
            pick("f1", 0).alias("f1"), pick("f2", 0).alias("f2"), pick("f1", 1).alias("e1"), pick("f2", 1).alias("e2")
        ),
        "fingerprints",
    )
    # The first row of the next range stands after the last row of a range; one row a range.
    after = {heads[(i + 1) % len(heads)][0]: heads[i][0] for i in range(len(heads))} or {0: 0}
    previous = F.create_map(*[F.lit(x) for pair in after.items() for x in pair])
    firsts = rows.filter("seq = 1").select(previous[F.col("b")].alias("b"), F.col("f1").alias("h1"), F.col("f2").alias("h2"))
    order = Window.partitionBy("b").orderBy("seq")
    joined = rows.join(F.broadcast(firsts), "b", "left")
    followed = joined.withColumn("n1", F.coalesce(F.lead("f1").over(order), "h1")).withColumn("n2", F.coalesce(F.lead("f2").over(order), "h2"))
    own, new, after_ = ((F.col(a), F.col(b)) for a, b in (("f1", "f2"), ("e1", "e2"), ("n1", "n2")))
    around = keep(neighbours(rows), "neighbours")
    followed = followed.join(small_side(around, "64"), ["f1", "f2"], "left")
    asked, copies = F.col("doc_id") % QUERY_EVERY == 0, F.col("own.n") > 1
    copy = F.when(F.col("own.low") < F.col("doc_id"), F.col("own.low")).otherwise(F.col("own.high"))
    return followed.select(
        "doc_id",
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        spelled(*own).alias("fingerprint"),
        spelled(*new).alias("edited_fingerprint"),
        likeness(own, new).alias("near_edited"),
        likeness(own, after_).alias("near_next"),
        F.when(asked, F.col("total") - 1).alias("n_neighbours"),
        F.when(asked, F.when(copies, copy).otherwise(F.col("nearest.low"))).alias("nearest_doc_id"),
    )


def block_tables(radius: int) -> list[tuple[tuple[int, int], ...]]:
    """Tables of hexadecimal digits: ranges (start, length) that a table's key joins.

    The digits are cut into ``radius + 2`` blocks; within the radius at least two blocks are
    equal, so the tables keyed by every two blocks find every pair.
    """
    digits, n = BITS // 4, radius + 2
    cuts = [round(i * digits / n) for i in range(n + 1)]
    blocks = [(cuts[i] + 1, cuts[i + 1] - cuts[i]) for i in range(n)]
    return list(combinations(blocks, 2))


def block_masks(radius: int) -> list[tuple[int, int]]:
    """The bits of each block in the two halves of a fingerprint."""
    blocks = sorted({block for table in block_tables(radius) for block in table})
    masks = []
    for start, length in blocks:
        bits = sum(0xF << 4 * (BITS // 4 - start - i) for i in range(length))
        halves = (bits >> 64, bits & (1 << 64) - 1)
        masks.append(tuple(h - (1 << 64) if h >> 63 else h for h in halves))
    return masks


def flips(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def matches(queries: DataFrame, table: DataFrame, radius: int, others: tuple[str, ...] = ()) -> DataFrame:
    """Rows ``q1``, ``q2``, ``found``: parts of what lies within ``radius`` bits of a query.

    ``queries`` has distinct ``q1``, ``q2``; ``table`` has distinct ``f1``, ``f2`` and
    ``others``. ``found`` is an array of these with ``distance``; each pair comes once over
    all rows, from the table of the first two equal blocks. The fingerprints of a bucket are
    dealt over ``SLICES`` rows and compared there, so that no pair is a row and none is
    compared in one task because its bucket is large.
    """
    masks = block_masks(radius)
    tables = list(combinations(range(len(masks)), 2))

    def keys(a: str, b: str) -> Column:
        def key(i: int, j: int) -> Column:
            parts = [F.col(c).bitwiseAND(F.lit(masks[i][h] | masks[j][h])) for h, c in enumerate((a, b))]
            return F.struct(F.lit(1 << i | 1 << j).alias("t"), F.xxhash64(*parts).alias("key"))

        return F.explode(F.array(*[key(i, j) for i, j in tables])).alias("k")

    slice_of = F.pmod(F.xxhash64("f1", "f2", F.lit("slice")), F.lit(SLICES)).cast("int").alias("slice")
    entry = F.struct("f1", "f2", *others).alias("entry")
    buckets = table.select(entry, slice_of, keys("f1", "f2")).groupBy("k.t", "k.key", "slice").agg(F.collect_list("entry").alias("entries"))
    asked = queries.select("q1", "q2", keys("q1", "q2")).select("q1", "q2", "k.t", "k.key", F.explode(F.array(*[F.lit(i) for i in range(SLICES)])).alias("slice"))
    joined = asked.hint("merge").join(buckets, ["t", "key", "slice"])
    query = (F.col("q1"), F.col("q2"))

    def first_two(x: Column) -> Column:
        """The two first equal blocks of a query and an entry, as bits."""
        equal = F.lit(0)
        for i, (m1, m2) in enumerate(masks):
            same = (query[0].bitwiseXOR(x["f1"]).bitwiseAND(F.lit(m1)) == 0) & (query[1].bitwiseXOR(x["f2"]).bitwiseAND(F.lit(m2)) == 0)
            equal = equal + F.when(same, 1 << i).otherwise(0)
        return let(equal, lambda e: let(e.bitwiseAND(e - 1), lambda rest: e - rest + rest.bitwiseAND(-rest)))

    measured = F.transform("entries", lambda x: F.struct(flips(query, (x["f1"], x["f2"])).alias("distance"), *[x[c].alias(c) for c in ("f1", "f2", *others)]))
    near = F.filter(F.filter(measured, lambda x: x["distance"] <= radius), lambda x: first_two(x) == F.col("t"))
    return joined.select("q1", "q2", near.alias("found")).filter(F.size("found") > 0)


def neighbours(rows: DataFrame, every: int = QUERY_EVERY, radius: int = RADIUS) -> DataFrame:
    """For each fingerprint of a query: its documents, those around it, and the nearest.

    ``rows`` has ``doc_id``, ``f1``, ``f2``. Copies are one entry with their number and their
    least and greatest id.
    """
    ids = [F.min("doc_id").alias("low"), F.max("doc_id").alias("high")]
    table = keep(rows.groupBy("f1", "f2").agg(F.count("*").alias("n"), *ids), "fingerprint_table")
    queries = rows.filter(F.col("doc_id") % every == 0).select(F.col("f1").alias("q1"), F.col("f2").alias("q2")).distinct()
    found = matches(queries, table, radius, ("n", "low", "high"))
    total = F.aggregate("found", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    own = F.filter("found", lambda x: x["distance"] == 0)
    own = F.get(own, F.lit(0))
    nearest = F.array_min(F.transform(F.filter("found", lambda x: x["distance"] > 0), lambda x: F.struct(x["distance"], x["low"])))
    parts = found.select("q1", "q2", total.alias("total"), own.alias("own"), nearest.alias("nearest"))
    return parts.groupBy(F.col("q1").alias("f1"), F.col("q2").alias("f2")).agg(F.sum("total").alias("total"), F.max("own").alias("own"), F.min("nearest").alias("nearest"))


def within(queries: DataFrame, fingerprint_table: DataFrame, radius: int) -> DataFrame:
    """Distinct fingerprints of ``fingerprint_table`` within ``radius`` bits of each query.

    Both have a column ``fingerprint`` (hexadecimal); a pair comes once, with ``distance``;
    equal fingerprints are one row each, so copies do not multiply. Null fingerprints match
    nothing; empty tables give none.
    """
    part = lambda at: f"CAST(conv(substring(fingerprint, {at}, 8), 16, 10) AS bigint)"
    numbers = [F.expr(f"shiftleft({part(at)}, 32) | {part(at + 8)}") for at in (1, 17)]

    def halves(df: DataFrame, names: str) -> DataFrame:
        return df.filter("fingerprint is not null").select(numbers[0].alias(names + "1"), numbers[1].alias(names + "2")).distinct()

    found = matches(halves(queries, "q"), halves(fingerprint_table, "f"), radius)
    pairs = found.select("q1", "q2", F.explode("found").alias("x"))
    return pairs.select(spelled(F.col("q1"), F.col("q2")).alias("query"), spelled(F.col("x.f1"), F.col("x.f2")).alias("found"), F.col("x.distance").alias("distance"))
