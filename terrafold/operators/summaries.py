"""Summaries of feature tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.sources.shared import fresh_path

# Ranges that an interval is cut into, and distinct values that are ranked in one task.
_RANGES, _RANKED = 200, 100_000


def feature_summary(features: DataFrame) -> DataFrame:
    """Rows and distinct scenes. Scenes collapse to one row each before they are counted."""
    return (
        features.groupBy("scene_id")
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(
            F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("n_rows"),
            F.count("scene_id").alias("n_scenes"),
        )
    )


def exact_quantiles(pairs: DataFrame, probabilities: Sequence[float], most: int = _RANKED) -> DataFrame:
    """Interpolated quantiles per ``column_name`` of its ``value``s, as ``q0, q1, ...``.

    No group is gathered anywhere. Equal values collapse to (value, count), which is written
    once. For every wanted rank an interval is then narrowed: a sketch of fixed size cuts it
    into ranges, the counts of the ranges tell which one holds the rank. Once it has at most
    ``most`` distinct values these are ranked. The driver sees a few numbers for each rank; a
    round makes intervals some two hundred times smaller.
    """
    spark = pairs.sparkSession
    path = fresh_path(spark, "values")
    grouped = pairs.filter(F.col("value").isNotNull()).groupBy("column_name", F.col("value").cast("double").alias("value"))
    grouped.agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    counts = spark.read.schema("column_name string, value double, n bigint").parquet(path)
    totals = {r["column_name"]: r["n"] for r in counts.groupBy("column_name").agg(F.sum("n").alias("n")).collect()}
    wanted = [(c, k, p * (n - 1)) for c, n in sorted(totals.items()) for k, p in enumerate(probabilities)]
    ranks = sorted({(c, rank) for c, _, at in wanted for rank in (math.floor(at), math.ceil(at))})
    # Of each rank: below and up to which value it lies, and how many values are below.
    known = {r: (None, None, 0) for r in ranks}
    state = "column_name string, rank bigint, low double, high double, start bigint"

    def inside(some: list[tuple[str, int]]) -> DataFrame:
        held = F.broadcast(spark.createDataFrame([(*r, *known[r]) for r in some], state))
        above = F.col("low").isNull() | (F.col("value") > F.col("low"))
        return counts.join(held, "column_name").filter(above & (F.col("high").isNull() | (F.col("value") <= F.col("high"))))

    wide, steps = ranks, F.array(*[F.lit(i / _RANGES) for i in range(1, _RANGES)])
    while wide:
        cut = inside(wide).groupBy("column_name", "rank").agg(
            F.count(F.lit(1)).alias("m"), F.percentile_approx("value", steps, F.lit(10 * _RANGES)).alias("cuts")
        )
        cuts = {(r["column_name"], r["rank"]): sorted(set(r["cuts"])) for r in cut.filter(F.col("m") > most).collect()}
        wide = sorted(cuts)
        if not wide:
            break
        table = F.broadcast(spark.createDataFrame([(*r, c) for r, c in cuts.items()], "column_name string, rank bigint, cuts array<double>"))
        placed = inside(wide).join(table, ["column_name", "rank"]).withColumn("range_no", F.size(F.filter("cuts", lambda c: c < F.col("value"))))
        sums: dict[tuple[str, int], dict[int, int]] = {r: {} for r in wide}
        for r in placed.groupBy("column_name", "rank", "range_no").agg(F.sum("n").alias("n")).collect():
            sums[r["column_name"], r["rank"]][r["range_no"]] = r["n"]
        for r in wide:
            low, high, start = known[r]
            for number in sorted(sums[r]):
                if start + sums[r][number] > r[1]:
                    break
                start += sums[r][number]
            known[r] = cuts[r][number - 1] if number else low, cuts[r][number] if number < len(cuts[r]) else high, start

    if not ranks:
        return spark.createDataFrame([], "column_name string, " + ", ".join(f"q{k} double" for k in range(len(probabilities))))
    order = Window.partitionBy("column_name", "rank").orderBy("value")
    ordered = inside(ranks).withColumn("last", F.col("start") + F.sum("n").over(order))
    found = ordered.filter((F.col("last") > F.col("rank")) & (F.col("last") - F.col("n") <= F.col("rank"))).select("column_name", "rank", "value")
    # Each found value weighs by how close its rank is to the wanted position.
    asked = [(c, k, at, rank) for c, k, at in wanted for rank in sorted({math.floor(at), math.ceil(at)})]
    positions = F.broadcast(spark.createDataFrame(asked, "column_name string, k int, position double, rank bigint"))
    part = F.col("value") * (F.lit(1.0) - F.abs(F.col("position") - F.col("rank")))
    return found.join(positions, ["column_name", "rank"]).groupBy("column_name").agg(
        *[F.sum(F.when(F.col("k") == k, part)).alias(f"q{k}") for k in range(len(probabilities))]
    )


def describe(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row per column.

    All columns are unfolded to (column, value) first, so one pass serves them all.
    """
    named = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    pairs = features.select(F.inline(named))
    value = F.col("value")
    moments = pairs.groupBy("column_name").agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = exact_quantiles(pairs, (0.25, 0.5, 0.75))
    return moments.join(quartiles, "column_name", "left").select(
        "column_name", "n", "mean", "std", "min",
        F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"), "max",
    )
