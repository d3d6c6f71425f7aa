"""Keeping computed columns computed once, and filters where they are cheap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters refer to by name.

    A filter on an ordinary computed column is pushed below it with the formula written
    out at every mention; for long formulas that outgrows what can be compiled. Unfolding
    a one-element array yields the same columns, but as the output of a generator, which
    filters on them stay above of.
    """
    values = F.struct(*[c.alias(n) for n, c in columns.items()])
    keep = [c for c in df.columns if c not in columns]
    return df.select(*keep, F.inline(F.array(values)))


def closed(test: Column) -> Column:
    """The test with NULL read as false.

    Spark derives "is not null" filters from the inputs of a bare comparison and pushes
    them down to the scan, rewriting each in terms of the scanned columns. Below a chain of
    computed columns that repeats the whole chain in front of the plan; a test that cannot
    be NULL has nothing to derive.
    """
    return F.coalesce(test, F.lit(False))
