"""Measured decisions: which side of a join may be broadcast.

Nothing here guesses from file statistics. A side is broadcast only after its rows and
bytes were counted. Other joins shuffle both sides once, and Spark splits partitions that
turn out skewed (``spark.sql.adaptive.skewJoin``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast table must stay well below executor memory on every node.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
BROADCAST_MAX_ROWS = 1_000_000

_FIXED_WIDTH = 16


def _width(data_type: T.DataType, value: Column) -> Column:
    """Bytes one value takes, computed in the JVM."""
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.coalesce(F.length(value), F.lit(0)).cast("bigint") + _FIXED_WIDTH
    if isinstance(data_type, T.ArrayType):
        fields = len(data_type.elementType.fields) if isinstance(data_type.elementType, T.StructType) else 1
        return F.when(value.isNotNull(), F.size(value)).otherwise(0).cast("bigint") * (
            _FIXED_WIDTH * (fields + 1)
        )
    return F.lit(_FIXED_WIDTH).cast("bigint")


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a table, by one aggregation over it."""
    width = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        width = width + _width(field.dataType, F.col(f"`{field.name}`"))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def broadcast_if_bounded(
    df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES, max_rows: int = BROADCAST_MAX_ROWS
) -> tuple[DataFrame, bool]:
    """The table marked for broadcast when its measured size is within the bound."""
    rows, size = measure(df)
    if rows <= max_rows and size <= max_bytes:
        return F.broadcast(df), True
    return df, False


def tile_join(
    big: DataFrame,
    other: DataFrame,
    keys: list[str],
    condition: Column,
    max_bytes: int = BROADCAST_MAX_BYTES,
    bound: tuple[int, int] | None = None,
) -> DataFrame:
    """Inner join of a large table with tiled regions: broadcast when the tiles are known
    to be small, one shuffle of either side otherwise.

    Each side is evaluated once, whatever the keys, and its columns may be of any type. A
    tile with a large share of all pixels is split by Spark, as both inputs are shuffled for
    this join alone.

    ``bound`` is an upper bound of the tiles' (rows, bytes) when the caller has one that is
    cheaper than counting; only where it is too large are the tiles counted themselves.
    """
    if bound is not None and bound[0] <= BROADCAST_MAX_ROWS and bound[1] <= max_bytes:
        side, small = F.broadcast(other), True
    else:
        side, small = broadcast_if_bounded(other, max_bytes=max_bytes)
    return big.join(side if small else other.hint("merge"), keys, "inner").filter(condition)
