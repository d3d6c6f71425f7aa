"""What several operators need: kept tables, text batches as bytes, gapless ranks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.sources.shared import fresh_path

#: Bytes of text that one NumPy step works on; a longer document is a step of its own.
CHUNK_BYTES = 1 << 20
#: Bytes up to which a measured table is sent to all executors rather than shuffled.
BROADCAST_BYTES = 32 << 20


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts lineage, fixes the rows (a repeated task reads the same ones) and outlives the loss
    of any executor.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame, rows: int = 1000) -> None:
    """Send whole texts to Python workers in batches of at most ``rows`` rows.

    Texts are long; ten thousand of them in a batch are held several times at once.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= rows:
        conf.set(name, rows)


def small_side(df: DataFrame, row_bytes: str) -> DataFrame:
    """Mark a kept table for broadcast if its measured size is within ``BROADCAST_BYTES``.

    ``row_bytes`` is SQL for the bytes of a row. A larger table is returned as it is, and
    the join shuffles; the rows that come out are the same.
    """
    total = df.agg(F.expr(f"coalesce(sum({row_bytes}), 0)")).first()[0]
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def split_by_bits(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose ``key`` may be among those of ``keys``, and rows whose key is not.

    The keys set bits of a map of 2**25 bits in 2**19 words; that map is what is broadcast, so
    it has at most 8 MB at any size. The more keys, the more rows of the first kind have none.
    """
    word, bit, bits = unused(df, "_word", "_bit", "_bits")
    held = keys.select(F.xxhash64(key).alias("h")).select(
        F.shiftrightunsigned("h", 45).alias(word), F.expr("shiftleft(1L, cast(h & 63 AS int))").alias("b")
    )
    held = F.broadcast(held.groupBy(word).agg(F.bit_or("b").alias(bits)))
    marked = df.withColumn(bit, F.xxhash64(key)).withColumn(word, F.shiftrightunsigned(bit, 45)).join(held, word, "left")
    hit = F.expr(f"coalesce({bits}, 0L) & shiftleft(1L, cast({bit} & 63 AS int))") != 0
    return marked.filter(hit).drop(word, bit, bits), marked.filter(~hit).drop(word, bit, bits)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow text column and each row's offsets; null is empty."""
    column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES, most: int = 1 << 16) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes and at most ``most`` rows; at least one row each."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), row + most, rows)
        yield row, end
        row = end


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, as far as they are asked for."""

    def __init__(self, base: int = 0x9E3779B97F4A7C15 | 1):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)
        # One fixed random number for each byte value.
        self.values = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            for name, step in (("up", self.base), ("down", self.inverse)):
                series = np.full(size, step, np.uint64)
                series[0] = 1
                setattr(self, name, np.multiply.accumulate(series))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Running sums from which ``between`` reads the hash of any byte range."""
        self.reach(len(data) + 1)
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of each range; equal bytes have equal hashes wherever they stand."""
        return (sums[end] - sums[start]) * self.down[start]


POWERS = Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def part_ids(rows: int, used: int) -> np.ndarray:
    """Ids for the next rows of a task: its number in the high bits, then a counter.

    The same layout as ``monotonically_increasing_id``.
    """
    return np.arange(used, used + rows, dtype=np.int64) + (np.int64(TaskContext.get().partitionId()) << 33)


def gapless_ranks(kept: DataFrame, key: str, rank: str, row_id: str) -> DataFrame:
    """Number the rows of each key from 0 without gaps, in the order of ``row_id``.

    ``row_id`` is unique, stored, and names the task that wrote the row in its high bits. A
    key's rows are numbered within each such part and shifted by the counts of the parts
    before, so a key that holds most rows is numbered by as many tasks as parts.
    """
    kept = kept.withColumn("_part", F.shiftright(row_id, 33))
    here = Window.partitionBy(key, "_part").orderBy(row_id)
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = kept.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    shifts = counts.select(key, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    return (
        kept.withColumn("_local", F.row_number().over(here) - 1)
        .join(shifts, [key, "_part"])
        .withColumn(rank, (F.col("_local") + F.col("_shift")).cast("long"))
        .drop("_part", "_local", "_shift")
    )
