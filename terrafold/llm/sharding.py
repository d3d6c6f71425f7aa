"""Shards of near equal bytes by sampled splitters.

Rows are ordered by a hash of their text and, within equal texts, by a row number. Size-
weighted samples of these keys give splitters at even quantiles; one pass measures every
range exactly; ranges above their share are sampled anew and cut again, inside one text
where copies alone overfill a range. Shards are runs of neighbouring ranges. The driver
sees samples and range totals, whose number depends on the number of shards alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrafold.llm.common import gapless_ranks, keep

SHARDS = 24
#: Ranges for each shard, and expected samples for each range.
RANGES, SAMPLES = 64, 8
#: Times an overfull range may be cut again.
ROUNDS = 6

Splitter = tuple[int, int]
#: Before every row of a text.
FIRST = -1


def locate(key: np.ndarray, row: np.ndarray, splitters: list[Splitter]) -> np.ndarray:
    """The range of every (key, row): how many splitters are at or before it."""
    keys = np.array([k for k, _ in splitters], np.int64)
    rows = np.array([r for _, r in splitters], np.int64)
    low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
    out, tied = low.copy(), np.flatnonzero(low < high)
    for a in np.unique(low[tied]):
        same = tied[low[tied] == a]
        out[same] = a + np.searchsorted(rows[a : high[same[0]]], row[same], "right")
    return out


def with_range(rows: DataFrame, splitters: list[Splitter]) -> DataFrame:
    def run(frames):
        for f in frames:
            yield f.assign(range=locate(f["key"].to_numpy(np.int64), f["row_id"].to_numpy(np.int64), splitters).astype(np.int32))

    return rows.mapInPandas(run, StructType(list(rows.schema.fields)).add("range", "integer"))


def sample(rows: DataFrame, chance) -> list[tuple]:
    """Rows drawn with a chance that grows with their size; the draw depends on the row alone."""
    draw = F.pmod(F.xxhash64("row_id", F.lit("draw")), F.lit(1 << 40)) / float(1 << 40)
    columns = ["key", "row_id", "size"] + [c for c in ("range",) if c in rows.columns]
    return sorted(tuple(r) for r in rows.filter(draw < chance).select(*columns).collect())


def quantiles(drawn: list[tuple], unit: float, ranges: int) -> list[tuple[int, int]]:
    """Keys that cut a weighted sample into ``ranges`` about equal parts."""
    weight = np.cumsum([max(float(d[2]), unit) for d in drawn])
    if not len(weight):
        return []
    at = np.searchsorted(weight, weight[-1] * np.arange(1, ranges) / ranges)
    return sorted({(drawn[i][0], drawn[i][1]) for i in at.tolist()})


@dataclass
class Ranges:
    splitters: list[Splitter]
    shard: list[int]


def choose(rows: DataFrame, shards: int, ranges: int = RANGES, samples: int = SAMPLES) -> Ranges:
    """Splitters, and the shard of every range between them."""
    total = rows.agg(F.sum("size")).first()[0]
    if not total:
        return Ranges([], [0])
    wanted = shards * ranges
    unit = total / (wanted * samples)
    drawn = sample(rows, F.col("size") / F.lit(unit))
    splitters = sorted({(k, FIRST) for k, _ in quantiles(drawn, unit, wanted)})
    limit = 2.0 * total / wanted
    for step in range(ROUNDS):
        placed = with_range(rows, splitters)
        sizes = {r["range"]: (r["bytes"], r["n"]) for r in placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
        over = {k: b for k, (b, n) in sizes.items() if b > limit and n > 1}
        if not over or step == ROUNDS - 1:
            break
        unit = total / (wanted * samples) / 2.0
        drawn = sample(placed.filter(F.col("range").isin(list(over))), F.col("size") / F.lit(unit))
        new = set()
        for k, size in over.items():
            own = [d for d in drawn if d[3] == k]
            new |= set(quantiles(own, unit, max(2, round(2 * size / limit) + 1)))
        # First between texts; a text that overfills its range alone is cut inside.
        cut = {(key, FIRST) for key, _ in new} if step == 0 else new | {(key, FIRST) for key, _ in new}
        if cut <= set(splitters):
            cut = new
        splitters = sorted(set(splitters) | cut)
    return Ranges(splitters, deal(splitters, [sizes.get(i, (0, 0))[0] for i in range(len(splitters) + 1)], shards))


def deal(splitters: list[Splitter], sizes: list[int], shards: int) -> list[int]:
    """Cut the ranges into runs whose totals are nearest to equal.

    Between two cuts about as good, the one that does not part equal texts is taken.
    """
    ends = np.cumsum(sizes)[:-1].astype(float)
    share = sum(sizes) / shards
    cost = np.array([0.0 if r == FIRST else 0.015 * share for _, r in splitters])
    cuts, last = [], 0
    for j in range(1, shards):
        if last < len(ends):
            last += int(np.argmin(np.abs(ends[last:] - j * share) + cost[last:]))
        cuts.append(last)
    # Range i lies after cut c when i > c.
    return [int(sum(i > c for c in cuts)) for i in range(len(sizes))]


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
        F.monotonically_increasing_id().alias("row_id"),
    )


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every row of ``docs`` (``doc_id``, ``text``), law ``bytes``.

    Totals of ``size`` (UTF-8 bytes and 8) are near equal: a shard differs from the mean by
    no more than a range, or one row if that is larger. Equal texts stay together unless
    that would unbalance the shards. Null text counts as empty; null or repeated ``doc_id``
    are rows like others; other columns are left out; an empty table gives none.
    """
    rows = keep(keyed(docs), "shard-rows")
    chosen = choose(rows, shards)
    splitters, by_range = chosen.splitters, np.array(chosen.shard, np.int32)

    def run(frames):
        for f in frames:
            ranges = locate(f["key"].to_numpy(np.int64), f["row_id"].to_numpy(np.int64), splitters)
            yield f.drop(columns="key").assign(shard=by_range[ranges])

    schema = StructType([x for x in rows.schema.fields if x.name != "key"]).add("shard", "integer")
    placed = gapless_ranks(rows.mapInPandas(run, schema), "shard", "slot", "row_id")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
