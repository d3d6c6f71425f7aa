"""Statistics of index columns per zone, in wide and long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions.spectral import INDEX_BANDS

DEFAULT_STATS = ("mean", "std")
INDEX_NAMES = tuple(INDEX_BANDS)

_STAT_FUNCTIONS = {
    "mean": F.avg,
    "std": F.stddev_pop,
    "min": F.min,
    "max": F.max,
    "count": F.count,
}


def check_stats(stats: Sequence[str]) -> tuple[str, ...]:
    unknown = sorted(set(stats) - set(_STAT_FUNCTIONS))
    if unknown:
        raise ValueError(f"Unknown statistics: {unknown}")
    return tuple(stats)


def stat_columns(indices: Sequence[str], stats: Sequence[str]) -> list[Column]:
    """``{index}_{stat}`` aggregates, all of which combine before the shuffle."""
    return [_STAT_FUNCTIONS[s](i).alias(f"{i}_{s}") for i in indices for s in check_stats(stats)]


def _valid_count(index: str) -> Column:
    return F.count(index).alias(f"__n_{index}")


def wide_stats(
    pixels: DataFrame,
    keys: Sequence[str],
    indices: Sequence[str] = INDEX_NAMES,
    stats: Sequence[str] = DEFAULT_STATS,
) -> DataFrame:
    """One row per zone: ``{index}_{stat}`` and ``pixel_count``.

    ``pixel_count`` is the count of the last index that has any valid pixel; zones where
    no index has one are dropped.
    """
    grouped = pixels.groupBy(*keys).agg(
        *stat_columns(indices, stats), *[_valid_count(i) for i in indices]
    )
    counts = [F.when(F.col(f"__n_{i}") > 0, F.col(f"__n_{i}")) for i in reversed(list(indices))]
    return (
        grouped.withColumn("pixel_count", F.coalesce(*counts))
        .filter(F.col("pixel_count").isNotNull())
        .drop(*[f"__n_{i}" for i in indices])
    )


def long_stats(
    pixels: DataFrame,
    keys: Sequence[str],
    indices: Sequence[str] = INDEX_NAMES,
    stats: Sequence[str] = DEFAULT_STATS,
) -> DataFrame:
    """One row per zone and index: ``index_name``, the statistics, and always ``max``.

    All indices are aggregated in one pass and unfolded afterwards. Zones without a valid
    pixel of an index have no row for it.
    """
    stats = list(check_stats(stats))
    if "max" not in stats:
        stats.append("max")
    grouped = pixels.groupBy(*keys).agg(
        *[
            F.struct(F.lit(i).alias("index_name"), F.count(i).alias("__n"),
                     *[_STAT_FUNCTIONS[s](i).alias(s) for s in stats]).alias(f"stats_{i}")
            for i in indices
        ]
    )
    unfolded = grouped.select(*keys, F.inline(F.array(*[f"stats_{i}" for i in indices])))
    return unfolded.filter(F.col("__n") > 0).drop("__n")


def union_indices(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of per-index (or per-scene) results by column name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def pivot_index_stats(long_df: DataFrame, stats: Sequence[str]) -> DataFrame:
    """Long statistics back to one row per region and scene.

    Absent indices give NULL columns; ``max`` is carried along when present.
    """
    keys = ["region_id", "region_kind", "scene_id", *[c for c in long_df.columns if c == "epsg"]]
    keys += [c for c in long_df.columns if c.startswith("cell_res")][:1]
    names = [s for s in stats if s in long_df.columns]
    if "max" in long_df.columns and "max" not in names:
        names.append("max")
    return long_df.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("index_name") == i, F.col(s))).alias(f"{i}_{s}")
            for i in INDEX_NAMES
            for s in names
        ]
    )


def attach_geometry(stats: DataFrame, regions: DataFrame, columns: Sequence[str] = ("edges",)) -> DataFrame:
    """Left join of region geometry onto statistics; where both name a system, of that one."""
    keys = ["region_id", *[c for c in ("epsg",) if c in stats.columns and c in regions.columns]]
    return stats.join(regions.select(*keys, *columns), keys, "left")


def tabular(features: DataFrame, geometry_columns: Sequence[str] = ("edges", "geometry")) -> DataFrame:
    """The table without its geometry."""
    return features.drop(*geometry_columns)
