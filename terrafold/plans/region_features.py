"""Index pixels to corridor or polygon feature rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.operators import regions as R
from terrafold.operators import zonal as Z
from terrafold.sources.features import replace_partitions
from terrafold.sources.shared import fresh_path, keep, shuffles_freed

#: Pixels whose shuffles may lie on disk at a time; with the statistics of their regions some 150 bytes each.
WAVE_PIXELS = 80_000_000


def region_statistics_long(
    indices: DataFrame,
    regions: DataFrame,
    stats: Sequence[str] = Z.DEFAULT_STATS,
    resolution: int | None = None,
    **join_options,
) -> DataFrame:
    """Statistics per region, scene and index, in long form; repeated region ids are an error."""
    regions = R.require_unique_ids(_kept(regions))
    keys = _keys(indices, regions, resolution)
    return _by_shape(indices, regions, keys, lambda joined, keys: Z.long_stats(joined, keys, stats=stats), join_options)


def build_region_features(
    indices: DataFrame,
    regions: DataFrame,
    stats: Sequence[str] = Z.DEFAULT_STATS,
    resolution: int | None = None,
    geometry: bool = True,
    **join_options,
) -> DataFrame:
    """One row per region and scene with ``{index}_{stat}`` and ``{index}_max``.

    All scenes and indices are one plan: tile join, exact test, aggregation that combines
    before its shuffle. Nothing is folded to long form only to be pivoted back. Indices with
    an ``epsg`` may lie in several zones, which then stands in the rows too.
    """
    regions = R.require_unique_ids(_kept(regions))
    stats = list(stats) + ([] if "max" in stats else ["max"])
    keys = _keys(indices, regions, resolution)
    wide = _by_shape(indices, regions, keys, lambda joined, keys: Z.wide_stats(joined, keys, stats=stats), join_options)
    return Z.attach_geometry(wide, regions) if geometry else wide


def features_by_scenes(
    indices: DataFrame, build: Callable[[DataFrame], DataFrame], most_pixels: int = WAVE_PIXELS
) -> DataFrame:
    """Features of all scenes, built once for some scenes at a time and kept in the shared folder.

    ``build`` maps the index pixels of some scenes to their feature rows, each of one scene. A
    wave has about ``most_pixels`` pixels, or one scene; its shuffle files are deleted before
    the next, so the disk a build takes does not grow with the number of scenes. Pixels are read
    once for their number and once for each wave. The driver sees a count for each scene.
    """
    path = fresh_path(indices.sparkSession, "features")
    with shuffles_freed(indices.sparkSession):
        for pixels in _waves(indices, most_pixels):
            features = build(pixels)
            features.write.mode("append").parquet(path)
    return indices.sparkSession.read.schema(features.schema).parquet(path)


def _waves(indices: DataFrame, most_pixels: int) -> Iterator[DataFrame]:
    """The pixels by waves of whole scenes, as even as scenes allow; a scene without a name is one too."""
    scenes = [(r["count"], r["scene_id"]) for r in indices.groupBy("scene_id").count().collect()]
    waves = [[0, []] for _ in range(min(len(scenes), -(-sum(n for n, _ in scenes) // most_pixels)))]
    for n, name in sorted(scenes, key=lambda s: (-s[0], str(s[1]))):
        lightest = min(waves, key=lambda w: w[0])
        lightest[0] += n
        lightest[1].append(name)
    if len(waves) < 2:
        yield indices
        return
    for _, names in waves:
        some = F.col("scene_id").isin([n for n in names if n is not None])
        yield indices.filter(some | F.col("scene_id").isNull() if None in names else some)


def _kept(regions: DataFrame) -> DataFrame:
    """The regions written to the shared folder: they are read several times, and shaping them is long."""
    return keep(regions.repartition(regions.sparkSession.sparkContext.defaultParallelism), "regions")


def _by_shape(
    indices: DataFrame, regions: DataFrame, keys: list[str], statistics: Callable[[DataFrame, list[str]], DataFrame], join_options: dict
) -> DataFrame:
    """Statistics per key; where many regions have one shape, it meets the pixels once."""
    if not R.mostly_copies(regions):
        return statistics(R.pixel_region_join(indices, regions, **join_options), keys)
    ones, members = R.one_of_each_shape(regions)
    own = [k for k in keys if k in members.columns and k != "epsg"]
    kept = ["region_id", *[k for k in keys if k not in own]]
    found = statistics(R.pixel_region_join(indices, ones, **join_options), kept).withColumnRenamed("region_id", "shape_id")
    on = ["shape_id", *[k for k in ("epsg",) if k in kept]]
    return found.join(members.select(*own, *on), on).select(*keys, *[c for c in found.columns if c not in kept and c != "shape_id"])


def _keys(indices: DataFrame, regions: DataFrame, resolution: int | None) -> list[str]:
    keys = ["region_id", "region_kind", "scene_id"]
    keys += [c for c in ("epsg",) if c in indices.columns and c in regions.columns]
    if resolution is not None:
        keys.append(f"cell_res{resolution}")
        if keys[-1] not in regions.columns:
            raise ValueError(f"regions have no column {keys[-1]}")
    return keys


def write_region_features(
    features: DataFrame, path: str, resolution: int | None = None, scenes: DataFrame | None = None
) -> str:
    """Write all scenes at once; a second run replaces its own scenes, and those wholly.

    ``scenes`` (``scene_id``) are those the features were built for: one that no longer has any
    feature is emptied by the same commit.

    A directory is a scene. Cells are sorted inside it, so a filter on the cell key skips row
    groups, and cells that a second run no longer has go with the scene's old files.
    """
    within = ["region_id"] if resolution is None else [f"cell_res{resolution}"]
    return replace_partitions(features, path, "scene_id", within, scenes)
