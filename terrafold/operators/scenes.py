"""Scene selection: filtering, deduplication, ordering, completeness and extents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.functions import scene_ids as S
from terrafold.functions.projection import unproject_columns
from terrafold.functions.spectral import REQUIRED_INDEX_BANDS
from terrafold.operators.cells import box_boundary

# Fixed value: a scene without a cloud figure counts as fully clouded.
MISSING_CLOUD_COVER = 100.0


def with_scene_parts(scenes: DataFrame, strict: bool = False) -> DataFrame:
    """Add path, row, year and date; ``strict`` makes a malformed id an error."""
    return scenes.withColumns(S.scene_parts("scene_id", strict=strict))


def filter_scenes(
    scenes: DataFrame,
    wrs_path: str | None = None,
    rows: Sequence[str] | None = None,
    dates: Sequence[str] | None = None,
    strict: bool = True,
) -> DataFrame:
    """Keep scenes that satisfy every filter given; None filters nothing.

    With ``strict`` a malformed id fails the job, as one scene silently missing from a
    result is worse than a stop.
    """
    parts = S.scene_parts("scene_id", strict=strict)
    if strict:
        # A bad id is rejected even where no filter is given.
        scenes = scenes.filter(parts["acquisition_date"].isNotNull())
    if wrs_path is not None:
        scenes = scenes.filter(parts["wrs_path"] == wrs_path)
    if rows is not None:
        scenes = scenes.filter(parts["wrs_row"].isin(list(rows)))
    if dates is not None:
        scenes = scenes.filter(parts["acquisition_date"].isin(list(dates)))
    return scenes


def check_threshold(max_cloud_cover: float) -> float:
    if not 0 <= max_cloud_cover <= 100:
        raise ValueError(f"max_cloud_cover must be between 0 and 100, got {max_cloud_cover}")
    return float(max_cloud_cover)


def discovered_scenes(items: DataFrame, max_cloud_cover: float, item_id: str = "item_id") -> DataFrame:
    """Search results to one row per scene with its lowest cloud cover.

    Cloud cover may be text or missing; both unparsable and missing count as 100. The
    comparison with the threshold is strict.
    """
    threshold = check_threshold(max_cloud_cover)
    cloud = F.col("cloud_cover").cast("string").try_cast("double")
    return (
        items.select(
            S.normalize_scene_id(item_id).alias("scene_id"),
            F.coalesce(F.nanvl(cloud, F.lit(MISSING_CLOUD_COVER)), F.lit(MISSING_CLOUD_COVER)).alias("cloud_cover"),
        )
        .filter(S.is_landsat9_l2sp("scene_id") & (F.col("cloud_cover") < threshold))
        .groupBy("scene_id")
        .agg(F.min("cloud_cover").alias("cloud_cover"))
    )


def clearest_first(scenes: DataFrame) -> DataFrame:
    """Ascending cloud cover; the id settles ties."""
    return scenes.orderBy("cloud_cover", "scene_id")


def clearest(scenes: DataFrame, n: int) -> DataFrame:
    """The ``n`` clearest scenes, as a top-k rather than a full sort."""
    return clearest_first(scenes).limit(n)


def missing_bands(
    scenes: DataFrame, available: DataFrame, required: Sequence[str] = REQUIRED_INDEX_BANDS
) -> DataFrame:
    """Required bands each scene lacks, comma separated and sorted.

    The requirement is unfolded from a literal array, and the anti-join runs on the
    distinct (scene, band) pairs.
    """
    wanted = scenes.select("scene_id").distinct().select(
        "scene_id", F.explode(F.array(*[F.lit(b) for b in required])).alias("band")
    )
    have = available.select("scene_id", "band").filter(F.col("band").isin(list(required))).distinct()
    return (
        wanted.join(have, ["scene_id", "band"], "left_anti")
        .groupBy("scene_id")
        .agg(F.concat_ws(",", F.array_sort(F.collect_set("band"))).alias("missing"))
    )


def require_bands(
    scenes: DataFrame, available: DataFrame, required: Sequence[str] = REQUIRED_INDEX_BANDS
) -> DataFrame:
    """The scenes, or an error naming some that lack required bands."""
    bad = missing_bands(scenes, available, required).limit(5).collect()
    if bad:
        text = "; ".join(f"{r['scene_id']}: {r['missing']}" for r in sorted(bad))
        raise ValueError(f"Missing required bands: {text}")
    return scenes


def scenes_from_paths(files: DataFrame) -> DataFrame:
    """Scene directories that hold at least one surface-reflectance band file."""
    return (
        files.filter(F.col("path").rlike("/[^/]*_SR_B[^/]*\\.TIF$"))
        .select(S.path_parent_name("path").alias("scene_id"))
        .distinct()
        .orderBy("scene_id")
    )


def scene_grid_extent(pixels: DataFrame, half_pixel: float, keys: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Outer grid box of each scene's pixels."""
    return pixels.groupBy(*keys).agg(
        (F.min("x") - half_pixel).alias("min_x"),
        (F.min("y") - half_pixel).alias("min_y"),
        (F.max("x") + half_pixel).alias("max_x"),
        (F.max("y") + half_pixel).alias("max_y"),
    )


def scene_bbox(extents: DataFrame, epsg: int, keys: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Lon/lat box of each grid box: the envelope of points along its four sides."""
    boxes = extents.select(*keys, "min_x", "min_y", "max_x", "max_y")
    points = unproject_columns(
        box_boundary(boxes, "min_x", "min_y", "max_x", "max_y"), "bx", "by", epsg, "__lon", "__lat"
    )
    return points.groupBy(*keys).agg(
        F.min("__lon").alias("west"),
        F.min("__lat").alias("south"),
        F.max("__lon").alias("east"),
        F.max("__lat").alias("north"),
    )


def intersect_boxes(df: DataFrame, a: Sequence[str], b: Sequence[str]) -> DataFrame:
    """Intersection ``west, south, east, north`` of two boxes per row; empty ones dropped."""
    west, south = F.greatest(a[0], b[0]), F.greatest(a[1], b[1])
    east, north = F.least(a[2], b[2]), F.least(a[3], b[3])
    return df.withColumns(
        {"__w": west, "__s": south, "__e": east, "__n": north}
    ).filter((F.col("__w") <= F.col("__e")) & (F.col("__s") <= F.col("__n"))).withColumnsRenamed(
        {"__w": "west", "__s": "south", "__e": "east", "__n": "north"}
    )
