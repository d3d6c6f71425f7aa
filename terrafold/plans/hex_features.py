"""Bands to hexagon feature rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions import hexgrid
from terrafold.functions.edges import coerce_bbox
from terrafold.functions.projection import project_point, unproject_columns, unproject_vertices, utm_code, zones_near
from terrafold.functions.scene_ids import scene_parts
from terrafold.functions.spectral import REQUIRED_INDEX_BANDS
from terrafold.operators import bands as B
from terrafold.operators import cells as C
from terrafold.operators import zonal as Z


def study_envelope(bbox, epsg: int, samples: int = 22) -> tuple[float, float, float, float]:
    """Grid box that holds a lon/lat box, its sides sampled on the driver."""
    west, south, east, north = coerce_bbox(bbox)
    steps = [i / samples for i in range(samples + 1)]
    lons = [west + (east - west) * t for t in steps]
    lats = [south + (north - south) * t for t in steps]
    points = [project_point(lo, la, epsg) for lo in lons for la in (south, north)]
    points += [project_point(lo, la, epsg) for la in lats for lo in (west, east)]
    xs, ys = zip(*points)
    bulge = 0.001 * (max(xs) - min(xs))
    return min(xs) - bulge, min(ys) - bulge, max(xs) + bulge, max(ys) + bulge


def cell_statistics(
    indices: DataFrame,
    resolution: int = hexgrid.DEFAULT_RESOLUTION,
    stats: Sequence[str] = Z.DEFAULT_STATS,
    touch: str = "all",
    half_pixel: float = 15.0,
) -> DataFrame:
    """Statistics of every index per scene and cell address ``q, r``.

    Grouping is on the two integers; partial aggregation leaves one row per task, scene
    and cell to shuffle, however many pixels a cell or scene has. Pixels that have an
    ``epsg`` have cells of their own zone; the code is then part of the address.
    """
    assigned = C.assign_cells(indices, resolution, touch, half_pixel)
    return Z.wide_stats(assigned, ["scene_id", *zone_column(indices), "q", "r"], stats=stats)


def zone_column(df: DataFrame) -> list[str]:
    """``epsg`` where rows have one."""
    return [c for c in df.columns if c == "epsg"]


def of_one_system(df: DataFrame, epsg: int) -> DataFrame:
    """The rows without their ``epsg``; a row of another system stops the query."""
    wrong = F.concat(F.lit(f"rows are to be in EPSG:{epsg}, found "), F.coalesce(F.col("epsg").cast("string"), F.lit("none")))
    return df.filter(F.when(F.col("epsg") == epsg, True).otherwise(F.raise_error(wrong).cast("boolean"))).drop("epsg")


def study_boxes(bbox_wgs84, resolution: int = hexgrid.DEFAULT_RESOLUTION, half_pixel: float = 15.0) -> dict[int, tuple[float, float, float, float]]:
    """The grid box of a lon/lat box in every zone near it, grown by what its cells can reach."""
    west, _, east, _ = coerce_bbox(bbox_wgs84)
    reach = hexgrid.edge_m(resolution) + half_pixel
    found = {code: study_envelope(bbox_wgs84, code) for code in zones_near(west, east)}
    return {code: (b[0] - reach, b[1] - reach, b[2] + reach, b[3] + reach) for code, b in found.items()}


def near_box(pixels: DataFrame, bbox_wgs84, epsg: int | None, reach: float) -> DataFrame:
    """Pixels within ``reach`` metres of a lon/lat box, by comparisons with literals.

    Where pixels have their own ``epsg`` the box is projected once to every zone near it; a
    pixel of a zone further away cannot lie in the box.
    """
    inside = lambda b: F.col("x").between(b[0] - reach, b[2] + reach) & F.col("y").between(b[1] - reach, b[3] + reach)
    if epsg is not None:
        return pixels.filter(inside(study_envelope(bbox_wgs84, epsg)))
    west, _, east, _ = coerce_bbox(bbox_wgs84)
    test = F.lit(False)
    for code in zones_near(west, east):
        test = test | ((F.col("epsg") == code) & inside(study_envelope(bbox_wgs84, code)))
    return pixels.filter(utm_code(F.col("epsg")).isNotNull()).filter(test)


def build_hex_features(
    pixels: DataFrame,
    bbox_wgs84,
    epsg: int | None = None,
    resolution: int = hexgrid.DEFAULT_RESOLUTION,
    stats: Sequence[str] = Z.DEFAULT_STATS,
    touch: str = "all",
    half_pixel: float = 15.0,
) -> DataFrame:
    """Aligned band pixels to feature rows of the cells centred in the study box.

    ``pixels`` has ``scene_id, x, y`` and one digital-number column per required band. All
    scenes are one plan. The box reaches the scan as literal comparisons, grown by one
    cell; cells without valid pixels vanish in the aggregation, so a footprint filter
    beforehand would not change the result.

    Pixels with an ``epsg`` column may lie in several UTM zones: each scene has cells of its
    zone's grid, whose ids and rows name the zone. With the argument ``epsg`` all pixels are
    of that one system, ids do without, and a pixel of another system is an error.
    """
    if epsg is None and "epsg" not in pixels.columns:
        raise ValueError("pixels have no epsg column: say which system they are in")
    if epsg is not None and "epsg" in pixels.columns:
        pixels = of_one_system(pixels, epsg)
    near = near_box(pixels, bbox_wgs84, epsg, hexgrid.edge_m(resolution) + half_pixel)
    zone = zone_column(pixels)
    indices = B.with_indices(near, ["scene_id", *zone, "x", "y"], REQUIRED_INDEX_BANDS)
    grouped = cell_statistics(indices, resolution, stats, touch, half_pixel)
    west, south, east, north = coerce_bbox(bbox_wgs84)
    system = F.col("epsg") if epsg is None else epsg
    centred = unproject_columns(C.with_center(grouped, resolution), "cx", "cy", system, "center_lon", "center_lat")
    kept = centred.filter(F.col("center_lon").between(west, east) & F.col("center_lat").between(south, north))
    return finish_features(kept, resolution, stats, zone)


def finish_features(
    grouped: DataFrame, resolution: int, stats: Sequence[str], extra: Sequence[str] = ()
) -> DataFrame:
    """Cell id, partition key and acquisition date; the public column order."""
    key = f"cell_res{resolution}"
    zone = F.col("epsg") if zone_column(grouped) else None
    named = grouped.withColumn("cell", hexgrid.cell_id(F.col("q"), F.col("r"), resolution, zone))
    return named.select(
        "cell",
        F.col("cell").alias(key),
        *[f"{i}_{s}" for i in Z.INDEX_NAMES for s in stats],
        "pixel_count",
        "scene_id",
        scene_parts("scene_id")["acquisition_date"].alias("acquisition_date"),
        *extra,
    )


def with_cell_geometry(features: DataFrame, epsg: int | None, resolution: int) -> DataFrame:
    """Add ``geometry``: the closed lon/lat ring of each cell, in the zone its id names."""
    _, q, r = hexgrid.parse_cell_id(F.col("cell"))
    corners = hexgrid.vertices(hexgrid.center_x(q, r, resolution), hexgrid.center_y(r, resolution), resolution)
    named = hexgrid.cell_epsg(F.col("cell"))
    zone = epsg if epsg is not None else named
    return features.withColumn("geometry", close_ring(unproject_vertices(corners, zone)))


def close_ring(points: Column) -> Column:
    return F.concat(points, F.slice(points, 1, 1))


def pixels_from_blocks(blocks: DataFrame) -> DataFrame:
    """Band blocks to aligned pixels named as :func:`build_hex_features` wants them."""
    return B.align_block_bands(blocks, REQUIRED_INDEX_BANDS)
