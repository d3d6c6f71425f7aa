"""Region tables and the joins between regions, blocks and pixels.

A region row is ``region_id, region_kind, areal, buffer_m, edges, epsg, min_x, min_y,
max_x, max_y`` (plus a partition column for cells). The buffer is never drawn: a pixel
belongs to a corridor when its distance to an edge is at most ``buffer_m``.

A region that scenes of several UTM zones may cover has a row for each zone, in that zone's
metres. Joins compare the systems of both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions import edges as E
from terrafold.functions.projection import central_meridian, project_vertices
from terrafold.functions.staging import closed, computed_once
from terrafold.operators.sizing import BROADCAST_MAX_BYTES, tile_join

DEFAULT_TILE_M = 240.0

_REGION_COLUMNS = ("region_id", "region_kind", "areal", "buffer_m", "edges", "epsg")


def geometry_paths(geom_type: Column, coordinates: Column) -> Column:
    """Coordinates of any GeoJSON geometry as an array of paths of ``[x, y]`` vertices.

    ``coordinates`` is the raw JSON text, because its nesting depends on the type.
    """
    depth = lambda d: F.from_json(coordinates, "array<" * d + "double" + ">" * d)
    return (
        F.when(geom_type == "Point", F.array(F.array(depth(1))))
        .when(geom_type == "MultiPoint", F.transform(depth(2), lambda p: F.array(p)))
        .when(geom_type == "LineString", F.array(depth(2)))
        .when(geom_type.isin("Polygon", "MultiLineString"), depth(3))
        .when(geom_type == "MultiPolygon", F.flatten(depth(4)))
    )


def with_paths(features: DataFrame) -> DataFrame:
    """Features (``geometry<type, coordinates>``) with ``paths`` and ``areal`` columns."""
    kind = F.col("geometry.type")
    return features.withColumns(
        {
            "paths": geometry_paths(kind, F.col("geometry.coordinates")),
            "areal": kind.isin("Polygon", "MultiPolygon"),
        }
    )


def drop_empty(features: DataFrame) -> DataFrame:
    """Features whose geometry has at least one vertex."""
    return features.filter(F.coalesce(F.exists("paths", lambda p: F.size(p) > 0), F.lit(False)))


def _finish(regions: DataFrame, extra: list[str]) -> DataFrame:
    return regions.select(*_REGION_COLUMNS, *extra).withColumns(E.envelope(F.col("edges")))


#: Degrees from a zone's central meridian beyond which a region is not placed in that zone.
ZONE_REACH = 9.0


def _in_zones(shaped: DataFrame, codes: Sequence[int]) -> DataFrame:
    """A row of every feature for each zone near it, paths in that zone's metres."""
    lons = F.flatten(F.transform("paths", lambda p: F.transform(p, lambda v: v[0])))
    zoned = shaped.withColumns({"__west": F.array_min(lons), "__east": F.array_max(lons)})
    zoned = zoned.withColumn("epsg", F.explode(F.array(*[F.lit(int(c)) for c in codes])))
    meridian = central_meridian(F.col("epsg"))
    near = (F.col("__west") <= meridian + ZONE_REACH) & (F.col("__east") >= meridian - ZONE_REACH)
    placed = F.transform("paths", lambda p: project_vertices(p, F.col("epsg")))
    return zoned.filter(near).withColumn("paths", placed).drop("__west", "__east")


def _regions(features: DataFrame, id_properties: list[str], epsg: int | Sequence[int] | None):
    """Paths in the metric grid, edges, and a stable id."""
    # Shaping is long, and a small file of features would be one task's.
    features = features.repartition(features.sparkSession.sparkContext.defaultParallelism)
    shaped = drop_empty(with_paths(features))
    # Features without a declared id get one from their shape: equal on every run.
    named = [F.col("properties")[p] for p in id_properties]
    if epsg is None or isinstance(epsg, int):
        paths = F.col("paths")
        if epsg is not None:
            paths = F.transform(paths, lambda p: project_vertices(p, epsg))
        shaped = shaped.withColumn("edges", E.paths_edges(paths)).withColumn("epsg", F.lit(4326 if epsg is None else epsg))
        shape = F.xxhash64("edges")
    else:
        # One id in all zones, so from the shape in degrees.
        told = shaped.withColumn("__shape", F.xxhash64("paths"))
        shaped, shape = _in_zones(told, epsg), F.col("__shape")
        shaped = shaped.withColumn("edges", E.paths_edges(F.col("paths")))
    return shaped.withColumn("region_id", F.coalesce(*named, shape.cast("string")))


def corridor_regions(
    features: DataFrame, buffer_m: float, epsg: int | Sequence[int] | None, bbox_wgs84=None, id_property: str = "OBJECTID"
) -> DataFrame:
    """Lines as buffered corridors; optionally only those that meet a lon/lat box.

    ``epsg`` is the code of the scenes' system, or the codes of all their systems: then a line
    has a row for each zone near it.
    """
    if bbox_wgs84 is not None:
        features = features_in_bbox(features, bbox_wgs84)
    shaped = _regions(features, [id_property], epsg)
    return _finish(
        shaped.withColumns(
            {"region_kind": F.lit("corridor"), "buffer_m": F.lit(float(buffer_m))}
        ),
        [],
    )


def polygon_regions(features: DataFrame, resolution: int, epsg: int | Sequence[int] | None = None) -> DataFrame:
    """Cell polygons of any origin, with the partition column ``cell_res{n}``.

    ``epsg`` as in :func:`corridor_regions`; without it polygons keep their degrees, and a
    join with pixels that have a system of their own is an error.
    """
    shaped = _regions(features, ["h3_index", "region_id"], epsg)
    key = f"cell_res{resolution}"
    return _finish(
        shaped.withColumns(
            {
                "region_kind": F.lit("hex"),
                "buffer_m": F.lit(0.0),
                key: F.col("region_id"),
            }
        ),
        [key],
    )


def features_in_bbox(features: DataFrame, bbox_wgs84) -> DataFrame:
    """GeoJSON features whose lon/lat geometry meets the box."""
    west, south, east, north = (F.lit(v) for v in E.coerce_bbox(bbox_wgs84))
    shaped = drop_empty(with_paths(features)).withColumn("__e", E.paths_edges(F.col("paths")))
    hit = E.edges_hit_box(F.col("__e"), F.col("areal"), west, south, east, north)
    return shaped.filter(hit).select(*features.columns)


def regions_in_box(regions: DataFrame, x0: Column, y0: Column, x1: Column, y1: Column) -> DataFrame:
    """Regions whose edges (or interior) meet a box in the regions' own coordinates.

    The envelope comparison is on plain columns, so it can be pushed into the scan.
    """
    return regions.filter(
        (F.col("min_x") <= x1) & (F.col("max_x") >= x0) & (F.col("min_y") <= y1) & (F.col("max_y") >= y0)
    ).filter(E.edges_hit_box(F.col("edges"), F.col("areal"), x0, y0, x1, y1))


def require_unique_ids(regions: DataFrame) -> DataFrame:
    """Fail when a region id occurs twice in a system; joining stats back would multiply rows."""
    keys = ["region_id", *[c for c in regions.columns if c == "epsg"]]
    repeated = regions.groupBy(*keys).count().filter("count > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"Duplicate region ids: {sorted({r['region_id'] for r in repeated})}")
    return regions


#: What makes two regions the same for every pixel.
_SHAPE = ("region_kind", "areal", "buffer_m", "edges", "epsg", "min_x", "min_y", "max_x", "max_y")


def mostly_copies(regions: DataFrame) -> bool:
    """Whether at least half of the regions have the shape of another one.

    The count is approximate; either way of joining gives the same rows.
    """
    shape = F.xxhash64(*[c for c in _SHAPE if c in regions.columns])
    row = regions.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(shape).alias("shapes")).first()
    return 2 * row["shapes"] <= row["n"]


def one_of_each_shape(regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A region for every shape, named by the smallest id, and the regions with that name as ``shape_id``."""
    shape = [c for c in _SHAPE if c in regions.columns]
    ones = regions.groupBy(*shape).agg(F.min("region_id").alias("region_id"))
    own = [c for c in regions.columns if c not in shape or c == "epsg"]
    named = ones.select(F.col("region_id").alias("shape_id"), *[F.col(c).alias(f"__{c}") for c in shape])
    condition = F.lit(True)
    for c in shape:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return ones, regions.join(named, condition).select(*own, "shape_id")


def _tile(value: Column, tile_m: float) -> Column:
    return F.floor(value / tile_m)


def tile_regions(regions: DataFrame, half_pixel: float, tile_m: float = DEFAULT_TILE_M) -> DataFrame:
    """Regions cut up by tile, holding only the edges that matter there.

    Pixels of a tile are decided by (a) edges near the tile, for distance, and (b) for
    areal shapes, edges to the right in the tile's row band, for ray crossings. All other
    edges are dropped. A region has one row in a tile and keeps each edge once there, so
    rows grow with the edges and a pixel meets a region once:

    - ``edge`` is the near edge where there is just one, ``edges`` holds several;
    - ``line_*`` describe a lone edge, see :func:`_line_distance_sq`;
    - ``ray_edges`` are those to cross for an areal shape with near edges. Where no edge is
      near, the tile is wholly inside (``full``) or wholly outside (dropped).
    """
    pad = F.col("buffer_m") + 2.0 * half_pixel
    rows = regions.withColumn("__pad", pad).withColumn(
        "tile_y",
        F.explode(
            F.sequence(
                _tile(F.col("min_y") - F.col("__pad"), tile_m),
                _tile(F.col("max_y") + F.col("__pad"), tile_m),
            )
        ),
    )
    keep = [c for c in regions.columns if c not in ("edges", "min_x", "min_y", "max_x", "max_y")]
    band_y0, band_y1 = F.col("tile_y") * tile_m, (F.col("tile_y") + 1) * tile_m
    banded = computed_once(
        rows,
        {
            "__band": F.filter(
                "edges",
                lambda e: (F.least(e["y0"], e["y1"]) - F.col("__pad") <= band_y1)
                & (F.greatest(e["y0"], e["y1"]) + F.col("__pad") >= band_y0),
            )
        },
    ).filter(F.size("__band") > 0)
    spans = computed_once(
        banded.select(*keep, "__pad", "tile_y", "__band"),
        {
            "__lo": F.array_min(F.transform("__band", lambda e: F.least(e["x0"], e["x1"]))),
            "__hi": F.array_max(F.transform("__band", lambda e: F.greatest(e["x0"], e["x1"]))),
        },
    )
    tiles = spans.withColumn(
        "tile_x",
        F.explode(
            F.sequence(
                _tile(F.col("__lo") - F.col("__pad"), tile_m),
                _tile(F.col("__hi") + F.col("__pad"), tile_m),
            )
        ),
    )
    # An edge is near when it, not merely its envelope, reaches the grown tile.
    x0, y0 = F.col("tile_x") * tile_m - F.col("__pad"), F.col("tile_y") * tile_m - F.col("__pad")
    x1, y1 = x0 + tile_m + F.col("__pad") * 2.0, y0 + tile_m + F.col("__pad") * 2.0
    none = F.array().cast(E.EDGES_TYPE)
    local = computed_once(
        tiles,
        {
            "__near": F.filter("__band", lambda e: E.edge_hits_box(e, x0, y0, x1, y1)),
            "__ray": F.when(
                F.col("areal"),
                F.filter("__band", lambda e: F.greatest(e["x0"], e["x1"]) >= F.col("tile_x") * tile_m),
            ).otherwise(none),
        },
    )
    middle = E.contains_point(F.col("__ray"), (F.col("tile_x") + 0.5) * tile_m, (F.col("tile_y") + 0.5) * tile_m)
    n = F.size("__near")
    found = computed_once(local, {"full": F.when(F.col("areal") & (n == 0), middle).otherwise(False)})
    one = F.col("__near")[0]
    ex, ey = one["x1"] - one["x0"], one["y1"] - one["y0"]
    long = F.sqrt(ex * ex + ey * ey)
    # A lone edge as its middle, unit direction and half its length, for the first look at a pair.
    line = {
        "line_x": (one["x0"] + one["x1"]) / 2.0, "line_y": (one["y0"] + one["y1"]) / 2.0,
        "line_dx": F.coalesce(F.try_divide(ex, long), F.lit(1.0)), "line_dy": F.coalesce(F.try_divide(ey, long), F.lit(0.0)),
        "line_half": long / 2.0,
    }
    return found.filter((n > 0) | F.col("full")).select(
        *keep, "tile_x", "tile_y", "full",
        *[F.when(n == 1, c).alias(name) for name, c in line.items()],
        F.when(n == 1, one).alias("edge"),
        F.when(n > 1, F.col("__near")).otherwise(none).alias("edges"),
        F.when(F.col("areal") & (n > 0), F.col("__ray")).otherwise(none).alias("ray_edges"),
    )


def tile_bound(regions: DataFrame, half_pixel: float, tile_m: float) -> tuple[int, int, list[int]]:
    """Upper bound of (rows, bytes) that :func:`tile_regions` can produce; the regions' systems.

    Read off the regions alone, in one pass: every edge reaches at most the tiles of its grown
    envelope, and every row holds at most all edges of its region twice.
    """
    pad = (F.col("buffer_m") + 2.0 * half_pixel) * 2.0
    tiles = lambda width, height: ((width + pad) / tile_m + 2.0) * ((height + pad) / tile_m + 2.0)
    along_edges = F.aggregate(
        "edges",
        F.lit(0.0),
        lambda total, e: total + tiles(F.abs(e["x1"] - e["x0"]), F.abs(e["y1"] - e["y0"])),
    )
    whole = F.when(
        F.col("areal"), tiles(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"))
    ).otherwise(0.0)
    rows = along_edges + whole
    row = regions.agg(
        F.coalesce(F.sum(rows), F.lit(0.0)).alias("n"),
        F.coalesce(F.sum(rows * (F.size("edges") * 80.0 + 160.0)), F.lit(0.0)).alias("b"),
        (F.sort_array(F.collect_set("epsg")) if "epsg" in regions.columns else F.array().cast("array<int>")).alias("codes"),
    ).first()
    return int(row["n"]), int(row["b"]), list(row["codes"])


def systems(regions: DataFrame) -> list[int]:
    """Codes of the systems that regions are in; at most one for each UTM zone."""
    return sorted(r["epsg"] for r in regions.select("epsg").distinct().collect() if r["epsg"] is not None)


def in_known_systems(pixels: DataFrame, codes: Sequence[int]) -> DataFrame:
    """The pixels; one in a system that no region is in stops the query."""
    known = F.col("epsg").isin(list(codes)) if codes else F.lit(True)
    wrong = F.concat(
        F.lit("pixels in EPSG:"), F.coalesce(F.col("epsg").cast("string"), F.lit("none")), F.lit(f", regions in EPSG:{list(codes)}")
    )
    return pixels.filter(F.when(known, True).otherwise(F.raise_error(wrong).cast("boolean")))


#: Columns of a tile that describe its lone edge.
LINE_COLUMNS = ("line_x", "line_y", "line_dx", "line_dy", "line_half")


def _line_distance_sq(x: Column, y: Column) -> Column:
    """Squared distance from a point to a tile's lone edge: two products, no division."""
    px, py = x - F.col("line_x"), y - F.col("line_y")
    past = F.greatest(F.abs(px * F.col("line_dx") + py * F.col("line_dy")) - F.col("line_half"), F.lit(0.0))
    across = py * F.col("line_dx") - px * F.col("line_dy")
    return past * past + across * across


def pixel_region_join(
    pixels: DataFrame,
    regions: DataFrame,
    half_pixel: float = 15.0,
    tile_m: float = DEFAULT_TILE_M,
    touch: str = "all",
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Pixels with every region they belong to, by an equi-join on square tiles.

    A pixel lies in exactly one tile and a region has one row there, so no pair is found
    twice and nothing needs a distinct. The test of a pixel against a single edge is
    compiled arithmetic; arrays are searched only where a region has more of them near.

    Pixels with an ``epsg`` meet the regions of their own system only; a pixel in a system
    without regions is an error. Pixels without one are taken to be in the system of the
    regions, which must then be a single one.
    """
    keys = ["tile_x", "tile_y"]
    *bound, codes = tile_bound(regions, half_pixel, tile_m)
    if "epsg" in regions.columns:
        if "epsg" in pixels.columns:
            pixels, keys = in_known_systems(pixels, codes), ["epsg", *keys]
        elif len(codes) > 1:
            raise ValueError(f"regions are in EPSG:{codes}, pixels do not say which system they are in")
        else:
            regions = regions.drop("epsg")
    tiled = pixels.withColumns(
        {"tile_x": _tile(F.col("x"), tile_m), "tile_y": _tile(F.col("y"), tile_m)}
    )
    # A small file of regions would be one task's to cut up.
    spread = regions.repartition(regions.sparkSession.sparkContext.defaultParallelism)
    areas = tile_regions(spread, half_pixel, tile_m)
    x, y, buffer_m = F.col("x"), F.col("y"), F.col("buffer_m")
    if touch == "all":
        near = lambda e: E.edge_near_square(e, x, y, half_pixel, buffer_m)
    elif touch == "center":
        near = lambda e: (buffer_m > 0) & E.edge_near_point(e, x, y, buffer_m)
    else:
        raise ValueError(f"touch must be 'all' or 'center', got {touch!r}")
    single = F.when(F.col("edge").isNotNull(), near(F.col("edge"))).otherwise(False)
    several = (F.size("edges") > 0) & F.exists("edges", near)
    inside = (F.size("ray_edges") > 0) & E.contains_point(F.col("ray_edges"), x, y)
    # Most pairs of a tile are far apart, and most of the others are near by their centre alone. A
    # short look settles both, with a millimetre to spare; the exact test is for the rest.
    distance_sq = _line_distance_sq(x, y)
    if touch == "all":
        reach, surely = buffer_m + (half_pixel * 2.0**0.5 + 1e-3), F.greatest(buffer_m - 1e-3, F.lit(0.0))
    else:
        reach, surely = buffer_m + 1e-3, F.lit(0.0)
    far = F.col("line_half").isNotNull() & (distance_sq > reach * reach) & (F.size("ray_edges") == 0)
    met = tile_join(tiled, areas, keys, closed(~far), max_bytes, tuple(bound))
    looked = computed_once(met, {"__near": closed(F.col("full") | (F.col("line_half").isNotNull() & (distance_sq < surely * surely)))})
    found = looked.filter(F.col("__near") | closed(single | several | inside))
    return found.drop("tile_x", "tile_y", "edge", "edges", "ray_edges", "full", "__near", *LINE_COLUMNS)


def block_region_join(
    blocks: DataFrame,
    regions: DataFrame,
    tile_m: float,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Blocks and regions whose envelopes meet (regions grown by their buffer).

    Blocks with an ``epsg`` meet the regions of their system only.
    Both sides cover several tiles. A pair is kept only in the tile holding the lower left
    corner of the common area, so it appears once without a distinct.
    """
    grown = regions.select(
        *[c for c in regions.columns if c not in ("min_x", "min_y", "max_x", "max_y", "edges")],
        (F.col("min_x") - F.col("buffer_m")).alias("region_min_x"),
        (F.col("min_y") - F.col("buffer_m")).alias("region_min_y"),
        (F.col("max_x") + F.col("buffer_m")).alias("region_max_x"),
        (F.col("max_y") + F.col("buffer_m")).alias("region_max_y"),
    )

    def tiles(df: DataFrame, p: str) -> DataFrame:
        for axis in ("x", "y"):
            span = F.sequence(_tile(F.col(f"{p}min_{axis}"), tile_m), _tile(F.col(f"{p}max_{axis}"), tile_m))
            df = df.withColumn(f"tile_{axis}", F.explode(span))
        return df

    corner_x = F.greatest("min_x", "region_min_x")
    corner_y = F.greatest("min_y", "region_min_y")
    meets = (
        (F.col("min_x") <= F.col("region_max_x"))
        & (F.col("max_x") >= F.col("region_min_x"))
        & (F.col("min_y") <= F.col("region_max_y"))
        & (F.col("max_y") >= F.col("region_min_y"))
        & (F.col("tile_x") == _tile(corner_x, tile_m))
        & (F.col("tile_y") == _tile(corner_y, tile_m))
    )
    keys = ["tile_x", "tile_y"]
    if "epsg" in blocks.columns and "epsg" in regions.columns:
        blocks, keys = in_known_systems(blocks, systems(regions)), ["epsg", *keys]
    joined = tile_join(tiles(blocks, ""), tiles(grown, "region_"), keys, meets, max_bytes)
    return joined.drop("tile_x", "tile_y")
