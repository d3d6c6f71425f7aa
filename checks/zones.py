"""Scenes of two zones or with grids of their own, bands tiled unlike, geometry as bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks import sqltext as Q
from checks.hexagons import _STUDY, rounded_stats, study_features
from checks.raster import IDX
from checks.registry import query
from terrafold.functions import hexgrid
from terrafold.functions.wkb import wkb_shape
from terrafold.operators import bands as B
from terrafold.operators import cells as C
from terrafold.operators import regions as R
from terrafold.operators import zonal as Z
from terrafold.plans import hex_features as H
from terrafold.plans import region_features as RF
from terrafold.sources import features as T
from terrafold.sources import geotiff
from terrafold.sources.shared import fresh_path

ZONES = (32610, 32611)
BORDER_BBOX = (-120.04, 40.56, -119.96, 40.60)

# The pixels of every scene moved next to the border of zones 10 and 11, each in its own zone.
_ZONE = "CASE WHEN l_suppkey % 9 % 2 = 0 THEN 32610 ELSE 32611 END"
_SHIFT = "CASE WHEN l_suppkey % 9 % 2 = 0 THEN 1505e2 ELSE -3566e2 END"
ZONED_PX = {**X.PX, "x": f"({X.PX['x']}) + {_SHIFT}", "epsg": _ZONE}
BORDER_LINES = {
    "region_id": "CAST(c_custkey AS string)",
    "lon0": "-120e0 + (c_custkey*37 % 6000 - 3000)/1e5",
    "lat0": "4058e-2 + (c_custkey*13 % 4000 - 2000)/1e5",
    "lon1": "-120e0 + (c_custkey*37 % 6000 - 3000 + c_custkey*11 % 500 - 250)/1e5",
    "lat1": "4058e-2 + (c_custkey*13 % 4000 - 2000 + c_custkey*29 % 500 - 250)/1e5",
}
_MERIDIAN = "(CASE WHEN epsg = 32610 THEN -123e0 ELSE -117e0 END)"


def zoned_px(spark, sf_dir):
    return X.table(spark, sf_dir, "lineitem").selectExpr(*X.columns(ZONED_PX))


_ZONED = {
    "zpx": "SELECT " + ", ".join(X.columns(ZONED_PX)) + " FROM lineitem",
    "ind": Q.indices("zpx", "scene_id, epsg, x, y"),
}
_CENTRES = f"(SELECT *, {Q.S8 * hexgrid.SQRT3!r}*(q + r/2e0) AS cx, {1.5 * Q.S8!r}*r AS cy FROM cells)"
_CELL = "'hx8_' || CAST(epsg % 100 AS string) || 'n_' || CAST(q AS string) || '_' || CAST(r AS string)"


@query(
    "hex_features_two_zones",
    X.with_(
        "",
        f"SELECT {_CELL} AS cell, {_CELL} AS cell_res8, "
        + ", ".join(f"{i}_{s}" for i in IDX for s in ("mean", "std"))
        + ", pixel_count, scene_id, epsg, substr(scene_id, 18, 8) AS acquisition_date FROM placed "
        f"WHERE clon BETWEEN {BORDER_BBOX[0]} AND {BORDER_BBOX[2]} AND clat BETWEEN {BORDER_BBOX[1]} AND {BORDER_BBOX[3]}",
        **_ZONED,
        hit=Q.cells_touched("ind", 15.0),
        cells=Q.wide_stats("hit", "scene_id, epsg, q, r", ("mean", "std")),
        placed=Q.unproject(_CENTRES, "cx", "cy", "clon", "clat", _MERIDIAN),
    ),
)
def hex_features_two_zones(spark, sf_dir):
    return rounded_stats(H.build_hex_features(zoned_px(spark, sf_dir), BORDER_BBOX), Z.DEFAULT_STATS)


@query(
    "corridor_features_two_zones",
    X.with_(
        "",
        "SELECT region_id, 'corridor' AS region_kind, scene_id, epsg, "
        + ", ".join(
            f"round({f}({i}), {d}) AS {i}_{n}"
            for i in IDX
            for n, f, d in (("mean", "avg", 6), ("std", "stddev_pop", 6), ("max", "max", 9))
        )
        + ", coalesce(nullif(count(ndwi), 0), nullif(count(nbr), 0), nullif(count(ndvi), 0)) AS pixel_count"
        " FROM pairs WHERE epsg = line_epsg GROUP BY region_id, scene_id, epsg HAVING count(ndvi) + count(nbr) + count(ndwi) > 0",
        **_ZONED,
        ends="SELECT " + ", ".join(X.columns(BORDER_LINES)) + ", epsg FROM customer CROSS JOIN (VALUES (32610), (32611)) z(epsg)",
        one=Q.project("ends", "lon0", "lat0", "x0", "y0", _MERIDIAN),
        two=Q.project("one", "lon1", "lat1", "x1", "y1", _MERIDIAN),
        lines="SELECT region_id, epsg AS line_epsg, x0, y0, x1, y1 FROM two",
        pairs=Q.line_pixels("ind"),
    ),
)
def corridor_features_two_zones(spark, sf_dir):
    line = "named_struct('type', 'LineString', 'coordinates', to_json(array(array(lon0, lat0), array(lon1, lat1)))) AS geometry"
    ends = X.table(spark, sf_dir, "customer").selectExpr(*X.columns(BORDER_LINES))
    regions = R.corridor_regions(ends.selectExpr(line, "map('OBJECTID', region_id) AS properties"), X.BUFFER_M, ZONES)
    indices = B.with_indices(zoned_px(spark, sf_dir), ["scene_id", "epsg", "x", "y"])
    features = RF.build_region_features(indices, regions, geometry=False, half_pixel=X.HALF)
    # A greatest value is one pixel's, and those may end in a 5 at the seventh decimal.
    return rounded_stats(features, ("mean", "std")).withColumns({f"{i}_max": F.round(f"{i}_max", 9) for i in IDX})


def unlike_files(spark, sf_dir, sides):
    """Block files of the digital numbers, the bands with sides of their own."""
    dn, keys = X.dn_long(spark, sf_dir), ["scene_id", "band", "block_row", "block_col", "side"]
    parts = None
    for bands, side in sides:
        packed = B.pixels_to_blocks(dn.filter(F.col("band").isin(bands)), "dn", side, fill=0, value_type="int")
        placed = packed.withColumns(
            {
                "x0": F.lit(6e5) + F.col("first_col") * 30.0, "y0": F.lit(45e5) - F.col("first_row") * 30.0,
                "pixel_size": F.lit(30.0), "epsg": F.lit(X.EPSG), "side": F.lit(side),
            }
        )
        part = geotiff.encode_geotiffs(placed, keys, "uint16", nodata=0.0)
        parts = part if parts is None else parts.unionByName(part)
    return parts.withColumnsRenamed({"block_row": "file_row", "block_col": "file_col"})


@query(
    "band_align_unlike_tiles",
    X.with_(
        "dn_long",
        "SELECT a.scene_id, a.row_no, a.col_no, 6e5 + 3e1*a.col_no + 15e0 AS x, 45e5 - 3e1*a.row_no - 15e0 AS y, 32610 AS epsg, "
        "a.dn AS b3, b.dn AS b4, c.dn AS b5, d.dn AS b7 FROM dn_long a "
        "JOIN dn_long b USING (scene_id, row_no, col_no) JOIN dn_long c USING (scene_id, row_no, col_no) "
        "JOIN dn_long d USING (scene_id, row_no, col_no) "
        "WHERE a.band = 'B3' AND b.band = 'B4' AND c.band = 'B5' AND d.band = 'B7' AND least(a.dn, b.dn, c.dn, d.dn) > 0",
    ),
)
def band_align_unlike_tiles(spark, sf_dir):
    """Two bands in tiles of 32, one in tiles of 48, one in tiles of 20, read back from files."""
    files = unlike_files(spark, sf_dir, [(["B3", "B4"], 32), (["B5"], 48), (["B7"], 20)])
    decoded = geotiff.decode_geotiffs(files, ["scene_id", "band", "file_row", "file_col", "side"])
    placed = decoded.withColumns(
        {
            "first_row": F.col("first_row") + F.col("file_row") * F.col("side"),
            "first_col": F.col("first_col") + F.col("file_col") * F.col("side"),
        }
    )
    # Fill stands for absent pixels of a block too.
    aligned = B.align_block_bands(placed, tile=64).filter("least(b3, b4, b5, b7) > 0")
    return aligned.withColumns({b: F.col(b).cast("bigint") for b in ("b3", "b4", "b5", "b7")})


@query(
    "features_wkb_roundtrip",
    X.with_(
        "px",
        "SELECT cell, scene_id, 'Polygon' AS kind, 125 AS n_bytes, CAST(k AS int) AS corner, round(lon, 7) AS lon, round(lat, 7) AS lat FROM geo",
        **_STUDY,
        kept="SELECT s.cell, s.scene_id, p.cx, p.cy FROM study s JOIN placed p ON s.scene_id = p.scene_id "
        "AND s.cell = 'hx8_' || CAST(p.q AS string) || '_' || CAST(p.r AS string)",
        corner="SELECT *, unnest(generate_series(0, 6)) AS k FROM kept",
        turned=f"SELECT *, cx + {Q.S8!r}*cos(radians(60*(k % 6) - 30)) AS vx, cy + {Q.S8!r}*sin(radians(60*(k % 6) - 30)) AS vy FROM corner",
        geo=Q.unproject("turned", "vx", "vy"),
    ),
)
def features_wkb_roundtrip(spark, sf_dir):
    """A feature table with polygons as bytes, written, read and taken apart again."""
    features = T.with_wkb(H.with_cell_geometry(study_features(spark, sf_dir), X.EPSG, X.RES))
    path = T.write_features(features, fresh_path(spark, "shapes"), "cell_res8")
    back = T.read_features(spark, path, features.schema, "cell_res8").select("cell", "scene_id", "geometry")
    shaped = back.withColumn("shape", wkb_shape("geometry"))
    return shaped.select(
        "cell", "scene_id", F.col("shape.type").alias("kind"), F.octet_length("geometry").alias("n_bytes"),
        F.posexplode(F.col("shape.paths")[0]).alias("corner", "p"),
    ).select("cell", "scene_id", "kind", "n_bytes", "corner", F.round(F.col("p")[0], 7).alias("lon"), F.round(F.col("p")[1], 7).alias("lat"))


# Every third scene has pixels of 50 m; all have corners of their own.
_GRID = (
    "6e5 + 17e2*CAST(substr(scene_id, 16, 1) AS int) AS gx, 45e5 - 13e2*CAST(substr(scene_id, 25, 1) AS int) AS gy, "
    "CASE WHEN substr(scene_id, 16, 1) = '2' THEN 5e1 ELSE 3e1 END AS size"
)
_SQUARES = (
    "SELECT scene_id, gx + (coarse_col + 5e-1)*{side} AS x, gy - (coarse_row + 5e-1)*{side} AS y FROM foot JOIN grids USING (scene_id) WHERE size = {size}"
)


@query(
    "cells_in_footprint_scene_grids",
    X.with_(
        "dn_long",
        f"SELECT DISTINCT scene_id, {Q.cell()} AS cell FROM filled JOIN (SELECT scene_id, q, r FROM fine UNION SELECT scene_id, q, r FROM rough) "
        "USING (scene_id, q, r)",
        grids=f"SELECT DISTINCT scene_id, {_GRID} FROM dn_long",
        coarse="SELECT DISTINCT scene_id, row_no // (CASE size WHEN 5e1 THEN 2 ELSE 4 END) AS cr, col_no // (CASE size WHEN 5e1 THEN 2 ELSE 4 END) AS cc "
        "FROM dn_long JOIN grids USING (scene_id) WHERE dn <> 0 AND band = 'B4'",
        foot="SELECT DISTINCT scene_id, cr + dr AS coarse_row, cc + dc AS coarse_col FROM coarse "
        "CROSS JOIN (VALUES (-1), (0), (1)) a(dr) CROSS JOIN (VALUES (-1), (0), (1)) b(dc)",
        extent="SELECT scene_id, min(gx + size*col_no) - 2e3 AS min_x, max(gx + size*(col_no + 1)) + 2e3 AS max_x, "
        "min(gy - size*(row_no + 1)) - 2e3 AS min_y, max(gy - size*row_no) + 2e3 AS max_y FROM dn_long JOIN grids USING (scene_id) GROUP BY scene_id",
        filled=Q.cells_centred("extent"),
        fine=Q.cells_touched(f"({_SQUARES.format(side='12e1', size='3e1')})", 60.0),
        rough=Q.cells_touched(f"({_SQUARES.format(side='1e2', size='5e1')})", 50.0),
    ),
)
def cells_in_footprint_scene_grids(spark, sf_dir):
    """Footprints of scenes whose corners and pixel sizes differ."""
    dn = X.dn_long(spark, sf_dir).selectExpr(
        "scene_id", "row_no", "col_no", "band", "dn", "6e5 + 17e2*CAST(substr(scene_id, 16, 1) AS int) AS gx",
        "45e5 - 13e2*CAST(substr(scene_id, 25, 1) AS int) AS gy", "CASE WHEN substr(scene_id, 16, 1) = '2' THEN 5e1 ELSE 3e1 END AS size",
    )
    edge = {"min_x": F.min(F.expr("gx + size*col_no")) - 2e3, "max_x": F.max(F.expr("gx + size*(col_no + 1)")) + 2e3}
    edge |= {"min_y": F.min(F.expr("gy - size*(row_no + 1)")) - 2e3, "max_y": F.max(F.expr("gy - size*row_no")) + 2e3}
    extent = dn.groupBy("scene_id").agg(*[e.alias(n) for n, e in edge.items()])
    study = C.polyfill(extent, X.RES).select("scene_id", "q", "r")
    # The grids as blocks of one row each would tell them.
    blocks = dn.selectExpr("scene_id", "gx + col_no*size AS x0", "gy - row_no*size AS y0", "size AS pixel_size", "row_no AS first_row", "col_no AS first_col")
    foot = C.valid_footprint(dn.filter("band = 'B4'"), ["scene_id"], F.col("size")).join(C.scene_grids(blocks), "scene_id")
    size = F.col("pixel_size")
    squares = C.footprint_squares(foot, F.col("x0"), F.col("y0"), size)
    half = C.coarse_factor(size) * size / 2
    return C.with_cell_id(C.cells_in_footprint(study, squares, ["scene_id"], X.RES, half), X.RES).select("scene_id", "cell")
