"""The hexagon grid, footprints, projection and hexagon statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks import sqltext as Q
from checks.raster import IDX, indexed_px
from checks.registry import query
from terrafold.functions import hexgrid
from terrafold.functions import projection as P
from terrafold.operators import cells as C
from terrafold.operators import summaries
from terrafold.operators import zonal as Z
from terrafold.operators.scenes import scene_bbox as scene_bbox_
from terrafold.operators.scenes import scene_grid_extent
from terrafold.plans import hex_features as H

STATS = ("mean", "std", "min", "max", "count")


def rounded_stats(df, stats, indices=IDX):
    names = [f"{i}_{s}" for i in indices for s in stats if s != "count"]
    return df.withColumns({n: F.round(n, 6) for n in names})


_HEX = {"ind": Q.indices("px", "scene_id, x, y"), "hit": Q.cells_touched("ind", 15.0)}


@query(
    "hex_zonal_stats",
    X.with_("px", Q.wide_stats("hit", "scene_id, q, r", STATS), **_HEX),
)
def hex_zonal_stats(spark, sf_dir):
    return rounded_stats(H.cell_statistics(indexed_px(spark, sf_dir), X.RES, STATS), STATS)


@query(
    "hex_zonal_stats_center",
    X.with_(
        "px", Q.wide_stats("hit", "scene_id, q, r", ("mean", "std")),
        ind=_HEX["ind"], hit=Q.cells_touched("ind", 0.0),
    ),
)
def hex_zonal_stats_center(spark, sf_dir):
    return rounded_stats(H.cell_statistics(indexed_px(spark, sf_dir), X.RES, touch="center"), Z.DEFAULT_STATS)


_STUDY = {
    **_HEX,
    "cells": Q.wide_stats("hit", "scene_id, q, r", ("mean", "std")),
    "placed": Q.unproject(
        f"(SELECT *, {Q.S8 * hexgrid.SQRT3!r}*(q + r/2e0) AS cx, {1.5 * Q.S8!r}*r AS cy FROM cells)",
        "cx", "cy", "clon", "clat",
    ),
    "study": f"SELECT {Q.cell()} AS cell, {Q.cell()} AS cell_res8, "
    + ", ".join(f"{i}_{s}" for i in IDX for s in ("mean", "std"))
    + ", pixel_count, scene_id, substr(scene_id, 18, 8) AS acquisition_date FROM placed "
    f"WHERE clon BETWEEN {X.STUDY_BBOX[0]} AND {X.STUDY_BBOX[2]} AND clat BETWEEN {X.STUDY_BBOX[1]} AND {X.STUDY_BBOX[3]}",
}


def study_features(spark, sf_dir):
    return H.build_hex_features(X.px(spark, sf_dir), X.STUDY_BBOX, X.EPSG, X.RES)


@query("build_hex_features", X.with_("px", "SELECT * FROM study", **_STUDY))
def build_hex_features(spark, sf_dir):
    return rounded_stats(study_features(spark, sf_dir), Z.DEFAULT_STATS)


@query("stats_tabular", X.with_("px", "SELECT * FROM study", **_STUDY))
def stats_tabular(spark, sf_dir):
    shaped = H.with_cell_geometry(study_features(spark, sf_dir), X.EPSG, X.RES)
    return rounded_stats(Z.tabular(shaped), Z.DEFAULT_STATS)


@query("feature_summary", X.with_("px", "SELECT count(*) AS n_rows, count(DISTINCT scene_id) AS n_scenes FROM cells", **_HEX, cells=_STUDY["cells"]))
def feature_summary(spark, sf_dir):
    return summaries.feature_summary(H.cell_statistics(indexed_px(spark, sf_dir), X.RES))


@query(
    "feature_describe",
    X.with_(
        "px",
        " UNION ALL ".join(
            f"SELECT '{i}_mean' AS column_name, count({i}_mean) AS n, round(avg({i}_mean), 6) AS mean, "
            f"round(stddev_samp({i}_mean), 6) AS std, round(min({i}_mean), 6) AS min, "
            f"round(quantile_cont({i}_mean, 0.25), 6) AS q25, round(quantile_cont({i}_mean, 0.5), 6) AS q50, "
            f"round(quantile_cont({i}_mean, 0.75), 6) AS q75, round(max({i}_mean), 6) AS max FROM cells"
            for i in IDX
        ),
        **_HEX,
        cells="SELECT scene_id, q, r, avg(ndvi) AS ndvi_mean, avg(nbr) AS nbr_mean, avg(ndwi) AS ndwi_mean "
        "FROM hit GROUP BY scene_id, q, r",
    ),
)
def feature_describe(spark, sf_dir):
    stats = H.cell_statistics(indexed_px(spark, sf_dir), X.RES, ["mean"])
    out = summaries.describe(stats, [f"{i}_mean" for i in IDX])
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")})


_PT = {"grid": Q.project("points")}


@query("project_utm", X.with_("points", "SELECT event_id, round(x, 2) AS x, round(y, 2) AS y FROM grid", **_PT))
def project_utm(spark, sf_dir):
    grid = P.project_columns(X.points(spark, sf_dir), "lon", "lat", X.EPSG)
    return grid.select("event_id", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"))


@query(
    "unproject_utm",
    "WITH src AS (SELECT event_id, 35e4 + event_id*37 % 300000 AS x, 40e5 + event_id*91 % 600000 AS y FROM events), "
    "geo AS (" + Q.unproject("src") + ") SELECT event_id, round(lon, 7) AS lon, round(lat, 7) AS lat FROM geo",
)
def unproject_utm(spark, sf_dir):
    src = X.table(spark, sf_dir, "events").selectExpr(
        "event_id", "35e4 + event_id*37 % 300000 AS x", "40e5 + event_id*91 % 600000 AS y"
    )
    geo = P.unproject_columns(src, "x", "y", X.EPSG)
    return geo.select("event_id", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


@query(
    "assign_hex_cell",
    X.with_("points", f"SELECT event_id, {Q.cell()} AS cell FROM hit", **_PT, hit=Q.cells_touched("grid", 0.0)),
)
def assign_hex_cell(spark, sf_dir):
    grid = P.project_columns(X.points(spark, sf_dir), "lon", "lat", X.EPSG)
    cells = C.assign_cells(grid, X.RES, "center")
    return C.with_cell_id(cells, X.RES).select("event_id", "cell")


# Candidates are all cells near the box's middle, without any envelope of its sides.
_FILL = {
    "mid": "SELECT *, (west + east)/2e0 AS mlon, (south + north)/2e0 AS mlat FROM boxes",
    "mgrid": Q.project("mid", "mlon", "mlat", "mx", "my"),
    "around": "SELECT *, mx - 3e3 AS min_x, mx + 3e3 AS max_x, my - 3e3 AS min_y, my + 3e3 AS max_y FROM mgrid",
    "near": Q.cells_centred("around"),
    "geo": Q.unproject("near", "cx", "cy", "clon", "clat"),
}
_FILLED = "FROM geo WHERE clon BETWEEN west AND east AND clat BETWEEN south AND north"


@query("hex_polyfill", X.with_("boxes", f"SELECT c_custkey, {Q.cell()} AS cell, 8 AS cell_res {_FILLED}", **_FILL))
def hex_polyfill(spark, sf_dir):
    cells = C.polyfill_wgs84(X.boxes(spark, sf_dir), X.EPSG, X.RES)
    return C.with_cell_id(cells, X.RES).select("c_custkey", "cell", "cell_res").orderBy("c_custkey", "cell")


_CORNERS = {
    "own": Q.cells_touched("px", 0.0),
    "ids": "SELECT DISTINCT q, r FROM own",
    "corner": f"SELECT *, unnest(generate_series(0, 5)) AS corner, {Q.S8 * hexgrid.SQRT3!r}*(q + r/2e0) AS cx, {1.5 * Q.S8!r}*r AS cy FROM ids",
    "turned": f"SELECT *, cx + {Q.S8!r}*cos(radians(60*corner - 30)) AS vx, cy + {Q.S8!r}*sin(radians(60*corner - 30)) AS vy FROM corner",
    "geo": Q.unproject("turned", "vx", "vy"),
}


@query(
    "hex_boundary",
    X.with_(
        "px",
        f"SELECT {Q.cell()} AS cell, CAST(corner AS int) AS corner, round(vx, 3) AS vx, round(vy, 3) AS vy, "
        "round(lon, 7) AS lon, round(lat, 7) AS lat FROM geo",
        **_CORNERS,
    ),
)
def hex_boundary(spark, sf_dir):
    located = C.assign_cells(X.px(spark, sf_dir).select("x", "y"), X.RES, "center")
    cells = C.with_center(located.select("q", "r").distinct(), X.RES)
    corners = P.unproject_columns(C.cell_corners(cells, X.RES), "vx", "vy", X.EPSG)
    return C.with_cell_id(corners, X.RES).select(
        "cell", "corner",
        F.round("vx", 3).alias("vx"), F.round("vy", 3).alias("vy"),
        F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"),
    )


def _box_hits_cell() -> str:
    """The six corners clipped against the box, side by side, would be long; instead: the
    box and the cell are apart along one of the five side directions."""
    s = Q.S8
    a = s * hexgrid.SQRT3 / 2
    mx, my = "((box_min_x + box_max_x)/2e0 - cx)", "((box_min_y + box_max_y)/2e0 - cy)"
    hx, hy = "((box_max_x - box_min_x)/2e0)", "((box_max_y - box_min_y)/2e0)"
    root = repr(hexgrid.SQRT3 / 2)
    return (
        f"abs({mx}) <= {hx} + {a!r} AND abs({my}) <= {hy} + {s!r} "
        f"AND abs(5e-1*{mx} + {root}*{my}) <= 5e-1*{hx} + {root}*{hy} + {a!r} "
        f"AND abs({root}*{my} - 5e-1*{mx}) <= 5e-1*{hx} + {root}*{hy} + {a!r}"
    )


@query(
    "cells_in_extent",
    X.with_(
        "grid_boxes",
        f"SELECT c_custkey, {Q.cell()} AS cell FROM filled WHERE {_box_hits_cell()}",
        filled=Q.cells_centred("grid_boxes"),
    ),
)
def cells_in_extent(spark, sf_dir):
    cells = C.cells_in_extent(C.polyfill(X.grid_boxes(spark, sf_dir), X.RES), X.RES)
    return C.with_cell_id(cells, X.RES).select("c_custkey", "cell")


_COARSE = {
    "coarse": "SELECT DISTINCT scene_id, row_no // 4 AS cr, col_no // 4 AS cc FROM dn_long WHERE dn <> 0 AND band = 'B4'",
    "foot": "SELECT DISTINCT scene_id, cr + dr AS coarse_row, cc + dc AS coarse_col FROM coarse "
    "CROSS JOIN (VALUES (-1), (0), (1)) a(dr) CROSS JOIN (VALUES (-1), (0), (1)) b(dc)",
}


def footprint(spark, sf_dir):
    red = X.dn_long(spark, sf_dir).filter("band = 'B4'")
    return C.valid_footprint(red, ["scene_id"], 30.0)


@query("valid_footprint", X.with_("dn_long", "SELECT scene_id, coarse_row, coarse_col FROM foot", **_COARSE))
def valid_footprint(spark, sf_dir):
    return footprint(spark, sf_dir)


def placed_dn(spark, sf_dir):
    return X.dn_long(spark, sf_dir).selectExpr(
        "scene_id", "band", "dn", "6e5 + 3e1*col_no + 15e0 AS x", "45e5 - 3e1*row_no - 15e0 AS y"
    )


@query(
    "cells_in_footprint",
    X.with_(
        "dn_long",
        f"SELECT DISTINCT scene_id, {Q.cell()} AS cell FROM filled JOIN hit USING (scene_id, q, r)",
        **_COARSE,
        extent="SELECT scene_id, min(6e5 + 3e1*col_no) - 2e3 AS min_x, max(6e5 + 3e1*col_no + 3e1) + 2e3 AS max_x, "
        "min(45e5 - 3e1*row_no - 3e1) - 2e3 AS min_y, max(45e5 - 3e1*row_no) + 2e3 AS max_y FROM dn_long GROUP BY scene_id",
        filled=Q.cells_centred("extent"),
        squares="SELECT scene_id, 6e5 + (coarse_col + 5e-1)*12e1 AS x, 45e5 - (coarse_row + 5e-1)*12e1 AS y FROM foot",
        hit=Q.cells_touched("squares", 60.0),
    ),
)
def cells_in_footprint(spark, sf_dir):
    # The study area is wider than the scene, so some of its cells must go.
    extent = scene_grid_extent(placed_dn(spark, sf_dir), X.HALF + 2000.0)
    study = C.polyfill(extent, X.RES).select("scene_id", "q", "r")
    squares = C.footprint_squares(footprint(spark, sf_dir), 6e5, 45e5, 30.0)
    kept = C.cells_in_footprint(study, squares, ["scene_id"], X.RES, 60.0)
    return C.with_cell_id(kept, X.RES).select("scene_id", "cell")


@query(
    "scene_bbox",
    X.with_(
        "px",
        "SELECT scene_id, round(min(lon), 7) AS west, round(min(lat), 7) AS south, round(max(lon), 7) AS east, "
        "round(max(lat), 7) AS north FROM geo GROUP BY scene_id",
        ext="SELECT scene_id, min(x) - 15 AS a, min(y) - 15 AS b, max(x) + 15 AS c, max(y) + 15 AS d FROM px GROUP BY scene_id",
        side="SELECT *, unnest(generate_series(0, 22))/22e0 AS t FROM ext",
        dots="SELECT scene_id, a + (c - a)*t AS x, b AS y FROM side UNION ALL SELECT scene_id, a + (c - a)*t, d FROM side "
        "UNION ALL SELECT scene_id, a, b + (d - b)*t FROM side UNION ALL SELECT scene_id, c, b + (d - b)*t FROM side",
        geo=Q.unproject("dots"),
    ),
)
def scene_bbox(spark, sf_dir):
    boxes = scene_bbox_(scene_grid_extent(X.px(spark, sf_dir), X.HALF), X.EPSG)
    return boxes.select("scene_id", *[F.round(c, 7).alias(c) for c in ("west", "south", "east", "north")])
