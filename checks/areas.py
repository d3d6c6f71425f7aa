"""Corridors, polygons and boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks import sqltext as Q
from checks.hexagons import rounded_stats
from checks.raster import IDX, indexed_px
from checks.registry import query
from terrafold.functions import edges as E
from terrafold.operators import regions as R
from terrafold.operators import scenes as S
from terrafold.operators import zonal as Z
from terrafold.plans import region_features as RF
from terrafold.sources import geojson
from terrafold.sources.shared import fresh_path

LONG = ("mean", "std", "max")

_PAIRS = {"ind": Q.indices("px", "scene_id, x, y"), "pairs": Q.line_pixels("ind")}


@query(
    "corridor_pixel_join",
    X.with_(
        "px lines",
        "SELECT region_id, scene_id, count(*) AS n, CAST(sum(x - 6e5) AS bigint) AS sum_x, "
        "CAST(sum(45e5 - y) AS bigint) AS sum_y FROM pairs GROUP BY region_id, scene_id",
        pairs=Q.line_pixels("px"),
    ),
)
def corridor_pixel_join(spark, sf_dir):
    pairs = R.pixel_region_join(X.px(spark, sf_dir).select("scene_id", "x", "y"), X.line_regions(spark, sf_dir), X.HALF)
    return pairs.groupBy("region_id", "scene_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("x") - 6e5).cast("bigint").alias("sum_x"),
        F.sum(F.lit(45e5) - F.col("y")).cast("bigint").alias("sum_y"),
    )


_LONG = " UNION ALL ".join(
    f"SELECT region_id, 'corridor' AS region_kind, scene_id, '{i}' AS index_name, "
    + ", ".join(f"round({f}({i}), 6) AS {n}" for n, f in (("mean", "avg"), ("std", "stddev_pop"), ("max", "max")))
    + f" FROM pairs GROUP BY region_id, scene_id HAVING count({i}) > 0"
    for i in IDX
)


def _long(spark, sf_dir):
    return RF.region_statistics_long(indexed_px(spark, sf_dir), X.line_regions(spark, sf_dir), half_pixel=X.HALF)


def _round_long(df):
    return df.withColumns({s: F.round(s, 6) for s in LONG})


@query("corridor_stats_long", X.with_("px lines", _LONG, **_PAIRS))
def corridor_stats_long(spark, sf_dir):
    return _round_long(_long(spark, sf_dir))


@query("union_index_stats", X.with_("px lines", _LONG, **_PAIRS))
def union_index_stats(spark, sf_dir):
    # One join and one aggregation for all indices; the parts are read from what it wrote.
    path = fresh_path(spark, "index-stats")
    _long(spark, sf_dir).write.partitionBy("index_name").parquet(path)
    parts = [spark.read.parquet(path).filter(F.col("index_name") == i) for i in IDX]
    return _round_long(Z.union_indices(parts))


_WIDE = (
    "SELECT region_id, 'corridor' AS region_kind, scene_id, "
    + ", ".join(
        f"round({f}({i}), 6) AS {i}_{n}" for i in IDX for n, f in (("mean", "avg"), ("std", "stddev_pop"), ("max", "max"))
    )
    + "{extra} FROM pairs GROUP BY region_id, scene_id"
    " HAVING count(ndvi) + count(nbr) + count(ndwi) > 0"
)


@query("pivot_index_stats", X.with_("px lines", _WIDE.format(extra=""), **_PAIRS))
def pivot_index_stats(spark, sf_dir):
    return rounded_stats(Z.pivot_index_stats(_long(spark, sf_dir), ["mean", "std"]), LONG)


_COUNT = ", coalesce(nullif(count(ndwi), 0), nullif(count(nbr), 0), nullif(count(ndvi), 0)) AS pixel_count"


@query("build_corridor_features", X.with_("px lines", _WIDE.format(extra=_COUNT), **_PAIRS))
def build_corridor_features(spark, sf_dir):
    features = RF.build_region_features(
        indexed_px(spark, sf_dir), X.line_regions(spark, sf_dir), geometry=False, half_pixel=X.HALF
    )
    return rounded_stats(features, LONG)


@query(
    "stats_with_geometry",
    X.with_(
        "px lines",
        "SELECT s.*, x0, y0, x1, y1 FROM stats s LEFT JOIN lines USING (region_id)",
        **_PAIRS, stats=_WIDE.format(extra=_COUNT),
    ),
)
def stats_with_geometry(spark, sf_dir):
    features = RF.build_region_features(indexed_px(spark, sf_dir), X.line_regions(spark, sf_dir), half_pixel=X.HALF)
    edge = F.col("edges")[0]
    return rounded_stats(features, LONG).select(
        *[c for c in features.columns if c != "edges"], edge["x0"].alias("x0"), edge["y0"].alias("y0"),
        edge["x1"].alias("x1"), edge["y1"].alias("y1"),
    )


_SIDES = [(a, b) for a, b in zip(X.NOTCHED, X.NOTCHED[1:] + X.NOTCHED[:1])]
_POLY = {
    "ind": Q.indices("px", "scene_id, x, y"),
    "rows": "SELECT *, row_number() OVER () AS pid FROM ind",
    "lines": " UNION ALL ".join(
        f"SELECT region_id, ax + w*{a[0]} AS x0, ay + h*{a[1]} AS y0, ax + w*{b[0]} AS x1, ay + h*{b[1]} AS y1, "
        "ax, ay, w, h FROM polygons"
        for a, b in _SIDES
    ),
    # One row per pixel, polygon and side; a pixel is in when a side meets its square or a
    # ray from its centre crosses an odd number of sides.
    "sides": "SELECT pid, scene_id, ndvi, nbr, ndwi, region_id, "
    + Q.near_line(0.0)
    + " AS meets, (y0 > y) <> (y1 > y) AND x0 + (y - y0)*(x1 - x0)/nullif(y1 - y0, 0) > x AS crossed "
    "FROM rows JOIN lines ON x BETWEEN ax - 15 AND ax + w + 15 AND y BETWEEN ay - 15 AND ay + h + 15",
    "inside": "SELECT pid, region_id, any_value(scene_id) AS scene_id, any_value(ndvi) AS ndvi, any_value(nbr) AS nbr, "
    "any_value(ndwi) AS ndwi FROM sides GROUP BY pid, region_id "
    "HAVING bool_or(meets) OR count(*) FILTER (WHERE crossed) % 2 = 1",
}


@query(
    "polygon_zonal_stats",
    X.with_(
        "px polygons",
        Q.wide_stats("(SELECT *, 'hex' AS region_kind, region_id AS cell_res8 FROM inside)",
                     "region_id, region_kind, scene_id, cell_res8", LONG),
        **_POLY,
    ),
)
def polygon_zonal_stats(spark, sf_dir):
    regions = R.polygon_regions(X.polygon_features(spark, sf_dir), X.RES)
    features = RF.build_region_features(
        indexed_px(spark, sf_dir), regions, resolution=X.RES, geometry=False, half_pixel=X.HALF
    )
    return rounded_stats(features, LONG)


def dn_envelopes(spark, sf_dir, block=32):
    side = 30.0 * block
    return (
        X.dn_long(spark, sf_dir)
        .selectExpr("scene_id", f"row_no div {block} AS block_row", f"col_no div {block} AS block_col")
        .distinct()
        .withColumns(
            {
                "min_x": F.lit(6e5) + F.col("block_col") * side,
                "max_x": F.lit(6e5) + (F.col("block_col") + 1) * side,
                "min_y": F.lit(45e5) - (F.col("block_row") + 1) * side,
                "max_y": F.lit(45e5) - F.col("block_row") * side,
            }
        )
    )


@query(
    "block_region_join",
    X.with_(
        "dn_long lines",
        "SELECT scene_id, block_row, block_col, region_id FROM blocks JOIN lines ON "
        "6e5 + block_col*96e1 <= greatest(x0, x1) + 100 AND 6e5 + (block_col + 1)*96e1 >= least(x0, x1) - 100 AND "
        "45e5 - (block_row + 1)*96e1 <= greatest(y0, y1) + 100 AND 45e5 - block_row*96e1 >= least(y0, y1) - 100",
        blocks="SELECT DISTINCT scene_id, row_no // 32 AS block_row, col_no // 32 AS block_col FROM dn_long",
    ),
)
def block_region_join(spark, sf_dir):
    pairs = R.block_region_join(dn_envelopes(spark, sf_dir), X.line_regions(spark, sf_dir), 1000.0)
    return pairs.select("scene_id", "block_row", "block_col", "region_id")


# Bare line features and two-feature collections; longitudes in thousandths of a degree.
_LON = "(-122500 + c_custkey*7 % 2500)"
_LAT = "(39000 + c_custkey*13 % 2500)"
_DX, _DY = "(c_custkey*11 % 500 - 250)", "(c_custkey*29 % 500 - 250)"


def _feature(key: str, shift: str) -> str:
    deg = lambda v: f"CAST({v} AS string) || 'e-3'"
    return (
        "'{\"type\":\"Feature\",\"properties\":{\"OBJECTID\":' || CAST(" + key + " AS string) || ',\"TLine Name\":\"L' || "
        "CAST(c_custkey AS string) || '\"},\"geometry\":{\"type\":\"LineString\",\"coordinates\":[[' || "
        + deg(f"({_LON} + {shift})") + " || ',' || " + deg(_LAT) + " || '],[' || "
        + deg(f"({_LON} + {shift} + {_DX})") + " || ',' || " + deg(f"({_LAT} + {_DY})") + " || ']]}}'"
    )


_DOCUMENT = (
    f"CASE WHEN c_custkey % 2 = 0 THEN {_feature('2*c_custkey', '0')} ELSE "
    "'{\"type\":\"FeatureCollection\",\"features\":[' || " + _feature("2*c_custkey", "0") + " || ',' || "
    + _feature("2*c_custkey + 1", "100") + " || ']}' END"
)
_SEGMENTS = (
    "SELECT CAST(2*c_custkey + k AS string) AS region_id, 'L' || CAST(c_custkey AS string) AS line_name, "
    f"({_LON} + 100*k)/1e3 AS x0, {_LAT}/1e3 AS y0, ({_LON} + 100*k + {_DX})/1e3 AS x1, ({_LAT} + {_DY})/1e3 AS y1 "
    "FROM customer CROSS JOIN (VALUES (0), (1)) v(k) WHERE k = 0 OR c_custkey % 2 = 1"
)


def features(spark, sf_dir):
    documents = X.table(spark, sf_dir, "customer").selectExpr(f"{_DOCUMENT} AS document")
    return geojson.parse_features(documents)


@query(
    "geojson_features",
    "SELECT region_id, line_name, 'LineString' AS geometry_type, 2 AS n_points, round(x0, 6) AS x0, round(y0, 6) AS y0, "
    f"round(x1, 6) AS x1, round(y1, 6) AS y1 FROM ({_SEGMENTS})",
)
def geojson_features(spark, sf_dir):
    shaped = R.with_paths(features(spark, sf_dir))
    path = F.col("paths")[0]
    end = lambda i, j, name: F.round(path[i][j], 6).alias(name)
    return shaped.select(
        F.col("properties")["OBJECTID"].alias("region_id"),
        F.col("properties")["TLine Name"].alias("line_name"),
        F.col("geometry.type").alias("geometry_type"),
        F.size(path).alias("n_points"),
        end(0, 0, "x0"), end(0, 1, "y0"), end(1, 0, "x1"), end(1, 1, "y1"),
    )


_BOX = (-121.9, 39.6, -121.6, 39.8)


def _clips(w: float, s: float, e: float, n: float) -> str:
    """The part of the segment inside the box, by parameter intervals, is not empty."""
    def slab(p0, d, lo, hi):
        within = f"{p0} BETWEEN {lo} AND {hi}"
        enter = f"CASE WHEN {d} <> 0 THEN least(({lo} - {p0})/nullif({d}, 0), ({hi} - {p0})/nullif({d}, 0)) WHEN {within} THEN 0e0 ELSE 2e0 END"
        leave = f"CASE WHEN {d} <> 0 THEN greatest(({lo} - {p0})/nullif({d}, 0), ({hi} - {p0})/nullif({d}, 0)) WHEN {within} THEN 1e0 ELSE -1e0 END"
        return enter, leave

    (a, b), (c, d) = slab("x0", "(x1 - x0)", w, e), slab("y0", "(y1 - y0)", s, n)
    return f"greatest({a}, {c}, 0e0) <= least({b}, {d}, 1e0)"


@query("regions_in_bbox", f"SELECT region_id, line_name FROM ({_SEGMENTS}) WHERE {_clips(*_BOX)}")
def regions_in_bbox(spark, sf_dir):
    return R.features_in_bbox(features(spark, sf_dir), _BOX).select(
        F.col("properties")["OBJECTID"].alias("region_id"), F.col("properties")["TLine Name"].alias("line_name")
    )


@query(
    "region_ids",
    "WITH seg AS (" + _SEGMENTS + "), lo AS (" + Q.project("seg", "x0", "y0", "gx0", "gy0") + "), hi AS ("
    + Q.project("lo", "x1", "y1", "gx1", "gy1") + ") SELECT region_id, 'corridor' AS region_kind, 1 AS n_edges, "
    "32610 AS epsg, round(least(gx0, gx1), 2) AS min_x, round(greatest(gy0, gy1), 2) AS max_y FROM hi "
    "UNION ALL SELECT CAST(s_suppkey AS string), 'hex', 5, 4326, "
    f"round({X.POLYGONS['ax']}, 2), round({X.POLYGONS['ay']} + {X.POLYGONS['h']}, 2) FROM supplier",
)
def region_ids(spark, sf_dir):
    corridors = R.corridor_regions(features(spark, sf_dir), X.BUFFER_M, X.EPSG)
    hexes = R.polygon_regions(X.polygon_features(spark, sf_dir), X.RES)
    return corridors.unionByName(hexes, allowMissingColumns=True).select(
        "region_id", "region_kind", F.size("edges").alias("n_edges"), "epsg",
        F.round("min_x", 2).alias("min_x"), F.round("max_y", 2).alias("max_y"),
    )


@query(
    "bbox_intersection",
    X.with_(
        "boxes",
        "SELECT c_custkey, round(w, 6) AS west, round(s, 6) AS south, round(e, 6) AS east, round(n, 6) AS north FROM cut "
        "WHERE w <= e AND s <= n",
        cut="SELECT c_custkey, greatest(west, -1221e-1) AS w, greatest(south, 395e-1) AS s, least(east, -1215e-1) AS e, "
        "least(north, 405e-1) AS n FROM boxes",
    ),
)
def bbox_intersection(spark, sf_dir):
    scenes = X.boxes(spark, sf_dir).withColumnsRenamed({c: f"scene_{c}" for c in ("west", "south", "east", "north")})
    study = dict(zip(("study_west", "study_south", "study_east", "study_north"), (-122.1, 39.5, -121.5, 40.5)))
    both = scenes.withColumns({k: F.lit(v) for k, v in study.items()})
    cut = S.intersect_boxes(both, list(study), [f"scene_{c}" for c in ("west", "south", "east", "north")])
    return cut.select("c_custkey", *[F.round(c, 6).alias(c) for c in ("west", "south", "east", "north")])


@query(
    "bbox_polygon",
    X.with_(
        "grid_boxes",
        "SELECT c_custkey, 5 AS n_points, 'POLYGON((' || a || ' ' || b || ', ' || c || ' ' || b || ', ' || c || ' ' || d "
        "|| ', ' || a || ' ' || d || ', ' || a || ' ' || b || '))' AS wkt FROM t",
        t="SELECT c_custkey, CAST(min_x AS string) AS a, CAST(min_y AS string) AS b, CAST(max_x AS string) AS c, "
        "CAST(max_y AS string) AS d FROM grid_boxes",
    ),
)
def bbox_polygon(spark, sf_dir):
    ring = E.bbox_ring(*(F.col(c) for c in ("min_x", "min_y", "max_x", "max_y")))
    return X.grid_boxes(spark, sf_dir).select(
        "c_custkey", F.size(ring).alias("n_points"), E.ring_wkt(ring).alias("wkt")
    )
