"""Rasters, lines, polygons and scenes derived from the given tables.

Every derivation is a list of plain SQL expressions that both engines accept, so the same
text builds a Spark DataFrame and a common table expression for the oracle. The mapped
area grows with the tables, which keeps the number of pixels and regions per square
kilometre constant from one scale factor to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPSG = 32610
HALF = 15.0
RES = 8
BUFFER_M = 100.0
STUDY_BBOX = (-121.85, 40.60, -121.76, 40.645)

_SCENE = (
    "'LC09_L2SP_04403' || CAST(1 + {k} % 3 AS string) || '_2024070' || CAST(1 + {k} % 9 AS string)"
    " || '_2024080' || CAST(1 + {k} % 9 AS string) || '_02_T1'"
)
_DN = "CASE WHEN l_suppkey % 17 = 0 THEN 0 ELSE 7273 + (l_orderkey*{a} + l_partkey*{b}) % 30000 END"

PX = {
    "scene_id": _SCENE.format(k="l_suppkey"),
    "x": "6e5 + 3e1*(l_partkey % 200 + 200*(CAST(floor(l_orderkey/15e5) AS bigint) % 100)) + 15e0",
    "y": "45e5 - 3e1*(CAST(floor(l_orderkey/75e0) AS bigint) % 20000) - 15e0",
    "b3": _DN.format(a=17, b=3),
    "b4": _DN.format(a=13, b=11),
    "b5": _DN.format(a=31, b=7),
    "b7": _DN.format(a=19, b=5),
}

# Bands of one order are unfolded from a literal list; low-priority orders lack band 7.
DN = {
    "scene_id": _SCENE.format(k="o_custkey"),
    "row_no": "CAST(floor(o_orderkey/125e0) AS bigint) % 20000",
    "col_no": "o_orderkey % 125 + 125*CAST(floor(o_orderkey/25e5) AS bigint)",
    "band": "band",
    "dn": "CASE WHEN (o_orderkey + k) % 23 = 0 THEN 0 ELSE 7273 + (o_orderkey*(7 + 6*k)) % 30000 END",
}
_DN_BANDS = "(VALUES ('B3', 0), ('B4', 1), ('B5', 2), ('B7', 3)) b(band, k)"
_DN_KEEP = "NOT (band = 'B7' AND o_orderpriority = '5-LOW')"

LINES = {
    "region_id": "CAST(c_custkey AS string)",
    "x0": "6e5 + c_custkey*37 % 6000 + 6e3*(CAST(floor(c_custkey/15e4) AS bigint) % 100)",
    "y0": "45e5 - c_custkey*4 % 600000",
    "x1": "6e5 + c_custkey*37 % 6000 + 6e3*(CAST(floor(c_custkey/15e4) AS bigint) % 100) + c_custkey*11 % 500 - 250",
    "y1": "45e5 - c_custkey*4 % 600000 + c_custkey*29 % 500 - 250",
}

POLYGONS = {
    "region_id": "CAST(s_suppkey AS string)",
    "ax": "6e5 + s_suppkey*137 % 6000 + 6e3*(CAST(floor(s_suppkey/1e4) AS bigint) % 100)",
    "ay": "45e5 - s_suppkey*60 % 600000",
    "w": "3e2 + s_suppkey*53 % 700",
    "h": "25e1 + s_suppkey*71 % 600",
}

ITEMS = {
    "item_id": "'LC09_L2SP_0440' || CAST(31 + s_suppkey % 3 AS string) || '_202407'"
    " || lpad(CAST(1 + s_suppkey % 20 AS string), 2, '0') || '_202407'"
    " || lpad(CAST(2 + s_suppkey % 20 AS string), 2, '0') || '_02_T1'"
    " || CASE WHEN s_suppkey % 2 = 0 THEN '_SR' ELSE '' END",
    "cloud_cover": "CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE (s_suppkey*37 % 1000)/1e1 END",
}

CAT_ID = (
    "'LC09_L2SP_' || lpad(CAST({k} % 1000000 AS string), 6, '0') || '_202407'"
    " || lpad(CAST(1 + {k} % 28 AS string), 2, '0') || '_' || lpad(CAST({k} AS string), CAST(greatest(10, length(CAST({k} AS string))) AS int), '0') || '_02_T1'"
)
SCENES = {"scene_id": CAT_ID.format(k="c_custkey"), "c_custkey": "c_custkey"}
FILES = {
    "scene_id": CAT_ID.format(k="o_custkey"),
    "band": "'B' || CAST(2 + o_orderkey % 6 AS string)",
    "o_orderkey": "o_orderkey",
}
POINTS = {
    "event_id": "event_id",
    "lon": "-1225e-1 + (event_id % 2500)/1e3",
    "lat": "39e0 + (event_id*7 % 2500)/1e3",
}
BOXES = {
    "c_custkey": "c_custkey",
    "west": "-1225e-1 + (c_custkey*7 % 2500)/1e3",
    "south": "39e0 + (c_custkey*13 % 2500)/1e3",
    "east": "-1225e-1 + (c_custkey*7 % 2500)/1e3 + 2e-2",
    "north": "39e0 + (c_custkey*13 % 2500)/1e3 + 2e-2",
}
GRID_BOXES = {
    "c_custkey": "c_custkey",
    "min_x": "6e5 + c_custkey*37 % 60000",
    "min_y": "44e5 + c_custkey*53 % 60000",
    "max_x": "6e5 + c_custkey*37 % 60000 + 18e2",
    "max_y": "44e5 + c_custkey*53 % 60000 + 15e2",
    "box_min_x": "6e5 + c_custkey*37 % 60000 + 4e2 - c_custkey % 2000",
    "box_min_y": "44e5 + c_custkey*53 % 60000 - 3e2",
    "box_max_x": "6e5 + c_custkey*37 % 60000 + 4e2 - c_custkey % 2000 + 9e2",
    "box_max_y": "44e5 + c_custkey*53 % 60000 + 5e2 + c_custkey % 700",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table as it lies."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(spec: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in spec.items()]


def px(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*columns(PX))


def dn_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = "inline(array(struct('B3', 0L), struct('B4', 1L), struct('B5', 2L), struct('B7', 3L))) AS (band, k)"
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("o_orderkey", "o_custkey", "o_orderpriority", bands)
        .filter(_DN_KEEP)
        .selectExpr(*columns(DN))
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*columns(LINES))


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(*columns(POLYGONS))


def stac_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(*columns(ITEMS))


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*columns(SCENES))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*columns(FILES))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*columns(POINTS))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*columns(BOXES))


def grid_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*columns(GRID_BOXES))


def _select(spec: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(columns(spec)) + " FROM " + source


CTE = {
    "px": _select(PX, "lineitem"),
    "dn_long": _select(DN, f"orders CROSS JOIN {_DN_BANDS}") + f" WHERE {_DN_KEEP}",
    "lines": _select(LINES, "customer"),
    "polygons": _select(POLYGONS, "supplier"),
    "stac_items": _select(ITEMS, "supplier"),
    "scenes": _select(SCENES, "customer"),
    "files": _select(FILES, "orders"),
    "points": _select(POINTS, "events"),
    "boxes": _select(BOXES, "customer"),
    "grid_boxes": _select(GRID_BOXES, "customer"),
}


def with_(names: str, body: str, **more: str) -> str:
    """Oracle text: the named fixtures and further expressions, then the body."""
    parts = [f"{n} AS ({CTE[n]})" for n in names.split()] + [f"{n} AS ({sql})" for n, sql in more.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def line_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as corridor regions in the grid."""
    edge = F.struct("x0", "y0", "x1", "y1")
    return lines(spark, sf_dir).select(
        "region_id",
        F.lit("corridor").alias("region_kind"),
        F.lit(False).alias("areal"),
        F.lit(BUFFER_M).alias("buffer_m"),
        F.array(edge).alias("edges"),
        F.lit(EPSG).alias("epsg"),
        F.least("x0", "x1").alias("min_x"),
        F.least("y0", "y1").alias("min_y"),
        F.greatest("x0", "x1").alias("max_x"),
        F.greatest("y0", "y1").alias("max_y"),
    )


# A notched ring: corner k at (fx, fy) of the polygon's width and height.
NOTCHED = ((0.0, 0.0), (1.0, 0.0), (0.5, 0.4), (1.0, 1.0), (0.0, 1.0))


def polygon_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The polygons as GeoJSON features in grid coordinates."""
    corners = [f"array(ax + w*{fx}D, ay + h*{fy}D)" for fx, fy in (*NOTCHED, NOTCHED[0])]
    ring = "array(array(" + ", ".join(corners) + "))"
    return polygons(spark, sf_dir).selectExpr(
        f"named_struct('type', 'Polygon', 'coordinates', to_json({ring})) AS geometry",
        "map('h3_index', region_id) AS properties",
    )
