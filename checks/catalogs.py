"""Metadata documents, catalog items and collections."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks.registry import query
from terrafold.functions import metadata as MD
from terrafold.functions import scene_ids as I
from terrafold.operators import catalog as K
from terrafold.plans import scene_catalog as P
from terrafold.sources import documents as D
from terrafold.sources.shared import fresh_path

COLLECTION = "landsat-9-scenes"

# Values of one metadata document, as SQL over ``customer``; some are absent or malformed.
_VALUES = {
    "CLOUD_COVER_LAND": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey*7 % 1000 AS string) || 'e-1' END",
    "CLOUD_COVER": "CASE WHEN c_custkey % 8 = 0 THEN 'n/a' ELSE CAST(c_custkey % 100 AS string) END",
    "SUN_ELEVATION_LAND": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 90 AS string) || '.5' END",
    "SUN_ELEVATION": "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE '61.25' END",
    "SUN_AZIMUTH": "CAST(c_custkey % 360 AS string)",
    "DATE_ACQUIRED": "CASE WHEN c_custkey % 9 = 1 THEN NULL ELSE '2024-07-' || lpad(CAST(1 + c_custkey % 28 AS string), 2, '0') END",
    "SCENE_CENTER_TIME": "CASE WHEN c_custkey % 9 = 2 THEN 'noon' ELSE '18:' || lpad(CAST(c_custkey % 60 AS string), 2, '0') || ':23.1234560Z' END",
}
_GRID = {
    "UTM_ZONE": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(10 + c_custkey % 3 AS string) END",
    "GRID_CELL_SIZE_REFLECTIVE": "'30.00'",
    "REFLECTIVE_LINES": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(7700 + c_custkey % 400 AS string) END",
    "REFLECTIVE_SAMPLES": "CAST(7600 + c_custkey % 300 AS string) || '.7'",
    "CORNER_UL_PROJECTION_X_PRODUCT": "CAST(500000 + c_custkey*30 % 60000 AS string) || '.000'",
    "CORNER_UL_PROJECTION_Y_PRODUCT": "CASE WHEN c_custkey % 11 = 0 THEN 'x' ELSE CAST(4500000 + c_custkey*30 % 60000 AS string) END",
}


def _section(name: str, values: dict[str, str]) -> str:
    pairs = " || ',' || ".join(f"'\"{k}\":' || coalesce('\"' || {v} || '\"', 'null')" for k, v in values.items())
    return f"'\"{name}\":{{' || {pairs} || '}}'"


_BODY = "'{' || " + _section("IMAGE_ATTRIBUTES", _VALUES) + " || ',' || " + _section("PROJECTION_ATTRIBUTES", _GRID) + " || '}'"
_DOCUMENT = f"CASE WHEN c_custkey % 2 = 0 THEN {_BODY} ELSE '{{\"LANDSAT_METADATA_FILE\":' || {_BODY} || '}}' END"

_FLAT = (
    "SELECT c_custkey, scene_id, "
    "coalesce(CASE WHEN c_custkey % 4 <> 0 THEN (c_custkey*7 % 1000)/1e1 WHEN c_custkey % 8 <> 0 THEN c_custkey % 100 END, 0e0) AS cloud_cover, "
    "CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 90 + 5e-1 WHEN c_custkey % 6 <> 0 THEN 6125e-2 ELSE 0e0 END AS sun_elevation, "
    "CAST(c_custkey % 360 AS double) AS sun_azimuth, "
    "CASE WHEN c_custkey % 5 = 0 THEN 32610 ELSE 32610 + c_custkey % 3 END AS epsg, "
    "CASE WHEN c_custkey % 7 <> 0 THEN 7700 + c_custkey % 400 END AS lines, "
    "CASE WHEN c_custkey % 7 <> 0 THEN 7600 + c_custkey % 300 END AS samples, "
    "CASE WHEN c_custkey % 11 <> 0 THEN CAST(500000 + c_custkey*30 % 60000 AS double) END AS origin_x, "
    "CASE WHEN c_custkey % 11 <> 0 THEN CAST(4500000 + c_custkey*30 % 60000 AS double) END AS origin_y, "
    "CASE WHEN c_custkey % 11 <> 0 THEN -3e1 END AS scale_y, "
    "CASE WHEN c_custkey % 9 NOT IN (1, 2) THEN '2024-07-' || lpad(CAST(1 + c_custkey % 28 AS string), 2, '0') || ' 18:' "
    "|| lpad(CAST(c_custkey % 60 AS string), 2, '0') || ':23' END AS scene_time FROM scenes"
)


def metadata(spark, sf_dir):
    documents = X.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", X.SCENES["scene_id"] + " AS scene_id", f"{_DOCUMENT} AS document"
    )
    return K.parse_metadata(documents).drop("document")


def _when(ts):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


@query("mtl_flatten", X.with_("scenes", _FLAT))
def mtl_flatten(spark, sf_dir):
    shape, affine = F.col("proj_shape"), F.col("proj_transform")
    return metadata(spark, sf_dir).select(
        "c_custkey", "scene_id", "cloud_cover", "sun_elevation", "sun_azimuth", "epsg",
        shape[0].alias("lines"), shape[1].alias("samples"),
        affine[2].alias("origin_x"), affine[5].alias("origin_y"), affine[4].alias("scale_y"),
        _when(F.col("scene_time")).alias("scene_time"),
    )


_NOON = "coalesce(scene_time, '2024-07-' || lpad(CAST(1 + c_custkey % 28 AS string), 2, '0') || ' 12:00:00')"


@query("scene_datetime", X.with_("scenes", f"SELECT scene_id, {_NOON} AS datetime FROM flat", flat=_FLAT))
def scene_datetime(spark, sf_dir):
    when = K.scene_datetime(F.col("scene_time"), F.col("scene_id"))
    return metadata(spark, sf_dir).select("scene_id", _when(when).alias("datetime"))


def items(spark, sf_dir, **options):
    bands = X.files(spark, sf_dir).select(
        "scene_id", "band", I.local_band_path("data/cog", "scene_id", "band").alias("path")
    )
    boxes = X.boxes(spark, sf_dir).withColumn("scene_id", F.expr(X.SCENES["scene_id"])).drop("c_custkey")
    return P.build_catalog(
        X.scenes(spark, sf_dir).select("scene_id"), metadata(spark, sf_dir).drop("c_custkey"), bands, boxes,
        collection_id=COLLECTION, title="Scenes", description="Derived scenes",
        providers=[{"name": "USGS", "roles": ["producer", "licensor"], "url": "https://earthexplorer.usgs.gov"}],
        **options,
    )


_ITEMS = {
    "flat": _FLAT,
    "per": "SELECT scene_id, string_agg(band, ',' ORDER BY band) AS bands, count(*) AS n_bands FROM (SELECT DISTINCT scene_id, band FROM files) "
    "GROUP BY scene_id HAVING bool_or(band = 'B4') AND bool_or(band = 'B5')",
    "built": f"SELECT scene_id, c_custkey, {_NOON} AS datetime, round(west, 6) AS west, round(south, 6) AS south, round(east, 6) AS east, "
    "round(north, 6) AS north, cloud_cover, sun_elevation, sun_azimuth, epsg, coalesce(lines, 8031) AS lines, coalesce(samples, 8001) AS samples, origin_x, bands, n_bands "
    "FROM flat JOIN per USING (scene_id) JOIN boxes USING (c_custkey)",
}
_HREF = (
    "'s3://usgs-landsat/collection02/level-2/standard/oli-tirs/2024/' || substr(scene_id, 11, 3) || '/' || substr(scene_id, 14, 3) "
    "|| '/' || scene_id || '/' || scene_id || '_SR_' || {band} || '.TIF'"
)


@query(
    "stac_item_build",
    X.with_(
        "scenes files boxes",
        "SELECT scene_id, datetime, west, south, east, north, substr(scene_id, 11, 3) AS wrs_path, substr(scene_id, 14, 3) AS wrs_row, "
        "cloud_cover, sun_elevation, sun_azimuth, epsg, lines, samples, origin_x, bands, n_bands, "
        + _HREF.format(band="'B4'") + " AS red_href FROM built",
        **_ITEMS,
    ),
)
def stac_item_build(spark, sf_dir):
    built, _ = items(spark, sf_dir)
    return built.select(
        "scene_id", _when(F.col("datetime")).alias("datetime"),
        *[F.round(c, 6).alias(c) for c in ("west", "south", "east", "north")],
        "wrs_path", "wrs_row", "cloud_cover", "sun_elevation", "sun_azimuth", "epsg",
        F.col("proj_shape")[0].alias("lines"), F.col("proj_shape")[1].alias("samples"),
        F.col("proj_transform")[2].alias("origin_x"),
        F.concat_ws(",", "bands").alias("bands"), F.size("bands").cast("bigint").alias("n_bands"),
        F.col("hrefs")["B4"].alias("red_href"),
    )


@query(
    "collection_extent",
    X.with_(
        "scenes files boxes",
        "SELECT min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north, min(datetime) AS first_datetime, "
        "max(datetime) AS last_datetime, count(*) AS n_items FROM built",
        **_ITEMS,
    ),
)
def collection_extent(spark, sf_dir):
    built, _ = items(spark, sf_dir)
    extent = K.collection_extent(built)
    return extent.withColumns(
        {
            **{c: F.round(c, 6) for c in ("west", "south", "east", "north")},
            **{c: _when(F.col(c)) for c in ("first_datetime", "last_datetime")},
        }
    )


@query(
    "catalog_assets",
    X.with_(
        "scenes files boxes",
        "SELECT scene_id AS id, datetime, cloud_cover, band, " + _HREF.format(band="band")
        + " AS href FROM (SELECT built.*, band FROM built JOIN (SELECT DISTINCT scene_id, band FROM files) USING (scene_id))",
        **_ITEMS,
    ),
)
def catalog_assets(spark, sf_dir):
    built, _ = items(spark, sf_dir)
    text = K.item_documents(built, COLLECTION).select(F.to_json("item").alias("text"))
    parsed = text.select(F.from_json("text", D.ITEM_SCHEMA).alias("d")).select(
        F.col("d.id").alias("id"),
        F.to_timestamp("d.properties.datetime").alias("datetime"),
        F.col("d.properties.`eo:cloud_cover`").alias("cloud_cover"),
        F.col("d.assets").alias("assets"),
    )
    return K.band_assets(parsed).withColumn("datetime", _when(F.col("datetime")))


@query(
    "catalog_json",
    X.with_(
        "scenes files boxes",
        "SELECT scene_id AS id, datetime, cloud_cover, round(west, 6) AS west, round(north, 6) AS north, "
        "'EPSG:' || CAST(epsg AS string) AS code, lines, n_bands + 1 AS n_assets, 'landsat-9-scenes' AS collection, "
        "'data/raw/' || scene_id || '/' || scene_id || '_MTL.json' AS metadata_href FROM built",
        **_ITEMS,
    ),
)
def catalog_json(spark, sf_dir):
    built, collection = items(spark, sf_dir, href_bucket=None)
    path = P.write_catalog(built, collection, COLLECTION, fresh_path(spark, "catalog"))
    read = D.read_items(spark, f"{path}/items", one_document_per_line=True)
    asset = F.col("assets")
    return read.select(
        "id", _when(F.col("datetime")).alias("datetime"), "cloud_cover",
        F.round(F.col("bbox")[0], 6).alias("west"), F.round(F.col("bbox")[3], 6).alias("north"),
        F.col("properties.`proj:code`").alias("code"), F.col("properties.`proj:shape`")[0].alias("lines"),
        F.size(F.map_keys(asset)).cast("bigint").alias("n_assets"), "collection",
        asset["MTL_JSON"]["href"].alias("metadata_href"),
    )


@query(
    "catalog_tree",
    X.with_(
        "scenes files boxes",
        "SELECT scene_id AS id, 4 AS depth, 'items/wrs_path=' || substr(scene_id, 11, 3) || '/wrs_row=' || substr(scene_id, 14, 3) || '/id=' || scene_id AS folder "
        "FROM built UNION ALL SELECT DISTINCT 'wrs_path=' || substr(scene_id, 11, 3) || '/wrs_row=' || substr(scene_id, 14, 3), 3, "
        "'rows/wrs_path=' || substr(scene_id, 11, 3) || '/wrs_row=' || substr(scene_id, 14, 3) FROM built "
        "UNION ALL SELECT DISTINCT 'wrs_path=' || substr(scene_id, 11, 3), 2, 'paths/wrs_path=' || substr(scene_id, 11, 3) FROM built "
        f"UNION ALL SELECT '{COLLECTION}', 1, 'collection' UNION ALL SELECT 'scenes', 0, 'catalog'",
        **_ITEMS,
    ),
)
def catalog_tree(spark, sf_dir):
    """All documents that links lead to from the root, read back from files."""
    built, collection = items(spark, sf_dir, href_bucket=None)
    path = P.write_catalog_tree(built, collection, COLLECTION, fresh_path(spark, "tree"))
    return K.linked_documents(D.read_tree(spark, path), "catalog", 5).select("id", "depth", "folder")
