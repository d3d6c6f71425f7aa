"""Bands, indices, blocks and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks import sqltext as Q
from checks.registry import query
from terrafold.functions.projection import project_bbox
from terrafold.functions.sql import register_functions
from terrafold.functions.spectral import reflectance
from terrafold.operators import bands as B
from terrafold.operators import catalog as K
from terrafold.sources import geotiff, listing

IDX = ("ndvi", "nbr", "ndwi")


def indexed_px(spark, sf_dir):
    return B.with_indices(X.px(spark, sf_dir), ["scene_id", "x", "y"])


# Digital numbers make values that end in a 5 at the seventh decimal, so rows are compared
# at nine; averages over many pixels are compared at six.
def _rounded(df, keep):
    return df.select(*keep, *[F.round(i, 9).alias(i) for i in IDX])


_ROUND = ", ".join(f"round({i}, 9) AS {i}" for i in IDX)


@query(
    "reflectance",
    X.with_("px", f"SELECT scene_id, x, y, round({Q.refl('b4')}, 9) AS red, round({Q.refl('b5')}, 9) AS nir FROM px"),
)
def reflectance_(spark, sf_dir):
    return X.px(spark, sf_dir).select(
        "scene_id", "x", "y",
        F.round(reflectance("b4"), 9).alias("red"),
        F.round(reflectance("b5"), 9).alias("nir"),
    )


@query("spectral_indices", X.with_("px", f"SELECT scene_id, x, y, {_ROUND} FROM ({Q.indices('px', 'scene_id, x, y')})"))
def spectral_indices_(spark, sf_dir):
    return _rounded(indexed_px(spark, sf_dir), ["scene_id", "x", "y"])


_ALIGN = (
    "SELECT a.scene_id, a.row_no, a.col_no, a.dn AS b3, b.dn AS b4, c.dn AS b5, d.dn AS b7 FROM {0} a "
    "JOIN {0} b USING (scene_id, row_no, col_no) JOIN {0} c USING (scene_id, row_no, col_no) "
    "JOIN {0} d USING (scene_id, row_no, col_no) "
    "WHERE a.band = 'B3' AND b.band = 'B4' AND c.band = 'B5' AND d.band = 'B7'"
).format("dn_long")


def aligned_dn(spark, sf_dir):
    return B.align_bands(X.dn_long(spark, sf_dir), ["scene_id", "row_no", "col_no"])


@query("band_align", X.with_("dn_long", _ALIGN))
def band_align(spark, sf_dir):
    return aligned_dn(spark, sf_dir)


@query(
    "index_encode",
    X.with_(
        "dn_long",
        "SELECT scene_id, row_no, col_no, "
        + ", ".join(f"round(CAST(coalesce(CAST({i} AS real), -9999) AS double), 6) AS {i}" for i in IDX)
        + " FROM (" + Q.indices("aligned", "scene_id, row_no, col_no") + ")",
        aligned=_ALIGN,
    ),
)
def index_encode(spark, sf_dir):
    keep = ["scene_id", "row_no", "col_no"]
    coded = B.encoded_indices(B.with_indices(aligned_dn(spark, sf_dir), keep))
    return coded.select(*keep, *[F.round(F.col(i).cast("double"), 6).alias(i) for i in IDX])


_w, _s, _e, _n = X.STUDY_BBOX


@query(
    "clip_bbox",
    X.with_(
        "px",
        "SELECT scene_id, x, y, b4 FROM px, box WHERE x BETWEEN x0 - 15 AND x1 + 15 AND y BETWEEN y0 - 15 AND y1 + 15",
        corners=f"SELECT * FROM (VALUES ({_w}, {_s}), ({_w}, {_n}), ({_e}, {_s}), ({_e}, {_n})) v(lon, lat)",
        projected=Q.project("(SELECT CAST(lon AS double) AS lon, CAST(lat AS double) AS lat FROM corners)"),
        box="SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM projected",
    ),
)
def clip_bbox(spark, sf_dir):
    clipped = B.clip_to_bbox(X.px(spark, sf_dir), X.STUDY_BBOX, X.EPSG, X.HALF)
    return clipped.select("scene_id", "x", "y", "b4")


@query(
    "sql_functions",
    X.with_(
        "px",
        f"SELECT scene_id, substr(scene_id, 11, 3) AS wrs_path, substr(scene_id, 14, 3) AS wrs_row, "
        f"substr(scene_id, 18, 8) AS acquired, round(avg(ndvi), 6) AS ndvi_mean, round(avg(nbr), 6) AS nbr_mean, "
        f"round(avg(ndwi), 6) AS ndwi_mean, round(avg(ndvi), 6) AS diff_mean "
        f"FROM ({Q.indices('px', 'scene_id')}) GROUP BY scene_id",
    ),
)
def sql_functions(spark, sf_dir):
    register_functions(spark)
    scaled = X.px(spark, sf_dir).selectExpr(
        "scene_normalize(concat(scene_id, '_SR')) AS scene_id",
        *[f"dn_reflectance({b}) AS {b}" for b in ("b3", "b4", "b5", "b7")],
    )
    return (
        scaled.selectExpr(
            "scene_id", "ndvi(b4, b5) AS ndvi", "nbr(b5, b7) AS nbr", "ndwi(b3, b5) AS ndwi",
            "norm_diff(b5, b4) AS diff",
        )
        .groupBy("scene_id")
        .agg(*[F.round(F.avg(i), 6).alias(f"{i}_mean") for i in (*IDX, "diff")])
        .selectExpr(
            "scene_id", "scene_wrs_path(scene_id) AS wrs_path", "scene_wrs_row(scene_id) AS wrs_row",
            "scene_date(scene_id) AS acquired", "ndvi_mean", "nbr_mean", "ndwi_mean", "diff_mean",
        )
    )


def dn_blocks(spark, sf_dir, block=32):
    """Blocks of the digital numbers, placed in the grid."""
    packed = B.pixels_to_blocks(X.dn_long(spark, sf_dir), "dn", block, fill=0, value_type="int")
    return packed.withColumns(
        {
            "x0": F.lit(6e5) + F.col("first_col") * 30.0,
            "y0": F.lit(45e5) - F.col("first_row") * 30.0,
            "pixel_size": F.lit(30.0),
            "epsg": F.lit(X.EPSG),
        }
    )


_PIXELS = X.with_(
    "dn_long",
    "SELECT scene_id, band, row_no, col_no, 6e5 + 3e1*col_no + 15e0 AS x, 45e5 - 3e1*row_no - 15e0 AS y, "
    "max(dn) AS dn FROM dn_long GROUP BY ALL HAVING max(dn) <> 0",
)


@query("block_to_pixels", _PIXELS)
def block_to_pixels(spark, sf_dir):
    pixels = B.blocks_to_pixels(dn_blocks(spark, sf_dir))
    return B.valid_pixels(pixels).withColumn("dn", F.col("dn").cast("bigint"))


@query("geotiff_blocks", _PIXELS)
def geotiff_blocks(spark, sf_dir):
    files = geotiff.encode_geotiffs(
        dn_blocks(spark, sf_dir), ["scene_id", "band", "block_row", "block_col"], "uint16", nodata=0.0
    ).withColumnsRenamed({"block_row": "file_row", "block_col": "file_col"})
    decoded = geotiff.decode_geotiffs(files, ["scene_id", "band", "file_row", "file_col"])
    # Each file is one block of its scene, so its own addresses are shifted back.
    placed = decoded.withColumns(
        {
            "first_row": F.col("first_row") + F.col("file_row") * 32,
            "first_col": F.col("first_col") + F.col("file_col") * 32,
        }
    )
    return B.valid_pixels(B.blocks_to_pixels(placed)).withColumn("dn", F.col("dn").cast("bigint"))


@query(
    "band_dim_join",
    X.with_(
        "dn_long",
        "SELECT dn_long.band AS band, band_name, common_name, center_wavelength, full_width_half_max, "
        "count(*) AS n, CAST(sum(dn) AS bigint) AS total FROM dn_long JOIN dim USING (band) GROUP BY ALL",
        dim="SELECT * FROM (VALUES ('B2','blue','blue',482e-3,60e-3),('B3','green','green',562e-3,57e-3),"
        "('B4','red','red',655e-3,38e-3),('B5','nir08','nir08',865e-3,28e-3),('B6','swir16','swir16',161e-2,85e-3),"
        "('B7','swir22','swir22',22e-1,2e-1)) d(band, band_name, common_name, center_wavelength, full_width_half_max)",
    ),
)
def band_dim_join(spark, sf_dir):
    # One row per band reaches the join; its names are attached afterwards.
    totals = X.dn_long(spark, sf_dir).groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.sum("dn").alias("total")
    )
    return K.join_band_dimension(totals)


_INDEX_PATHS = (
    "'file:/data/indices/' || " + X.CAT_ID.format(k="o_custkey") + " || '/' || "
    "CASE o_orderkey % 3 WHEN 0 THEN 'ndvi' WHEN 1 THEN 'nbr' ELSE 'ndwi' END || '.tif'"
)


@query(
    "raster_manifest",
    "SELECT DISTINCT regexp_extract(path, '([^/]+)/[^/]+$', 1) AS scene_id, "
    "regexp_extract(path, '([^/]+)[.]tif$', 1) AS index_name, substr(path, 6) AS path "
    f"FROM (SELECT {_INDEX_PATHS} AS path FROM orders)",
)
def raster_manifest(spark, sf_dir):
    paths = X.table(spark, sf_dir, "orders").selectExpr(f"{_INDEX_PATHS} AS path").distinct()
    return listing.manifest_from_paths(paths).orderBy("scene_id", "index_name")


_RAW_PATHS = (
    "'file:/data/raw/' || " + X.CAT_ID.format(k="l_orderkey") + " || '/' || " + X.CAT_ID.format(k="l_orderkey")
    + " || CASE WHEN l_linenumber = 1 THEN '_MTL.json' ELSE '_SR_B' || CAST(l_linenumber AS string) || '.TIF' END"
)


@query(
    "scene_listing",
    f"SELECT DISTINCT scene_id FROM (SELECT {X.CAT_ID.format(k='l_orderkey')} AS scene_id, l_linenumber FROM lineitem) "
    "WHERE l_linenumber <> 1",
)
def scene_listing(spark, sf_dir):
    paths = X.table(spark, sf_dir, "lineitem").selectExpr(f"{_RAW_PATHS} AS path")
    return listing.scenes_from_paths(paths)
