from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from terrafold.functions import edges, metadata, projection, scene_ids, spectral
from terrafold.operators import bands, cells
from terrafold.operators.scenes import scene_bbox


def one(spark, column, **values):
    row = {k: v for k, v in values.items()} or {"_": 0}
    return spark.createDataFrame([row]).select(column.alias("out")).first()["out"]


def test_reflectance(spark):
    """Fill has no reflectance; the scale runs through its own zero and past one."""
    given = {0: None, 1: -0.1999725, 8000: 0.02, 43636: 0.99999, 65455: 1.6000125}
    rows = spark.createDataFrame([(k,) for k in given], "dn int").select("dn", spectral.reflectance("dn").alias("r")).collect()
    assert {r["dn"]: None if r["r"] is None else pytest.approx(r["r"], abs=1e-9) for r in rows} == given


def test_index_values(spark):
    """Each index by hand from bands that give fractions of small numbers."""
    df = spark.createDataFrame([(0.12, 0.06, 0.42, 0.14)], "b3 double, b4 double, b5 double, b7 double")
    row = df.select(*spectral.spectral_indices({"B3": "b3", "B4": "b4", "B5": "b5", "B7": "b7"})).first()
    assert row["ndvi"] == pytest.approx(3 / 4)
    assert row["nbr"] == pytest.approx(1 / 2)
    assert row["ndwi"] == pytest.approx(-5 / 9)


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(0.1, -0.1)], "a double, b double")
    assert df.select(spectral.normalized_difference("a", "b").alias("v")).first()["v"] is None


def test_missing_bands_are_an_error(spark):
    with pytest.raises(ValueError, match="Missing required bands"):
        spectral.spectral_indices({"B4": "b4", "B5": "b5"})
    with pytest.raises(ValueError, match="Missing required bands"):
        bands.with_indices(spark.createDataFrame([(1, 2)], "b4 int, b5 int"), [])


def test_index_encoding_round_trip(spark):
    df = spark.createDataFrame([(0.25,), (None,), (float("nan"),), (float("inf"),)], "v double")
    coded = df.select(spectral.encode_index("v").alias("c"))
    assert [r["c"] for r in coded.collect()] == [0.25, -9999.0, -9999.0, -9999.0]
    assert [r["d"] for r in coded.select(spectral.decode_index("c").alias("d")).collect()] == [0.25, None, None, None]


def test_projection_round_trip():
    for epsg in (32610, 32633, 32719):
        lon0 = projection.central_meridian(epsg)
        sign = -1 if epsg // 100 == 327 else 1
        for dlon in (-3.0, -1.2, 0.0, 2.5):
            for lat in (1.0, 39.0, 70.0):
                x, y = projection.project_point(lon0 + dlon, sign * lat, epsg)
                lon, la = projection.unproject_point(x, y, epsg)
                assert lon == pytest.approx(lon0 + dlon, abs=1e-9)
                assert la == pytest.approx(sign * lat, abs=1e-9)


def test_projection_rejects_other_codes():
    with pytest.raises(ValueError):
        projection.utm_zone(3857)


def test_scene_box_of_a_published_item(spark):
    # Grid and box of a public catalog item; its transform names the corner pixel's centre.
    x0, y0, lines, samples = 567600.0, 4741200.0, 7761, 7641
    extent = spark.createDataFrame(
        [("s", x0 - 15, y0 + 15 - 30.0 * lines, x0 - 15 + 30.0 * samples, y0 + 15)],
        "scene_id string, min_x double, min_y double, max_x double, max_y double",
    )
    row = scene_bbox(extent, 32610).first()
    got = [row["west"], row["south"], row["east"], row["north"]]
    assert got == pytest.approx(
        [-122.1997254539928, 40.67295409167015, -119.3723994484045, 42.82051448319362], abs=1e-9
    )


def test_vertex_projection_equals_points(spark):
    df = spark.createDataFrame([([[-121.7, 39.7], [-122.0, 40.1]],)], "p array<array<double>>")
    out = df.select(projection.project_vertices(F.col("p"), 32610).alias("g")).first()["g"]
    for got, (lon, lat) in zip(out, [(-121.7, 39.7), (-122.0, 40.1)]):
        assert got == pytest.approx(projection.project_point(lon, lat, 32610), abs=1e-6)
    back = df.select(
        projection.unproject_vertices(projection.project_vertices(F.col("p"), 32610), 32610).alias("b")
    ).first()["b"]
    assert back[1] == pytest.approx([-122.0, 40.1], abs=1e-10)


def test_scene_id_rules(spark):
    ids = ["LC09_L2SP_012022_20210305_20210309_02_T1", "LC09_L2SP_01202_20210305", "short_id", None]
    df = spark.createDataFrame([(i,) for i in ids], "scene_id string")
    rows = df.select(scene_ids.valid_scene_id("scene_id").alias("ok"), *[
        c.alias(n) for n, c in scene_ids.scene_parts("scene_id").items()
    ]).collect()
    assert rows[0].asDict() == {
        "ok": True, "wrs_path": "012", "wrs_row": "022", "year": 2021, "acquisition_date": "20210305"
    }
    assert all(r["wrs_path"] is None for r in rows[1:])
    with pytest.raises(Exception, match="Invalid scene ID"):
        df.select(*scene_ids.scene_parts("scene_id", strict=True).values()).collect()


def test_only_one_suffix_is_removed(spark):
    assert one(spark, scene_ids.normalize_scene_id("i"), i="a_SR_SR") == "a_SR"


def test_band_labels(spark):
    df = spark.createDataFrame([("b4",), ("5",), ("B7",), ("QA",)], "b string")
    assert [r[0] for r in df.select(scene_ids.band_label("b")).collect()] == ["B4", "B5", "B7", None]
    with pytest.raises(Exception, match="Invalid band"):
        df.select(scene_ids.band_label("b", strict=True)).collect()


def test_metadata_document(spark):
    from terrafold.operators.catalog import parse_metadata

    text = (
        '{"LANDSAT_METADATA_FILE":{"IMAGE_ATTRIBUTES":{"CLOUD_COVER_LAND":"4.12","SUN_ELEVATION_LAND":"65.5",'
        '"SUN_AZIMUTH_LAND":"145.2","DATE_ACQUIRED":"2024-07-15","SCENE_CENTER_TIME":"18:45:23.1234560Z"},'
        '"PROJECTION_ATTRIBUTES":{"UTM_ZONE":"10","GRID_CELL_SIZE_REFLECTIVE":"30.00","REFLECTIVE_LINES":"8031",'
        '"REFLECTIVE_SAMPLES":"8001","CORNER_UL_PROJECTION_X_PRODUCT":"600000.000",'
        '"CORNER_UL_PROJECTION_Y_PRODUCT":"4500000.000"}}}'
    )
    rows = parse_metadata(spark.createDataFrame([(text,), ("{}",)], "document string")).collect()
    full, empty = rows
    assert (full["cloud_cover"], full["sun_elevation"], full["sun_azimuth"], full["epsg"]) == (4.12, 65.5, 145.2, 32610)
    assert full["proj_shape"] == [8031, 8001]
    assert full["proj_transform"] == [30.0, 0.0, 600000.0, 0.0, -30.0, 4500000.0]
    assert full["scene_time"] == datetime.datetime(2024, 7, 15, 18, 45, 23)
    assert (empty["cloud_cover"], empty["epsg"], empty["proj_shape"], empty["scene_time"]) == (0.0, 32610, None, None)


def test_bad_times_are_null(spark):
    for date, clock in (("2024-13-01", "10:00:00Z"), ("2024-07-01", "noon"), (None, "10:00:00Z"), ("2024-07-01", "25:00:00")):
        df = spark.createDataFrame([(date, clock)], "d string, t string")
        assert df.select(metadata.scene_center_time(F.col("d"), F.col("t")).alias("v")).first()["v"] is None


def test_bbox_needs_four_numbers():
    assert edges.coerce_bbox([1, 2, 3, 4]) == (1.0, 2.0, 3.0, 4.0)
    with pytest.raises(ValueError, match="exactly 4"):
        edges.coerce_bbox([1, 2, 3])


def test_polyfill_centres_lie_inside(spark):
    box = spark.createDataFrame([(-121.9, 39.6, -121.6, 39.8)], "west double, south double, east double, north double")
    found = cells.polyfill_wgs84(box, 32610).collect()
    assert all(-121.9 <= r["center_lon"] <= -121.6 and 39.6 <= r["center_lat"] <= 39.8 for r in found)
    # Area of the box over the area of a cell.
    assert len(found) == pytest.approx(0.3 * math.cos(math.radians(39.7)) * 0.2 * 111194.9**2 / (1.5 * math.sqrt(3) * 461**2), rel=0.03)
    empty = cells.polyfill_wgs84(box.limit(0), 32610)
    assert empty.count() == 0


def test_prefixes_of_usual_and_other_ids(spark):
    """The short way for usual ids gives what taking ids apart gives, whatever the prefix holds."""
    ids = ["LC09_L2SP_012022_20210305_20210309_02_T1", "a_b_123456_01990101", "__000000_20000101_$1", "x_y_1_2", "LC09_L2SP_012022_20210305", "", None]
    df = spark.createDataFrame([(i,) for i in ids], "scene_id string")
    for prefix in (scene_ids.COLLECTION_PREFIX, "a$1\\2/b/"):
        rows = df.select(
            scene_ids.scene_prefix("scene_id", prefix).alias("short"), scene_ids._any_prefix("scene_id", prefix, False).alias("long")
        ).collect()
        assert [r["short"] for r in rows] == [r["long"] for r in rows]
        assert rows[0]["short"] == f"{prefix.rstrip('/')}/2021/012/022/{ids[0]}/" and rows[1]["short"].startswith(f"{prefix.rstrip('/')}/199/123/456/")
        assert [r["short"] is None for r in rows] == [False, False, False, True, False, True, True]
