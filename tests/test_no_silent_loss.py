"""No silent loss: envelopes, missing data, replays, repeated ids, bad names."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from terrafold.functions import hexgrid, metadata, projection, scene_ids
from terrafold.operators import catalog, cells
from terrafold.plans import region_features as RF
from terrafold.sources import features, listing

BOXES = [
    (-120.2, -10.0, -120.0, 30.0),  # crosses the equator next to the zone's edge
    (-126.0, -0.5, -120.0, 0.5),
    (-124.0, 50.0, -122.0, 72.0),
    (-126.0, 60.0, -125.5, 60.3),
]


@pytest.mark.parametrize("box", BOXES)
def test_envelope_holds_every_boundary_point(spark, box):
    df = spark.createDataFrame([box], "west double, south double, east double, north double")
    row = cells.grid_envelope(df, 32610).first()
    west, south, east, north = box
    steps = [i / 400 for i in range(401)]
    sides = [(west + (east - west) * t, y) for t in steps for y in (south, north)]
    sides += [(x, south + (north - south) * t) for t in steps for x in (west, east)]
    xs, ys = zip(*(projection.project_point(lon, lat, 32610) for lon, lat in sides), strict=True)
    assert row["min_x"] <= min(xs) + 1e-3 and row["max_x"] >= max(xs) - 1e-3
    assert row["min_y"] <= min(ys) + 1e-3 and row["max_y"] >= max(ys) - 1e-3
    assert abs(row["max_x"] - max(xs)) < 50 and abs(row["min_x"] - min(xs)) < 50


def test_polyfill_next_to_the_equator(spark):
    """Cells of a thin strip are those whose centre unprojects into it, none missing."""
    box = (-120.2, -0.05, -120.0, 0.05)
    tall = (-120.2, -10.0, -120.0, 30.0)
    schema = "west double, south double, east double, north double"
    near = cells.polyfill_wgs84(spark.createDataFrame([box], schema), 32610, 8).select("q", "r")
    whole = cells.polyfill_wgs84(spark.createDataFrame([tall], schema), 32610, 8).filter("center_lat between -0.05 and 0.05").select("q", "r")
    assert {tuple(r) for r in near.collect()} == {tuple(r) for r in whole.collect()}
    s, expected = hexgrid.edge_m(8), 0
    x0, y0 = projection.project_point(-120.2, 0.0, 32610)
    x1, _ = projection.project_point(-120.0, 0.0, 32610)
    for r in range(int((y0 - 6000) / (1.5 * s)), int((y0 + 6000) / (1.5 * s)) + 2):
        for q in range(int((x0 - 9000) / (3**0.5 * s) - r / 2), int((x1 + 9000) / (3**0.5 * s) - r / 2) + 2):
            lon, lat = projection.unproject_point((q + r / 2) * 3**0.5 * s, r * 1.5 * s, 32610)
            expected += -120.2 <= lon <= -120.0 and -0.05 <= lat <= 0.05
    assert near.count() == expected


def test_equal_boxes_stay_apart(spark):
    df = spark.createDataFrame([BOXES[3]] * 2, "west double, south double, east double, north double")
    assert cells.grid_envelope(df, 32610).count() == 2


def test_only_a_missing_path_reads_as_empty(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0)], "cell string, v double")
    path = features.write_features(df, str(tmp_path / "out"), "cell")
    with pytest.raises(AnalysisException):
        features.read_features(spark, path, "cell string, id long, ID long", "cell").collect()
    assert features.read_features(spark, str(tmp_path / "none"), df.schema, "cell").count() == 0
    assert listing.scene_listing(spark, str(tmp_path / "none")).count() == 0


def test_a_second_run_replaces_whole_scenes(spark, tmp_path):
    rows = [("s1", "r1", "c1", 1.0), ("s1", "r2", "c2", 2.0), ("s2", "r1", "c1", 3.0)]
    df = spark.createDataFrame(rows, "scene_id string, region_id string, cell_res8 string, v double")
    path = str(tmp_path / "cells")
    RF.write_region_features(df, path, resolution=8)
    RF.write_region_features(df.filter("scene_id = 's1' and cell_res8 = 'c1'").withColumn("v", F.lit(9.0)), path, resolution=8)
    back = spark.read.parquet(path).select("scene_id", "cell_res8", "v").collect()
    assert {tuple(r) for r in back} == {("s1", "c1", 9.0), ("s2", "c1", 3.0)}


def test_repeated_region_ids_are_an_error_in_every_form(spark):
    line = "array(named_struct('x0', 0d, 'y0', 0d, 'x1', 1d, 'y1', 1d))"
    regions = spark.range(2).selectExpr("'A' AS region_id", "'corridor' AS region_kind", f"{line} AS edges")
    for build in (RF.region_statistics_long, RF.build_region_features):
        with pytest.raises(ValueError, match="Duplicate region ids"):
            build(spark.range(1), regions)
    with pytest.raises(ValueError, match="Duplicate region ids"):
        RF.build_region_features(spark.range(1), regions, geometry=False)


def test_bad_names_give_null_or_an_error(spark):
    good = "LC09_L2SP_012022_20210305_20210309_02_T1"
    df = spark.createDataFrame([(good, "B4"), (good, "XX"), (None, "B4")], "scene string, band string")
    paths = [r[0] for r in df.select(scene_ids.local_band_path("data/raw", "scene", "band")).collect()]
    assert paths == [f"data/raw/{good}/{good}_SR_B4.TIF", None, None]
    keys = [r[0] for r in df.select(scene_ids.band_key("scene", "band")).collect()]
    assert keys[0].endswith(f"2021/012/022/{good}/{good}_SR_B4.TIF") and keys[1:] == [None, None]
    for strict in (scene_ids.band_key("scene", "band", strict=True), scene_ids.local_band_path("r", "scene", "band", strict=True)):
        with pytest.raises(Exception, match="Invalid band XX"):
            df.filter("band = 'XX'").select(strict).collect()
    with pytest.raises(Exception, match="Invalid scene ID"):
        df.filter("scene is null").select(scene_ids.metadata_key("scene", strict=True)).collect()


def test_type_suffixes_are_no_numbers(spark):
    texts = ["5d", "5f", " 5.5 ", "1e3", "-.5", "5.", "x", "", None, "NaN"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(metadata.as_float(F.col("t"))).collect()]
    assert got[:9] == [None, None, 5.5, 1000.0, -0.5, 5.0, None, None, None] and got[9] != got[9]


def test_few_files_for_each_key(spark, tmp_path):
    df = spark.range(2000).selectExpr("concat('c', id % 20) AS cell", "concat('s', id % 7) AS scene_id", "id AS v").repartition(40)
    path = features.write_features(df, str(tmp_path / "out"), "cell")
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * 20 and spark.read.parquet(path).count() == 2000
    again = features.replace_partitions(df, str(tmp_path / "scenes"), "scene_id", ["cell"])
    files = [f for _, _, names in os.walk(again) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * 7 and spark.read.parquet(again).count() == 2000


def test_scenes_left_out_are_named(spark):
    good = ["LC09_L2SP_012022_20210305_20210309_02_T1", "LC09_L2SP_012021_20210305_20210309_02_T1", "LC09_L2SP_012023_20210305_20210309_02_T1"]
    scenes = spark.createDataFrame([(s,) for s in [*good, "nonsense", None]], "scene_id string")
    metadata = spark.createDataFrame([(good[0],), (good[2],)], "scene_id string")
    required = list(catalog.REQUIRED_ITEM_BANDS)
    bands = spark.createDataFrame([(s, b) for s in good for b in required if (s, b) != (good[2], required[0])], "scene_id string, band string")
    got = {r["scene_id"]: (r["reason"], r["missing"]) for r in catalog.rejected_scenes(scenes, metadata, bands).collect()}
    assert got[good[1]] == ("no metadata", []) and got[good[2]] == ("missing bands", [required[0]])
    assert got["nonsense"][0] == got[None][0] == "invalid id" and good[0] not in got
    with pytest.raises(ValueError, match="Scenes without an item"):
        catalog.require_complete(scenes, metadata, bands)
