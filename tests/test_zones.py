"""Several UTM zones in one table, and bands that are stored unlike."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.functions import hexgrid, projection
from terrafold.operators import bands as B
from terrafold.operators import cells as C
from terrafold.operators import regions as R
from terrafold.plans import hex_features as H
from terrafold.plans import region_features as RF
from terrafold.sources import features as T

NAME = "LC09_L2SP_012022_20210305_20210309_02_T1"


def test_projection_by_column(spark):
    rows = [(lon, lat, code) for code in (32610, 32611, 32710, 32760, 32601) for lon, lat in ((-123.7, 40.5), (-120.0, -3.25))]
    rows = [(projection.central_meridian(c) + lon + 122.0, lat, c) for lon, lat, c in rows]
    df = spark.createDataFrame(rows, "lon double, lat double, epsg int")
    grid = projection.project_columns(df, "lon", "lat", F.col("epsg"))
    back = projection.unproject_columns(grid, "x", "y", F.col("epsg"), "lon2", "lat2")
    for r in back.collect():
        assert (r["x"], r["y"]) == pytest.approx(projection.project_point(r["lon"], r["lat"], r["epsg"]), abs=1e-6)
        assert (r["lon2"], r["lat2"]) == pytest.approx((r["lon"], r["lat"]), abs=1e-9)
    bad = spark.createDataFrame([(1.0, 2.0, 4326)], "x double, y double, epsg int")
    with pytest.raises(Exception, match="EPSG:4326 is not a WGS84 / UTM code"):
        projection.unproject_columns(bad, "x", "y", F.col("epsg")).collect()


def test_cell_ids_with_and_without_a_zone(spark):
    df = spark.createDataFrame([(3, -4, 32610), (3, -4, 32733), (5, 6, None)], "q long, r long, epsg int")
    ids = df.select(hexgrid.cell_id(F.col("q"), F.col("r"), 8, F.col("epsg")).alias("cell"))
    rows = ids.select("cell", *hexgrid.parse_cell_id(F.col("cell")), hexgrid.cell_epsg(F.col("cell"))).collect()
    assert [tuple(r) for r in rows] == [("hx8_10n_3_-4", 8, 3, -4, 32610), ("hx8_33s_3_-4", 8, 3, -4, 32733), ("hx8_5_6", 8, 5, 6, None)]
    coarse = T.with_coarse_key(ids, 5).collect()
    assert [r["cell_res5"].rsplit("_", 2)[0] for r in coarse] == ["hx5_10n", "hx5_33s", "hx5"]


def pixels_at(spark, points, value=20000):
    """Pixels around (lon, lat, epsg) in the system of each."""
    rows = []
    for i, (lon, lat, code) in enumerate(points):
        x, y = projection.project_point(lon, lat, code)
        rows += [(f"LC09_L2SP_01202{i}_20210305_20210309_02_T1", code, x + 30 * a, y + 30 * b, value, value + i, value * 2, value + 7) for a in range(3) for b in range(3)]
    return spark.createDataFrame(rows, "scene_id string, epsg int, x double, y double, b3 int, b4 int, b5 int, b7 int")


def test_each_scene_in_its_own_zone(spark):
    """One place seen from both zones gives cells of both whose centres are there."""
    pixels = pixels_at(spark, [(-120.0, 40.5, 32610), (-120.0, 40.5, 32611), (-120.0, -8.5, 32710), (-117.0, 40.5, 32611)])
    out = H.build_hex_features(pixels, (-120.05, 40.45, -119.95, 40.55)).collect()
    assert {r["epsg"] for r in out} == {32610, 32611} and all(f"_{r['epsg'] % 100}n_" in r["cell"] for r in out)
    shaped = H.with_cell_geometry(spark.createDataFrame(out), None, 8).collect()
    for r in shaped:
        assert all(abs(p[0] + 120.0) < 0.03 and abs(p[1] - 40.5) < 0.02 for p in r["geometry"])
    south = H.build_hex_features(pixels, (-120.05, -8.55, -119.95, -8.45)).collect()
    assert south and {r["epsg"] for r in south} == {32710}


def test_wrong_systems_are_errors(spark):
    pixels = pixels_at(spark, [(-120.0, 40.5, 32610), (-120.0, 40.5, 32611)])
    box = (-120.05, 40.45, -119.95, 40.55)
    with pytest.raises(Exception, match="rows are to be in EPSG:32610, found 32611"):
        H.build_hex_features(pixels, box, 32610).collect()
    with pytest.raises(ValueError, match="no epsg column"):
        H.build_hex_features(pixels.drop("epsg"), box)
    one = H.build_hex_features(pixels.filter("epsg = 32610"), box, 32610)
    assert "epsg" not in one.columns and one.first()["cell"].count("_") == 2
    indices = B.with_indices(pixels, ["scene_id", "epsg", "x", "y"])
    line = "named_struct('type', 'LineString', 'coordinates', '[[-120.01, 40.5], [-119.99, 40.5]]') AS geometry"
    feature = spark.range(1).selectExpr(line, "map('OBJECTID', 'L') AS properties")
    for epsg in (None, 32610):
        with pytest.raises(Exception, match="pixels in EPSG:32611, regions in EPSG:|pixels in EPSG:32610, regions in EPSG:"):
            RF.build_region_features(indices, R.corridor_regions(feature, 50.0, epsg)).collect()
    both = R.corridor_regions(feature, 50.0, [32610, 32611])
    with pytest.raises(ValueError, match="do not say which system"):
        RF.build_region_features(indices.drop("epsg"), both)
    rows = RF.build_region_features(indices, both).collect()
    assert sorted(r["epsg"] for r in rows) == [32610, 32611] and {r["region_id"] for r in rows} == {"L"}
    assert all(r["edges"] for r in rows)


def test_far_zones_have_no_region(spark):
    line = "named_struct('type', 'LineString', 'coordinates', '[[-120.01, 40.5], [-119.99, 40.5]]') AS geometry"
    feature = spark.range(1).selectExpr(line, "map('OBJECTID', 'L') AS properties")
    regions = R.corridor_regions(feature, 50.0, [32610, 32611, 32633])
    assert {r["epsg"] for r in regions.collect()} == {32610, 32611}
    unnamed = R.corridor_regions(feature.withColumn("properties", F.create_map().cast("map<string,string>")), 50.0, [32610, 32611])
    assert len({r["region_id"] for r in unnamed.collect()}) == 1 and unnamed.count() == 2


def test_polyfill_by_column(spark):
    box = (-120.05, 40.45, -119.95, 40.5)
    df = spark.createDataFrame([(*box, 32610), (*box, 32611)], "west double, south double, east double, north double, epsg int")
    got = C.polyfill_wgs84(df, F.col("epsg")).select("epsg", "q", "r").collect()
    for code in (32610, 32611):
        want = C.polyfill_wgs84(df.limit(1).drop("epsg"), code).select("q", "r").collect()
        assert {(r["q"], r["r"]) for r in got if r["epsg"] == code} == {tuple(r) for r in want} != set()


def blocks_of(values, band, rows, cols, x0=600015.0, y0=4500015.0, size=30.0, epsg=32610):
    """A band cut into blocks of so many rows and columns."""
    out = []
    for r in range(0, values.shape[0], rows):
        for c in range(0, values.shape[1], cols):
            part = values[r : r + rows, c : c + cols]
            data = [None if v != v else float(v) for v in part.ravel()]
            out.append((NAME, band, r // rows, c // cols, r, c, x0 + c * size, y0 - r * size, size, part.shape[1], part.shape[0], epsg, data))
    return out


BLOCKS = (
    "scene_id string, band string, block_row long, block_col long, first_row long, first_col long, x0 double, y0 double, "
    "pixel_size double, width int, height int, epsg int, data array<double>"
)


def pixelwise(spark, rows):
    pixels = B.blocks_to_pixels(spark.createDataFrame(rows, BLOCKS), extra=["epsg"]).filter("dn is not null")
    wide = B.align_bands(pixels, ["scene_id", "x", "y", "epsg"])
    return {(r["x"], r["y"], r["epsg"]): (r["b3"], r["b4"], r["b5"], r["b7"]) for r in wide.collect()}


def aligned(spark, rows, tile):
    out = B.align_block_bands(spark.createDataFrame(rows, BLOCKS), tile=tile).collect()
    assert len({(r["row_no"], r["col_no"]) for r in out}) == len(out)
    for r in out:
        assert (r["x"], r["y"]) == (600015.0 + (r["col_no"] + 0.5) * 30.0, 4500015.0 - (r["row_no"] + 0.5) * 30.0)
    return {(r["x"], r["y"], r["epsg"]): (r["b3"], r["b4"], r["b5"], r["b7"]) for r in out}


@pytest.mark.parametrize("layout", [(64, 64, 32, 16), (32, 32, 32, 16), (20, 7, 33, 64)])
@pytest.mark.parametrize("tile", [16, 256])
def test_unlike_tiles_equal_the_join_of_pixels(spark, layout, tile):
    draw = np.random.default_rng(3)
    rows = []
    for i, (band, side) in enumerate(zip(B.REQUIRED_INDEX_BANDS, layout, strict=True)):
        values = draw.integers(1, 60000, (64, 50)).astype(float)
        values[draw.random((64, 50)) < 0.05] = np.nan if i % 2 else 0.0
        # The last band is in strips.
        rows += blocks_of(values, band, side, 50 if i == 3 else side)
    got = aligned(spark, rows, tile)
    assert got == pixelwise(spark, rows) and len(got) > 2500


def test_bands_that_start_whole_pixels_apart(spark):
    """Bands of different extents meet by coordinates; a missing block takes its pixels along."""
    draw = np.random.default_rng(4)
    rows = []
    for i, band in enumerate(B.REQUIRED_INDEX_BANDS):
        values = draw.integers(1, 60000, (40, 40)).astype(float)
        rows += blocks_of(values, band, 16, 16, 600015.0 + 30.0 * 3 * (i == 2), 4500015.0 - 30.0 * 5 * (i == 3))
    del rows[4]
    got = aligned(spark, rows, 32)
    assert got == pixelwise(spark, rows) and 900 < len(got) < 35 * 37


@pytest.mark.parametrize("other", [{"x0": 600000.0}, {"size": 15.0}, {"epsg": 32611}, {"y0": 4500001.0}])
def test_another_grid_is_an_error(spark, other):
    values = np.ones((8, 8))
    rows = [x for b in B.REQUIRED_INDEX_BANDS for x in blocks_of(values, b, 8, 8, **(other if b == "B5" else {}))]
    with pytest.raises(Exception, match="lie on different grids"):
        B.align_block_bands(spark.createDataFrame(rows, BLOCKS)).collect()
