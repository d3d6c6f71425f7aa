from __future__ import annotations

import json
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.operators import bands, catalog, regions, summaries
from terrafold.plans import hex_features, region_features, scene_catalog
from terrafold.sources import documents, features, geojson, geotiff, listing
from terrafold.sources.shared import fresh_path, shared_folder
from terrafold.streaming.incremental import ingest_scenes

SCENE = "LC09_L2SP_012022_20210305_20210309_02_T1"


def assemble(raw: bytes, band: int = 1) -> np.ndarray:
    blocks = list(geotiff.decode_blocks(raw, band))
    height = max(b["first_row"] + b["height"] for b in blocks)
    width = max(b["first_col"] + b["width"] for b in blocks)
    out = np.full((height, width), np.nan)
    for b in blocks:
        out[b["first_row"] : b["first_row"] + b["height"], b["first_col"] : b["first_col"] + b["width"]] = (
            b["data"].reshape(b["height"], b["width"])
        )
    return out


@pytest.mark.parametrize("dtype", ["uint8", "uint16", "int16", "float32", "float64"])
@pytest.mark.parametrize("tile", [None, 16])
def test_raster_bytes_round_trip(dtype, tile):
    values = (np.arange(37 * 50).reshape(37, 50) * 7 % 251).astype(dtype)
    raw = geotiff.encode_geotiff(values, 600000.0, 4500000.0, 30.0, 32610, nodata=-9999.0, tile=tile)
    assert np.array_equal(assemble(raw), values.astype(float))
    first = next(geotiff.decode_blocks(raw))
    assert (first["x0"], first["y0"], first["pixel_size"], first["epsg"], first["nodata"]) == (
        600000.0, 4500000.0, 30.0, 32610, -9999.0
    )


def test_horizontal_differencing():
    values = np.random.default_rng(1).integers(0, 65535, (20, 33)).astype("uint16")
    for tile in (None, 16):
        raw = geotiff.encode_geotiff(values, 0.0, 0.0, 30.0, 32610, tile=tile, predictor=2)
        assert np.array_equal(assemble(raw), values.astype(float))


def test_several_bands_in_one_file():
    """Hand-built uncompressed big-endian files, pixel-interleaved and band by band."""
    values = np.arange(2 * 3 * 4, dtype=">u2").reshape(2, 3, 4)
    for planar in (1, 2):
        data = values.tobytes() if planar == 2 else np.moveaxis(values, 0, 2).tobytes()
        tags = [(256, 3, 1, 4), (257, 3, 1, 3), (258, 3, 1, 16), (277, 3, 1, 2), (284, 3, 1, planar)]
        if planar == 1:
            tags += [(273, 4, 1, 8), (278, 3, 1, 3), (279, 4, 1, len(data))]
            extra = b""
        else:
            at = 8 + len(data)
            tags += [(273, 4, 2, at), (278, 3, 1, 3), (279, 4, 2, at + 8)]
            extra = struct.pack(">IIII", 8, 8 + len(data) // 2, len(data) // 2, len(data) // 2)
        body = struct.pack(">H", len(tags))
        for tag, kind, count, value in sorted(tags):
            shown = struct.pack(">HH", value, 0) if kind == 3 else struct.pack(">I", value)
            body += struct.pack(">HHI", tag, kind, count) + shown
        raw = struct.pack(">2sHI", b"MM", 42, 8 + len(data) + len(extra)) + data + extra + body + struct.pack(">I", 0)
        for band in (1, 2):
            assert np.array_equal(assemble(raw, band), values[band - 1].astype(float))
        with pytest.raises(ValueError):
            next(geotiff.decode_blocks(raw, 3))


def test_not_a_raster():
    with pytest.raises(ValueError, match="not a baseline TIFF"):
        next(geotiff.decode_blocks(b"PK\x03\x04 something else"))


def write_scene(root, scene=SCENE, only=("B3", "B4", "B5", "B7"), size=32):
    os.makedirs(f"{root}/{scene}", exist_ok=True)
    for band, value in {"B3": 0.3, "B4": 0.1, "B5": 0.5, "B7": 0.2}.items():
        if band in only:
            dn = max(1, round((value + 0.2) / 0.0000275))
            raw = geotiff.encode_geotiff(
                np.full((size, size), dn, dtype="uint16"), 600000.0, 4500000.0, 30.0, 32610, tile=16
            )
            with open(f"{root}/{scene}/{scene}_SR_{band}.TIF", "wb") as f:
                f.write(raw)


def test_band_files_to_hexagon_features(spark, tmp_path):
    root = str(tmp_path / "cog")
    write_scene(root)
    pixels = hex_features.pixels_from_blocks(geotiff.read_scene_bands(spark, root))
    assert pixels.count() == 32 * 32
    out = hex_features.build_hex_features(pixels, (-122.0, 40.0, -121.0, 41.0), 32610)
    rows = out.collect()
    assert rows and {r["scene_id"] for r in rows} == {SCENE}
    assert {r["acquisition_date"] for r in rows} == {"20210305"}
    for r in rows:
        assert r["ndvi_mean"] == pytest.approx(0.66667, abs=1e-3)
        assert r["nbr_mean"] == pytest.approx(0.42857, abs=1e-3)
        assert r["ndwi_mean"] == pytest.approx(-0.25, abs=1e-3)
        assert r["ndvi_std"] == pytest.approx(0.0, abs=1e-9) and r["pixel_count"] > 0
    # Only tiles near the study area are unpacked; the features are the same.
    box = (-121.817, 40.641, -121.813, 40.645)
    near = geotiff.read_scene_bands(spark, root, boxes=hex_features.study_boxes(box))
    whole = geotiff.read_scene_bands(spark, root)
    assert 0 < near.count() <= whole.count()
    some = hex_features.build_hex_features(hex_features.pixels_from_blocks(near), box)
    every = hex_features.build_hex_features(hex_features.pixels_from_blocks(whole), box)
    assert sorted(map(str, some.collect())) == sorted(map(str, every.collect())) != []
    assert geotiff.read_scene_bands(spark, root, boxes=hex_features.study_boxes((10.0, 40.0, 11.0, 41.0))).count() == 0
    # Elsewhere nothing is found.
    assert hex_features.build_hex_features(pixels, (-120.0, 39.0, -119.9, 39.1), 32610).count() == 0
    # Block-wise and pixel-wise alignment agree.
    loose = bands.blocks_to_pixels(geotiff.read_scene_bands(spark, root), extra=["epsg"])
    keys = ["scene_id", "row_no", "col_no", "x", "y", "epsg"]
    wide = bands.align_bands(loose, keys).select(*pixels.columns)
    assert wide.exceptAll(pixels).count() == 0 and wide.count() == pixels.count()


def test_listings(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_scene(root)
    os.makedirs(f"{root}/empty_scene")
    assert [r["scene_id"] for r in listing.scene_listing(spark, root).collect()] == [SCENE]
    assert listing.scene_listing(spark, str(tmp_path / "nowhere")).count() == 0
    found = listing.band_listing(spark, root).orderBy("band").collect()
    assert [r["band"] for r in found] == ["B3", "B4", "B5", "B7"] and found[0]["path"].startswith("/")
    with pytest.raises(ValueError, match="not found"):
        listing.raster_manifest(spark, str(tmp_path / "nowhere"))
    with pytest.raises(ValueError, match="No index rasters"):
        listing.raster_manifest(spark, root)


def test_manifest_join(spark, tmp_path):
    root = tmp_path / "indices"
    for scene, name in (("s2", "ndvi"), ("s1", "nbr"), ("s1", "ndvi")):
        os.makedirs(root / scene, exist_ok=True)
        raw = geotiff.encode_geotiff(np.full((4, 4), 0.5, "float32"), 0.0, 120.0, 30.0, 32610, nodata=-9999.0)
        (root / scene / f"{name}.tif").write_bytes(raw)
    manifest = listing.raster_manifest(spark, str(root))
    assert [(r["scene_id"], r["index_name"]) for r in manifest.collect()] == [("s1", "nbr"), ("s1", "ndvi"), ("s2", "ndvi")]
    wanted = manifest.filter("scene_id = 's1'")
    blocks = geotiff.read_manifest_blocks(spark, wanted).collect()
    assert {(b["scene_id"], b["index_name"]) for b in blocks} == {("s1", "nbr"), ("s1", "ndvi")}
    assert all(b["data"] == [0.5] * 16 for b in blocks)


LINE = {"type": "LineString", "coordinates": [[-121.82, 40.6], [-121.80, 40.61]]}
SQUARE = [[-121.9, 39.6], [-121.6, 39.6], [-121.6, 39.8], [-121.9, 39.8], [-121.9, 39.6]]


def collection(*pairs):
    return {
        "type": "FeatureCollection",
        "features": [{"type": "Feature", "geometry": g, "properties": p} for g, p in pairs],
    }


def test_geojson_files(spark, tmp_path):
    path = tmp_path / "lines.geojson"
    path.write_text(json.dumps(collection((LINE, {"OBJECTID": 7, "TLine Name": "A"}), (LINE, {"TLine Name": "B"})), indent=1))
    shaped = regions.corridor_regions(geojson.read_features(spark, str(path)), 100.0, 32610)
    rows = shaped.collect()
    assert rows[0]["region_id"] == "7" and rows[0]["epsg"] == 32610 and rows[0]["buffer_m"] == 100.0
    # Without an id the shape names the region, the same way every time.
    assert rows[1]["region_id"] == shaped.collect()[1]["region_id"] != "7"
    near = regions.corridor_regions(geojson.read_features(spark, str(path)), 100.0, 32610, bbox_wgs84=(-121.81, 40.0, -121.7, 41.0))
    assert near.count() == 2
    far = regions.corridor_regions(geojson.read_features(spark, str(path)), 100.0, 32610, bbox_wgs84=(-120.0, 40.0, -119.0, 41.0))
    assert far.count() == 0

    lines = tmp_path / "many.geojsonl"
    lines.write_text("\n".join(json.dumps(f) for f in collection((LINE, {"OBJECTID": 1}), (LINE, {"OBJECTID": 2}))["features"]))
    assert geojson.read_features(spark, str(lines), one_document_per_line=True).count() == 2

    bad = tmp_path / "bad.geojson"
    bad.write_text('{"type": "Topology"}')
    with pytest.raises(Exception, match="no features or geometry"):
        geojson.read_features(spark, str(bad)).collect()


@pytest.mark.parametrize(
    "geometry, n_edges, areal",
    [
        ({"type": "Point", "coordinates": [1, 2]}, 1, False),
        ({"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]}, 2, False),
        ({"type": "LineString", "coordinates": [[0, 0], [1, 1], [2, 0]]}, 2, False),
        ({"type": "MultiLineString", "coordinates": [[[0, 0], [1, 1]], [[2, 2], [3, 3], [4, 4]]]}, 3, False),
        ({"type": "Polygon", "coordinates": [SQUARE]}, 4, True),
        ({"type": "MultiPolygon", "coordinates": [[SQUARE], [SQUARE]]}, 8, True),
    ],
)
def test_every_geometry_type(spark, geometry, n_edges, areal):
    docs = spark.createDataFrame([(json.dumps(collection((geometry, {"h3_index": "c"}))),)], "document string")
    row = regions.polygon_regions(geojson.parse_features(docs), 8).first()
    assert (len(row["edges"]), row["areal"], row["region_id"], row["cell_res8"]) == (n_edges, areal, "c", "c")


def test_box_inside_polygon_and_polygon_around_nothing(spark):
    docs = spark.createDataFrame([(json.dumps(collection(({"type": "Polygon", "coordinates": [SQUARE]}, {}))),)], "document string")
    feats = geojson.parse_features(docs)
    assert regions.features_in_bbox(feats, (-121.8, 39.65, -121.7, 39.7)).count() == 1
    assert regions.features_in_bbox(feats, (-121.5, 39.65, -121.4, 39.7)).count() == 0
    shaped = regions.polygon_regions(feats, 8)
    box = [F.lit(v) for v in (-121.8, 39.65, -121.7, 39.7)]
    assert regions.regions_in_box(shaped, *box).count() == 1


def test_metadata_and_catalog_files(spark, tmp_path):
    mtl = {
        "LANDSAT_METADATA_FILE": {
            "IMAGE_ATTRIBUTES": {"CLOUD_COVER_LAND": "4.12", "DATE_ACQUIRED": "2024-07-15", "SCENE_CENTER_TIME": "18:45:23.1Z"},
            "PROJECTION_ATTRIBUTES": {"UTM_ZONE": "10", "REFLECTIVE_LINES": "32", "REFLECTIVE_SAMPLES": "32"},
        }
    }
    raw = tmp_path / "raw" / SCENE
    raw.mkdir(parents=True)
    (raw / f"{SCENE}_MTL.json").write_text(json.dumps(mtl, indent=2))
    parsed = documents.read_metadata(spark, str(tmp_path / "raw"))
    row = parsed.first()
    assert (row["scene_id"], row["cloud_cover"], row["proj_shape"]) == (SCENE, 4.12, [32, 32])

    scenes = parsed.select("scene_id")
    files = spark.createDataFrame([(SCENE, b, f"/cog/{b}.TIF") for b in ("B4", "B5", "B4")], "scene_id string, band string, path string")
    box = spark.createDataFrame([(SCENE, -122.0, 40.0, -121.0, 41.0)], "scene_id string, west double, south double, east double, north double")
    items, coll = scene_catalog.build_catalog(
        scenes, parsed, files, box, collection_id="c", title="t", description="d",
        providers=[{"name": "n", "roles": ["host"], "url": "u"}],
    )
    path = scene_catalog.write_catalog(items, coll, "c", str(tmp_path / "catalog"))
    read = documents.read_items(spark, f"{path}/items", one_document_per_line=True)
    assert [r["band"] for r in catalog.band_assets(read).orderBy("band").collect()] == ["B4", "B5"]
    item = json.loads(spark.read.text(f"{path}/items").first()[0])
    assert item["id"] == SCENE and item["properties"]["datetime"] == "2024-07-15T18:45:23Z"
    assert item["geometry"]["coordinates"][0][0] == item["geometry"]["coordinates"][0][-1]
    assert item["assets"]["B4"]["href"].startswith("s3://usgs-landsat/collection02/level-2/standard/oli-tirs/2021/012/022/")
    assert [b["name"] for b in item["properties"]["eo:bands"]] == ["red", "nir08"]
    doc = json.loads(spark.read.text(f"{path}/collection").first()[0])
    assert doc["extent"]["spatial"]["bbox"] == [[-122.0, 40.0, -121.0, 41.0]]
    assert doc["extent"]["temporal"]["interval"] == [["2024-07-15T18:45:23Z", "2024-07-15T18:45:23Z"]]

    lacking = catalog.build_items(scenes, parsed, files.filter("band = 'B4'"), box, keep_incomplete=True)
    assert catalog.items_with_missing_bands(lacking).first()["missing"] == ["B5"]
    assert catalog.build_items(scenes, parsed, files.filter("band = 'B4'"), box).count() == 0


def test_feature_table_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("hx8_0_1", "hx8_0_1", 0.5, "s1"), ("hx8_0_2", "hx8_0_2", 0.25, "s1")], "cell string, cell_res8 string, v double, scene_id string")
    path = features.write_features(df, str(tmp_path / "out"), "cell_res8")
    assert sorted(d for d in os.listdir(path) if d.startswith("cell_res8=")) == ["cell_res8=hx8_0_1", "cell_res8=hx8_0_2"]
    back = features.read_features(spark, path, df.schema, "cell_res8")
    assert back.exceptAll(df).count() == 0 and back.count() == 2
    # A later write replaces the whole tree; an empty one leaves an empty table.
    features.write_features(df.limit(1), path, "cell_res8")
    assert features.read_features(spark, path, df.schema, "cell_res8").count() == 1
    features.write_features(df.limit(0), path, "cell_res8")
    assert os.path.isdir(path) and features.read_features(spark, path, df.schema, "cell_res8").count() == 0
    assert features.read_features(spark, str(tmp_path / "absent"), df.schema, "cell_res8").count() == 0
    coarse = features.with_coarse_key(df, 5).collect()
    assert {r["cell_res5"] for r in coarse} == {"hx5_0_0"}


def test_index_table(spark, tmp_path):
    df = spark.createDataFrame([("s1", 1.0, 2.0, 0.5, None, 0.1)], "scene_id string, x double, y double, ndvi double, nbr double, ndwi double")
    path = features.write_indices(bands.encoded_indices(df), str(tmp_path / "idx"))
    row = spark.read.parquet(path).first()
    assert (row["ndvi"], row["nbr"], row["scene_id"]) == (0.5, -9999.0, "s1")


def test_summary_of_nothing(spark):
    row = summaries.feature_summary(spark.createDataFrame([], "scene_id string")).first()
    assert (row["n_rows"], row["n_scenes"]) == (0, 0)


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0] * 40 + [7.0], [float(i * i % 97) for i in range(1000)]])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(3)
    row = summaries.describe(df, ["v"]).first()
    assert row["n"] == len(values) and row["max"] == max(values)
    assert [row["q25"], row["q50"], row["q75"]] == pytest.approx(list(np.percentile(values, [25, 50, 75])))


@pytest.mark.parametrize("most", [3, 300, 100_000])
def test_quantiles_by_narrowing(spark, most):
    """Intervals are narrowed until few distinct values are left; every rank is exact."""
    draw = np.random.default_rng(7)
    columns = {"a": draw.normal(size=3000), "b": np.repeat(draw.integers(0, 50, 40), 30).astype(float), "c": np.array([5.0]), "d": np.exp(draw.normal(size=2000) * 9)}
    pairs = spark.createDataFrame([(k, float(v)) for k, values in columns.items() for v in values] + [("e", None)], "column_name string, value double").repartition(4)
    probabilities = (0.0, 0.013, 0.25, 0.5, 0.999, 1.0)
    rows = {r["column_name"]: list(r)[1:] for r in summaries.exact_quantiles(pairs, probabilities, most).collect()}
    assert set(rows) == set(columns)
    for k, values in columns.items():
        assert rows[k] == pytest.approx(np.quantile(values, probabilities).tolist(), rel=1e-12)
    assert summaries.exact_quantiles(pairs.filter("column_name = 'e'"), probabilities).count() == 0


def test_shared_folder_is_the_named_one(spark):
    assert fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_ingest_adds_only_what_is_new(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = spark.createDataFrame([("a", 1)], "scene_id string, v bigint").schema
    seen = []

    def build(rows):
        seen.append(sorted(r[0] for r in rows.select("scene_id").distinct().collect()))
        return rows.groupBy("scene_id").agg(F.sum("v").alias("v"))

    def drop(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)
        ingest_scenes(spark, source, schema, build, target, progress)

    drop(("a", 1), ("b", 5))
    drop(("a", 2))
    assert seen[-1] == ["a"]
    assert {(r["scene_id"], r["v"]) for r in spark.read.parquet(target).collect()} == {("a", 3), ("b", 5)}
    n = len(seen)
    ingest_scenes(spark, source, schema, build, target, progress)
    assert len(seen) == n
    ingest_scenes(spark, source, schema, build, target, str(tmp_path / "again"), max_files_per_trigger=1)
    assert {(r["scene_id"], r["v"]) for r in spark.read.parquet(target).collect()} == {("a", 3), ("b", 5)}


def plan_files(df):
    return {f.rsplit("/", 2)[1] for f in df.inputFiles()}


def test_ingest_reads_only_touched_scenes(spark, tmp_path):
    """A directory for each scene: a batch lists those it touches; scenes that become empty go."""
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = spark.createDataFrame([("a", 1)], "scene_id string, v bigint").schema
    seen = []

    def build(rows):
        seen.append(plan_files(rows))
        return rows.filter("v > 0").groupBy("scene_id").agg(F.sum("v").alias("v"))

    def drop(mode, *rows):
        df = spark.createDataFrame(list(rows), schema).coalesce(1)
        df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("scene_id").parquet(source)
        ingest_scenes(spark, source, schema, build, target, progress, partitioned=True)
        table = features.read_features(spark, target, schema, "scene_id")
        return {(r["scene_id"], r["v"]) for r in table.collect()}

    assert drop("append", ("a", 1), ("b=c [dé]%", 5), ("c", 7)) == {("a", 1), ("b=c [dé]%", 5), ("c", 7)}
    assert drop("append", ("a", 2)) == {("a", 3), ("b=c [dé]%", 5), ("c", 7)}
    assert seen[-1] == {"scene_id=a"}
    assert drop("overwrite", ("c", 0)) == {("a", 3), ("b=c [dé]%", 5)}
    assert seen[-1] == {"scene_id=c"}
    assert drop("append", ("b=c [dé]%", 1), ("c", 4)) == {("a", 3), ("b=c [dé]%", 6), ("c", 4)}
    # Emptied and filled again in other ways: a repeated run, scenes that never had a row.
    for _ in range(2):
        features.replace_partitions(spark.createDataFrame([], schema), target, "scene_id", touched=spark.createDataFrame([("a",), ("z",)], "scene_id string"))
    table = features.read_features(spark, target, schema, "scene_id")
    assert {(r["scene_id"], r["v"]) for r in table.collect()} == {("b=c [dé]%", 6), ("c", 4)}


def test_region_features_of_scenes_that_become_empty(spark, tmp_path):
    rows = [("s1", "r1", "c1", 1.0), ("s1", "r2", "c2", 2.0), ("s2", "r1", "c1", 3.0)]
    df = spark.createDataFrame(rows, "scene_id string, region_id string, cell_res8 string, v double")
    path, scenes = str(tmp_path / "cells"), spark.createDataFrame([("s1",), ("s2",), (None,)], "scene_id string")
    region_features.write_region_features(df, path, 8, scenes)
    region_features.write_region_features(df.filter("scene_id = 's2'"), path, 8, scenes)
    back = features.read_features(spark, path, df.schema, "scene_id")
    assert [tuple(r) for r in back.select("scene_id", "region_id", "v").collect()] == [("s2", "r1", 3.0)]
