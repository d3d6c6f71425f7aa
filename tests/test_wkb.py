"""Geometry as bytes, against bytes written by hand."""

from __future__ import annotations

import json
import struct

import pytest
from pyspark.sql import functions as F

from terrafold.functions import wkb
from terrafold.operators import cells as C
from terrafold.sources import features as T

GEOMETRIES = {
    "Point": ([1.0, -2.0], "0000000001" "3FF0000000000000" "C000000000000000", [[[1.0, -2.0]]]),
    "LineString": (
        [[0.0, 0.5], [100.0, -0.0]],
        "0000000002" "00000002" "0000000000000000" "3FE0000000000000" "4059000000000000" "8000000000000000",
        [[[0.0, 0.5], [100.0, -0.0]]],
    ),
    "Polygon": (
        [[[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]], [[2.0, 2.0]]],
        "0000000003" "00000002" "00000003" + "0" * 32 + "3FF0000000000000" + "0" * 48 + "00000001" + "4000000000000000" * 2,
        [[[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]], [[2.0, 2.0]]],
    ),
    "MultiPoint": ([[1.0, 1.0], [2.0, 2.0]], "0000000004" "00000002" + "0000000001" + "3FF0000000000000" * 2 + "0000000001" + "4000000000000000" * 2, [[[1.0, 1.0]], [[2.0, 2.0]]]),
    "MultiLineString": ([[[1.0, 1.0]], []], "0000000005" "00000002" "0000000002" "00000001" + "3FF0000000000000" * 2 + "0000000002" "00000000", [[[1.0, 1.0]], []]),
    "MultiPolygon": (
        [[[[1.0, 1.0]]], [[[2.0, 2.0]], [[1.0, 2.0]]]],
        "0000000006" "00000002" "0000000003" "00000001" "00000001" + "3FF0000000000000" * 2
        + "0000000003" "00000002" "00000001" + "4000000000000000" * 2 + "00000001" "3FF0000000000000" "4000000000000000",
        [[[1.0, 1.0]], [[2.0, 2.0]], [[1.0, 2.0]]],
    ),
}


def test_every_geometry_type(spark):
    rows = [(k, json.dumps(c)) for k, (c, _, _) in GEOMETRIES.items()] + [("Circle", "[]"), (None, None)]
    df = spark.createDataFrame(rows, "kind string, coordinates string").withColumn("wkb", wkb.geojson_wkb(F.col("kind"), F.col("coordinates")))
    got = {r["kind"]: (r["hex"], r["shape"]) for r in df.select("kind", F.hex("wkb").alias("hex"), wkb.wkb_shape("wkb").alias("shape")).collect()}
    assert got["Circle"][0] is None and got[None][0] is None
    for kind, (_, digits, paths) in GEOMETRIES.items():
        assert got[kind][0] == digits
        assert (got[kind][1]["type"], got[kind][1]["paths"]) == (kind, paths)


def test_the_other_byte_order_and_damage():
    line = b"\1" + struct.pack("<II4d", 2, 2, 1.5, 2.5, -3.0, 4.0)
    mixed = b"\0" + struct.pack(">II", 5, 1) + line
    assert wkb.read_one(line) == ("LineString", [[[1.5, 2.5], [-3.0, 4.0]]])
    assert wkb.read_one(mixed) == ("MultiLineString", [[[1.5, 2.5], [-3.0, 4.0]]])
    for bad, why in ((line + b"x", "bytes after"), (line[:-1], "cut short"), (b"\2" + line[1:], "not a two-dimensional"), (b"\1" + struct.pack("<I", 1001), "not a two-dim")):
        with pytest.raises(ValueError, match=why):
            wkb.read_one(bad)


def test_rings_as_polygons(spark):
    ring = [[0.0, 0.0], [2.0, 0.0], [2.0, 1.0], [0.0, 0.0]]
    df = spark.createDataFrame([("a", ring), ("b", None)], "cell string, geometry array<array<double>>")
    out = T.with_wkb(df).select("cell", wkb.wkb_shape("geometry").alias("s")).collect()
    assert {r["cell"]: None if r["s"]["type"] is None else (r["s"]["type"], r["s"]["paths"]) for r in out} == {"a": ("Polygon", [ring]), "b": None}


def test_grids_of_scenes(spark):
    """Squares of two scenes with corners and pixel sizes of their own, by hand."""
    blocks = spark.createDataFrame(
        [("a", 1000.0 + 30.0 * 64, 5000.0, 30.0, 0, 64), ("a", 1000.0, 5000.0 - 30.0 * 64, 30.0, 64, 0), ("b", 70.0, 900.0, 60.0, 0, 0)],
        "scene_id string, x0 double, y0 double, pixel_size double, first_row long, first_col long",
    )
    grids = C.scene_grids(blocks)
    assert {tuple(r) for r in grids.collect()} == {("a", 1000.0, 5000.0, 30.0), ("b", 70.0, 900.0, 60.0)}
    pixels = spark.createDataFrame([("a", 9, 4, 1, 30.0), ("b", 9, 4, 1, 60.0), ("b", 0, 0, 0, 60.0)], "scene_id string, row_no long, col_no long, dn int, size double")
    foot = C.valid_footprint(pixels, ["scene_id"], F.col("size"))
    squares = C.footprint_squares(foot.join(grids, "scene_id"), F.col("x0"), F.col("y0"), F.col("pixel_size")).collect()
    middle = {r["scene_id"]: (r["x"], r["y"]) for r in squares if (r["coarse_row"], r["coarse_col"]) == {"a": (2, 1), "b": (4, 2)}[r["scene_id"]]}
    assert middle == {"a": (1000.0 + 1.5 * 120.0, 5000.0 - 2.5 * 120.0), "b": (70.0 + 2.5 * 120.0, 900.0 - 4.5 * 120.0)}
    assert len(squares) == 18
