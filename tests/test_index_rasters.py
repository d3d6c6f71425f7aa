"""Rasters written byte by byte here, so no error of our own encoder can cancel out."""

from __future__ import annotations

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.functions import projection
from terrafold.operators import bands as B
from terrafold.operators import regions as R
from terrafold.plans import region_features as RF
from terrafold.sources import geojson, geotiff


def tiff(values, x, y, size=(30.0, 30.0), point=False, nodata=b"-9999\0", empty=False):
    """A little-endian float file of one uncompressed strip."""
    rows, cols = values.shape
    data = b"" if empty else values.astype("<f4").tobytes()
    keys = [1, 1, 0, 2, 1025, 0, 1, 2 if point else 1, 3072, 0, 1, 32610]
    entries = [
        (256, 3, [cols]), (257, 3, [rows]), (258, 3, [32]), (259, 3, [1]), (262, 3, [1]), (273, 4, [8]), (277, 3, [1]),
        (278, 3, [rows]), (279, 4, [len(data)]), (339, 3, [3]), (33550, 12, [*size, 0.0]), (33922, 12, [0.0, 0.0, 0.0, x, y, 0.0]),
        (34735, 3, keys), (42113, 2, nodata),
    ]
    at = 8 + len(data)
    more_at, head, more = at + 2 + 12 * len(entries) + 4, struct.pack("<H", len(entries)), b""
    for tag, kind, v in entries:
        body = v if kind == 2 else struct.pack(f"<{len(v)}{ {3: 'H', 4: 'I', 12: 'd'}[kind]}", *v)
        inline = body.ljust(4, b"\0") if len(body) <= 4 else struct.pack("<I", more_at + len(more))
        more += b"" if len(body) <= 4 else body
        head += struct.pack("<HHI", tag, kind, len(v)) + inline
    return struct.pack("<2sHI", b"II", 42, at) + data + head + struct.pack("<I", 0) + more


VALUES = np.array([[0.1, 0.2, -9999.0], [0.4, float("nan"), 0.6]])


def test_points_and_areas():
    area, point = (next(geotiff.decode_blocks(tiff(VALUES, 600000.0, 4500000.0, point=p))) for p in (False, True))
    assert (area["x0"], area["y0"]) == (600000.0, 4500000.0)
    assert (point["x0"], point["y0"]) == (600000.0 - 15.0, 4500000.0 + 15.0)


def test_unequal_scales_are_rejected():
    with pytest.raises(ValueError, match="not square"):
        next(geotiff.decode_blocks(tiff(VALUES, 0.0, 0.0, size=(30.0, 60.0))))


def test_sparse_strips_hold_nodata():
    assert set(next(geotiff.decode_blocks(tiff(VALUES, 0.0, 0.0, empty=True)))["data"]) == {-9999.0}


def test_index_rasters_to_region_features(spark, tmp_path):
    """Manifest, files, nodata, pixels and statistics; files that are not named stay unread."""
    rows = []
    for name, shift in (("ndvi", 0.0), ("nbr", 1.0)):
        path = tmp_path / "s1" / f"{name}.tif"
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(tiff(np.where(VALUES == -9999.0, VALUES, VALUES + shift), 600000.0, 4500000.0))
        rows.append(("s1", name, str(path)))
    (tmp_path / "s1" / "broken.tif").write_bytes(b"no raster")
    manifest = spark.createDataFrame(rows, "scene_id string, index_name string, path string")
    indices = B.indices_from_blocks(geotiff.read_manifest_blocks(spark, manifest), ["ndvi", "nbr"])
    got = {(r["x"], r["y"]): (round(r["ndvi"], 4), round(r["nbr"], 4)) for r in indices.collect()}
    assert got == {
        (600015.0, 4499985.0): (0.1, 1.1), (600045.0, 4499985.0): (0.2, 1.2),
        (600015.0, 4499955.0): (0.4, 1.4), (600075.0, 4499955.0): (0.6, 1.6),
    }
    assert geotiff.read_manifest_blocks(spark, manifest.limit(0)).count() == 0
    ends = [projection.unproject_point(x, 4499985.0, 32610) for x in (600005.0, 600055.0)]
    line = {"type": "Feature", "properties": {"OBJECTID": 7}, "geometry": {"type": "LineString", "coordinates": ends}}
    (tmp_path / "lines.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [line]}))
    regions = R.corridor_regions(geojson.read_features(spark, str(tmp_path / "lines.geojson")), 5.0, 32610)
    full = indices.withColumn("ndwi", F.lit(None).cast("double"))
    row = RF.build_region_features(full, regions).first()
    inside = {(x, y): v for (x, y), v in got.items() if y == 4499985.0}
    assert round(row["ndvi_max"], 4) == 0.2 and round(row["nbr_mean"], 4) == 1.15 and len(inside) == 2
