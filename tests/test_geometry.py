"""Spatial operators against brute force on small random inputs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.functions import hexgrid
from terrafold.operators import cells, regions, sizing, zonal
from terrafold.plans import region_features

REGION_DDL = (
    "region_id string, region_kind string, areal boolean, buffer_m double, "
    "edges array<struct<x0:double,y0:double,x1:double,y1:double>>, epsg int, "
    "min_x double, min_y double, max_x double, max_y double"
)


def region(name, paths, areal, buffer_m, closed):
    es = []
    for path in paths:
        ring = path + path[:1] if closed else path
        es += [(a[0], a[1], b[0], b[1]) for a, b in zip(ring, ring[1:])]
    xs = [v for e in es for v in (e[0], e[2])]
    ys = [v for e in es for v in (e[1], e[3])]
    return (name, "t", areal, buffer_m, es, 32610, min(xs), min(ys), max(xs), max(ys))


def segment_distance(p, a, b):
    ax, ay, bx, by = *a, *b
    ex, ey = bx - ax, by - ay
    n = ex * ex + ey * ey
    t = 0.0 if n == 0 else max(0.0, min(1.0, ((p[0] - ax) * ex + (p[1] - ay) * ey) / n))
    return math.hypot(p[0] - ax - t * ex, p[1] - ay - t * ey)


def square_edge_distance(x, y, h, e):
    """Distance of a filled square and a segment: zero when the clipped segment is not empty."""
    t0, t1 = 0.0, 1.0
    for p, d, lo, hi in ((e[0], e[2] - e[0], x - h, x + h), (e[1], e[3] - e[1], y - h, y + h)):
        if d == 0:
            if not lo <= p <= hi:
                t0, t1 = 1.0, 0.0
        else:
            a, b = sorted(((lo - p) / d, (hi - p) / d))
            t0, t1 = max(t0, a), min(t1, b)
    if t0 <= t1:
        return 0.0
    corners = [(x + sx, y + sy) for sx in (-h, h) for sy in (-h, h)]
    best = min(segment_distance(c, e[:2], e[2:]) for c in corners)
    for px, py in (e[:2], e[2:]):
        best = min(best, math.hypot(max(abs(px - x) - h, 0), max(abs(py - y) - h, 0)))
    return best


def inside(x, y, es):
    odd = False
    for x0, y0, x1, y1 in es:
        if (y0 > y) != (y1 > y) and x0 + (y - y0) * (x1 - x0) / (y1 - y0) > x:
            odd = not odd
    return odd


def brute(pixels, rows, h, touch):
    out = set()
    for pid, x, y in pixels:
        for r in rows:
            es, buf = r[4], r[3]
            if touch == "all":
                near = any(square_edge_distance(x, y, h, e) <= buf for e in es)
            else:
                near = buf > 0 and any(segment_distance((x, y), e[:2], e[2:]) <= buf for e in es)
            if near or (r[2] and inside(x, y, es)):
                out.add((pid, r[0]))
    return out


@pytest.fixture(scope="module")
def world(spark):
    rnd = random.Random(7)
    u = lambda: rnd.uniform(0, 1500) + 0.123
    pixels = [(i, 15.0 + 30 * (i % 50), 15.0 + 30 * (i // 50)) for i in range(2500)]
    # A third of all pixels share one place.
    pixels += [(3000 + i, 765.0, 765.0) for i in range(1200)]
    box = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    rows = [region(f"line{i}", [[(u(), u()) for _ in range(rnd.randint(2, 6))]], False, rnd.choice([0.0, 37.5, 101.3]), False) for i in range(12)]
    rows += [region(f"multi{i}", [[(u(), u()), (u(), u())], [(u(), u()), (u(), u())]], False, 55.5, False) for i in range(3)]
    rows += [region(f"poly{i}", [[(u(), u()) for _ in range(rnd.randint(3, 6))]], True, rnd.choice([0.0, 20.2]), True) for i in range(6)]
    rows.append(region("hole", [box(101.5, 101.5, 1303.5, 1202.5), box(402.5, 303.5, 903.5, 1001.5)], True, 0.0, True))
    rows.append(region("parts", [box(1.5, 1.5, 300.5, 200.5), box(700.5, 900.5, 1100.5, 1400.5)], True, 0.0, True))
    rows.append(region("speck", [box(610.2, 610.2, 611.3, 611.3)], True, 0.0, True))
    rows.append(region("point", [[(777.7, 333.3), (777.7, 333.3)]], False, 60.6, False))
    df = spark.createDataFrame(pixels, "pid int, x double, y double").repartition(4)
    return pixels, rows, df, spark.createDataFrame(rows, REGION_DDL)


def pairs(df):
    got = [(r["pid"], r["region_id"]) for r in df.select("pid", "region_id").collect()]
    assert len(got) == len(set(got)), "a pair was found twice"
    return set(got)


@pytest.mark.parametrize("touch", ["all", "center"])
@pytest.mark.parametrize("tile_m", [97.0, 240.0, 5000.0])
def test_tile_join_equals_every_pair(world, touch, tile_m):
    pixels, rows, px, regs = world
    joined = regions.pixel_region_join(px, regs, 15.0, tile_m, touch)
    assert pairs(joined) == brute(pixels, rows, 15.0, touch)


def test_shuffled_join_gives_the_same(world):
    """Both sides shuffle once, and columns that cannot be grouped pass through."""
    pixels, rows, px, regs = world
    tagged = px.withColumn("tags", F.create_map(F.lit("a"), F.col("pid")))
    joined = regions.pixel_region_join(tagged, regs, 15.0, max_bytes=0)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoop" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert pairs(joined) == brute(pixels, rows, 15.0, "all")
    assert joined.filter("tags['a'] <> pid").count() == 0


def test_a_heavy_tile_is_split(spark):
    """A third of all rows in one tile: Spark reads its partition in several tasks."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
        big = spark.range(0, 300_000, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        other = spark.range(300_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        out = sizing.tile_join(big, other, ["k"], F.lit(True), max_bytes=0)
        assert out.count() == 300_000
        total = out.agg(F.max("v"), F.sum("w"))
        total.collect()
        assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_stored_edges_grow_linearly(spark):
    """A line of many edges in one tile keeps each once, in one row."""
    sizes = []
    for k in (50, 400):
        points = [(100 + 50 * math.cos(i), 100 + 50 * math.sin(i * 1.7)) for i in range(k + 1)]
        df = spark.createDataFrame([region("coast", [points], False, 5.0, False)], REGION_DDL)
        tiles = regions.tile_regions(df, 15.0, 240.0)
        sizes.append(tiles.agg(F.sum(F.size("edges") + F.col("edge").isNotNull().cast("int"))).first()[0])
        assert tiles.groupBy("tile_x", "tile_y").count().filter("count > 1").count() == 0
    assert sizes[1] <= 9 * sizes[0]


def test_measured_broadcast(spark):
    small = spark.range(10).withColumn("a", F.array(F.lit(1.0), F.lit(2.0)))
    assert sizing.measure(small)[0] == 10
    assert sizing.broadcast_if_bounded(small)[1]
    assert not sizing.broadcast_if_bounded(small, max_rows=9)[1]
    assert not sizing.broadcast_if_bounded(small, max_bytes=100)[1]


def clip_polygon(poly, x0, y0, x1, y1):
    """Area left after cutting a polygon to a box, edge by edge."""
    for axis, bound, keep_less in ((0, x0, False), (0, x1, True), (1, y0, False), (1, y1, True)):
        out = []
        for a, b in zip(poly, poly[1:] + poly[:1]):
            ia = a[axis] <= bound if keep_less else a[axis] >= bound
            ib = b[axis] <= bound if keep_less else b[axis] >= bound
            if ia:
                out.append(a)
            if ia != ib:
                t = (bound - a[axis]) / (b[axis] - a[axis])
                out.append((a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))
        poly = out
        if not poly:
            return False
    return True


@pytest.mark.parametrize("resolution", [8, 11])
def test_touched_cells_equal_polygon_clipping(spark, resolution):
    rnd = np.random.default_rng(3)
    pts = rnd.uniform(-2000, 2000, (300, 2))
    s = hexgrid.edge_m(resolution)
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "pid int, x double, y double")
    got = {(r["pid"], r["q"], r["r"]) for r in cells.assign_cells(df, resolution, "all", 15.0).collect()}
    expected = set()
    for i, (x, y) in enumerate(pts):
        r0 = round(y / (1.5 * s))
        for r in range(r0 - 2, r0 + 3):
            q0 = round(x / (hexgrid.SQRT3 * s) - r / 2)
            for q in range(q0 - 2, q0 + 3):
                cx, cy = s * hexgrid.SQRT3 * (q + r / 2), 1.5 * s * r
                hexagon = [(cx + s * math.cos(math.radians(60 * k - 30)), cy + s * math.sin(math.radians(60 * k - 30))) for k in range(6)]
                if clip_polygon(hexagon, x - 15, y - 15, x + 15, y + 15):
                    expected.add((i, q, r))
    assert got == expected


def test_centre_mode_counts_each_pixel_once(spark):
    df = spark.range(5000).select((F.col("id") * 37.7 % 9000).alias("x"), (F.col("id") * 91.3 % 9000).alias("y"))
    assert cells.assign_cells(df, 8, "center").count() == 5000
    with pytest.raises(ValueError):
        cells.assign_cells(df, 8, "nearest")
    with pytest.raises(ValueError, match="larger than cells"):
        cells.assign_cells(df, 14, "all", 15.0)


def test_uniform_raster(spark):
    """A constant index gives its value as mean and no deviation; zones off the raster vanish."""
    pixels = spark.range(1024).select(
        F.lit("s").alias("scene_id"),
        (F.lit(600015.0) + (F.col("id") % 32) * 30).alias("x"),
        (F.lit(4499985.0) - F.expr("id div 32") * 30).alias("y"),
        F.lit(0.5).alias("ndvi"), F.lit(None).cast("double").alias("nbr"), F.lit(None).cast("double").alias("ndwi"),
    )
    rows = [
        region("1", [[(599500.0, 4499500.0), (601000.0, 4500500.0)]], False, 100.0, False),
        region("far", [[(0.0, 0.0), (10.0, 10.0)]], False, 100.0, False),
    ]
    out = region_features.build_region_features(pixels, spark.createDataFrame(rows, REGION_DDL)).collect()
    assert [r["region_id"] for r in out] == ["1"]
    assert (out[0]["ndvi_mean"], out[0]["ndvi_std"], out[0]["ndvi_max"]) == (0.5, 0.0, 0.5)
    assert out[0]["nbr_mean"] is None and out[0]["pixel_count"] > 0


def test_pivot_leaves_absent_indices_null(spark):
    long_df = spark.createDataFrame(
        [("1", "hex", "s", "ndvi", "c", 0.5, 0.1, 0.9)],
        "region_id string, region_kind string, scene_id string, index_name string, cell_res8 string, mean double, std double, max double",
    )
    row = zonal.pivot_index_stats(long_df, ["mean", "std"]).first()
    assert (row["ndvi_mean"], row["ndvi_max"], row["cell_res8"]) == (0.5, 0.9, "c")
    assert row["nbr_mean"] is None and row["ndwi_max"] is None


def test_unknown_statistic():
    with pytest.raises(ValueError, match="Unknown statistics"):
        zonal.check_stats(["median"])


def test_duplicate_region_ids_are_rejected(world):
    _, _, _, regs = world
    regions.require_unique_ids(regs)
    with pytest.raises(ValueError, match="Duplicate region ids"):
        regions.require_unique_ids(regs.unionByName(regs))
