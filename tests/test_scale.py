"""Steps whose cost must not outgrow their input: files, packing, cutting."""

from __future__ import annotations

import glob
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import tables
from terrafold.functions import edges as E
from terrafold.operators import bands as B
from terrafold.operators import catalog as K
from terrafold.operators import cells as C
from terrafold.operators import regions as R
from terrafold.plans import region_features as RF
from terrafold.sources import documents as D
from terrafold.sources import features as S
from terrafold.sources import geotiff


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tree_has_no_file_for_each_document(spark, tmp_path):
    """Documents share files; their folders and links lead through all of them."""
    link = lambda rel, href: F.struct(F.lit(rel).alias("rel"), href.alias("href"), F.lit("application/json").alias("type"))
    n, place = 60, F.concat(F.lit("items/"), F.col("id").cast("string"))
    items = spark.range(n).select(
        place.alias("folder"), F.struct(F.lit("Feature").alias("type"), F.col("id").cast("string").alias("id"), F.array(link("parent", F.lit("../../catalog"))).alias("links")).alias("document"),
        F.lit("044").alias("wrs_path"),
    )
    children = spark.range(n).select(link("item", F.concat(F.lit("../"), place)).alias("l")).agg(F.collect_list("l").alias("links"))
    root = children.select(F.lit("catalog").alias("folder"), F.struct(F.lit("Catalog").alias("type"), F.lit("scenes").alias("id"), "links").alias("document"))
    path = D.write_tree({"catalog": (root, []), "items": (items, ["wrs_path"])}, str(tmp_path / "tree"))
    assert len(glob.glob(f"{path}/**/part-*", recursive=True)) < 20
    found = K.linked_documents(D.read_tree(spark, path), "catalog", 3)
    assert {(r["folder"], r["depth"]) for r in found.collect()} == {("catalog", 0), *((f"items/{i}", 1) for i in range(n))}


@pytest.mark.parametrize("rows", [7, 10_000])
def test_packing_fills_groups_that_cross_batches(spark, rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        dn = spark.range(4000).selectExpr(
            "CASE WHEN id % 3 = 0 THEN NULL ELSE 's' || (id % 3) END AS scene_id", "'B4' AS band",
            "id * 7 % 50 AS row_no", "id * 11 % 40 AS col_no", "CASE WHEN id % 13 = 0 THEN NULL ELSE CAST(id AS int) END AS dn",
        )
        packed = B.pixels_to_blocks(dn, "dn", 16, fill=-1)
        assert "FlatMapGroupsInPandas" not in plan(packed)
        want: dict = {}
        for r in dn.collect():
            block = want.setdefault((r["scene_id"], r["row_no"] // 16, r["col_no"] // 16), np.full((16, 16), -1))
            at = r["row_no"] % 16, r["col_no"] % 16
            block[at] = max(block[at], -1 if r["dn"] is None else r["dn"])
        got = {(r["scene_id"], r["block_row"], r["block_col"]): np.array(r["data"]).reshape(16, 16) for r in packed.collect()}
        assert got.keys() == want.keys()
        assert all((got[k] == want[k]).all() for k in want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_small_files_are_decoded_together():
    import pandas as pd

    class Files:
        schema = {"scene_id": type("Field", (), {"dataType": type("Text", (), {"simpleString": lambda self: "string"})()})()}
        select = lambda self, *_: self
        mapInPandas = lambda self, run, _: run  # noqa: E731, N815

    contents = [geotiff.encode_geotiff(np.full((4, 4), i, np.uint16), 6e5, 45e5, 30.0, 32610, i or None) for i in range(50)]
    run = geotiff.decode_geotiffs(Files(), ["scene_id"])
    frames = list(run(iter([pd.DataFrame({"scene_id": [str(i) for i in range(50)], "content": contents})])))
    assert len(frames) == 1
    assert [d[0] for d in frames[0]["data"]] == list(range(50))
    assert [v is None for v in frames[0]["nodata"]] == [True] + [False] * 49


def test_unlike_blocks_stay_where_they_are_until_cut(spark):
    """The check of grids moves no block, and a block is read once for all its tiles."""
    blocks = spark.range(2).selectExpr(
        "CAST(id div 2 AS string) AS scene_id", "CASE id WHEN 0 THEN 'B3' ELSE 'B4' END AS band", "0 AS first_row", "0 AS first_col", "30D * id AS x0",
        "0D AS y0", "30D AS pixel_size", "5 AS width", "4 AS height", "32610 AS epsg",
        "transform(sequence(0, 19), i -> CASE WHEN i % 6 = 5 THEN NULL ELSE i * 1D END) AS data",
    )
    checked = B.one_grid_per_scene(blocks)
    assert checked.count() == 2
    assert "SortMergeJoin" not in plan(checked) and "BroadcastHashJoin" in plan(checked)
    pieces = B.cut_blocks(checked, 3)
    assert "Generate" not in plan(pieces)
    for band, shift in (("B3", 0), ("B4", 1)):
        got = {}
        for p in pieces.filter(F.col("band") == band).collect():
            for i, v in enumerate(p["data"]):
                row, col = p["tile_row"] * 3 + p["row"] + i // p["width"], p["tile_col"] * 3 + p["col"] + i % p["width"]
                assert (row, col) not in got and 0 <= p["row"] < 3 and 0 <= p["col"] < 3
                got[row, col] = v
        assert got == {(i // 5, i % 5 + shift): None if i % 6 == 5 else float(i) for i in range(20)}


LINE = {"type": "LineString", "coordinates": "[[600100.0, 4499000.0], [600400.0, 4499200.0]]"}


def same_lines(spark, n):
    rows = [({**LINE}, {"OBJECTID": str(i)}) for i in range(n)]
    return spark.createDataFrame(rows, "geometry struct<type:string,coordinates:string>, properties map<string,string>")


def test_regions_of_one_shape_meet_the_pixels_once(spark):
    regions = R.corridor_regions(same_lines(spark, 40), 100.0, None).withColumn("epsg", F.lit(32610))
    assert R.mostly_copies(regions)
    ones, members = R.one_of_each_shape(regions)
    assert ones.count() == 1 and members.count() == 40
    pixels = spark.range(400).selectExpr(
        "'s' AS scene_id", "32610 AS epsg", "600000D + 30 * (id % 20) AS x", "4499500D - 30 * (id div 20) AS y",
        "id * 1D AS ndvi", "id * 2D AS nbr", "id * 3D AS ndwi",
    )
    features = RF.build_region_features(pixels, regions, geometry=False)
    alone = RF.build_region_features(pixels, regions.filter("region_id = '0'"), geometry=False)
    assert features.columns == alone.columns
    want = alone.drop("region_id").collect()
    got = features.collect()
    assert len(want) == 1 and {r["region_id"] for r in got} == {str(i) for i in range(40)} and len(got) == 40
    assert {tuple(r[c] for c in features.columns if c != "region_id") for r in got} == {tuple(want[0])}


@pytest.mark.parametrize("touch", ["all", "center"])
def test_pairs_are_looked_at_shortly_before_the_exact_test(spark, touch):
    regions = R.corridor_regions(same_lines(spark, 1), 100.0, None).drop("epsg")
    pixels = spark.range(4000).selectExpr("id", "600000D + 10 * (id % 80) AS x", "4499500D - 15 * (id div 80) AS y")
    joined = R.pixel_region_join(pixels, regions, touch=touch)
    joins = [line for line in plan(joined).splitlines() if "HashJoin" in line or "SortMergeJoin" in line]
    assert joins and all("exists(" not in line for line in joins)
    whole = pixels.crossJoin(regions)
    hit = E.square_in_region(F.col("edges"), F.col("areal"), F.col("buffer_m"), F.col("x"), F.col("y"), 15.0, touch)
    assert {r["id"] for r in joined.collect()} == {r["id"] for r in whole.filter(hit).collect()}


def test_equal_boxes_are_filled_once(spark):
    boxes = spark.range(30).selectExpr("id", "-121.9D - id div 100 AS west", "40.5D AS south", "-121.88D AS east", "40.52D AS north")
    filled = C.polyfill_wgs84(boxes, 32610)
    assert "HashAggregate(keys=[" in plan(filled)
    per_box = {}
    for r in filled.collect():
        per_box.setdefault(r["id"], set()).add((r["q"], r["r"]))
    assert len(per_box) == 30 and len({frozenset(c) for c in per_box.values()}) == 1


def shuffle_files(spark):
    """Names of the shuffle files that the session has on disk."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {n for n in names if n.startswith("shuffle_")}


def left_behind(spark, before):
    """Shuffle files that are new and stay; Spark deletes them beside the query."""
    for _ in range(50):
        if not (new := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return new


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    rows = spark.range(12600).selectExpr("concat('s', id % 7) AS scene_id", "id % 900 AS region_id", "id AS v")
    summed = rows.groupBy("scene_id", "region_id").agg(F.sum("v").alias("v"))
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_to, before = spark.conf.get(name, None), shuffle_files(spark)
    path = S.replace_partitions(summed, str(tmp_path / "scenes"), "scene_id", ["region_id"])
    S.replace_partitions(summed, path, "scene_id", ["region_id"], rows.select("scene_id"))
    assert left_behind(spark, before) == set()
    assert spark.conf.get(name, None) == set_to
    assert spark.read.parquet(path).count() == summed.count() == 6300


def small_tables(spark, folder):
    """Pixels of nine scenes and one without a name, and lines among them."""
    keys = "id * 5 % 600 AS l_orderkey", "id * 7 % 200 AS l_partkey", "CASE WHEN id % 50 = 0 THEN NULL ELSE id % 90 END AS l_suppkey"
    spark.range(3000).selectExpr(*keys).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(40).selectExpr("id AS c_custkey").write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def test_both_writes_are_of_features_built_once(spark, tmp_path, monkeypatch):
    """What is written has no join below it any more, so a replay does not repeat the join's shuffles."""
    written, write = [], RF.write_region_features
    monkeypatch.setattr(RF, "write_region_features", lambda features, path: (written.append(plan(features)), write(features, path))[1])
    assert tables.zonal_write(spark, small_tables(spark, tmp_path)).count() > 0
    assert len(written) == 2
    assert all("Exchange" not in p and "Join" not in p for p in written)


def test_scenes_are_built_some_at_a_time(spark):
    """Each wave has whole scenes and leaves no shuffle files to the next; the rows are those of one build."""
    regions = R.corridor_regions(same_lines(spark, 1), 100.0, None).withColumn("epsg", F.lit(32610))
    pixels = spark.range(2000).selectExpr(
        "CASE WHEN id % 10 < 4 THEN 's1' WHEN id % 10 < 9 THEN concat('s', id % 10) END AS scene_id", "32610 AS epsg",
        "600000D + 30 * (id div 10 % 20) AS x", "4499500D - 30 * (id div 200) AS y", "id * 1D AS ndvi", "id * 2D AS nbr", "id * 3D AS ndwi",
    )
    waves, left, before = [], [], shuffle_files(spark)

    def build(some):
        left.append(left_behind(spark, before))
        waves.append({r["scene_id"]: r["count"] for r in some.groupBy("scene_id").count().collect()})
        return RF.build_region_features(some, regions, geometry=False)

    found = RF.features_by_scenes(pixels, build, most_pixels=800)
    assert sorted(sum(w.values()) for w in waves) == [600, 600, 800]
    assert sorted(str(name) for w in waves for name in w) == ["None", "s1", "s4", "s5", "s6", "s7", "s8"]
    assert left == [set()] * 3
    whole = RF.build_region_features(pixels, regions, geometry=False)
    assert found.columns == whole.columns and found.count() == whole.count() == 7
    rounded = lambda df: {tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()}
    assert rounded(found) == rounded(whole)


def test_few_or_no_pixels_are_one_wave(spark):
    rows, calls = spark.range(10).selectExpr("'s' AS scene_id", "id AS v"), []
    for some in (rows, rows.filter("v < 0")):
        kept = RF.features_by_scenes(some, lambda df: (calls.append(df), df)[1])
        assert kept.exceptAll(some).count() == 0 and kept.count() == some.count()
        assert calls.pop() is some and not calls
