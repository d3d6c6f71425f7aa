from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from terrafold.operators import manifests, scenes
from terrafold.plans import scene_selection

IDS = [
    "LC09_L2SP_012022_20210305_20210309_02_T1",
    "LC09_L2SP_012023_20210305_20210309_02_T1",
    "LC09_L2SP_012022_20210321_20210325_02_T1",
]


def ids(df):
    return [r["scene_id"] for r in df.collect()]


def scene_table(spark, names):
    return spark.createDataFrame([(n,) for n in names], "scene_id string")


def test_filters_combine(spark):
    df = scene_table(spark, IDS)
    assert sorted(ids(scenes.filter_scenes(df))) == sorted(IDS)
    assert ids(scenes.filter_scenes(df, "012", ["022"], ["20210321"])) == [IDS[2]]
    assert ids(scenes.filter_scenes(df, wrs_path="045")) == []
    assert sorted(ids(scenes.filter_scenes(df, rows=["022", "023"], dates=["20210305"]))) == sorted(IDS[:2])


def test_malformed_id_fails_even_without_a_filter(spark):
    df = scene_table(spark, [*IDS, "garbage"])
    with pytest.raises(Exception, match="Invalid scene ID"):
        scenes.filter_scenes(df).collect()
    assert len(ids(scenes.filter_scenes(df, "012", strict=False))) == 3


def items(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id string, cloud_cover string")


def test_selection(spark):
    found = items(
        spark, (IDS[0] + "_SR", "5.0"), (IDS[0], "3.0"), (IDS[1], "10.0"), (IDS[2], "9.9"),
        ("LC08_L2SP_012022_20210305_20210309_02_T1", "1.0"), ("LC09_L2SP_bad", "1.0"),
    )
    out = scene_selection.select_scenes(found, 10.0)
    assert [(r["scene_id"], r["cloud_cover"]) for r in out.collect()] == [(IDS[0], 3.0), (IDS[2], 9.9)]


def test_missing_cloud_counts_as_full(spark):
    found = items(spark, (IDS[0], None), (IDS[1], "unknown"), (IDS[2], "99.9"))
    assert ids(scene_selection.select_scenes(found, 100.0)) == [IDS[2]]


def test_selection_errors(spark):
    for bad in (-1, 101):
        with pytest.raises(ValueError, match="between 0 and 100"):
            scene_selection.select_scenes(items(spark, (IDS[0], "1")), bad)
    with pytest.raises(ValueError, match="No scenes found"):
        scene_selection.select_scenes(items(spark, (IDS[0], "50")), 10.0, require_any=True)


def test_rejoined_cloud_figures(spark):
    discovered = scenes.discovered_scenes(items(spark, (IDS[0], "7"), (IDS[1], "2")), 10.0)
    out = scene_selection.selected_with_cloud(scene_table(spark, [IDS[0], IDS[2]]), discovered)
    assert [(r["scene_id"], r["cloud_cover"]) for r in out.collect()] == [(IDS[0], 7.0)]


def test_required_bands(spark):
    df = scene_table(spark, IDS[:2])
    have = spark.createDataFrame(
        [(IDS[0], b) for b in ("B3", "B4", "B5", "B7", "B2")] + [(IDS[1], "B4")], "scene_id string, band string"
    )
    assert [(r["scene_id"], r["missing"]) for r in scenes.missing_bands(df, have).collect()] == [(IDS[1], "B3,B5,B7")]
    with pytest.raises(ValueError, match="Missing required bands.*B3,B5,B7"):
        scenes.require_bands(df, have)
    assert scenes.require_bands(scene_table(spark, IDS[:1]), have) is not None


def test_seven_objects_per_scene(spark):
    wanted = manifests.wanted_objects(scene_table(spark, IDS[:1]))
    assert wanted.count() == 7
    path = wanted.filter("label = 'B4'").first()["path"]
    existing = spark.createDataFrame([(path, 10), ("x", 0)], "path string, length bigint")
    plan = manifests.transfer_plan(wanted, existing)
    assert plan.count() == 6 and plan.filter("label = 'B4'").count() == 0
    assert manifests.transfer_plan(wanted, existing.withColumn("length", F.lit(0))).count() == 7
    assert manifests.transfer_plan(wanted, existing, force=True).count() == 7


def test_conversion_states(spark):
    rows = [
        (False, False, True, True, False, "failed"),
        (True, False, True, True, False, "skipped"),
        (True, True, True, True, True, "validated"),
        (True, True, False, False, False, "validated"),
        (True, False, True, False, False, "converted"),
        (True, False, True, True, True, "converted"),
    ]
    df = spark.createDataFrame(
        rows, "in_exists boolean, in_valid boolean, out_exists boolean, out_valid boolean, force boolean, expected string"
    )
    assert manifests.with_conversion_status(df).filter("status <> expected").count() == 0


def test_failures_stop_the_job(spark):
    df = spark.createDataFrame([("a", "skipped"), ("a", "failed"), ("b", "converted")], "scene_id string, status string")
    report = manifests.outcome_report(df)
    row = report.filter("scene_id = 'a'").first()
    assert (row["n_failed"], row["n_skipped"], row["n_files"], row["failed"]) == (1, 1, 2, True)
    with pytest.raises(RuntimeError, match="1 scene"):
        manifests.require_no_failures(report)
    assert manifests.require_no_failures(report.filter("scene_id = 'b'")) is not None


def test_empty_intersections_are_dropped(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 2.0, 2.0, 1.0, 1.0, 3.0, 3.0), (0.0, 0.0, 1.0, 1.0, 2.0, 2.0, 3.0, 3.0)],
        "a double, b double, c double, d double, e double, f double, g double, h double",
    )
    rows = scenes.intersect_boxes(df, list("abcd"), list("efgh")).collect()
    assert [(r["west"], r["south"], r["east"], r["north"]) for r in rows] == [(1.0, 1.0, 2.0, 2.0)]
