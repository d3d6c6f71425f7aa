"""Every registered query against its oracle, and the shape of the plans."""

from __future__ import annotations

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_oracle(spark, con, name):
    assert name in oracle_sql()
    assert compare.differences(queries()[name](spark, SF), con, oracle_sql()[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0


# Row counts that must be positive even on the smallest tables, so no oracle passes empty.
@pytest.mark.parametrize(
    "name",
    ["corridor_pixel_join", "polygon_zonal_stats", "cells_in_footprint", "missing_bands", "catalog_assets", "scene_filter"],
)
def test_not_vacuous(spark, name):
    assert queries()[name](spark, SF).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "hex_zonal_stats", "build_hex_features", "corridor_pixel_join", "build_corridor_features",
        "polygon_zonal_stats", "block_region_join", "band_align", "missing_bands", "transfer_plan",
        "stac_item_build", "cells_in_footprint",
    ],
)
def test_no_nested_loops(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["hex_zonal_stats", "band_align", "build_hex_features"])
def test_one_shuffle_after_partial_aggregation(spark, name):
    text = plan(queries()[name](spark, SF))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_" in text


def test_only_needed_columns_are_read(spark):
    text = plan(queries()["hex_zonal_stats"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint>" in text
