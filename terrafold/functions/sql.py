"""SQL names for the scalar rules, as SQL-bodied functions Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from terrafold.functions.hexgrid import SQRT3
from terrafold.functions.spectral import FILL_DN, REFLECTANCE_SCALE

_FUNCTIONS = {
    "dn_reflectance": (
        "dn DOUBLE",
        "DOUBLE",
        f"CASE WHEN dn <> {FILL_DN} THEN dn * {REFLECTANCE_SCALE!r}D - 2e-1 END",
    ),
    "norm_diff": ("a DOUBLE, b DOUBLE", "DOUBLE", "try_divide(a - b, a + b)"),
    "ndvi": ("red DOUBLE, nir DOUBLE", "DOUBLE", "try_divide(nir - red, nir + red)"),
    "nbr": ("nir DOUBLE, swir2 DOUBLE", "DOUBLE", "try_divide(nir - swir2, nir + swir2)"),
    "ndwi": ("green DOUBLE, nir DOUBLE", "DOUBLE", "try_divide(green - nir, green + nir)"),
    "hex_edge_m": ("res INT", "DOUBLE", "461e0 * power(7e0, (8 - res) / 2e0)"),
    "hex_center_x": ("q BIGINT, r BIGINT, s DOUBLE", "DOUBLE", f"(q + r / 2e0) * (s * {SQRT3!r}D)"),
    "hex_center_y": ("r BIGINT, s DOUBLE", "DOUBLE", "r * (15e-1 * s)"),
    "scene_normalize": ("id STRING", "STRING", "regexp_replace(id, '_SR$', '')"),
    "scene_wrs_path": ("id STRING", "STRING", "substring(get(split(id, '_'), 2), 1, 3)"),
    "scene_wrs_row": ("id STRING", "STRING", "substring(get(split(id, '_'), 2), 4, 3)"),
    "scene_date": ("id STRING", "STRING", "get(split(id, '_'), 3)"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session and return their names."""
    for name, (args, returns, body) in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns} RETURN {body}")
    return list(_FUNCTIONS)
