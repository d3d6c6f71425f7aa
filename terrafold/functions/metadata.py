"""Scene metadata documents, flattened to typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Section and field names of the Collection 2 metadata document.
IMAGE_FIELDS = (
    "CLOUD_COVER_LAND",
    "CLOUD_COVER",
    "SUN_ELEVATION_LAND",
    "SUN_ELEVATION",
    "SUN_AZIMUTH_LAND",
    "SUN_AZIMUTH",
    "DATE_ACQUIRED",
    "SCENE_CENTER_TIME",
)
PROJECTION_FIELDS = (
    "UTM_ZONE",
    "GRID_CELL_SIZE_REFLECTIVE",
    "REFLECTIVE_LINES",
    "REFLECTIVE_SAMPLES",
    "CORNER_UL_PROJECTION_X_PRODUCT",
    "CORNER_UL_PROJECTION_Y_PRODUCT",
)
# Fixed values that stand in where metadata has none.
DEFAULT_EPSG = 32610
DEFAULT_SHAPE = (8031, 8001)


def _struct_ddl(fields) -> str:
    return "struct<" + ",".join(f"{f}:string" for f in fields) + ">"


_SECTIONS = f"IMAGE_ATTRIBUTES:{_struct_ddl(IMAGE_FIELDS)},PROJECTION_ATTRIBUTES:{_struct_ddl(PROJECTION_FIELDS)}"

# The wrapper object is optional, so both levels are declared. Every leaf is read as text.
METADATA_SCHEMA = f"LANDSAT_METADATA_FILE struct<{_SECTIONS}>, " + ", ".join(
    part.replace(":struct", " struct", 1) for part in (
        f"IMAGE_ATTRIBUTES:{_struct_ddl(IMAGE_FIELDS)}",
        f"PROJECTION_ATTRIBUTES:{_struct_ddl(PROJECTION_FIELDS)}",
    )
)


# Spark's cast also takes type suffixes such as ``5d``, which are no numbers in metadata.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:nan|inf|infinity)$"


def as_float(text: Column) -> Column:
    """NULL where the text is not a number."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))


def as_int(text: Column) -> Column:
    """Number truncated towards zero; NULL where the text is not a number."""
    return as_float(text).try_cast("bigint")


def scene_center_time(date_acquired: Column, center_time: Column) -> Column:
    """UTC instant; zone letter and fraction are dropped, anything malformed is NULL."""
    clock = F.regexp_replace(F.trim(center_time), "(\\.[^Z]*)?Z?$", "")
    text = F.concat(date_acquired, F.lit("T"), clock)
    well_formed = text.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$")
    return F.when(well_formed, F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit("yyyy-M-d'T'H:m:sX")))


def noon_of_date(yyyymmdd: Column) -> Column:
    """12:00 UTC of a ``YYYYMMDD`` date; NULL where it is no calendar date."""
    return F.try_to_timestamp(F.concat(yyyymmdd, F.lit(" 12:00:00Z")), F.lit("yyyyMMdd HH:mm:ssX"))


def affine(cell: Column, ulx: Column, uly: Column) -> Column:
    """``[cell, 0, ulx, 0, -cell, uly]``, NULL when a part is missing."""
    zero = F.lit(0.0)
    return F.when(
        cell.isNotNull() & ulx.isNotNull() & uly.isNotNull(),
        F.array(cell, zero, ulx, zero, -cell, uly),
    )


def metadata_fields(image: Column, projection: Column) -> dict[str, Column]:
    """Flat catalog fields of the two document sections."""
    zone = as_int(projection["UTM_ZONE"])
    lines = as_int(projection["REFLECTIVE_LINES"])
    samples = as_int(projection["REFLECTIVE_SAMPLES"])
    cloud_text = F.coalesce(image["CLOUD_COVER_LAND"], image["CLOUD_COVER"])
    zero = F.lit(0.0)
    return {
        "cloud_cover": F.coalesce(as_float(cloud_text), zero),
        "sun_elevation": F.coalesce(
            as_float(image["SUN_ELEVATION_LAND"]), as_float(image["SUN_ELEVATION"]), zero
        ),
        "sun_azimuth": F.coalesce(
            as_float(image["SUN_AZIMUTH_LAND"]), as_float(image["SUN_AZIMUTH"]), zero
        ),
        "epsg": F.coalesce(zone + 32600, F.lit(DEFAULT_EPSG).cast("bigint")),
        "proj_shape": F.when(lines.isNotNull() & samples.isNotNull(), F.array(lines, samples)),
        "proj_transform": affine(
            as_float(projection["GRID_CELL_SIZE_REFLECTIVE"]),
            as_float(projection["CORNER_UL_PROJECTION_X_PRODUCT"]),
            as_float(projection["CORNER_UL_PROJECTION_Y_PRODUCT"]),
        ),
        "scene_time": scene_center_time(image["DATE_ACQUIRED"], image["SCENE_CENTER_TIME"]),
    }
