"""Scene identifiers, object keys and local paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the public archive layout.
COLLECTION_PREFIX = "collection02/level-2/standard/oli-tirs"
LANDSAT9_PREFIX = "LC09_L2SP_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_scene_id(item_id: Column | str) -> Column:
    """Drop one trailing ``_SR``."""
    return F.regexp_replace(_col(item_id), "_SR$", "")


def valid_scene_id(scene_id: Column | str) -> Column:
    """At least four tokens; token 3 has six digits and token 4 has eight."""
    return _col(scene_id).rlike("^[^_]*_[^_]*_[0-9]{6}_[0-9]{8}(_.*)?$")


def is_landsat9_l2sp(scene_id: Column | str) -> Column:
    c = _col(scene_id)
    return c.startswith(LANDSAT9_PREFIX) & valid_scene_id(c)


def scene_parts(scene_id: Column | str, strict: bool = False) -> dict[str, Column]:
    """WRS path and row, year and acquisition date; NULL (or an error) for bad ids."""
    c = _col(scene_id)
    valid = valid_scene_id(c)
    token = F.split(c, "_")

    def part(value: Column) -> Column:
        out = F.when(valid, value)
        if strict:
            problem = F.concat(F.lit("Invalid scene ID "), F.coalesce(c, F.lit("NULL")))
            out = out.otherwise(F.raise_error(problem).cast("string"))
        return out

    wrs, date = F.get(token, F.lit(2)), F.get(token, F.lit(3))
    return {
        "wrs_path": part(F.substring(wrs, 1, 3)),
        "wrs_row": part(F.substring(wrs, 4, 3)),
        "year": part(F.substring(date, 1, 4)).cast("int"),
        "acquisition_date": part(date),
    }


def band_label(band: Column | str, strict: bool = False) -> Column:
    """``b4`` and ``4`` become ``B4``; anything without band digits NULL (or an error)."""
    digits = F.regexp_replace(F.upper(_col(band)), "^B", "")
    out = F.when(digits.rlike("^[0-9]+$"), F.concat(F.lit("B"), digits))
    if strict:
        problem = F.concat(F.lit("Invalid band "), F.coalesce(_col(band), F.lit("NULL")))
        out = out.otherwise(F.raise_error(problem).cast("string"))
    return out


def scene_prefix(scene_id: Column | str, collection_prefix: str = COLLECTION_PREFIX, strict: bool = False) -> Column:
    """Directory key of a scene, ending in a slash; NULL (or an error) for bad ids.

    Usual ids take one test and one replacement; only the others are taken apart.
    """
    root = re.sub(r"([\\$])", r"\\\1", collection_prefix.rstrip("/"))
    usual = F.regexp_replace(_col(scene_id), USUAL_ID, root + "/$3/$1/$2/$0/")
    return F.when(_col(scene_id).rlike(USUAL_ID), usual).otherwise(_any_prefix(scene_id, collection_prefix, strict))


#: A scene id with its path, row and year, whose first digit is no zero.
USUAL_ID = "^[^_]*_[^_]*_([0-9]{3})([0-9]{3})_([1-9][0-9]{3})[0-9]{4}(?:_.*)?$"


def _any_prefix(scene_id: Column | str, collection_prefix: str, strict: bool) -> Column:
    parts = scene_parts(scene_id, strict)
    pieces = (parts["year"].cast("string"), parts["wrs_path"], parts["wrs_row"], _col(scene_id))
    slash = F.lit("/")
    return F.concat(F.lit(collection_prefix.rstrip("/")), *[x for piece in pieces for x in (slash, piece)], slash)


def band_file(scene_id: Column | str, band: Column | str, strict: bool = False) -> Column:
    return F.concat(_col(scene_id), F.lit("_SR_"), band_label(band, strict), F.lit(".TIF"))


def metadata_file(scene_id: Column | str) -> Column:
    return F.concat(_col(scene_id), F.lit("_MTL.json"))


def band_key(
    scene_id: Column | str, band: Column | str, collection_prefix: str = COLLECTION_PREFIX, strict: bool = False
) -> Column:
    return F.concat(scene_prefix(scene_id, collection_prefix, strict), band_file(scene_id, band, strict))


def metadata_key(scene_id: Column | str, collection_prefix: str = COLLECTION_PREFIX, strict: bool = False) -> Column:
    return F.concat(scene_prefix(scene_id, collection_prefix, strict), metadata_file(scene_id))


def bucket_href(bucket: str, key: Column) -> Column:
    return F.concat(F.lit(f"s3://{bucket}/"), key)


def local_scene_dir(root: str, scene_id: Column | str) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), _col(scene_id))


def local_band_path(root: str, scene_id: Column | str, band: Column | str, strict: bool = False) -> Column:
    """File of a band; NULL (or an error) for a bad band or a missing scene."""
    return F.concat(local_scene_dir(root, scene_id), F.lit("/"), band_file(scene_id, band, strict))


def local_metadata_path(root: str, scene_id: Column | str) -> Column:
    return F.concat(local_scene_dir(root, scene_id), F.lit("/"), metadata_file(scene_id))


def strip_file_scheme(path: Column | str) -> Column:
    """Remove a leading ``file:`` from a listed path."""
    return F.regexp_replace(_col(path), "^file:", "")


def path_parent_name(path: Column | str) -> Column:
    """Name of the directory that holds a file."""
    return F.regexp_extract(_col(path), "([^/]+)/[^/]+$", 1)


def path_stem(path: Column | str) -> Column:
    """File name without its last extension."""
    return F.regexp_extract(_col(path), "([^/]+?)(\\.[^./]*)?$", 1)
