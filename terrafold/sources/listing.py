"""Directory listings as tables. File contents are never selected, so never read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions.scene_ids import path_parent_name, path_stem, strip_file_scheme
from terrafold.operators.scenes import scenes_from_paths
from terrafold.sources.shared import path_missing

_LISTING_SCHEMA = "path string, length bigint, modificationTime timestamp"


def list_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """``path, length, modificationTime`` of the files below ``root``."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def manifest_from_paths(files: DataFrame) -> DataFrame:
    """``scene_id, index_name, path`` of files laid out as ``<scene>/<index>.tif``."""
    return files.select(
        path_parent_name("path").alias("scene_id"),
        path_stem("path").alias("index_name"),
        strip_file_scheme("path").alias("path"),
    )


def raster_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Index rasters below ``root``, sorted; an error when there is none."""
    try:
        files = list_files(spark, root, "*.tif")
        empty = files.isEmpty()
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        raise ValueError(f"Index raster directory not found: {root}") from exc
    if empty:
        raise ValueError(f"No index rasters found under {root}")
    return manifest_from_paths(files).orderBy("scene_id", "index_name")


def scene_listing(spark: SparkSession, root: str) -> DataFrame:
    """Scene directories below ``root``, sorted; a missing root gives an empty table."""
    try:
        files = list_files(spark, root, "*_SR_B*.TIF")
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        files = spark.createDataFrame([], _LISTING_SCHEMA)
    return scenes_from_paths(files)


def band_listing(spark: SparkSession, root: str) -> DataFrame:
    """``scene_id, band, path, length`` of the band files below ``root``."""
    files = list_files(spark, root, "*_SR_B*.TIF")
    return files.select(
        path_parent_name("path").alias("scene_id"),
        F.regexp_extract("path", "_SR_(B[0-9]+)\\.TIF$", 1).alias("band"),
        strip_file_scheme("path").alias("path"),
        "length",
    )
