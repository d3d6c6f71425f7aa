"""GeoJSON in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FEATURE = "geometry struct<type:string,coordinates:string>, properties map<string,string>"
_FEATURE_STRUCT = "struct<geometry:struct<type:string,coordinates:string>,properties:map<string,string>>"
DOCUMENT_SCHEMA = f"type string, features array<{_FEATURE_STRUCT}>, {_FEATURE}"


def explode_features(documents: DataFrame) -> DataFrame:
    """Collections and bare features to one row per feature.

    A document with neither is an error.
    """
    collection = F.col("features").isNotNull()
    bare = F.array(F.struct("geometry", "properties").cast(_FEATURE_STRUCT))
    listed = (
        F.when(collection, F.col("features"))
        .when(F.col("geometry").isNotNull(), bare)
        .otherwise(F.raise_error(F.lit("GeoJSON has no features or geometry")).cast(f"array<{_FEATURE_STRUCT}>"))
    )
    return documents.select(F.explode(listed).alias("f")).select("f.geometry", "f.properties")


def parse_features(documents: DataFrame, text: str = "document") -> DataFrame:
    """GeoJSON held as text. Coordinates stay text: their nesting depends on the type."""
    parsed = documents.select(F.from_json(text, DOCUMENT_SCHEMA).alias("d")).select("d.*")
    return explode_features(parsed)


def read_features(spark: SparkSession, path: str, one_document_per_line: bool = False) -> DataFrame:
    """Features of GeoJSON files.

    A file holding one collection is one task's work; newline-delimited GeoJSON
    (``one_document_per_line``) is split like any text file and is the form for large sets.
    """
    documents = (
        spark.read.schema(DOCUMENT_SCHEMA)
        .option("multiLine", str(not one_document_per_line).lower())
        .option("mode", "FAILFAST")
        .json(path)
    )
    return explode_features(documents)


def features_json(df: DataFrame, ring: Column, properties: Sequence[str]) -> DataFrame:
    """One line of GeoJSON per row: a polygon of a closed ring and its properties."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        F.struct(*[F.col(p) for p in properties]).alias("properties"),
    )
    return df.filter(F.size(ring) > 0).select(F.to_json(feature).alias("value"))


def write_features(df: DataFrame, ring: Column, properties: Sequence[str], path: str) -> str:
    """Write newline-delimited GeoJSON, in parallel."""
    features_json(df, ring, properties).write.mode("overwrite").text(path)
    return path
