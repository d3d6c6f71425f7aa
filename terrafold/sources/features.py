"""Partitioned feature tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrafold.functions import hexgrid
from terrafold.functions.wkb import polygon_wkb
from terrafold.sources.shared import keep, path_missing, shuffles_freed


def with_coarse_key(features: DataFrame, coarse_resolution: int, name: str | None = None) -> DataFrame:
    """Add the coarse cell holding each cell's centre, as a partition key.

    One directory per resolution-8 cell suits a study area; a continent needs far fewer
    and larger ones.
    """
    _, q, r = hexgrid.parse_cell_id(F.col("cell"))
    fine = F.substring(F.split("cell", "_")[0], 3, 4).cast("int")
    s = F.lit(461.0) * F.pow(F.lit(7.0), (F.lit(8.0) - fine) / 2.0)
    located = features.withColumns(
        {"__x": (q + r / 2.0) * s * hexgrid.SQRT3, "__y": r * s * 1.5}
    )
    coarse = hexgrid.with_axial(located, coarse_resolution, "__x", "__y", "__cq", "__cr")
    key = name or f"cell_res{coarse_resolution}"
    zone = hexgrid.cell_epsg(F.col("cell"))
    return coarse.withColumn(
        key, hexgrid.cell_id(F.col("__cq"), F.col("__cr"), coarse_resolution, zone)
    ).drop("__x", "__y", "__cq", "__cr")


def with_wkb(features: DataFrame, ring: str = "geometry") -> DataFrame:
    """The closed ring of each row, an array of vertices, as the bytes of a polygon."""
    return features.withColumn(ring, polygon_wkb(F.array(F.col(ring))))


def write_features(features: DataFrame, path: str, key: str, max_records_per_file: int = 5_000_000) -> str:
    """Write one directory per ``key`` value, replacing what was there.

    Rows are brought together by key, so a directory gets few files; Spark splits a popular
    key's rows over several tasks by their measured size. An empty table leaves an empty
    directory.
    """
    (
        features.hint("rebalance", key)
        .sortWithinPartitions(key)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(key)
        .parquet(path)
    )
    return path


def emptied(features: DataFrame, touched: DataFrame, key: str) -> DataFrame:
    """For each touched key without any feature a row that has nothing but the key."""
    names = touched.select(F.col(key).cast(features.schema[key].dataType)).filter(F.col(key).isNotNull()).distinct()
    gone = names.join(features.select(key).distinct(), key, "left_anti")
    return gone.select(*[F.col(c) if c == key else F.lit(None).cast(features.schema[c].dataType).alias(c) for c in features.columns])


def present(features: DataFrame, key: str) -> DataFrame:
    """The rows of a feature table without those that mark an emptied partition."""
    values = [F.col(f"`{c}`") for c in features.columns if c != key]
    return features.filter(F.coalesce(*[F.when(v.isNotNull(), True) for v in values], F.lit(False))) if values else features


def replace_partitions(
    features: DataFrame, path: str, key: str, order: list[str] | None = None, touched: DataFrame | None = None
) -> str:
    """Overwrite exactly the partitions present in ``features``, in one write.

    Running it again with the same rows gives the same table. A large partition is split
    over several tasks by its measured size; ``order`` sorts rows inside its files.

    ``touched`` has the keys that the features were built for. Those that no row has any more
    are emptied by the same commit: their partition then holds one row of nulls, which
    :func:`read_features` leaves out. Features are written once to the shared folder first,
    so that they are built only once.
    """
    if touched is not None:
        features = keep(features, "features")
        features = features.unionByName(emptied(features, touched, key))
    with shuffles_freed(features.sparkSession):
        (
            features.hint("rebalance", key)
            .sortWithinPartitions(key, *(order or []))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(key)
            .parquet(path)
        )
    return path


def read_features(spark: SparkSession, path: str, schema: T.StructType | str, key: str) -> DataFrame:
    """Read a feature table, its key restored from the directory names as text.

    ``schema`` declares all columns including the key; a path that does not exist gives an
    empty table of that schema. Any other error is the caller's. Partitions emptied by
    :func:`replace_partitions` have no rows.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    declared = T.StructType([T.StructField(f.name, T.StringType() if f.name == key else f.dataType) for f in schema])
    try:
        return present(spark.read.schema(declared).parquet(path).select(*declared.names), key)
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        return spark.createDataFrame([], declared)


def write_indices(indices: DataFrame, path: str) -> str:
    """Encoded index rasters as Parquet, one directory per scene.

    Rows are ordered by map tile inside each file, so box filters skip row groups.
    """
    tile = lambda c: F.floor(F.col(c) / 7680.0)
    (
        indices.withColumns({"__tx": tile("x"), "__ty": tile("y")})
        .repartition("scene_id", "__tx", "__ty")
        .sortWithinPartitions("scene_id", "__ty", "__tx", "y", "x")
        .drop("__tx", "__ty")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("scene_id")
        .parquet(path)
    )
    return path
