"""Scenes that arrive as files, added to a feature table without duplicates.

Each micro-batch only tells which scenes were touched. Their features are recomputed from
the source and replace the scenes' partitions, so a scene may arrive in pieces, in any
order, and be replayed, and the table still equals the batch result; a scene that comes to
have no features loses those it had. The only state is the stream's checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrafold.sources.features import replace_partitions
from terrafold.sources.shared import path_missing


def rows_of(spark: SparkSession, source: str, schema: T.StructType, key: str, names: list[str], partitioned: bool) -> DataFrame:
    """Source rows of some scenes.

    Of a source with a directory for each scene only the directories of these scenes are
    listed and read; of any other the comparison reaches the scan.
    """
    rows = spark.read.schema(schema)
    if not partitioned:
        return rows.parquet(source).filter(F.col(key).isin(names))
    # A scene whose directory is gone has no rows.
    folders = [f"{source.rstrip('/')}/{key}={partition_name(n)}" for n in names]
    there = [f for f in folders if _exists(rows, f)]
    if not there:
        return spark.createDataFrame([], schema)
    return rows.option("basePath", source).parquet(*there).select(*schema.names)


#: Characters that Spark escapes in the names of partition directories, besides control ones.
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def partition_name(value: str) -> str:
    """The name of a text value's directory, after the equals sign."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in ESCAPED else c for c in value)


def _exists(reader: DataFrameReader, folder: str) -> bool:
    try:
        reader.parquet(folder)
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        return False
    return True


def ingest_scenes(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    build: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    key: str = "scene_id",
    partitioned: bool = False,
) -> None:
    """Process every file not seen yet, then stop.

    ``build`` maps source rows of some scenes to feature rows with the scene key, a text. With
    ``partitioned`` the source has a directory for each scene, and a batch reads those it
    touches. The names of a batch's scenes pass the driver; ``max_files_per_trigger`` bounds
    them.
    """
    stream = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)

    def refresh(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        names = sorted(r[key] for r in batch.select(key).distinct().collect() if r[key] is not None)
        if names:
            touched = session.createDataFrame([(n,) for n in names], f"{key} string")
            rows = rows_of(session, source, schema, key, names, partitioned)
            replace_partitions(build(rows), target, key, touched=touched)

    query = (
        stream.parquet(source)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(refresh)
        .start()
    )
    query.awaitTermination()
