"""A folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without one, since there the driver's temporary folder is
    also every task's.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="terrafold-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else writes to."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Has Spark delete an execution's shuffle files when it ends, not when the driver forgets its plan.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes within are deleted as each ends.

    Otherwise they stay until the driver's JVM happens to collect the plan, so those of one
    write lie beside those of the next. Spark before 4.1 does not know the setting and keeps them.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def keep(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read from there, so that it is made only once."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_missing(error: AnalysisException) -> bool:
    """Whether Spark found nothing at a path, as opposed to anything else being wrong."""
    return error.getCondition() == "PATH_NOT_FOUND"
