"""Work plans and outcome reports over file manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions import scene_ids as S

# Bands delivered per scene.
DEFAULT_BANDS = ("B2", "B3", "B4", "B5", "B6", "B7")
STATUSES = ("downloaded", "converted", "validated", "skipped", "failed")


def wanted_objects(
    scenes: DataFrame,
    bands: Sequence[str] = DEFAULT_BANDS,
    root: str = "data/raw",
    collection_prefix: str = S.COLLECTION_PREFIX,
) -> DataFrame:
    """Objects to fetch per scene: one per band and the metadata document."""
    labels = F.array(*[F.lit(b) for b in [*bands, "MTL"]])
    wanted = scenes.select("scene_id", F.explode(labels).alias("label"))
    is_mtl = F.col("label") == "MTL"
    return wanted.select(
        "scene_id",
        "label",
        F.when(is_mtl, S.metadata_key("scene_id", collection_prefix))
        .otherwise(S.band_key("scene_id", "label", collection_prefix))
        .alias("object_key"),
        F.when(is_mtl, S.local_metadata_path(root, "scene_id"))
        .otherwise(S.local_band_path(root, "scene_id", "label"))
        .alias("path"),
    )


def transfer_plan(wanted: DataFrame, existing: DataFrame, force: bool = False) -> DataFrame:
    """Objects still to fetch: those without a non-empty local copy."""
    if force:
        return wanted
    present = existing.filter(F.col("length") > 0).select("path").distinct()
    return wanted.join(present, "path", "left_anti")


def conversion_status() -> Column:
    """What happens to one raster, from the state of its input and output files."""
    return (
        F.when(~F.col("in_exists"), "failed")
        .when(F.col("out_exists") & F.col("out_valid") & ~F.col("force"), "skipped")
        .when(F.col("in_valid"), "validated")
        .otherwise("converted")
    )


def with_conversion_status(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("status", conversion_status())


def outcome_report(outcomes: DataFrame, statuses: Sequence[str] = STATUSES) -> DataFrame:
    """Files per scene by status, and whether the scene failed."""
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in statuses]
    return outcomes.groupBy("scene_id").agg(*counts, F.count(F.lit(1)).alias("n_files")).withColumn(
        "failed", F.col("n_failed") > 0
    )


def require_no_failures(report: DataFrame) -> DataFrame:
    """The report, or an error when any file failed."""
    bad = report.filter("failed").agg(F.count(F.lit(1)).alias("n"), F.min("scene_id").alias("s")).first()
    if bad["n"]:
        raise RuntimeError(f"{bad['n']} scene(s) have failed files, e.g. {bad['s']}")
    return report
