"""Scenes, metadata and band files to catalog documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from terrafold.operators import catalog as K
from terrafold.sources.documents import write_documents, write_tree
from terrafold.sources.shared import fresh_path


def build_catalog(
    scenes: DataFrame,
    metadata: DataFrame,
    bands: DataFrame,
    boxes: DataFrame,
    *,
    collection_id: str,
    title: str,
    description: str,
    providers: Sequence[dict],
    **item_options,
) -> tuple[DataFrame, DataFrame]:
    """Items and the one-row collection, both lazy."""
    items = K.build_items(scenes, metadata, bands, boxes, **item_options)
    return items, K.collection_document(items, collection_id, title, description, providers)


def write_catalog_tree(
    items: DataFrame, collection: DataFrame, collection_id: str, path: str, catalog_id: str = "scenes", description: str = "All scenes"
) -> str:
    """The whole catalog as linked documents, each with a folder of its own in their links:
    root, collection, a catalog for each path and each row, and the items.

    Items are written to the shared folder first, as every level is made from them.
    """
    spark, kept = items.sparkSession, fresh_path(items.sparkSession, "items")
    items.write.parquet(kept)
    items = spark.read.schema(items.schema).parquet(kept)
    return write_tree(K.tree_documents(items, collection, collection_id, catalog_id, description), path)


def write_catalog(items: DataFrame, collection: DataFrame, collection_id: str, path: str) -> str:
    """Item documents, one per line, beside the collection document."""
    write_documents(K.item_documents(items, collection_id), "item", f"{path}/items")
    write_documents(collection, "collection", f"{path}/collection")
    return path
