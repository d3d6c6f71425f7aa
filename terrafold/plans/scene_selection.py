"""Search results to the ordered list of scenes to work on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from terrafold.operators import scenes as S


def select_scenes(
    items: DataFrame,
    max_cloud_cover: float,
    wrs_path: str | None = None,
    rows: Sequence[str] | None = None,
    dates: Sequence[str] | None = None,
    require_any: bool = False,
) -> DataFrame:
    """``scene_id, cloud_cover`` of the scenes under the threshold, clearest first.

    Filters keep the cloud figure on its row, so it is not joined back. ``require_any``
    makes an empty selection an error.
    """
    found = S.discovered_scenes(items, max_cloud_cover)
    if require_any and found.isEmpty():
        raise ValueError(f"No scenes found with cloud_cover < {max_cloud_cover}%")
    return S.clearest_first(S.filter_scenes(found, wrs_path, rows, dates, strict=False))


def selected_with_cloud(scene_ids: DataFrame, discovered: DataFrame) -> DataFrame:
    """A list of ids joined back to its cloud figures."""
    return S.clearest_first(scene_ids.join(discovered.select("scene_id", "cloud_cover"), "scene_id"))
