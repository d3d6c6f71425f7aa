"""Written tables: partitions, replays, GeoJSON and incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks import sqltext as Q
from checks.areas import _COUNT, _PAIRS, _WIDE
from checks.hexagons import _FILL, _FILLED, _HEX, _STUDY, rounded_stats, study_features
from checks.raster import indexed_px
from checks.registry import query
from terrafold.functions import hexgrid
from terrafold.functions.projection import unproject_vertices
from terrafold.operators import bands as B
from terrafold.operators import cells as C
from terrafold.operators import regions as R
from terrafold.operators import zonal as Z
from terrafold.plans import hex_features as H
from terrafold.plans import region_features as RF
from terrafold.sources import features as T
from terrafold.sources import geojson
from terrafold.sources.shared import fresh_path
from terrafold.streaming.incremental import ingest_scenes


@query("features_roundtrip", X.with_("px", "SELECT * FROM study", **_STUDY))
def features_roundtrip(spark, sf_dir):
    features = rounded_stats(study_features(spark, sf_dir), Z.DEFAULT_STATS)
    path = T.write_features(features, fresh_path(spark, "features"), "cell_res8")
    return T.read_features(spark, path, features.schema, "cell_res8")


@query("zonal_write", X.with_("px lines", _WIDE.format(extra=_COUNT), **_PAIRS))
def zonal_write(spark, sf_dir):
    regions = X.line_regions(spark, sf_dir)

    def build(indices):
        return rounded_stats(RF.build_region_features(indices, regions, geometry=False, half_pixel=X.HALF), RF_STATS)

    # Both writes are of the same rows, so these are built once; the join's shuffles go before they begin.
    features = RF.features_by_scenes(indexed_px(spark, sf_dir), build)
    path = fresh_path(spark, "zonal")
    # The second write replays every scene; the table must not change.
    for _ in range(2):
        RF.write_region_features(features, path)
    return T.read_features(spark, path, features.schema, "scene_id").select(*features.columns)


RF_STATS = ("mean", "std", "max")


@query(
    "cells_geojson",
    X.with_(
        "boxes",
        "SELECT cell AS region_id, cell AS cell_res8, 6 AS n_edges, round(min(lon), 7) AS min_x, round(min(lat), 7) AS min_y, round(max(lon), 7) AS max_x, "
        "round(max(lat), 7) AS max_y FROM ring GROUP BY cell",
        **_FILL,
        picked=f"SELECT DISTINCT {Q.cell()} AS cell, cx, cy {_FILLED}",
        corner="SELECT *, unnest(generate_series(0, 5)) AS k FROM picked",
        turned=f"SELECT cell, cx + {Q.S8!r}*cos(radians(60*k - 30)) AS vx, cy + {Q.S8!r}*sin(radians(60*k - 30)) AS vy FROM corner",
        ring=Q.unproject("turned", "vx", "vy"),
    ),
)
def cells_geojson(spark, sf_dir):
    filled = C.polyfill_wgs84(X.boxes(spark, sf_dir), X.EPSG, X.RES).select("q", "r").distinct()
    cells = C.with_cell_id(C.with_center(filled, X.RES), X.RES).withColumn("h3_index", F.col("cell"))
    corners = hexgrid.vertices(F.col("cx"), F.col("cy"), X.RES)
    shaped = cells.withColumn("ring", H.close_ring(unproject_vertices(corners, X.EPSG)))
    path = geojson.write_features(shaped, F.col("ring"), ["h3_index"], fresh_path(spark, "cells"))
    regions = R.polygon_regions(geojson.read_features(spark, path, one_document_per_line=True), X.RES)
    sides = [F.round(c, 7).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")]
    return regions.select("region_id", "cell_res8", F.size("edges").alias("n_edges"), *sides)


@query(
    "incremental_scenes",
    X.with_("px", Q.wide_stats("hit", "scene_id, q, r", ("mean", "std")), **_HEX),
)
def incremental_scenes(spark, sf_dir):
    source, target = fresh_path(spark, "drops"), fresh_path(spark, "ingested")
    pixels = X.px(spark, sf_dir).withColumn("drop_no", F.col("b4") % 2)

    def build(rows):
        indices = B.with_indices(rows, ["scene_id", "x", "y"])
        return rounded_stats(H.cell_statistics(indices, X.RES), Z.DEFAULT_STATS)

    def ingest(checkpoint):
        ingest_scenes(spark, source, pixels.drop("drop_no").schema, build, target, checkpoint)

    # Every scene arrives in two pieces; then a new checkpoint replays all of it.
    first = fresh_path(spark, "progress")
    for piece in (0, 1):
        pixels.filter(F.col("drop_no") == piece).drop("drop_no").write.mode("append").parquet(source)
        ingest(first)
    ingest(fresh_path(spark, "progress"))
    schema = build(pixels.drop("drop_no")).schema
    return T.read_features(spark, target, schema, "scene_id")


_GONE = "scene_id LIKE '%044032%'"


@query(
    "incremental_retired_scenes",
    X.with_("px", f"SELECT * FROM ({Q.wide_stats('hit', 'scene_id, q, r', ('mean', 'std'))}) WHERE NOT ({_GONE})", **_HEX),
)
def incremental_retired_scenes(spark, sf_dir):
    """A source with a directory for each scene; a third of the scenes is withdrawn to fill alone."""
    source, target, progress = (fresh_path(spark, n) for n in ("drops", "ingested", "progress"))
    pixels = X.px(spark, sf_dir)
    schema = pixels.schema

    def build(rows):
        indices = B.with_indices(rows, ["scene_id", "x", "y"])
        return rounded_stats(H.cell_statistics(indices, X.RES), Z.DEFAULT_STATS)

    fill = pixels.filter(_GONE).withColumns({b: F.lit(0).cast(schema[b].dataType) for b in ("b3", "b4", "b5", "b7")})
    for rows in (pixels, fill):
        T.replace_partitions(rows, source, "scene_id")
        ingest_scenes(spark, source, schema, build, target, progress, partitioned=True)
    return T.read_features(spark, target, build(pixels).schema, "scene_id")
