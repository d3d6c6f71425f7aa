"""Scene ids, selection, plans and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks.registry import query
from terrafold.functions import scene_ids as I
from terrafold.operators import manifests as M
from terrafold.operators import scenes as S
from terrafold.plans import scene_selection as P

# Ids as they may arrive: some carry a suffix, some are cut short or hold letters.
_RAW_ID = (
    X.CAT_ID.format(k="c_custkey") + " || CASE WHEN c_custkey % 3 = 0 THEN '_SR' ELSE '' END"
)
_MESSY = (
    f"CASE WHEN c_custkey % 10 = 7 THEN 'LC09_L2SP_' || CAST(c_custkey AS string) WHEN c_custkey % 10 = 8 THEN "
    f"replace({_RAW_ID}, '_202407', '_2024X7') ELSE {_RAW_ID} END"
)


@query(
    "parse_scene_id",
    "WITH raw AS (SELECT " + _MESSY + " AS item_id FROM customer), "
    "ids AS (SELECT item_id, CASE WHEN item_id LIKE '%\\_SR' ESCAPE '\\' THEN left(item_id, length(item_id) - 3) ELSE item_id END AS scene_id FROM raw), "
    "tok AS (SELECT *, string_split(scene_id, '_') AS t FROM ids), "
    "ok AS (SELECT *, coalesce(len(t) >= 4 AND regexp_full_match(t[3], '[0-9]{6}') AND regexp_full_match(t[4], '[0-9]{8}'), false) AS valid FROM tok) "
    "SELECT item_id, scene_id, valid, CASE WHEN valid THEN left(t[3], 3) END AS wrs_path, "
    "CASE WHEN valid THEN right(t[3], 3) END AS wrs_row, CASE WHEN valid THEN CAST(left(t[4], 4) AS int) END AS year, "
    "CASE WHEN valid THEN t[4] END AS acquisition_date FROM ok",
)
def parse_scene_id(spark, sf_dir):
    raw = X.table(spark, sf_dir, "customer").selectExpr(f"{_MESSY} AS item_id")
    named = raw.withColumn("scene_id", I.normalize_scene_id("item_id"))
    return S.with_scene_parts(named.withColumn("valid", I.valid_scene_id("scene_id")))


_PREFIX = "'collection02/level-2/standard/oli-tirs/2024/' || substr(scene_id, 11, 3) || '/' || substr(scene_id, 14, 3) || '/' || scene_id || '/'"


@query(
    "object_keys",
    X.with_(
        "files",
        f"SELECT scene_id, band, {_PREFIX} AS prefix, {_PREFIX} || scene_id || '_SR_' || band || '.TIF' AS band_key, "
        f"{_PREFIX} || scene_id || '_MTL.json' AS metadata_key, "
        f"'s3://usgs-landsat/' || {_PREFIX} || scene_id || '_SR_' || band || '.TIF' AS href, "
        "'data/raw/' || scene_id || '/' || scene_id || '_SR_' || band || '.TIF' AS band_path, "
        "'data/raw/' || scene_id || '/' || scene_id || '_MTL.json' AS metadata_path FROM files",
    ),
)
def object_keys(spark, sf_dir):
    # Lower-case and bare band numbers are the same band.
    spelled = F.when(F.col("o_orderkey") % 2 == 0, F.lower("band")).otherwise(F.substring("band", 2, 2))
    key = I.band_key("scene_id", spelled)
    return X.files(spark, sf_dir).select(
        "scene_id",
        I.band_label(spelled).alias("band"),
        I.scene_prefix("scene_id").alias("prefix"),
        key.alias("band_key"),
        I.metadata_key("scene_id").alias("metadata_key"),
        I.bucket_href("usgs-landsat", key).alias("href"),
        I.local_band_path("data/raw", "scene_id", spelled).alias("band_path"),
        I.local_metadata_path("data/raw", "scene_id").alias("metadata_path"),
    )


_ROWS = [f"{n:03d}" for n in range(20, 140)]
_DATES = [f"202407{d:02d}" for d in range(5, 15)]


def _listed(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


@query(
    "scene_filter",
    X.with_(
        "scenes",
        "SELECT scene_id FROM scenes WHERE substr(scene_id, 11, 3) = '000' "
        f"AND substr(scene_id, 14, 3) IN {_listed(_ROWS)} AND substr(scene_id, 18, 8) IN {_listed(_DATES)}",
    ),
)
def scene_filter(spark, sf_dir):
    return S.filter_scenes(X.scenes(spark, sf_dir).select("scene_id"), "000", _ROWS, _DATES)


_FOUND = {
    "named": "SELECT CASE WHEN item_id LIKE '%\\_SR' ESCAPE '\\' THEN left(item_id, length(item_id) - 3) ELSE item_id END AS scene_id, "
    "coalesce(cloud_cover, 100) AS cloud_cover FROM stac_items",
    "found": "SELECT scene_id, min(cloud_cover) AS cloud_cover FROM named WHERE cloud_cover < 60 GROUP BY scene_id",
}


@query(
    "scene_discovery",
    X.with_("stac_items", "SELECT scene_id, cloud_cover FROM found WHERE substr(scene_id, 14, 3) IN ('032', '033')", **_FOUND),
)
def scene_discovery(spark, sf_dir):
    return P.select_scenes(X.stac_items(spark, sf_dir), 60.0, wrs_path="044", rows=["032", "033"])


@query(
    "clearest_scenes_topk",
    X.with_("stac_items", "SELECT scene_id, cloud_cover FROM found ORDER BY cloud_cover, scene_id LIMIT 5", **_FOUND),
)
def clearest_scenes_topk(spark, sf_dir):
    return S.clearest(S.discovered_scenes(X.stac_items(spark, sf_dir), 60.0), 5)


_ORDER_BANDS = {
    "have": f"SELECT DISTINCT {X.CAT_ID.format(k='l_orderkey')} AS scene_id, 'B' || CAST(1 + l_linenumber AS string) AS band FROM lineitem",
    "want": f"SELECT {X.CAT_ID.format(k='o_orderkey')} AS scene_id, band FROM orders CROSS JOIN (VALUES ('B3'), ('B4'), ('B5'), ('B7')) v(band)",
}


@query(
    "missing_bands",
    X.with_(
        "",
        "SELECT scene_id, string_agg(band, ',' ORDER BY band) AS missing FROM (SELECT * FROM want EXCEPT SELECT * FROM have) GROUP BY scene_id",
        **_ORDER_BANDS,
    ),
)
def missing_bands(spark, sf_dir):
    scenes = X.table(spark, sf_dir, "orders").selectExpr(X.CAT_ID.format(k="o_orderkey") + " AS scene_id")
    have = X.table(spark, sf_dir, "lineitem").selectExpr(
        X.CAT_ID.format(k="l_orderkey") + " AS scene_id", "'B' || CAST(1 + l_linenumber AS string) AS band"
    )
    return S.missing_bands(scenes, have)


@query(
    "transfer_plan",
    X.with_(
        "scenes files",
        "SELECT scene_id, label, object_key, path FROM want WHERE path NOT IN (SELECT path FROM have)",
        want="SELECT scene_id, label, " + _PREFIX + " || scene_id || tail AS object_key, "
        "'data/raw/' || scene_id || '/' || scene_id || tail AS path FROM scenes CROSS JOIN (VALUES "
        + ", ".join(f"('B{b}', '_SR_B{b}.TIF')" for b in range(2, 8))
        + ", ('MTL', '_MTL.json')) v(label, tail)",
        have="SELECT 'data/raw/' || scene_id || '/' || scene_id || '_SR_' || band || '.TIF' AS path FROM files WHERE o_orderkey % 5 > 0",
    ),
)
def transfer_plan(spark, sf_dir):
    existing = X.files(spark, sf_dir).select(
        I.local_band_path("data/raw", "scene_id", "band").alias("path"), (F.col("o_orderkey") % 5).alias("length")
    )
    return M.transfer_plan(M.wanted_objects(X.scenes(spark, sf_dir)), existing)


_FLAGS = {
    "in_exists": "o_orderkey % 13 <> 0",
    "in_valid": "o_orderkey % 3 = 0",
    "out_exists": "o_orderkey % 4 <> 1",
    "out_valid": "o_orderkey % 7 <> 2",
    "force": "o_orderkey % 10 = 0",
}
_STATUS = (
    "CASE WHEN o_orderkey % 13 = 0 THEN 'failed' WHEN o_orderkey % 4 <> 1 AND o_orderkey % 7 <> 2 AND o_orderkey % 10 <> 0 "
    "THEN 'skipped' WHEN o_orderkey % 3 = 0 THEN 'validated' ELSE 'converted' END"
)


def _outcomes(spark, sf_dir):
    flags = [f"{e} AS {n}" for n, e in _FLAGS.items()]
    manifest = X.table(spark, sf_dir, "orders").selectExpr("o_orderkey", X.CAT_ID.format(k="o_custkey") + " AS scene_id", *flags)
    return M.with_conversion_status(manifest)


@query("cog_plan", f"SELECT o_orderkey, {X.CAT_ID.format(k='o_custkey')} AS scene_id, {_STATUS} AS status FROM orders")
def cog_plan(spark, sf_dir):
    return _outcomes(spark, sf_dir).select("o_orderkey", "scene_id", "status")


@query(
    "outcome_report",
    f"WITH o AS (SELECT {X.CAT_ID.format(k='o_custkey')} AS scene_id, {_STATUS} AS status FROM orders) "
    "SELECT scene_id, "
    + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS n_{s}" for s in M.STATUSES)
    + ", count(*) AS n_files, bool_or(status = 'failed') AS failed FROM o GROUP BY scene_id",
)
def outcome_report(spark, sf_dir):
    return M.outcome_report(_outcomes(spark, sf_dir))
