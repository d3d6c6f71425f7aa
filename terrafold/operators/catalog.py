"""Catalog tables: metadata, band dimension, items, collection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions import metadata as M
from terrafold.functions import scene_ids as S
from terrafold.functions.edges import bbox_ring
from terrafold.sources.shared import fresh_path

# Band label, name, common name, centre wavelength and width in micrometres.
LANDSAT9_BANDS = (
    ("B2", "blue", "blue", 0.482, 0.060),
    ("B3", "green", "green", 0.562, 0.057),
    ("B4", "red", "red", 0.655, 0.038),
    ("B5", "nir08", "nir08", 0.865, 0.028),
    ("B6", "swir16", "swir16", 1.610, 0.085),
    ("B7", "swir22", "swir22", 2.200, 0.200),
)
BAND_SCHEMA = (
    "band string, band_name string, common_name string, "
    "center_wavelength double, full_width_half_max double"
)

# Fixed values of the item, collection and catalog documents.
STAC_VERSION = "1.1.0"
STAC_EXTENSIONS = (
    "https://stac-extensions.github.io/eo/v1.1.0/schema.json",
    "https://stac-extensions.github.io/projection/v2.0.0/schema.json",
    "https://stac-extensions.github.io/view/v1.0.0/schema.json",
)
RASTER_MEDIA_TYPE = "image/tiff; application=geotiff; profile=cloud-optimized"
PLATFORM = "landsat-9"
INSTRUMENTS = ("OLI", "TIRS")
CONSTELLATION = "landsat"
REQUIRED_ITEM_BANDS = ("B4", "B5")


def band_dimension(spark: SparkSession) -> DataFrame:
    """The six surface-reflectance bands."""
    return spark.createDataFrame(list(LANDSAT9_BANDS), BAND_SCHEMA)


def join_band_dimension(df: DataFrame) -> DataFrame:
    """Attach band names and wavelengths (a table of six rows is always broadcast)."""
    return df.join(F.broadcast(band_dimension(df.sparkSession)), "band", "inner")


def parse_metadata(documents: DataFrame, text: str = "document") -> DataFrame:
    """Metadata documents held as text, flattened to catalog fields."""
    parsed = documents.withColumn("__doc", F.from_json(text, M.METADATA_SCHEMA))
    return flatten_metadata(
        parsed.withColumns(
            {
                "__wrapped": F.col("__doc.LANDSAT_METADATA_FILE"),
                "__image": F.col("__doc.IMAGE_ATTRIBUTES"),
                "__projection": F.col("__doc.PROJECTION_ATTRIBUTES"),
            }
        )
    ).drop("__doc")


def flatten_metadata(parsed: DataFrame) -> DataFrame:
    """Fields of a document with or without the wrapper object."""
    wrapped = F.col("__wrapped").isNotNull()
    image = F.when(wrapped, F.col("__wrapped.IMAGE_ATTRIBUTES")).otherwise(F.col("__image"))
    projection = F.when(wrapped, F.col("__wrapped.PROJECTION_ATTRIBUTES")).otherwise(F.col("__projection"))
    staged = parsed.withColumns({"__i": image, "__p": projection})
    return staged.withColumns(M.metadata_fields(F.col("__i"), F.col("__p"))).drop(
        "__i", "__p", "__wrapped", "__image", "__projection"
    )


def scene_datetime(scene_time: Column, scene_id: Column) -> Column:
    """Centre time, or noon of the date in the id."""
    date = F.get(F.split(scene_id, "_"), F.lit(3))
    return F.coalesce(scene_time, M.noon_of_date(date))


def _band_struct(band: Column) -> Column:
    """Band description of a label, as a chain over the six fixed bands."""
    out = None
    for label, name, common, wavelength, width in LANDSAT9_BANDS:
        value = F.struct(
            F.lit(name).alias("name"),
            F.lit(common).alias("common_name"),
            F.lit(wavelength).alias("center_wavelength"),
            F.lit(width).alias("full_width_half_max"),
        )
        out = F.when(band == label, value) if out is None else out.when(band == label, value)
    return out


def scene_assets(
    bands: DataFrame, href_bucket: str | None, collection_prefix: str = S.COLLECTION_PREFIX
) -> DataFrame:
    """One row per scene: ``bands`` (sorted labels) and ``hrefs`` (label to address).

    Only the declared bands count, and repeated files of one band collapse first, so the
    lists hold at most six entries. Addresses are bucket keys, or the local ``path`` when
    no bucket is given.
    """
    declared = bands.filter(F.col("band").isin([b[0] for b in LANDSAT9_BANDS]))
    one = declared.groupBy("scene_id", "band").agg(F.min("path").alias("path"))
    href = (
        F.col("path")
        if href_bucket is None
        else S.bucket_href(href_bucket, S.band_key("scene_id", "band", collection_prefix))
    )
    entry = F.struct(F.col("band").alias("band"), href.alias("href"))
    return (
        one.groupBy("scene_id")
        .agg(F.array_sort(F.collect_list(entry)).alias("__assets"))
        .select(
            "scene_id",
            F.col("__assets.band").alias("bands"),
            F.map_from_entries("__assets").alias("hrefs"),
        )
    )


def build_items(
    scenes: DataFrame,
    metadata: DataFrame,
    bands: DataFrame,
    boxes: DataFrame,
    *,
    href_bucket: str | None = "usgs-landsat",
    collection_prefix: str = S.COLLECTION_PREFIX,
    metadata_root: str = "data/raw",
    required: Sequence[str] = REQUIRED_ITEM_BANDS,
    keep_incomplete: bool = False,
) -> DataFrame:
    """Catalog items as a flat table: one row per scene that has its required bands.

    ``scenes(scene_id)``, ``metadata(scene_id, cloud_cover, ...)``, ``bands(scene_id, band,
    path)`` and ``boxes(scene_id, west, south, east, north)`` share the scene id, so after
    one shuffle of each the three joins need no other exchange.
    """
    assets = scene_assets(bands, href_bucket, collection_prefix)
    items = scenes.join(metadata, "scene_id").join(assets, "scene_id").join(boxes, "scene_id")
    if not keep_incomplete:
        items = items.filter(
            F.size(F.array_except(F.array(*[F.lit(b) for b in required]), F.col("bands"))) == 0
        )
    parts = S.scene_parts("scene_id")
    mtl = (
        S.local_metadata_path(metadata_root, "scene_id")
        if href_bucket is None
        else S.bucket_href(href_bucket, S.metadata_key("scene_id", collection_prefix))
    )
    return items.select(
        "scene_id",
        scene_datetime(F.col("scene_time"), F.col("scene_id")).alias("datetime"),
        "west", "south", "east", "north",
        parts["wrs_path"].alias("wrs_path"),
        parts["wrs_row"].alias("wrs_row"),
        "cloud_cover", "sun_elevation", "sun_azimuth", "epsg",
        F.coalesce(
            "proj_shape", F.array(*[F.lit(v).cast("bigint") for v in M.DEFAULT_SHAPE])
        ).alias("proj_shape"),
        "proj_transform",
        "bands",
        "hrefs",
        mtl.alias("metadata_href"),
    )


def rejected_scenes(
    scenes: DataFrame, metadata: DataFrame, bands: DataFrame, required: Sequence[str] = REQUIRED_ITEM_BANDS
) -> DataFrame:
    """Scenes that :func:`catalog_items` leaves out, and why.

    ``reason`` is ``invalid id``, ``no metadata`` or ``missing bands``, ``missing`` names the
    bands; the first reason that holds is given.
    """
    owned = bands.groupBy("scene_id").agg(F.collect_set("band").alias("__bands"))
    known = metadata.select("scene_id", F.lit(True).alias("__known")).distinct()
    joined = scenes.select("scene_id").distinct().join(known, "scene_id", "left").join(owned, "scene_id", "left")
    wanted = F.array(*[F.lit(b) for b in required])
    missing = F.array_sort(F.array_except(wanted, F.coalesce("__bands", F.array().cast("array<string>"))))
    reason = (
        F.when(~F.coalesce(S.valid_scene_id("scene_id"), F.lit(False)), "invalid id")
        .when(F.col("__known").isNull(), "no metadata")
        .when(F.size(missing) > 0, "missing bands")
    )
    found = joined.select("scene_id", reason.alias("reason"), missing.alias("missing"))
    return found.filter("reason IS NOT NULL")


def require_complete(scenes: DataFrame, metadata: DataFrame, bands: DataFrame, required: Sequence[str] = REQUIRED_ITEM_BANDS) -> DataFrame:
    """The scenes, or an error that names some that could not become items."""
    bad = rejected_scenes(scenes, metadata, bands, required).limit(5).collect()
    if bad:
        raise ValueError("Scenes without an item: " + ", ".join(f"{r['scene_id']} ({r['reason']})" for r in bad))
    return scenes


def items_with_missing_bands(items: DataFrame, required: Sequence[str] = REQUIRED_ITEM_BANDS) -> DataFrame:
    """Items (built with ``keep_incomplete``) that lack a required band."""
    lacking = F.array_except(F.array(*[F.lit(b) for b in required]), F.col("bands"))
    return items.select("scene_id", F.array_sort(lacking).alias("missing")).filter(F.size("missing") > 0)


def _utc_text(ts: Column) -> Column:
    """Instant as ``YYYY-MM-DDTHH:MM:SSZ`` whatever the session time zone is."""
    utc = F.to_utc_timestamp(ts, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def item_documents(items: DataFrame, collection_id: str) -> DataFrame:
    """``scene_id`` and the nested item struct ``item``."""
    ring = bbox_ring(F.col("west"), F.col("south"), F.col("east"), F.col("north"))
    lit_array = lambda values: F.array(*[F.lit(v) for v in values])
    band_assets = F.transform(
        F.map_entries("hrefs"),
        lambda e: F.struct(
            e["key"].alias("key"),
            F.struct(
                e["value"].alias("href"),
                F.lit(RASTER_MEDIA_TYPE).alias("type"),
                F.concat(F.lit("Band "), e["key"]).alias("title"),
                F.filter(F.array(_band_struct(e["key"])), lambda b: b.isNotNull()).alias("eo:bands"),
                lit_array(["data"]).alias("roles"),
            ).alias("value"),
        ),
    )
    no_band = F.filter(F.array(_band_struct(F.lit(""))), lambda b: b.isNotNull())
    metadata_asset = F.array(
        F.struct(
            F.lit("MTL_JSON").alias("key"),
            F.struct(
                F.col("metadata_href").alias("href"),
                F.lit("application/json").alias("type"),
                F.lit("MTL JSON Metadata").alias("title"),
                no_band.alias("eo:bands"),
                lit_array(["metadata"]).alias("roles"),
            ).alias("value"),
        )
    )
    properties = F.struct(
        F.lit(PLATFORM).alias("platform"),
        lit_array(INSTRUMENTS).alias("instruments"),
        F.lit(CONSTELLATION).alias("constellation"),
        F.col("wrs_path").alias("landsat:wrs_path"),
        F.col("wrs_row").alias("landsat:wrs_row"),
        F.lit("L2SP").alias("landsat:processing_level"),
        F.lit("02").alias("landsat:collection_number"),
        F.lit("T1").alias("landsat:collection_category"),
        F.transform("bands", _band_struct).alias("eo:bands"),
        F.col("cloud_cover").alias("eo:cloud_cover"),
        F.concat(F.lit("EPSG:"), F.col("epsg").cast("string")).alias("proj:code"),
        F.col("proj_shape").alias("proj:shape"),
        F.col("proj_transform").alias("proj:transform"),
        F.col("sun_azimuth").alias("view:sun_azimuth"),
        F.col("sun_elevation").alias("view:sun_elevation"),
        _utc_text(F.col("datetime")).alias("datetime"),
    )
    item = F.struct(
        F.lit("Feature").alias("type"),
        F.lit(STAC_VERSION).alias("stac_version"),
        lit_array(STAC_EXTENSIONS).alias("stac_extensions"),
        F.col("scene_id").alias("id"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        F.array("west", "south", "east", "north").alias("bbox"),
        properties.alias("properties"),
        F.map_from_entries(F.concat(band_assets, metadata_asset)).alias("assets"),
        F.lit(collection_id).alias("collection"),
    )
    return items.select("scene_id", item.alias("item"))


def collection_extent(items: DataFrame) -> DataFrame:
    """Union of the boxes, first and last datetime, and number of items: one row."""
    return items.agg(
        F.min("west").alias("west"),
        F.min("south").alias("south"),
        F.max("east").alias("east"),
        F.max("north").alias("north"),
        F.min("datetime").alias("first_datetime"),
        F.max("datetime").alias("last_datetime"),
        F.count(F.lit(1)).alias("n_items"),
    )


def collection_document(
    items: DataFrame, collection_id: str, title: str, description: str, providers: Sequence[dict]
) -> DataFrame:
    """One row holding the collection struct ``collection``."""
    lit_array = lambda values: F.array(*[F.lit(v) for v in values])
    provider = lambda p: F.struct(
        F.lit(p["name"]).alias("name"), lit_array(p["roles"]).alias("roles"), F.lit(p["url"]).alias("url")
    )
    extent = collection_extent(items)
    summaries = F.struct(
        lit_array([PLATFORM]).alias("platform"),
        lit_array(INSTRUMENTS).alias("instruments"),
        F.array(*[_band_struct(F.lit(b[0])) for b in LANDSAT9_BANDS]).alias("eo:bands"),
    )
    return extent.select(
        F.struct(
            F.lit("Collection").alias("type"),
            F.lit(collection_id).alias("id"),
            F.lit(STAC_VERSION).alias("stac_version"),
            F.lit(title).alias("title"),
            F.lit(description).alias("description"),
            F.struct(
                F.struct(F.array(F.array("west", "south", "east", "north")).alias("bbox")).alias("spatial"),
                F.struct(
                    F.array(
                        F.array(_utc_text(F.col("first_datetime")), _utc_text(F.col("last_datetime")))
                    ).alias("interval")
                ).alias("temporal"),
            ).alias("extent"),
            F.lit("proprietary").alias("license"),
            F.array(*[provider(p) for p in providers]).alias("providers"),
            summaries.alias("summaries"),
        ).alias("collection"),
    )


def _link(rel: str, href: Column | str) -> Column:
    return F.struct(F.lit(rel).alias("rel"), (F.lit(href) if isinstance(href, str) else href).alias("href"), F.lit("application/json").alias("type"))


def _catalog(name: Column, text: Column, links: Column) -> Column:
    return F.struct(
        F.lit("Catalog").alias("type"), name.alias("id"), F.lit(STAC_VERSION).alias("stac_version"), text.alias("description"), links.alias("links")
    )


def tree_documents(
    items: DataFrame, collection: DataFrame, collection_id: str, catalog_id: str, description: str
) -> dict[str, tuple[DataFrame, list[str]]]:
    """Every document of a catalog, by level: a table with ``folder`` and ``document``, and its partition columns.

    Between the collection and the items stand a catalog for each path and one for each path
    and row of the scenes' reference system. So no document has more links than there are
    paths, rows of a path or scenes of one place, however many items there are. Links are
    relative to the document's own folder.
    """
    at_path = F.concat(F.lit("wrs_path="), F.col("wrs_path"))
    at_row = F.concat(at_path, F.lit("/wrs_row="), F.col("wrs_row"))
    below = lambda folder, place, up: F.concat(F.lit("../" * up + folder + "/"), place)
    places = items.groupBy("wrs_path", "wrs_row").agg(F.sort_array(F.collect_list("scene_id")).alias("ids"))
    paths = places.groupBy("wrs_path").agg(F.sort_array(F.collect_list("wrs_row")).alias("rows"))
    all_paths = paths.agg(F.sort_array(F.collect_list("wrs_path")).alias("paths"))

    root = _catalog(F.lit(catalog_id), F.lit(description), F.array(_link("root", "."), _link("self", "."), _link("child", "../collection")))
    children = F.transform("paths", lambda p: _link("child", F.concat(F.lit("../paths/wrs_path="), p)))
    own = F.array(_link("root", "../catalog"), _link("parent", "../catalog"), _link("self", "."))
    # Two tables of one row each.
    both = collection.withColumn("__one", F.lit(1)).join(all_paths.withColumn("__one", F.lit(1)), "__one")
    whole = both.select(F.struct("collection.*", F.concat(own, children).alias("links")).alias("document"))

    row_links = F.transform("rows", lambda r: _link("child", F.concat(F.lit("../../rows/"), at_path, F.lit("/wrs_row="), r)))
    up = F.array(_link("root", "../../catalog"), _link("parent", "../../collection"), _link("self", "."))
    by_path = _catalog(at_path, F.concat(F.lit("Scenes of path "), F.col("wrs_path")), F.concat(up, row_links))

    item_links = F.transform("ids", lambda i: _link("item", F.concat(F.lit("../../../items/"), at_row, F.lit("/id="), i)))
    up = F.array(_link("root", "../../../catalog"), _link("parent", below("paths", at_path, 3)), _link("self", "."))
    by_row = _catalog(at_row, F.concat(F.lit("Scenes of path "), F.col("wrs_path"), F.lit(", row "), F.col("wrs_row")), F.concat(up, item_links))

    up = F.array(
        _link("root", "../../../../catalog"), _link("parent", below("rows", at_row, 4)), _link("collection", "../../../../collection"), _link("self", ".")
    )
    documents = item_documents(items, collection_id).select("scene_id", "item.*")
    placed = documents.join(items.select("scene_id", "wrs_path", "wrs_row"), "scene_id").withColumnRenamed("scene_id", "__id")
    names = [f"`{c}`" for c in documents.columns if c != "scene_id"]
    single = placed.select(F.struct(*names, up.alias("links")).alias("document"), "wrs_path", "wrs_row", F.col("__id").alias("id"))
    return {
        "catalog": (all_paths.select(F.lit("catalog").alias("folder"), root.alias("document")), []),
        "collection": (whole.select(F.lit("collection").alias("folder"), "document"), []),
        "paths": (paths.select(F.concat(F.lit("paths/"), at_path).alias("folder"), by_path.alias("document")), []),
        "rows": (places.select(F.concat(F.lit("rows/"), at_row).alias("folder"), by_row.alias("document"), "wrs_path"), ["wrs_path"]),
        "items": (
            single.select(F.concat(F.lit("items/"), at_row, F.lit("/id="), F.col("id")).alias("folder"), "document", "wrs_path"),
            ["wrs_path"],
        ),
    }


def resolved(folder: Column, href: Column) -> Column:
    """The folder that a relative link names, seen from a document's own folder."""
    parts = F.filter(F.split(F.concat(folder, F.lit("/"), href), "/"), lambda p: (p != ".") & (p != ""))
    step = lambda done, p: F.when(p == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(p)))
    return F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")


def linked_documents(documents: DataFrame, root: str, levels: int = 8) -> DataFrame:
    """Documents (``folder, links``) that links lead to from the root, with how many it takes.

    Each level joins the links of the one before with the folders; a link to no document is
    an error, and so is a document whose parent link does not lead back. The documents are
    read and their links resolved once; both are kept in the shared folder.
    """
    spark = documents.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    documents = kept(documents, "documents")
    links = documents.select("folder", F.explode("links").alias("l")).filter(F.col("l.rel").isin("child", "item", "parent"))
    links = kept(links.select("folder", "l.rel", resolved(F.col("folder"), F.col("l.href")).alias("target")), "links")
    down = links.filter(F.col("rel").isin("child", "item")).select("folder", "target")
    parents = links.filter("rel = 'parent'").select(F.col("folder").alias("target"), F.col("target").alias("parent"))
    down = kept(down.join(parents, "target", "left"), "down")
    reached = documents.filter(F.col("folder") == root).select("folder", F.lit(0).alias("depth"))
    out = reached
    for depth in range(1, levels):
        ends = reached.select("folder").join(down, "folder")
        lost = F.concat(F.lit("the link from "), F.col("folder"), F.lit(" to "), F.col("target"), F.lit(" has no way back"))
        held = F.when(F.col("parent") == F.col("folder"), F.col("target")).otherwise(F.raise_error(lost).cast("string"))
        reached = ends.select(held.alias("folder"), F.lit(depth).alias("depth"))
        out = out.unionByName(reached)
    return out.join(documents, "folder")


def band_assets(items: DataFrame) -> DataFrame:
    """Items read back (``id, datetime, cloud_cover, assets``) as one row per band asset."""
    bands = F.map_filter("assets", lambda k, _: k.startswith("B"))
    return items.select("id", "datetime", "cloud_cover", F.explode(bands).alias("band", "asset")).select(
        "id", "datetime", "cloud_cover", "band", F.col("asset.href").alias("href")
    )
