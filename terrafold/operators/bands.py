"""Band grids: blocks, pixels, alignment, indices and clipping."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions.edges import coerce_bbox
from terrafold.functions.projection import project_bbox
from terrafold.functions.spectral import (
    FILL_DN,
    INDEX_BANDS,
    REQUIRED_INDEX_BANDS,
    encode_index,
    reflectance,
    spectral_indices,
)

BLOCK_COLUMNS = (
    "scene_id", "band", "block_row", "block_col", "x0", "y0", "pixel_size",
    "width", "height", "epsg", "data",
)

#: Values that a task holds at once while it fills or cuts blocks.
VALUES_PER_BATCH = 1 << 20


def block_size(blocks: DataFrame) -> DataFrame:
    """Blocks with their grid envelope, for pruning before any pixel is unpacked."""
    return blocks.withColumns(
        {
            "min_x": F.col("x0"),
            "max_x": F.col("x0") + F.col("width") * F.col("pixel_size"),
            "min_y": F.col("y0") - F.col("height") * F.col("pixel_size"),
            "max_y": F.col("y0"),
        }
    )


def blocks_to_pixels(blocks: DataFrame, band: str | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """One row per pixel of a block, with the pixel centre's grid coordinates.

    ``extra`` names block columns, such as ``epsg``, that go with every pixel.

    ``x0``/``y0`` is the outer corner of the block's first pixel and ``first_row`` /
    ``first_col`` its address in the scene. Pixel order is row-major. Where blocks have a
    ``nodata`` value, pixels of that value (or not a number) are NULL.
    """
    if band is not None:
        blocks = blocks.filter(F.col("band") == band)
    i, w = F.col("pos"), F.col("width")
    row, col = F.expr("pos div width"), i % w
    value, nodata = F.col("dn"), []
    if "nodata" in blocks.columns:
        nodata = ["nodata"]
        value = F.when(F.col("nodata").isNull() | ((value != F.col("nodata")) & ~F.isnan(value.cast("double"))), value)
    return blocks.select(
        "scene_id", "band", "first_row", "first_col", "x0", "y0", "pixel_size", "width", *nodata, *extra,
        F.posexplode("data").alias("pos", "dn"),
    ).select(
        "scene_id",
        "band",
        (F.col("first_row") + row).cast("bigint").alias("row_no"),
        (F.col("first_col") + col).cast("bigint").alias("col_no"),
        (F.col("x0") + (col + 0.5) * F.col("pixel_size")).alias("x"),
        (F.col("y0") - (row + 0.5) * F.col("pixel_size")).alias("y"),
        value.alias("dn"),
        *extra,
    )


def indices_from_blocks(blocks: DataFrame, names: Sequence[str]) -> DataFrame:
    """Index rasters to one row per pixel with a column per index.

    ``blocks`` have the index in ``index_name``. Nodata is NULL; a pixel without any index is
    no row. Indices of one pixel meet in one aggregation that combines before its shuffle.
    The code of the blocks' system goes along as ``epsg``.
    """
    pixels = blocks_to_pixels(blocks.withColumn("band", F.col("index_name")), extra=["epsg"])
    chosen = pixels.filter(F.col("band").isin(list(names)) & F.col("dn").isNotNull())
    values = [F.max(F.when(F.col("band") == n, F.col("dn"))).alias(n) for n in names]
    return chosen.groupBy("scene_id", "x", "y", "epsg").agg(*values)


def _group_starts(rows: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Where a new group begins in rows that are sorted by ``keys``."""
    if not rows.num_rows:
        return np.zeros(0, np.int64)
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for k in keys:
        here, before = rows.column(k).slice(1), rows.column(k).slice(0, rows.num_rows - 1)
        differ = pc.or_(pc.fill_null(pc.not_equal(here, before), False), pc.xor(here.is_null(), before.is_null()))
        new[1:] |= differ.to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def pixels_to_blocks(
    pixels: DataFrame, value: str, block: int, fill: float, value_type: str = "int",
    keys: Sequence[str] = ("scene_id", "band"),
) -> DataFrame:
    """Pack pixels into dense square blocks; absent pixels take ``fill``.

    Duplicate addresses are reduced first, so a group never holds more than block x block
    rows whatever the input looks like.
    """
    keys = list(keys)
    dtype = {"int": np.int32, "float": np.float32, "double": np.float64}[value_type]
    addressed = pixels.select(
        *keys,
        F.expr(f"row_no div {block}").alias("block_row"),
        F.expr(f"col_no div {block}").alias("block_col"),
        ((F.col("row_no") % block) * block + F.col("col_no") % block).cast("int").alias("pos"),
        F.col(value).cast(value_type).alias("v"),
    )
    group = [*keys, "block_row", "block_col"]
    single = addressed.groupBy(*group, "pos").agg(F.max("v").alias("v"))
    # Groups lie one after the other, and so are filled many at a time.
    sorted_ = single.repartition(*group).sortWithinPartitions(*group)
    side, most = block * block, max(1, VALUES_PER_BATCH // (block * block))

    def filled(rows: pa.RecordBatch, first: np.ndarray) -> pa.RecordBatch:
        """Blocks of whole groups, which start at the rows ``first``."""
        of = np.repeat(np.arange(len(first)), np.diff(np.append(first, rows.num_rows)))
        pos, v = rows.column("pos").to_numpy(), rows.column("v")
        present = v.is_valid().to_numpy(zero_copy_only=False)
        out = np.full((len(first), side), fill, dtype=dtype)
        out[of[present], pos[present]] = v.drop_null().to_numpy()
        ends = np.arange(0, out.size + 1, side, dtype=np.int32)
        heads = [rows.column(k).take(pa.array(first)) for k in group]
        return pa.RecordBatch.from_arrays([*heads, pa.ListArray.from_arrays(ends, out.ravel())], names=[*group, "data"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pa.concat_batches([rest, batch])
            first = _group_starts(rows, group)
            # The last group may go on in the next batch.
            for i in range(0, len(first) - 1, most):
                end = min(i + most, len(first) - 1)
                yield filled(rows.slice(first[i], first[end] - first[i]), first[i:end] - first[i])
            rest = rows.slice(first[-1]) if len(first) else None
        if rest is not None:
            yield filled(rest, np.zeros(1, np.int64))

    key_ddl = ", ".join(f"{k} {addressed.schema[k].dataType.simpleString()}" for k in group)
    packed = sorted_.mapInArrow(pack, f"{key_ddl}, data array<{value_type}>")
    return packed.withColumns(
        {
            "first_row": F.col("block_row") * block,
            "first_col": F.col("block_col") * block,
            "width": F.lit(block),
            "height": F.lit(block),
        }
    )


def align_bands(
    dn_long: DataFrame,
    keys: Sequence[str],
    bands: Sequence[str] = REQUIRED_INDEX_BANDS,
) -> DataFrame:
    """Bring the bands of one pixel onto one row; pixels lacking any band are dropped.

    Equals joining one table per band on the pixel address, but costs one shuffle and
    combines before it.
    """
    wide = (
        dn_long.filter(F.col("band").isin(list(bands)))
        .groupBy(*keys)
        .agg(*[F.max(F.when(F.col("band") == b, F.col("dn"))).alias(b.lower()) for b in bands])
    )
    return wide.dropna(subset=[b.lower() for b in bands])


#: Sides, in pixels, of the common tiles that unlike blocks are cut into.
TILE = 256


def align_block_bands(blocks: DataFrame, bands: Sequence[str] = REQUIRED_INDEX_BANDS, tile: int = TILE) -> DataFrame:
    """Align bands block by block, then unpack pixels; ``epsg`` goes along.

    Where all bands have the same block, the shuffle moves one row per block instead of one
    per pixel. Blocks that not all bands have, be they tiles of another size, strips or the
    edge of a band, are cut into common tiles and aligned there. Pixels lacking any band are
    dropped, as in :func:`align_bands`. Bands may start a whole number of pixels apart; rows
    and columns are then counted from the first band's corner. Bands of one scene that have
    another pixel size, system or a grid shifted by part of a pixel are an error.
    """
    keys = ["scene_id", "first_row", "first_col", "x0", "y0", "pixel_size", "width", "height", "epsg"]
    names = [b.lower() for b in bands]
    wide = (
        blocks.filter(F.col("band").isin(list(bands)))
        .groupBy(*keys)
        .agg(*[F.first(F.when(F.col("band") == b, F.col("data")), ignorenulls=True).alias(b.lower()) for b in bands])
    )
    whole = F.lit(True)
    for n in names:
        whole = whole & F.col(n).isNotNull()
    row, col = F.expr("pos div width"), F.col("pos") % F.col("width")
    alike = wide.filter(whole).select(
        *keys, F.posexplode(F.arrays_zip(*names)).alias("pos", "dn")
    ).select(
        "scene_id",
        (F.col("first_row") + row).cast("bigint").alias("row_no"),
        (F.col("first_col") + col).cast("bigint").alias("col_no"),
        (F.col("x0") + (col + 0.5) * F.col("pixel_size")).alias("x"),
        (F.col("y0") - (row + 0.5) * F.col("pixel_size")).alias("y"),
        "epsg",
        *[F.col(f"dn.{n}").alias(n) for n in names],
    )
    each = F.array(*[F.struct(F.lit(b).alias("band"), F.col(b.lower()).alias("data")) for b in bands])
    unlike = wide.filter(~whole).select(*keys, F.inline(each)).filter(F.col("data").isNotNull())
    return alike.unionByName(align_unlike_blocks(unlike, bands, tile))


def _part(pixels: Column) -> Column:
    """How far a number of pixels is past a whole one, to a thousandth."""
    return F.pmod(F.round(pixels, 3), F.lit(1.0))


def one_grid_per_scene(blocks: DataFrame) -> DataFrame:
    """The blocks; an error where those of a scene do not lie on one grid of pixels."""
    part = lambda c: _part(F.col(c) / F.col("pixel_size"))
    grid = F.struct(F.col("pixel_size"), F.col("epsg"), part("x0").alias("x_part"), part("y0").alias("y_part"))
    told = blocks.withColumn("__grid", F.to_json(grid))
    grids = told.groupBy("scene_id").agg(F.min("__grid").alias("__least"), F.max("__grid").alias("__most"))
    # One scene with two grids is enough to stop, so a single row is sent to all tasks; blocks stay where they are.
    two = F.broadcast(grids.filter("__least <> __most").withColumnRenamed("scene_id", "__scene").limit(1))
    wrong = F.concat(F.lit("bands of "), F.col("scene_id"), F.lit(" lie on different grids: "), F.col("__least"), F.lit(" and "), F.col("__most"))
    same = F.when(F.col("__least").isNull(), True).otherwise(F.raise_error(wrong).cast("boolean"))
    checked = blocks.join(two, F.col("scene_id").eqNullSafe(F.col("__scene")), "left")
    return checked.filter(same).drop("__scene", "__least", "__most")


def cut_blocks(blocks: DataFrame, tile: int = TILE) -> DataFrame:
    """Blocks cut where the common tiles of their grid meet; a piece has its place in its tile.

    Tiles are counted from the origin of the coordinate system, so they do not depend on how
    any band is stored. A block is read once, whatever the number of its tiles, and each of
    its values is copied once.
    """
    whole = lambda pixels: F.round(pixels - _part(pixels)).cast("bigint")
    size = F.col("pixel_size")
    placed = blocks.withColumns({"__top": whole(-F.col("y0") / size), "__left": whole(F.col("x0") / size)})
    placed = placed.select(
        "scene_id", "band", "pixel_size", "epsg",
        (F.col("__top") - F.col("first_row")).alias("top"),
        (F.col("__left") - F.col("first_col")).alias("left"),
        (F.col("x0") - F.col("first_col") * size).alias("corner_x"),
        (F.col("y0") + F.col("first_row") * size).alias("corner_y"),
        "__top", "__left", F.col("height").cast("int").alias("__h"), F.col("width").cast("int").alias("__w"), "data",
    )
    kept = ["scene_id", "band", "pixel_size", "epsg", "top", "left", "corner_x", "corner_y"]
    counted = ["tile_row", "tile_col", "row", "col", "height", "width"]

    def pieces(top: int, left: int, height: int, width: int) -> Iterator[tuple]:
        """Tile, place in it, size, and the values' indices in the block, for every tile in reach."""
        for r in range(top // tile, (top + height - 1) // tile + 1):
            r0, r1 = max(r * tile - top, 0), min((r + 1) * tile - top, height)
            for c in range(left // tile, (left + width - 1) // tile + 1):
                c0, c1 = max(c * tile - left, 0), min((c + 1) * tile - left, width)
                at = (np.arange(r0, r1)[:, None] * width + np.arange(c0, c1)).ravel()
                yield (r, c, top + r0 - r * tile, left + c0 - c * tile, r1 - r0, c1 - c0), at

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("data").flatten()
            starts = np.concatenate([[0], np.cumsum(batch.column("data").value_lengths().to_numpy())])
            frames = (batch.column(n).to_pylist() for n in ("__top", "__left", "__h", "__w"))
            found, held = [], 0
            for i, frame in enumerate(zip(*frames)):
                for head, at in pieces(*frame):
                    found.append((i, head, at + starts[i]))
                    held += len(at)
                    if held >= VALUES_PER_BATCH:
                        yield taken(batch, values, found)
                        found, held = [], 0
            if found:
                yield taken(batch, values, found)

    def taken(batch: pa.RecordBatch, values: pa.Array, found: list[tuple]) -> pa.RecordBatch:
        of = pa.array([i for i, _, _ in found])
        heads = np.array([head for _, head, _ in found], np.int64).T
        ends = np.cumsum([0, *[len(at) for _, _, at in found]]).astype(np.int32)
        data = pa.ListArray.from_arrays(ends, values.take(pa.array(np.concatenate([at for _, _, at in found]))))
        columns = [batch.column(k).take(of) for k in kept]
        columns += [pa.array(h if n.startswith("tile") else h.astype(np.int32)) for n, h in zip(counted, heads)]
        return pa.RecordBatch.from_arrays([*columns, data], names=[*kept, *counted, "data"])

    ddl = ", ".join(f"{k} {placed.schema[k].dataType.simpleString()}" for k in kept)
    ddl += ", tile_row bigint, tile_col bigint, row int, col int, height int, width int"
    return placed.mapInArrow(cut, f"{ddl}, data {blocks.schema['data'].dataType.simpleString()}")


def align_unlike_blocks(blocks: DataFrame, bands: Sequence[str], tile: int = TILE) -> DataFrame:
    """Pixels of bands whose blocks differ, brought together in common tiles.

    A group is the pieces of one tile of one scene: as many values as bands and pixels of a
    tile, however the bands are stored.
    """
    pieces = cut_blocks(one_grid_per_scene(blocks), tile)
    names, element = [b.lower() for b in bands], pieces.schema["data"].dataType.elementType
    dtype = {"double": np.float64, "float": np.float32, "int": np.int32, "smallint": np.int16, "bigint": np.int64}[element.simpleString()]

    def assemble(f: pd.DataFrame) -> pd.DataFrame:
        values, there = np.zeros((len(bands), tile, tile), dtype), np.zeros((len(bands), tile, tile), bool)
        place = {b: i for i, b in enumerate(bands)}
        for p in f.itertuples(index=False):
            data = np.asarray(p.data)
            known = ~pd.isna(data)
            at = place[p.band], slice(p.row, p.row + p.height), slice(p.col, p.col + p.width)
            values[at] = np.where(known, data, 0).astype(dtype).reshape(p.height, p.width)
            there[at] = known.reshape(p.height, p.width)
        row, col = np.nonzero(there.all(0))
        if not len(row):
            return pd.DataFrame(columns=[*single, "row", "col", *names])
        # Rows, columns and coordinates are counted from the first band's own corner.
        head = f[f["band"] == bands[0]].iloc[0]
        found = {n: [values[i, row, col]] for i, n in enumerate(names)}
        return pd.DataFrame({c: [head[c]] for c in single} | {"row": [row.astype(np.int32)], "col": [col.astype(np.int32)]} | found)

    single = ["scene_id", "tile_row", "tile_col", "pixel_size", "epsg", "top", "left", "corner_x", "corner_y"]
    schema = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in single) + ", row array<int>, col array<int>, "
    schema += ", ".join(f"{n} array<{element.simpleString()}>" for n in names)
    together = pieces.groupBy("scene_id", "tile_row", "tile_col").applyInPandas(assemble, schema)
    spread = together.select(*single, F.explode(F.arrays_zip("row", "col", *names)).alias("p")).withColumns(
        {
            "row_no": (F.col("tile_row") * tile + F.col("p.row") - F.col("top")).cast("bigint"),
            "col_no": (F.col("tile_col") * tile + F.col("p.col") - F.col("left")).cast("bigint"),
        }
    )
    return spread.select(
        "scene_id",
        "row_no",
        "col_no",
        (F.col("corner_x") + (F.col("col_no") + 0.5) * F.col("pixel_size")).alias("x"),
        (F.col("corner_y") - (F.col("row_no") + 0.5) * F.col("pixel_size")).alias("y"),
        "epsg",
        *[F.col(f"p.{n}").alias(n) for n in names],
    )


def with_indices(
    aligned: DataFrame, keep: Sequence[str], bands: Sequence[str] = REQUIRED_INDEX_BANDS
) -> DataFrame:
    """Reflectance of every band, then every index, in two projections."""
    names = {b: b.lower() for b in bands}
    missing = sorted(b for b, n in names.items() if n not in aligned.columns)
    if missing:
        raise ValueError(f"Missing required bands for spectral indices: {missing}")
    scaled = aligned.select(*keep, *[reflectance(n).alias(n) for n in names.values()])
    return scaled.select(*keep, *spectral_indices(names))


def encoded_indices(indices: DataFrame) -> DataFrame:
    """Replace every index by its stored single-precision form."""
    return indices.withColumns({name: encode_index(name) for name in INDEX_BANDS})


def clip_to_bbox(pixels: DataFrame, bbox, epsg: int, half_pixel: float) -> DataFrame:
    """Keep pixels whose square meets a lon/lat box.

    The box is projected once on the driver and becomes four literal comparisons on
    ``x``/``y``, which reach the Parquet scan.
    """
    min_x, min_y, max_x, max_y = project_bbox(coerce_bbox(bbox), epsg)
    return pixels.filter(
        F.col("x").between(min_x - half_pixel, max_x + half_pixel)
        & F.col("y").between(min_y - half_pixel, max_y + half_pixel)
    )


def clip_to_box_columns(pixels: DataFrame, half_pixel: Column | float) -> DataFrame:
    """Keep pixels whose square meets the box in their own ``box_*`` columns."""
    return pixels.filter(
        (F.col("x") >= F.col("box_min_x") - half_pixel)
        & (F.col("x") <= F.col("box_max_x") + half_pixel)
        & (F.col("y") >= F.col("box_min_y") - half_pixel)
        & (F.col("y") <= F.col("box_max_y") + half_pixel)
    )


def valid_pixels(pixels: DataFrame, dn: str = "dn") -> DataFrame:
    """Pixels that carry data."""
    return pixels.filter(F.col(dn) != FILL_DN)
