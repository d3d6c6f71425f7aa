"""GeoTIFF bytes to block rows and back.

Read are strips and tiles of integers and floats, plain, deflate or LZW, with horizontal or
floating-point differencing, in files with 32-bit or 64-bit directories.

Decoding is the one step Spark has no expression for. A file is unpacked tile by tile
inside the task that read it, and every tile or strip becomes one block row; nothing
larger than one file is ever held.
"""

from __future__ import annotations

import struct
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions.scene_ids import path_parent_name, path_stem, strip_file_scheme

# Ship these helpers inside the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_FIELDS = (
    "block_row bigint, block_col bigint, first_row bigint, first_col bigint, x0 double, y0 double, "
    "pixel_size double, width int, height int, epsg int, nodata double, data array<{values}>"
)
#: Types that values may be delivered as.
VALUE_TYPES = {
    "double": np.dtype("f8"), "float": np.dtype("f4"), "bigint": np.dtype("i8"), "int": np.dtype("i4"), "smallint": np.dtype("i2"),
}

# Fixed values of the TIFF and GeoTIFF formats.
TAG_WIDTH, TAG_HEIGHT, TAG_BITS, TAG_COMPRESSION, TAG_PHOTOMETRIC = 256, 257, 258, 259, 262
TAG_STRIP_OFFSETS, TAG_SAMPLES, TAG_ROWS_PER_STRIP, TAG_STRIP_COUNTS = 273, 277, 278, 279
TAG_PLANAR, TAG_PREDICTOR, TAG_TILE_WIDTH, TAG_TILE_HEIGHT = 284, 317, 322, 323
TAG_TILE_OFFSETS, TAG_TILE_COUNTS, TAG_SAMPLE_FORMAT = 324, 325, 339
TAG_PIXEL_SCALE, TAG_TIEPOINT, TAG_GEO_KEYS, TAG_NODATA = 33550, 33922, 34735, 42113
KEY_RASTER_TYPE, KEY_GEOGRAPHIC, KEY_PROJECTED = 1025, 2048, 3072
PIXEL_IS_POINT = 2
COMPRESSION_NONE, COMPRESSION_LZW, COMPRESSION_DEFLATE, COMPRESSION_DEFLATE_OLD = 1, 5, 8, 32946
FIELD_FORMATS = {
    1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q",
}
LZW_CLEAR, LZW_END, LZW_FIRST, LZW_WIDEST = 256, 257, 9, 12
PREDICTOR_NONE, PREDICTOR_HORIZONTAL, PREDICTOR_FLOAT = 1, 2, 3
SAMPLE_KINDS = {1: "u", 2: "i", 3: "f"}


def _tags(raw: bytes) -> tuple[str, dict[int, tuple]]:
    """Byte order and the tag values of the first (full-resolution) directory.

    A 64-bit file differs in its version and in the width of counts, offsets and of what an
    entry holds itself.
    """
    order = {b"II": "<", b"MM": ">"}.get(raw[:2])
    version = struct.unpack_from(order + "H", raw, 2)[0] if order else None
    if version == 42:
        word, number, entries = "I", "H", 4
    elif version == 43 and struct.unpack_from(order + "HH", raw, 4) == (8, 0):
        word, number, entries = "Q", "Q", 8
    else:
        raise ValueError("not a baseline TIFF, nor one with 64-bit offsets")
    size = struct.calcsize(order + word)
    at = struct.unpack_from(order + word, raw, entries)[0]
    first = at + struct.calcsize(order + number)
    tags = {}
    for k in range(struct.unpack_from(order + number, raw, at)[0]):
        entry = first + (4 + 2 * size) * k
        tag, kind, count = struct.unpack_from(order + "HH" + word, raw, entry)
        if kind not in FIELD_FORMATS:
            continue
        code = FIELD_FORMATS[kind]
        layout = order + (f"{count}s" if code == "s" else code * count)
        where = entry + 4 + size
        if struct.calcsize(layout) > size:
            where = struct.unpack_from(order + word, raw, where)[0]
        tags[tag] = struct.unpack_from(layout, raw, where)
    return order, tags


def _geo_keys(tags: dict[int, tuple]) -> dict[int, int]:
    """Keys whose value stands in the directory itself."""
    keys = tags.get(TAG_GEO_KEYS, ())
    return {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}


def _corner(tags: dict[int, tuple], geo: dict[int, int]) -> tuple[float, float, float]:
    """Outer corner of the first pixel and the pixel size.

    The tie point names a pixel's corner or, where pixels are points, its centre.
    """
    scale = tags.get(TAG_PIXEL_SCALE, (1.0, 1.0, 0.0))
    if scale[0] != scale[1]:
        raise ValueError(f"pixels of {scale[0]} by {scale[1]} are not square")
    tie = tags.get(TAG_TIEPOINT, (0.0,) * 6)
    back = 0.5 if geo.get(KEY_RASTER_TYPE) == PIXEL_IS_POINT else 0.0
    return tie[3] - (tie[0] + back) * scale[0], tie[4] + (tie[1] + back) * scale[0], scale[0]


def unpack_lzw(packed: bytes) -> bytes:
    """Bytes of an LZW stream: codes of 9 to 12 bits, the highest bit first.

    A code grows by a bit one entry before the table needs it.
    """
    table: list[bytes] = [bytes((i,)) for i in range(256)] + [b"", b""]
    out, last, width, held, bits = [], None, LZW_FIRST, 0, 0
    for byte in packed:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == LZW_END:
            break
        if code == LZW_CLEAR:
            del table[258:]
            last, width = None, LZW_FIRST
            continue
        if code > len(table) or code == len(table) and last is None:
            raise ValueError(f"damaged LZW data: code {code} of {len(table)}")
        found = table[code] if code < len(table) else last + last[:1]
        out.append(found)
        if last is not None and len(table) < 1 << LZW_WIDEST:
            table.append(last + found[:1])
        last = found
        if len(table) >= (1 << width) - 1 and width < LZW_WIDEST:
            width += 1
    return b"".join(out)


def _samples(chunk: bytes, compression: int, dtype, rows: int, cols: int, depth: int, predictor: int):
    """Decoded values of one tile or strip as (rows, cols, depth)."""
    if compression in (COMPRESSION_DEFLATE, COMPRESSION_DEFLATE_OLD):
        chunk = zlib.decompress(chunk)
    elif compression == COMPRESSION_LZW:
        chunk = unpack_lzw(chunk)
    elif compression != COMPRESSION_NONE:
        raise ValueError(f"unsupported TIFF compression {compression}")
    if predictor == PREDICTOR_FLOAT:
        if dtype.kind != "f":
            raise ValueError("floating-point differencing of values that are no floats")
        # A row has the highest bytes of all values first, then the next ones, as differences.
        size = dtype.itemsize
        steps = np.frombuffer(chunk, np.uint8, rows * cols * depth * size).reshape(rows, -1, depth)
        planes = np.cumsum(steps, axis=1, dtype=np.uint8).reshape(rows, size, cols * depth)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(f">f{size}").reshape(rows, cols, depth)
    values = np.frombuffer(chunk, dtype=dtype, count=rows * cols * depth).reshape(rows, cols, depth)
    if predictor == PREDICTOR_HORIZONTAL:
        if dtype.kind == "f":
            raise ValueError("horizontal differencing of floats")
        values = np.cumsum(values, axis=1, dtype=values.dtype.newbyteorder("="))
    elif predictor != PREDICTOR_NONE:
        raise ValueError(f"unsupported TIFF predictor {predictor}")
    return values


def decode_blocks(
    raw: bytes, band: int = 1, value_type: str = "double", boxes: dict[int, tuple[float, float, float, float]] | None = None
) -> Iterator[dict]:
    """Blocks of one file. ``band`` is counted from 1.

    Values are delivered as ``value_type``; a file whose own type does not fit it is an error.
    ``boxes`` has a box ``min_x, min_y, max_x, max_y`` for each coordinate system: only tiles
    and strips that meet it are unpacked, and of a file in another system none.
    """
    order, tags = _tags(raw)
    width, height = tags[TAG_WIDTH][0], tags[TAG_HEIGHT][0]
    samples = tags.get(TAG_SAMPLES, (1,))[0]
    if not 1 <= band <= samples:
        raise ValueError(f"band {band} of a file with {samples}")
    bits = tags.get(TAG_BITS, (1,))[0]
    kind = SAMPLE_KINDS[tags.get(TAG_SAMPLE_FORMAT, (1,))[0]]
    dtype, wanted = np.dtype(f"{order}{kind}{bits // 8}"), VALUE_TYPES[value_type]
    if not np.can_cast(dtype, wanted) and wanted != VALUE_TYPES["double"]:
        raise ValueError(f"values of type {dtype.name} do not fit {value_type}")
    compression = tags.get(TAG_COMPRESSION, (COMPRESSION_NONE,))[0]
    predictor = tags.get(TAG_PREDICTOR, (1,))[0]
    separate = tags.get(TAG_PLANAR, (1,))[0] == 2
    depth = 1 if separate else samples

    tiled = TAG_TILE_OFFSETS in tags
    if tiled:
        bw, bh = tags[TAG_TILE_WIDTH][0], tags[TAG_TILE_HEIGHT][0]
        offsets, counts = tags[TAG_TILE_OFFSETS], tags[TAG_TILE_COUNTS]
    else:
        bw, bh = width, min(height, tags.get(TAG_ROWS_PER_STRIP, (height,))[0])
        offsets, counts = tags[TAG_STRIP_OFFSETS], tags[TAG_STRIP_COUNTS]
    across, down = -(-width // bw), -(-height // bh)

    geo = _geo_keys(tags)
    left, top, size = _corner(tags, geo)
    nodata = tags.get(TAG_NODATA)
    nodata = float(nodata[0].rstrip(b"\0 ").decode()) if nodata else None

    epsg = geo.get(KEY_PROJECTED, geo.get(KEY_GEOGRAPHIC))
    box = None if boxes is None else boxes.get(epsg)
    if boxes is not None and box is None:
        return
    skip = (band - 1) * across * down if separate else 0
    for k in range(across * down):
        r, c = divmod(k, across)
        rows, cols = min(bh, height - r * bh), min(bw, width - c * bw)
        if box is not None:
            x0, y1 = left + c * bw * size, top - r * bh * size
            if x0 > box[2] or x0 + cols * size < box[0] or y1 < box[1] or y1 - rows * size > box[3]:
                continue
        start, stored = offsets[skip + k], counts[skip + k]
        if stored:
            values = _samples(
                raw[start : start + stored], compression, dtype, bh if tiled else rows, bw, depth, predictor
            )[:rows, :cols, 0 if separate else band - 1]
        else:  # a sparse file leaves out tiles without data
            values = np.full((rows, cols), 0.0 if nodata is None else nodata, wanted)
        yield {
            "block_row": r, "block_col": c, "first_row": r * bh, "first_col": c * bw,
            "x0": left + c * bw * size, "y0": top - r * bh * size,
            "pixel_size": size, "width": cols, "height": rows,
            "epsg": epsg, "nodata": nodata,
            "data": values.astype(wanted).ravel(),
        }


def encode_geotiff(
    values: np.ndarray, x0: float, y0: float, pixel_size: float, epsg: int,
    nodata: float | None = None, tile: int | None = None, predictor: int = 1,
) -> bytes:
    """One single-band, deflate-compressed file. ``tile`` switches from one strip to tiles."""
    height, width = values.shape
    dtype = values.dtype.newbyteorder("<")

    def pack(part: np.ndarray) -> bytes:
        part = part.astype(dtype)
        if predictor == 2:
            part = np.concatenate([part[:, :1], np.diff(part, axis=1)], axis=1).astype(dtype)
        return zlib.compress(np.ascontiguousarray(part).tobytes())

    if tile is None:
        chunks = [pack(values)]
    else:
        padded = np.pad(values, ((0, -height % tile), (0, -width % tile)))
        chunks = [
            pack(padded[r : r + tile, c : c + tile])
            for r in range(0, padded.shape[0], tile)
            for c in range(0, padded.shape[1], tile)
        ]
    sample_format = {"u": 1, "i": 2, "f": 3}[values.dtype.kind]
    offsets = np.cumsum([8] + [len(c) for c in chunks])
    where, sizes = tuple(int(o) for o in offsets[:-1]), tuple(len(c) for c in chunks)
    tags = [
        (TAG_WIDTH, "I", (width,)), (TAG_HEIGHT, "I", (height,)),
        (TAG_BITS, "H", (values.dtype.itemsize * 8,)), (TAG_COMPRESSION, "H", (COMPRESSION_DEFLATE,)),
        (TAG_PHOTOMETRIC, "H", (1,)), (TAG_SAMPLES, "H", (1,)), (TAG_PREDICTOR, "H", (predictor,)),
        (TAG_SAMPLE_FORMAT, "H", (sample_format,)),
        (TAG_PIXEL_SCALE, "d", (pixel_size, pixel_size, 0.0)),
        (TAG_TIEPOINT, "d", (0.0, 0.0, 0.0, x0, y0, 0.0)),
        (TAG_GEO_KEYS, "H", (1, 1, 0, 1, KEY_PROJECTED, 0, 1, epsg)),
    ]
    if tile is None:
        tags += [
            (TAG_STRIP_OFFSETS, "I", where), (TAG_ROWS_PER_STRIP, "I", (height,)),
            (TAG_STRIP_COUNTS, "I", sizes),
        ]
    else:
        tags += [
            (TAG_TILE_WIDTH, "I", (tile,)), (TAG_TILE_HEIGHT, "I", (tile,)),
            (TAG_TILE_OFFSETS, "I", where), (TAG_TILE_COUNTS, "I", sizes),
        ]
    if nodata is not None:
        tags.append((TAG_NODATA, "s", repr(nodata).encode() + b"\0"))

    at = int(offsets[-1])
    at += at % 2
    tags.sort()
    extra_at = at + 2 + 12 * len(tags) + 4
    directory, extra = struct.pack("<H", len(tags)), b""
    kinds = {code: kind for kind, code in FIELD_FORMATS.items()}
    for tag, code, value in tags:
        body = value if code == "s" else struct.pack(f"<{len(value)}{code}", *value)
        head = struct.pack("<HHI", tag, kinds[code], len(value))
        if len(body) <= 4:
            directory += head + body.ljust(4, b"\0")
        else:
            directory += head + struct.pack("<I", extra_at + len(extra))
            extra += body + b"\0" * (len(body) % 2)
    body = b"".join(chunks)
    body += b"\0" * (at - 8 - len(body))
    return struct.pack("<2sHI", b"II", 42, at) + body + directory + struct.pack("<I", 0) + extra


def decode_geotiffs(
    files: DataFrame, keys: list[str], band: int = 1, pixels_per_batch: int = 1 << 20, value_type: str = "double",
    boxes: dict[int, tuple[float, float, float, float]] | None = None,
) -> DataFrame:
    """Files (``content`` bytes plus key columns) to one row per block, near the ``boxes`` if given.

    ``value_type`` is the element type of ``data``: ``int`` for 16-bit numbers halves what
    every later shuffle moves. Blocks of many small
    files are handed on together.
    """
    key_ddl = ", ".join(f"{k} {files.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held = [], 0
        for batch in batches:
            for row in batch.to_dict("records"):
                head = {k: row[k] for k in keys}
                for block in decode_blocks(row["content"], band, value_type, boxes):
                    out.append({**head, **block})
                    held += len(block["data"])
                    if held >= pixels_per_batch:
                        yield pd.DataFrame(out, dtype=object)
                        out, held = [], 0
        if out:
            yield pd.DataFrame(out, dtype=object)

    return files.select(*keys, "content").mapInPandas(run, f"{key_ddl}, {BLOCK_FIELDS.format(values=value_type)}")


def encode_geotiffs(blocks: DataFrame, keys: list[str], dtype: str, nodata: float | None = None) -> DataFrame:
    """One file per block: ``content`` bytes beside the key columns.

    Files are bounded by the block size; a scene's rasters form a set of block files, so
    no scene is ever gathered in one task.
    """
    key_ddl = ", ".join(f"{k} {blocks.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            content = [
                encode_geotiff(
                    np.asarray(b.data).reshape(b.height, b.width).astype(dtype),
                    b.x0, b.y0, b.pixel_size, int(b.epsg), nodata,
                )
                for b in batch.itertuples(index=False)
            ]
            yield batch[keys].assign(content=content)

    columns = [*keys, "x0", "y0", "pixel_size", "width", "height", "epsg", "data"]
    return blocks.select(*dict.fromkeys(columns)).mapInPandas(run, f"{key_ddl}, content binary")


def read_geotiff_blocks(
    spark: SparkSession, root: str, glob: str = "*.tif", band: int = 1, value_type: str = "double",
    boxes: dict[int, tuple[float, float, float, float]] | None = None,
) -> DataFrame:
    """Rasters below ``root`` as blocks named by directory (scene) and file stem."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select(
            path_parent_name("path").alias("scene_id"),
            path_stem("path").alias("name"),
            strip_file_scheme("path").alias("path"),
            "content",
        )
    )
    return decode_geotiffs(files, ["scene_id", "name", "path"], band, value_type=value_type, boxes=boxes)


def read_manifest_blocks(spark: SparkSession, manifest: DataFrame, band: int = 1) -> DataFrame:
    """Blocks of the files a manifest (``path`` and other columns) names.

    Only these files are opened. Their names pass the driver, whose file index holds the
    names of all files of a read in any case.
    """
    names = [r["path"] for r in manifest.select("path").distinct().toLocalIterator()]
    if not names:
        nothing = manifest.withColumn("content", F.lit(None).cast("binary"))
        return decode_geotiffs(nothing, manifest.columns, band)
    files = spark.read.format("binaryFile").load(names).select(strip_file_scheme("path").alias("path"), "content")
    return decode_geotiffs(files.join(manifest, "path"), manifest.columns, band)


def read_scene_bands(
    spark: SparkSession, root: str, value_type: str = "int", boxes: dict[int, tuple[float, float, float, float]] | None = None
) -> DataFrame:
    """Band files below ``root`` as blocks with ``scene_id`` and ``band``; digital numbers are whole.

    With ``boxes``, as ``hex_features.study_boxes`` makes them, only tiles near a study area
    are unpacked.
    """
    blocks = read_geotiff_blocks(spark, root, "*_SR_B*.TIF", value_type=value_type, boxes=boxes)
    return blocks.withColumn("band", F.regexp_extract("name", "_SR_(B[0-9]+)$", 1)).drop("name")
