"""Compressed, differenced and 64-bit rasters, written here byte by byte."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest

from terrafold.operators import bands as B
from terrafold.sources import geotiff


def packed_codes(codes: list[tuple[int, int]]) -> bytes:
    """(code, bits) one after the other, highest bit first."""
    text = "".join(f"{code:0{bits}b}" for code, bits in codes)
    text += "0" * (-len(text) % 8)
    return bytes(int(text[i : i + 8], 2) for i in range(0, len(text), 8))


def lzw(data: bytes) -> bytes:
    """Greedy codes; the table is cleared one entry before its last code."""
    codes, table, width, at = [(256, 9)], {bytes([i]): i for i in range(256)}, 9, 0
    free = 258
    while at < len(data):
        end = at + 1
        while end < len(data) and data[at : end + 1] in table:
            end += 1
        codes.append((table[data[at:end]], width))
        table[data[at : end + 1]] = free
        free += 1
        if free == (1 << width):  # the reader is one entry behind
            width += 1
        if free == 4095:
            codes.append((256, 12))
            table, width, free = {bytes([i]): i for i in range(256)}, 9, 258
        at = end
    return packed_codes([*codes, (257, width)])


def test_lzw_by_hand():
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]
    assert geotiff.unpack_lzw(packed_codes([(c, 9) for c in codes])) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    assert geotiff.unpack_lzw(packed_codes([(256, 9), (65, 9), (256, 9), (66, 9), (258, 9), (257, 9)])) == b"ABBB"
    assert geotiff.unpack_lzw(packed_codes([(256, 9), (257, 9)])) == b""
    with pytest.raises(ValueError, match="damaged LZW"):
        geotiff.unpack_lzw(packed_codes([(256, 9), (300, 9)]))


@pytest.mark.parametrize("kind", ["random", "zeros", "steps", "text"])
def test_lzw_through_all_widths_and_clears(kind):
    draw = np.random.default_rng(2)
    data = {
        "random": draw.integers(0, 256, 20_000).astype(np.uint8).tobytes(),
        "zeros": bytes(100_000),
        "steps": np.arange(30_000, dtype="<u2").tobytes(),
        "text": b"the same words again and again " * 800,
    }[kind]
    assert geotiff.unpack_lzw(lzw(data)) == data


def tiff(chunks, width, height, bits, sample_format, compression, predictor=1, tile=None, big=False, order="<"):
    """A file of strips of one chunk each, or of tiles, with 32-bit or 64-bit offsets."""
    word, size = ("Q", 8) if big else ("I", 4)
    head = 16 if big else 8
    where = [head + sum(map(len, chunks[:i])) for i in range(len(chunks))]
    rows = -(-height // len(chunks))
    kind = 16 if big else 4
    entries = [
        (256, 3, [width]), (257, 3, [height]), (258, 3, [bits]), (259, 3, [compression]), (262, 3, [1]), (277, 3, [1]),
        (317, 3, [predictor]), (339, 3, [sample_format]), (33550, 12, [30.0, 30.0, 0.0]),
        (33922, 12, [0.0, 0.0, 0.0, 600000.0, 4500000.0, 0.0]), (34735, 3, [1, 1, 0, 1, 3072, 0, 1, 32610]),
    ]
    if tile:
        entries += [(322, 3, [tile]), (323, 3, [tile]), (324, kind, where), (325, kind, [len(c) for c in chunks])]
    else:
        entries += [(273, kind, where), (278, 3, [rows]), (279, kind, [len(c) for c in chunks])]
    entries.sort()
    at = head + sum(map(len, chunks))
    count = struct.calcsize(order + ("Q" if big else "H"))
    more_at, out, more = at + count + (4 + 2 * size) * len(entries) + size, struct.pack(order + ("Q" if big else "H"), len(entries)), b""
    for tag, k, v in entries:
        body = struct.pack(f"{order}{len(v)}{ {3: 'H', 4: 'I', 12: 'd', 16: 'Q'}[k]}", *v)
        inline = body.ljust(size, b"\0") if len(body) <= size else struct.pack(order + word, more_at + len(more))
        more += b"" if len(body) <= size else body
        out += struct.pack(order + "HH" + word, tag, k, len(v)) + inline
    mark = b"II" if order == "<" else b"MM"
    start = mark + (struct.pack(order + "HHHQ", 43, 8, 0, at) if big else struct.pack(order + "HI", 42, at))
    return start + b"".join(chunks) + out + struct.pack(order + word, 0) + more


def values_of(raw, value_type="double"):
    blocks = list(geotiff.decode_blocks(raw, value_type=value_type))
    out = np.zeros((max(b["first_row"] + b["height"] for b in blocks), max(b["first_col"] + b["width"] for b in blocks)), blocks[0]["data"].dtype)
    for b in blocks:
        out[b["first_row"] : b["first_row"] + b["height"], b["first_col"] : b["first_col"] + b["width"]] = b["data"].reshape(b["height"], b["width"])
    return out, blocks[0]


DN = (np.arange(20 * 24).reshape(20, 24) * 977 % 60000).astype(np.uint16)


@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("compression, pack", [(1, bytes), (5, lzw), (8, zlib.compress)])
def test_strips(big, order, compression, pack):
    for predictor in (1, 2):
        stored = DN if predictor == 1 else np.diff(DN, axis=1, prepend=np.uint16(0))
        chunks = [pack(stored[r : r + 7].astype(f"{order}u2").tobytes()) for r in range(0, 20, 7)]
        got, first = values_of(tiff(chunks, 24, 20, 16, 1, compression, predictor, big=big, order=order), "int")
        assert got.dtype == np.int32 and np.array_equal(got, DN)
        assert (first["x0"], first["y0"], first["epsg"], first["height"]) == (600000.0, 4500000.0, 32610, 7)


def test_64_bit_tiles_that_hang_over():
    padded = np.pad(DN, ((0, 12), (0, 8)))
    chunks = [lzw(padded[r : r + 16, c : c + 16].tobytes()) for r in (0, 16) for c in (0, 16)]
    got, _ = values_of(tiff(chunks, 24, 20, 16, 1, 5, tile=16, big=True))
    assert np.array_equal(got, DN)


def test_float_differences_by_hand():
    # 1, 2 and 0.5 are 3F800000, 40000000, 3F000000: highest bytes first, then differences.
    chunk = bytes([0x3F, 0x01, 0xFF, 0x41, 0x80, 0, 0, 0, 0, 0, 0, 0])
    for order in "<>":
        got, _ = values_of(tiff([zlib.compress(chunk)], 3, 1, 32, 3, 8, predictor=3, order=order), "float")
        assert got.dtype == np.float32 and got.tolist() == [[1.0, 2.0, 0.5]]


@pytest.mark.parametrize("bits", [32, 64])
def test_float_differences_of_rows(bits):
    values = np.random.default_rng(5).normal(size=(6, 9)).astype(f"f{bits // 8}")
    planes = values.astype(f">f{bits // 8}").view(np.uint8).reshape(6, 9, bits // 8).transpose(0, 2, 1).reshape(6, -1)
    chunks = [lzw(np.diff(planes[r : r + 2], axis=1, prepend=np.uint8(0)).tobytes()) for r in (0, 2, 4)]
    got, _ = values_of(tiff(chunks, 9, 6, bits, 3, 5, predictor=3, big=True))
    assert np.array_equal(got, values.astype(float))


def test_values_that_do_not_fit_are_an_error():
    floats = tiff([bytes(16)], 2, 2, 32, 3, 1)
    for wanted in ("int", "smallint"):
        with pytest.raises(ValueError, match="values of type float32 do not fit"):
            next(geotiff.decode_blocks(floats, value_type=wanted))
    with pytest.raises(ValueError, match="uint16 do not fit smallint"):
        next(geotiff.decode_blocks(tiff([bytes(8)], 2, 2, 16, 1, 1), value_type="smallint"))
    with pytest.raises(ValueError, match="differencing of values that are no floats"):
        next(geotiff.decode_blocks(tiff([bytes(8)], 2, 2, 16, 1, 1, predictor=3)))
    with pytest.raises(ValueError, match="not a baseline TIFF"):
        next(geotiff.decode_blocks(b"II" + struct.pack("<HHHQ", 43, 4, 0, 16) + bytes(20)))


def test_bands_of_every_kind_make_one_scene(spark):
    """Four bands stored in four ways: plain strips, LZW strips, 64-bit LZW tiles, deflate tiles."""
    padded = np.pad(DN, ((0, 12), (0, 8)))
    tiles = [padded[r : r + 16, c : c + 16].tobytes() for r in (0, 16) for c in (0, 16)]
    files = [
        ("B3", tiff([DN[:10].tobytes(), DN[10:].tobytes()], 24, 20, 16, 1, 1)),
        ("B4", tiff([lzw(DN[r : r + 5].tobytes()) for r in range(0, 20, 5)], 24, 20, 16, 1, 5)),
        ("B5", tiff([lzw(t) for t in tiles], 24, 20, 16, 1, 5, tile=16, big=True)),
        ("B7", tiff([zlib.compress(t) for t in tiles], 24, 20, 16, 1, 8, tile=16)),
    ]
    df = spark.createDataFrame([("s", b, bytearray(raw)) for b, raw in files], "scene_id string, band string, content binary")
    blocks = geotiff.decode_geotiffs(df, ["scene_id", "band"], value_type="int")
    assert blocks.schema["data"].dataType.simpleString() == "array<int>"
    rows = B.align_block_bands(blocks, tile=16).collect()
    assert len(rows) == DN.size
    assert all(r["b3"] == r["b4"] == r["b5"] == r["b7"] == DN[r["row_no"], r["col_no"]] for r in rows)


def test_only_tiles_that_meet_a_box_are_unpacked():
    """Tiles outside are damaged here, so unpacking one would fail."""
    padded = np.pad(DN, ((0, 12), (0, 8)))
    chunks = [zlib.compress(padded[r : r + 16, c : c + 16].tobytes()) for r in (0, 16) for c in (0, 16)]
    raw = tiff([chunks[0], b"damaged", b"damaged", b"damaged"], 24, 20, 16, 1, 8, tile=16)
    box = (600000.0 + 40.0, 4500000.0 - 300.0, 600000.0 + 400.0, 4500000.0 - 100.0)
    found = list(geotiff.decode_blocks(raw, boxes={32610: box}))
    assert [(b["block_row"], b["block_col"]) for b in found] == [(0, 0)]
    assert list(geotiff.decode_blocks(raw, boxes={32611: box})) == []
    with pytest.raises(zlib.error):
        list(geotiff.decode_blocks(raw, boxes={32610: (box[0], box[1], box[2] + 300.0, box[3])}))
