"""Well-known binary: geometry as bytes that other tools read.

Writing is column arithmetic: numbers become their bits, bits become hexadecimal digits, and
one ``unhex`` makes the bytes, highest first. Reading takes either byte order and is one pass
over Arrow batches, as the place of every part depends on the sizes of those before.
"""

from __future__ import annotations

import struct
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Ship these helpers inside the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Geometry types of the format.
TYPES = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6}

#: What reading gives: every ring, line or point is a path of ``[x, y]``.
SHAPE = "struct<type:string,paths:array<array<array<double>>>>"


def _number(value: Column) -> Column:
    """Eight hexadecimal digits of a count or type."""
    return F.lpad(F.hex(value.cast("bigint")), 8, "0")


def _coordinate(value: Column) -> Column:
    """Sixteen hexadecimal digits of a coordinate's bits."""
    bits = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), value.cast("double"))
    return F.lpad(F.hex(bits.cast("bigint")), 16, "0")


def _head(kind: str) -> Column:
    return F.lit(f"00{TYPES[kind]:08X}")


def _all(parts: Column, one) -> Column:
    """Their number and then all of them; NULL where any is NULL."""
    digits = F.transform(parts, one)
    return F.when(~F.exists(digits, lambda d: d.isNull()), F.concat(_number(F.size(parts)), F.array_join(digits, "")))


def _vertex(p: Column) -> Column:
    return F.concat(_coordinate(p[0]), _coordinate(p[1]))


def _path(path: Column) -> Column:
    return _all(path, _vertex)


def _point(p: Column) -> Column:
    return F.concat(_head("Point"), _vertex(p))


def _line(path: Column) -> Column:
    return F.concat(_head("LineString"), _path(path))


def _polygon(rings: Column) -> Column:
    return F.concat(_head("Polygon"), _all(rings, _path))


def point_wkb(p: Column) -> Column:
    """A point ``[x, y]`` as bytes; NULL stays NULL, as in all of these."""
    return F.unhex(_point(p))


def line_wkb(path: Column) -> Column:
    """A path of vertices as bytes."""
    return F.unhex(_line(path))


def polygon_wkb(rings: Column) -> Column:
    """Rings, the outer one first, as bytes. Rings are closed by their first vertex."""
    return F.unhex(_polygon(rings))


def geojson_wkb(kind: Column, coordinates: Column) -> Column:
    """Bytes of a GeoJSON geometry, given its type and the text of its coordinates."""
    depth = lambda d: F.from_json(coordinates, "array<" * d + "double" + ">" * d)
    many = lambda name, parts, one: F.concat(_head(name), _all(parts, one))
    digits = (
        F.when(kind == "Point", _point(depth(1)))
        .when(kind == "LineString", _line(depth(2)))
        .when(kind == "Polygon", _polygon(depth(3)))
        .when(kind == "MultiPoint", many("MultiPoint", depth(2), _point))
        .when(kind == "MultiLineString", many("MultiLineString", depth(3), _line))
        .when(kind == "MultiPolygon", many("MultiPolygon", depth(4), _polygon))
    )
    return F.unhex(digits)


def read_one(data: bytes) -> tuple[str, list[list[list[float]]]]:
    """Type and paths of one geometry in two dimensions."""
    names = {v: k for k, v in TYPES.items()}

    def geometry(at: int) -> tuple[str, list, int]:
        order = {0: ">", 1: "<"}.get(data[at])
        code = struct.unpack_from(f"{order}I", data, at + 1)[0] if order else None
        if code not in names:
            raise ValueError(f"not a two-dimensional geometry at byte {at}")
        kind, at = names[code], at + 5

        def path(at: int, n: int) -> tuple[list, int]:
            if at + 16 * n > len(data):
                raise ValueError("geometry is cut short")
            return np.frombuffer(data, f"{order}f8", 2 * n, at).reshape(n, 2).tolist(), at + 16 * n

        if kind == "Point":
            found, at = path(at, 1)
            return kind, [found], at
        n, at = struct.unpack_from(f"{order}I", data, at)[0], at + 4
        if kind == "LineString":
            found, at = path(at, n)
            return kind, [found], at
        paths: list = []
        for _ in range(n):
            if kind == "Polygon":
                size = struct.unpack_from(f"{order}I", data, at)[0]
                found, at = path(at + 4, size)
                paths.append(found)
            else:
                _, found, at = geometry(at)
                paths += found
        return kind, paths, at

    kind, paths, end = geometry(0)
    if end != len(data):
        raise ValueError(f"{len(data) - end} bytes after a geometry")
    return kind, paths


def _shapes(wkb: pd.Series) -> pd.DataFrame:
    found = [(None, None) if b is None else read_one(bytes(b)) for b in wkb]
    return pd.DataFrame(found, columns=["type", "paths"], dtype=object)


def wkb_shape(wkb: Column | str) -> Column:
    """Type and paths of every geometry; NULL of NULL. Damaged bytes stop the query."""
    return F.pandas_udf(_shapes, SHAPE)(wkb)
