"""Transverse Mercator (UTM) in both directions, as column arithmetic.

The series is Krueger's, to the fourth order in the third flattening n; for points
inside a zone the truncation error is far below a millimetre. Every formula takes a
small namespace of functions, so the same text yields Spark columns over a table and
Python floats for literal boxes that are projected once on the driver.

``epsg`` is one code for all rows or a column with the code of each row; a code that is no
UTM zone stops the query.
"""

from __future__ import annotations

import math
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions.staging import computed_once

# WGS84 ellipsoid and the UTM grid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1.0 / 298.257223563
SCALE_K0 = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0

_N = FLATTENING / (2.0 - FLATTENING)
RADIUS = SEMI_MAJOR / (1.0 + _N) * (1.0 + _N**2 / 4.0 + _N**4 / 64.0)
_E = 2.0 * math.sqrt(_N) / (1.0 + _N)

# Published series coefficients.
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)

_SPARK = SimpleNamespace(
    sin=F.sin, cos=F.cos, sinh=F.sinh, cosh=F.cosh, asin=F.asin,
    atan2=F.atan2, atanh=F.atanh, sqrt=F.sqrt, degrees=F.degrees, radians=F.radians,
)
_FLOAT = SimpleNamespace(
    sin=math.sin, cos=math.cos, sinh=math.sinh, cosh=math.cosh, asin=math.asin,
    atan2=math.atan2, atanh=math.atanh, sqrt=math.sqrt, degrees=math.degrees,
    radians=math.radians,
)


def utm_zone(epsg: int) -> tuple[int, bool]:
    """(zone number, is southern) of an EPSG code 326xx or 327xx."""
    zone = epsg % 100
    if epsg // 100 not in (326, 327) or not 1 <= zone <= 60:
        raise ValueError(f"EPSG:{epsg} is not a WGS84 / UTM code (326xx or 327xx)")
    return zone, epsg // 100 == 327


def utm_code(epsg: Column) -> Column:
    """The codes of a column, each checked."""
    known = F.floor(epsg / 100).isin(326, 327) & (epsg % 100).between(1, 60)
    wrong = F.concat(F.lit("EPSG:"), F.coalesce(epsg.cast("string"), F.lit("none")), F.lit(" is not a WGS84 / UTM code (326xx or 327xx)"))
    return F.when(known, epsg.cast("int")).otherwise(F.raise_error(wrong).cast("int"))


def zone_label(epsg: Column) -> Column:
    """Zone and hemisphere as text, such as ``10n``; NULL of NULL."""
    return F.concat((epsg % 100).cast("string"), F.when(epsg >= 32700, "s").otherwise("n"))


def label_code(label: Column) -> Column:
    """The code of a zone and hemisphere."""
    return F.when(label.endswith("s"), 32700).otherwise(32600) + F.regexp_extract(label, "^[0-9]+", 0).cast("int")


def zones_near(west: float, east: float, beyond: float = 9.0) -> list[int]:
    """Codes of both hemispheres whose central meridian is within ``beyond`` degrees of a box.

    A zone is three degrees wide on either side and scenes reach over its border by two or
    three, so nothing of a box is missed in a scene of any other zone.
    """
    near = [z for z in range(1, 61) if west - beyond <= 6.0 * z - 183.0 <= east + beyond]
    return [base + z for base in (32600, 32700) for z in near]


def central_meridian(epsg):
    if isinstance(epsg, Column):
        return (utm_code(epsg) % 100) * 6.0 - 183.0
    return 6.0 * utm_zone(epsg)[0] - 183.0


def _false_northing(epsg):
    if isinstance(epsg, Column):
        return F.when(epsg >= 32700, FALSE_NORTHING_SOUTH).otherwise(0.0)
    return FALSE_NORTHING_SOUTH if utm_zone(epsg)[1] else 0.0


def _sphere(m, lon, lat, epsg):
    """Gauss-Schreiber coordinates (xi', eta') of a geographic point."""
    s = m.sin(m.radians(lat))
    lam = m.radians(lon - central_meridian(epsg))
    t = m.sinh(m.atanh(s) - _E * m.atanh(s * _E))
    return m.atan2(t, m.cos(lam)), m.atanh(m.sin(lam) / m.sqrt(t * t + 1.0))


def _grid(m, xi, eta, epsg):
    """Easting and northing of Gauss-Schreiber coordinates."""
    e, n = eta, xi
    for j, a in enumerate(_ALPHA, start=1):
        e = e + m.cos(xi * (2.0 * j)) * m.sinh(eta * (2.0 * j)) * a
        n = n + m.sin(xi * (2.0 * j)) * m.cosh(eta * (2.0 * j)) * a
    scale = SCALE_K0 * RADIUS
    return e * scale + FALSE_EASTING, n * scale + _false_northing(epsg)


def _ungrid(m, x, y, epsg):
    """Inverse of :func:`_grid`."""
    scale = SCALE_K0 * RADIUS
    xi, eta = (y - _false_northing(epsg)) / scale, (x - FALSE_EASTING) / scale
    xi1, eta1 = xi, eta
    for j, b in enumerate(_BETA, start=1):
        xi1 = xi1 - m.sin(xi * (2.0 * j)) * m.cosh(eta * (2.0 * j)) * b
        eta1 = eta1 - m.cos(xi * (2.0 * j)) * m.sinh(eta * (2.0 * j)) * b
    return xi1, eta1


def _conformal(m, xi, eta):
    """Conformal latitude and longitude offset, both in radians."""
    return m.asin(m.sin(xi) / m.cosh(eta)), m.atan2(m.sinh(eta), m.cos(xi))


def _geographic(m, chi, lam, epsg):
    """Longitude and latitude in degrees."""
    lat = chi
    for j, d in enumerate(_DELTA, start=1):
        lat = lat + m.sin(chi * (2.0 * j)) * d
    return m.degrees(lam) + central_meridian(epsg), m.degrees(lat)


def project_point(lon: float, lat: float, epsg: int) -> tuple[float, float]:
    """Project one literal point."""
    return _grid(_FLOAT, *_sphere(_FLOAT, lon, lat, epsg), epsg)


def unproject_point(x: float, y: float, epsg: int) -> tuple[float, float]:
    """Unproject one literal point."""
    return _geographic(_FLOAT, *_conformal(_FLOAT, *_ungrid(_FLOAT, x, y, epsg)), epsg)


def project_bbox(bbox: tuple[float, float, float, float], epsg: int):
    """Envelope in the grid of the four projected corners of a lon/lat box."""
    west, south, east, north = bbox
    xs, ys = zip(*(project_point(lo, la, epsg) for lo in (west, east) for la in (south, north)))
    return min(xs), min(ys), max(xs), max(ys)


def project_columns(df: DataFrame, lon: str, lat: str, epsg: int | Column, x: str = "x", y: str = "y") -> DataFrame:
    """Add grid coordinates of ``lon``/``lat``.

    The intermediate pair is a projection of its own, so that each series term refers to
    a computed column instead of repeating the whole expression.
    """
    xi, eta = _sphere(_SPARK, F.col(lon), F.col(lat), epsg)
    staged = df.withColumns({"__xi": xi, "__eta": eta})
    gx, gy = _grid(_SPARK, F.col("__xi"), F.col("__eta"), epsg)
    return computed_once(staged, {x: gx, y: gy}).drop("__xi", "__eta")


def unproject_columns(df: DataFrame, x: str, y: str, epsg: int | Column, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add longitude and latitude of grid coordinates."""
    xi, eta = _ungrid(_SPARK, F.col(x), F.col(y), epsg)
    staged = df.withColumns({"__xi": xi, "__eta": eta})
    chi, lam = _conformal(_SPARK, F.col("__xi"), F.col("__eta"))
    staged = staged.withColumns({"__chi": chi, "__lam": lam})
    glon, glat = _geographic(_SPARK, F.col("__chi"), F.col("__lam"), epsg)
    return computed_once(staged, {lon: glon, lat: glat}).drop("__xi", "__eta", "__chi", "__lam")


def project_vertices(points: Column, epsg: int | Column) -> Column:
    """Project every ``[lon, lat]`` of an array of vertices (region side only)."""

    def to_sphere(p: Column) -> Column:
        xi, eta = _sphere(_SPARK, p[0], p[1], epsg)
        return F.struct(xi.alias("xi"), eta.alias("eta"))

    def to_grid(s: Column) -> Column:
        gx, gy = _grid(_SPARK, s["xi"], s["eta"], epsg)
        return F.array(gx, gy)

    return F.transform(F.transform(points, to_sphere), to_grid)


def unproject_vertices(points: Column, epsg: int | Column) -> Column:
    """Unproject every ``[x, y]`` of an array of vertices (region side only)."""

    def to_sphere(p: Column) -> Column:
        xi, eta = _ungrid(_SPARK, p[0], p[1], epsg)
        return F.struct(xi.alias("xi"), eta.alias("eta"))

    def to_conformal(s: Column) -> Column:
        chi, lam = _conformal(_SPARK, s["xi"], s["eta"])
        return F.struct(chi.alias("chi"), lam.alias("lam"))

    def to_geographic(s: Column) -> Column:
        lon, lat = _geographic(_SPARK, s["chi"], s["lam"], epsg)
        return F.array(lon, lat)

    return F.transform(F.transform(F.transform(points, to_sphere), to_conformal), to_geographic)
