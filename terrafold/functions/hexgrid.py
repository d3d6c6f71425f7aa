"""A planar grid of pointy-top hexagons with axial addresses.

Cells live in a metric coordinate system, one grid in each UTM zone. Resolution 8 has the edge length of the widely
used resolution-8 hexagons (461 m) and each step changes the area by a factor of seven.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions.projection import label_code, zone_label

SQRT3 = math.sqrt(3.0)
DEFAULT_RESOLUTION = 8

# Axial offsets of a cell and its six neighbours.
RING = ((0, 0), (1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1))

# Unit normals of the three pairs of parallel sides.
NORMALS = ((1.0, 0.0), (0.5, SQRT3 / 2.0), (-0.5, SQRT3 / 2.0))


def edge_m(resolution: int) -> float:
    """Edge length (= circumradius) of a cell in metres."""
    return 461.0 * 7.0 ** ((8 - resolution) / 2.0)


def apothem_m(resolution: int) -> float:
    return SQRT3 / 2.0 * edge_m(resolution)


def with_axial(df: DataFrame, resolution: int, x: str = "x", y: str = "y", q: str = "q", r: str = "r") -> DataFrame:
    """Add the axial address (``q``, ``r``) of the cell holding each point.

    Cube rounding: round the three cube coordinates, then recompute the one that moved
    most from the other two.
    """
    s = edge_m(resolution)
    staged = df.selectExpr(
        "*",
        f"({x} * {SQRT3 / 3.0!r}D - {y} / 3D) / {s!r}D AS __fq",
        f"{y} * {2.0 / 3.0!r}D / {s!r}D AS __fr",
    )
    staged = staged.selectExpr(
        "*", "floor(__fq + 0.5D) AS __rq", "floor(__fr + 0.5D) AS __rr", "floor(-__fq - __fr + 0.5D) AS __rs"
    )
    staged = staged.selectExpr(
        "*", "abs(__rq - __fq) AS __dq", "abs(__rr - __fr) AS __dr", "abs(__rs + __fq + __fr) AS __ds"
    )
    move_q = "__dq > __dr AND __dq > __ds"
    return staged.selectExpr(
        *[f"`{c}`" for c in df.columns if c not in (q, r)],
        f"CASE WHEN {move_q} THEN -__rr - __rs ELSE __rq END AS {q}",
        f"CASE WHEN NOT ({move_q}) AND __dr > __ds THEN -__rq - __rs ELSE __rr END AS {r}",
    )


def center_x(q: Column, r: Column, resolution: int) -> Column:
    return (q + r / F.lit(2.0)) * (edge_m(resolution) * SQRT3)


def center_y(r: Column, resolution: int) -> Column:
    return r * (1.5 * edge_m(resolution))


def cell_id(q: Column, r: Column, resolution: int, epsg: Column | None = None) -> Column:
    """Text id, built once per result row rather than once per pixel.

    With ``epsg`` the zone stands in the id, ``hx8_10n_{q}_{r}``; a NULL code leaves it out.
    """
    zone = [] if epsg is None else [zone_label(epsg)]
    return F.concat_ws("_", F.lit(f"hx{resolution}"), *zone, q.cast("string"), r.cast("string"))


def parse_cell_id(cell: Column) -> tuple[Column, Column, Column]:
    """(resolution, q, r) of a text id, with or without a zone."""
    part = F.split(cell, "_")
    return (
        F.substring(part[0], 3, 4).cast("int"),
        F.element_at(part, -2).cast("bigint"),
        F.element_at(part, -1).cast("bigint"),
    )


def cell_epsg(cell: Column) -> Column:
    """Code of the zone in a text id, NULL if it has none."""
    part = F.split(cell, "_")
    return F.when(F.size(part) == 4, label_code(part[1]))


def vertices(cx: Column, cy: Column, resolution: int) -> Column:
    """The six corners ``[x, y]``, counter-clockwise from the lower right."""
    s, a = edge_m(resolution), apothem_m(resolution)
    corners = ((a, -s / 2), (a, s / 2), (0.0, s), (-a, s / 2), (-a, -s / 2), (0.0, -s))
    return F.array(*[F.array(cx + dx, cy + dy) for dx, dy in corners])


def square_overlap_terms(dx: Column, dy: Column, half: float) -> list[Column]:
    """Projected distance minus the square's reach, along each side normal.

    ``dx``/``dy`` is the square's centre relative to the cell's centre. The square touches
    the cell where every term is at most the apothem (and ``|dy|`` is within reach of the
    pointed ends), and lies strictly inside where the terms with the reach *added* do.
    """
    return [F.abs(dx * nx + dy * ny) - half * (abs(nx) + abs(ny)) for nx, ny in NORMALS]


def square_touches(dx: Column, dy: Column, half: float, resolution: int) -> Column:
    """Separating-axis test of an axis-aligned square against a cell."""
    a, s = apothem_m(resolution), edge_m(resolution)
    test = F.abs(dy) <= s + half
    for term in square_overlap_terms(dx, dy, half):
        test = test & (term <= a)
    return test


def square_strictly_inside(dx: Column, dy: Column, half: float, resolution: int) -> Column:
    """True where the square cannot reach any other cell."""
    a = apothem_m(resolution)
    test = F.lit(True)
    for nx, ny in NORMALS:
        test = test & (F.abs(dx * nx + dy * ny) + half * (abs(nx) + abs(ny)) < a)
    return test


def box_touches(cx: Column, cy: Column, x0: Column, y0: Column, x1: Column, y1: Column, resolution: int) -> Column:
    """Separating-axis test of an axis-aligned box against a cell."""
    a, s = apothem_m(resolution), edge_m(resolution)
    dx, dy = (x0 + x1) / 2.0 - cx, (y0 + y1) / 2.0 - cy
    hx, hy = (x1 - x0) / 2.0, (y1 - y0) / 2.0
    test = F.abs(dy) <= hy + s
    for nx, ny in NORMALS:
        reach = hx * abs(nx) + hy * abs(ny) + a
        test = test & (F.abs(dx * nx + dy * ny) <= reach)
    return test
