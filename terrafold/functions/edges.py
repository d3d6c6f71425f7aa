"""Geometry as arrays of edges, tested with column arithmetic.

A shape is an array of ``struct<x0,y0,x1,y1>``. Lines, rings, holes and multi-part shapes
are all the same thing: distance asks for the nearest edge, and containment counts how
many edges a ray crosses (even-odd), so holes need no special case.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EDGE_TYPE = "struct<x0:double,y0:double,x1:double,y1:double>"
EDGES_TYPE = f"array<{EDGE_TYPE}>"


def edge(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(
        x0.cast("double").alias("x0"),
        y0.cast("double").alias("y0"),
        x1.cast("double").alias("x1"),
        y1.cast("double").alias("y1"),
    )


def path_edges(path: Column) -> Column:
    """Edges between consecutive ``[x, y]`` vertices; a lone vertex is a zero-length edge."""
    steps = F.when(F.size(path) > 1, F.slice(path, 1, F.size(path) - 1)).otherwise(path)
    return F.transform(
        steps,
        lambda p, i: edge(
            p[0],
            p[1],
            F.coalesce(F.get(path, i + 1)[0], p[0]),
            F.coalesce(F.get(path, i + 1)[1], p[1]),
        ),
    )


def paths_edges(paths: Column) -> Column:
    return F.flatten(F.transform(paths, path_edges))


def ring_edges(points: Column) -> Column:
    """Edges of an implicitly closed ring of ``[x, y]`` vertices."""
    n = F.size(points)
    return F.transform(
        points,
        lambda p, i: edge(p[0], p[1], points[(i + 1) % n][0], points[(i + 1) % n][1]),
    )


def envelope(edges: Column) -> dict[str, Column]:
    """Column name -> envelope side."""
    return {
        "min_x": F.array_min(F.transform(edges, lambda e: F.least(e["x0"], e["x1"]))),
        "min_y": F.array_min(F.transform(edges, lambda e: F.least(e["y0"], e["y1"]))),
        "max_x": F.array_max(F.transform(edges, lambda e: F.greatest(e["x0"], e["x1"]))),
        "max_y": F.array_max(F.transform(edges, lambda e: F.greatest(e["y0"], e["y1"]))),
    }


def edge_hits_box(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Does a segment meet an axis-aligned box? Separating axes: x, y, segment normal."""
    cx, cy = (x0 + x1) / 2.0, (y0 + y1) / 2.0
    hx, hy = (x1 - x0) / 2.0, (y1 - y0) / 2.0
    ex, ey = e["x1"] - e["x0"], e["y1"] - e["y0"]
    return (
        (F.least(e["x0"], e["x1"]) <= x1)
        & (F.greatest(e["x0"], e["x1"]) >= x0)
        & (F.least(e["y0"], e["y1"]) <= y1)
        & (F.greatest(e["y0"], e["y1"]) >= y0)
        & (F.abs(ex * (cy - e["y0"]) - ey * (cx - e["x0"])) <= hy * F.abs(ex) + hx * F.abs(ey))
    )


def _point_edge_sq(px: Column, py: Column, e: Column) -> Column:
    """Squared distance from a point to a segment."""
    ex, ey = e["x1"] - e["x0"], e["y1"] - e["y0"]
    dx, dy = px - e["x0"], py - e["y0"]
    t = F.coalesce(F.try_divide(dx * ex + dy * ey, ex * ex + ey * ey), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return (dx - t * ex) * (dx - t * ex) + (dy - t * ey) * (dy - t * ey)


def edge_near_square(e: Column, x: Column, y: Column, half: float, distance: Column) -> Column:
    """Is the segment within ``distance`` of the square centred on (x, y)?

    Two convex shapes that do not meet are nearest at a corner of one of them, so either
    they meet, or an end of the segment is near the square, or a corner of the square is
    near the segment. A corner whose foot falls beyond an end is settled by that end,
    which leaves the corners with a foot on the segment: no division is needed. The
    envelope comparison comes first and settles most pairs.
    """
    reach = distance + half
    d2 = distance * distance
    ex, ey = e["x1"] - e["x0"], e["y1"] - e["y0"]
    len2 = ex * ex + ey * ey
    dx, dy = x - e["x0"], y - e["y0"]
    close = (
        (F.least(e["x0"], e["x1"]) <= x + reach)
        & (F.greatest(e["x0"], e["x1"]) >= x - reach)
        & (F.least(e["y0"], e["y1"]) <= y + reach)
        & (F.greatest(e["y0"], e["y1"]) >= y - reach)
    )

    def end_near(ux: Column, uy: Column) -> Column:
        gx = F.greatest(F.abs(ux) - half, F.lit(0.0))
        gy = F.greatest(F.abs(uy) - half, F.lit(0.0))
        return gx * gx + gy * gy <= d2

    def corner_near(sx: float, sy: float) -> Column:
        cx, cy = dx + sx, dy + sy
        along, across = cx * ex + cy * ey, cx * ey - cy * ex
        return (along > 0) & (along < len2) & (across * across <= d2 * len2)

    near = edge_hits_box(e, x - half, y - half, x + half, y + half) | end_near(dx, dy) | end_near(dx - ex, dy - ey)
    for sx in (-half, half):
        for sy in (-half, half):
            near = near | corner_near(sx, sy)
    return close & near


def edge_near_point(e: Column, x: Column, y: Column, distance: Column) -> Column:
    return _point_edge_sq(x, y, e) <= distance * distance


def ray_crossings(edges: Column, x: Column, y: Column) -> Column:
    """How many edges a ray from (x, y) towards +x crosses."""

    def crossed(e: Column) -> Column:
        spans = (e["y0"] > y) != (e["y1"] > y)
        # Evaluated only where ``spans`` holds, but kept free of division by zero anyway.
        at = e["x0"] + F.coalesce(
            F.try_divide((y - e["y0"]) * (e["x1"] - e["x0"]), e["y1"] - e["y0"]), F.lit(0.0)
        )
        return spans & (at > x)

    return F.size(F.filter(edges, crossed))


def contains_point(edges: Column, x: Column, y: Column) -> Column:
    return ray_crossings(edges, x, y) % 2 == 1


def square_in_region(
    edges: Column, areal: Column, buffer_m: Column, x: Column, y: Column, half: float, touch: str
) -> Column:
    """Does a pixel belong to a region?

    ``touch="all"`` counts a pixel whose square reaches the buffered shape; ``"center"``
    asks for the pixel's centre only.
    """
    if touch == "all":
        near = F.exists(edges, lambda e: edge_near_square(e, x, y, half, buffer_m))
    elif touch == "center":
        near = F.exists(edges, lambda e: edge_near_point(e, x, y, buffer_m)) & (buffer_m > 0)
    else:
        raise ValueError(f"touch must be 'all' or 'center', got {touch!r}")
    return near | (areal & contains_point(edges, x, y))


def edges_hit_box(edges: Column, areal: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Does a shape meet a box: an edge does, or the box lies inside an areal shape?"""
    return F.exists(edges, lambda e: edge_hits_box(e, x0, y0, x1, y1)) | (
        areal & contains_point(edges, x0, y0)
    )


def bbox_ring(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Closed ring of a box, counter-clockwise from the lower left."""
    return F.array(
        F.array(west, south),
        F.array(east, south),
        F.array(east, north),
        F.array(west, north),
        F.array(west, south),
    )


def ring_wkt(ring: Column) -> Column:
    """Polygon text of a closed ring."""
    return F.concat(
        F.lit("POLYGON(("),
        F.array_join(F.transform(ring, lambda p: F.concat_ws(" ", p[0].cast("string"), p[1].cast("string"))), ", "),
        F.lit("))"),
    )


def coerce_bbox(bbox) -> tuple[float, float, float, float]:
    """Check a literal box: exactly four numbers, west, south, east, north."""
    values = tuple(float(v) for v in bbox)
    if len(values) != 4:
        raise ValueError(f"Bounding box must have exactly 4 values, got {len(values)}")
    return values
