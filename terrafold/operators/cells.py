"""Hexagon tables: polyfill, boundaries, extent and footprint filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions import hexgrid
from terrafold.functions.edges import EDGE_TYPE
from terrafold.functions.projection import central_meridian, project_vertices, unproject_columns
from terrafold.functions.spectral import FILL_DN
from terrafold.functions.staging import closed, computed_once

FOOTPRINT_TARGET_M = 120.0

# Scene boxes are sampled at this many steps per side.
SIDE_STEPS = 22


def _bigint_sequence(first: Column, last: Column) -> Column:
    """Ascending whole numbers, empty (NULL, so exploded to nothing) when last < first."""
    return F.when(last >= first, F.sequence(first.cast("bigint"), last.cast("bigint")))


def polyfill(boxes: DataFrame, resolution: int = hexgrid.DEFAULT_RESOLUTION) -> DataFrame:
    """Cells whose centre lies in each grid box ``min_x, min_y, max_x, max_y``.

    Rows of the hexagon grid are enumerated first and columns within each row second, so
    no array longer than one grid row is ever built.
    """
    s = hexgrid.edge_m(resolution)
    step_y, step_x = 1.5 * s, hexgrid.SQRT3 * s
    rows = boxes.withColumn(
        "r",
        F.explode(
            _bigint_sequence(
                F.floor(F.col("min_y") / step_y), F.ceil(F.col("max_y") / step_y)
            )
        ),
    )
    cells = rows.withColumn(
        "q",
        F.explode(
            _bigint_sequence(
                F.floor(F.col("min_x") / step_x - F.col("r") / 2.0),
                F.ceil(F.col("max_x") / step_x - F.col("r") / 2.0),
            )
        ),
    )
    cells = cells.withColumns(
        {
            "cx": hexgrid.center_x(F.col("q"), F.col("r"), resolution),
            "cy": hexgrid.center_y(F.col("r"), resolution),
        }
    )
    return cells.filter(
        F.col("cx").between(F.col("min_x"), F.col("max_x"))
        & F.col("cy").between(F.col("min_y"), F.col("max_y"))
    )


def box_boundary(
    boxes: DataFrame, west: str, south: str, east: str, north: str, steps_per_side: int = SIDE_STEPS
) -> DataFrame:
    """Sample points ``bx, by`` along the four sides of every box."""
    steps = F.array(*[F.lit(i / steps_per_side) for i in range(steps_per_side + 1)])
    w, s, e, n = (F.col(c) for c in (west, south, east, north))
    sampled = boxes.withColumn("__t", F.explode(steps))
    t = F.col("__t")
    along_x, along_y = w + (e - w) * t, s + (n - s) * t
    point = lambda x, y: F.struct(x.alias("bx"), y.alias("by"))
    sides = F.array(point(along_x, s), point(along_x, n), point(w, along_y), point(e, along_y))
    return sampled.withColumn("__p", F.explode(sides)).select(*boxes.columns, "__p.bx", "__p.by")


def grid_envelope(boxes: DataFrame, epsg: int | Column) -> DataFrame:
    """Add the grid envelope of each lon/lat box ``west, south, east, north``.

    ``epsg`` is one code or a column with each box's own.

    Exact: along a meridian the easting is furthest out where the box is nearest to the
    equator, along a parallel the northing is extreme at the ends or where it is nearest to
    the zone's central meridian, and both are monotone in between. So three longitudes and
    three latitudes hold all extremes.
    """
    nearest = lambda low, high, to: F.greatest(low, F.least(high, to if isinstance(to, Column) else F.lit(to)))
    w, s, e, n = (F.col(c) for c in ("west", "south", "east", "north"))
    lons = (w, nearest(w, e, central_meridian(epsg)), e)
    lats = (s, nearest(s, n, 0.0), n)
    points = F.array(*[F.array(x.cast("double"), y.cast("double")) for x in lons for y in lats])
    placed = boxes.withColumn("__grid", project_vertices(points, epsg))
    side = lambda i: F.transform("__grid", lambda p: p[i])
    found = {
        "min_x": F.array_min(side(0)), "min_y": F.array_min(side(1)),
        "max_x": F.array_max(side(0)), "max_y": F.array_max(side(1)),
    }
    return computed_once(placed, found).drop("__grid")


def polyfill_wgs84(boxes: DataFrame, epsg: int | Column, resolution: int = hexgrid.DEFAULT_RESOLUTION) -> DataFrame:
    """Cells whose centre lies in each lon/lat box; rows of equal boxes get cells each.

    Candidates are the cells of the box's grid envelope, a metre wider for rounding; every
    one is then tested exactly in degrees. Equal boxes are filled once, and dealt over all
    tasks for it, as a small file of boxes would be one task's.
    """
    given = boxes.columns
    sides = ["west", "south", "east", "north"]
    if isinstance(epsg, Column):
        boxes, epsg, sides = boxes.withColumn("__epsg", epsg), F.col("__epsg"), [*sides, "__epsg"]
    wide = grid_envelope(boxes.select(*sides).distinct(), epsg).withColumns(
        {
            "min_x": F.col("min_x") - 1.0,
            "min_y": F.col("min_y") - 1.0,
            "max_x": F.col("max_x") + 1.0,
            "max_y": F.col("max_y") + 1.0,
        }
    )
    cells = unproject_columns(polyfill(wide, resolution), "cx", "cy", epsg, "center_lon", "center_lat")
    inside = cells.filter(
        F.col("center_lon").between(F.col("west"), F.col("east"))
        & F.col("center_lat").between(F.col("south"), F.col("north"))
    )
    found = ["r", "q", "cx", "cy", "center_lon", "center_lat"]
    return boxes.join(inside.select(*sides, *found), sides).select(*given, *found)


def with_cell_id(cells: DataFrame, resolution: int, epsg: Column | None = None) -> DataFrame:
    return cells.withColumns(
        {
            "cell": hexgrid.cell_id(F.col("q"), F.col("r"), resolution, epsg),
            "cell_res": F.lit(resolution),
        }
    )


def with_center(cells: DataFrame, resolution: int) -> DataFrame:
    return cells.withColumns(
        {
            "cx": hexgrid.center_x(F.col("q"), F.col("r"), resolution),
            "cy": hexgrid.center_y(F.col("r"), resolution),
        }
    )


def cell_corners(cells: DataFrame, resolution: int) -> DataFrame:
    """One row per cell corner: ``corner`` 0-5 and its ``vx, vy``."""
    corners = hexgrid.vertices(F.col("cx"), F.col("cy"), resolution)
    return cells.select("*", F.posexplode(corners).alias("corner", "__v")).select(
        *cells.columns, "corner", F.col("__v")[0].alias("vx"), F.col("__v")[1].alias("vy")
    )


def cell_edges(cx: Column, cy: Column, resolution: int) -> Column:
    """Edges of a cell, built from literal corner offsets."""
    s, a = hexgrid.edge_m(resolution), hexgrid.apothem_m(resolution)
    ring = [(a, -s / 2), (a, s / 2), (0.0, s), (-a, s / 2), (-a, -s / 2), (0.0, -s)]
    sides = [
        F.struct(
            (cx + x0).alias("x0"), (cy + y0).alias("y0"), (cx + x1).alias("x1"), (cy + y1).alias("y1")
        )
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1])
    ]
    return F.array(*sides).cast(f"array<{EDGE_TYPE}>")


def assign_cells(
    pixels: DataFrame,
    resolution: int = hexgrid.DEFAULT_RESOLUTION,
    touch: str = "all",
    half_pixel: float | Column = 15.0,
) -> DataFrame:
    """Give each pixel its cell (``touch="center"``) or every cell its square reaches.

    A pixel strictly inside its cell stays one row; only pixels near a side are offered
    the six neighbours, so the table grows by the share of border pixels, not sevenfold.
    """
    located = hexgrid.with_axial(pixels, resolution)
    if touch == "center":
        return located
    if touch != "all":
        raise ValueError(f"touch must be 'all' or 'center', got {touch!r}")
    if not isinstance(half_pixel, Column) and half_pixel > hexgrid.apothem_m(resolution):
        raise ValueError("pixels must not be larger than cells")

    dx = F.col("x") - hexgrid.center_x(F.col("q"), F.col("r"), resolution)
    dy = F.col("y") - hexgrid.center_y(F.col("r"), resolution)
    located = located.withColumns({"__dx": dx, "__dy": dy})
    offset = lambda dq, dr: F.struct(F.lit(dq).alias("dq"), F.lit(dr).alias("dr"))
    inside = hexgrid.square_strictly_inside(F.col("__dx"), F.col("__dy"), half_pixel, resolution)
    offered = F.when(inside, F.array(offset(0, 0))).otherwise(
        F.array(*[offset(dq, dr) for dq, dr in hexgrid.RING])
    )
    candidates = located.select("*", F.explode(offered).alias("__o"))
    s = hexgrid.edge_m(resolution)
    cdx = F.col("__dx") - (F.col("__o.dq") + F.col("__o.dr") / 2.0) * (s * hexgrid.SQRT3)
    cdy = F.col("__dy") - F.col("__o.dr") * (1.5 * s)
    return (
        candidates.filter(closed(hexgrid.square_touches(cdx, cdy, half_pixel, resolution)))
        .withColumns({"q": F.col("q") + F.col("__o.dq"), "r": F.col("r") + F.col("__o.dr")})
        .drop("__dx", "__dy", "__o")
    )


def cells_in_extent(cells: DataFrame, resolution: int) -> DataFrame:
    """Cells whose hexagon meets the grid box ``box_min_x .. box_max_y`` on their row."""
    return cells.filter(
        hexgrid.box_touches(
            F.col("cx"), F.col("cy"),
            F.col("box_min_x"), F.col("box_min_y"), F.col("box_max_x"), F.col("box_max_y"),
            resolution,
        )
    )


def coarse_factor(pixel_size: float | Column, target_m: float = FOOTPRINT_TARGET_M) -> int | Column:
    """Pixels along the side of a coarse square."""
    if isinstance(pixel_size, Column):
        return F.greatest(F.lit(1), F.rint(F.lit(target_m) / pixel_size)).cast("bigint")
    return max(1, round(target_m / pixel_size))


def scene_grids(blocks: DataFrame) -> DataFrame:
    """The corner ``x0, y0`` and ``pixel_size`` of every scene's grid, read off its blocks."""
    return blocks.groupBy("scene_id").agg(
        F.min(F.col("x0") - F.col("first_col") * F.col("pixel_size")).alias("x0"),
        F.max(F.col("y0") + F.col("first_row") * F.col("pixel_size")).alias("y0"),
        F.min("pixel_size").alias("pixel_size"),
    )


def valid_footprint(
    pixels: DataFrame, keys: list[str], pixel_size: float | Column, target_m: float = FOOTPRINT_TARGET_M
) -> DataFrame:
    """Coarse squares around valid data, grown by one coarse pixel.

    ``pixel_size`` is one number or a column with each row's own.

    Pixels collapse to coarse addresses before the shuffle; growth happens on the coarse
    table, which is at least (target / pixel)^2 times smaller.
    """
    factor = coarse_factor(pixel_size, target_m)
    coarse = (
        pixels.filter(F.col("dn") != FILL_DN)
        .select(
            *keys,
            F.floor(F.col("row_no") / factor).alias("coarse_row"),
            F.floor(F.col("col_no") / factor).alias("coarse_col"),
        )
        .distinct()
    )
    shifts = F.array(*[F.lit(d).cast("bigint") for d in (-1, 0, 1)])
    grown = coarse.withColumn("__dr", F.explode(shifts)).withColumn("__dc", F.explode(shifts))
    return grown.select(
        *keys,
        (F.col("coarse_row") + F.col("__dr")).alias("coarse_row"),
        (F.col("coarse_col") + F.col("__dc")).alias("coarse_col"),
    ).distinct()


def footprint_squares(
    footprint: DataFrame, x0: float | Column, y0: float | Column, pixel_size: float | Column, target_m: float = FOOTPRINT_TARGET_M
) -> DataFrame:
    """Footprint addresses as squares: centre ``x, y`` in the grid.

    Corner and pixel size are numbers for all rows or columns with each scene's own, as
    :func:`scene_grids` finds them.
    """
    side = coarse_factor(pixel_size, target_m) * pixel_size
    return footprint.withColumns(
        {
            "x": F.lit(x0) + (F.col("coarse_col") + 0.5) * side,
            "y": F.lit(y0) - (F.col("coarse_row") + 0.5) * side,
        }
    )


def cells_in_footprint(
    cells: DataFrame,
    squares: DataFrame,
    keys: list[str],
    resolution: int,
    half: float | Column,
) -> DataFrame:
    """Cells (unique per ``keys, q, r``) whose hexagon meets a footprint square.

    Each square names the cells it touches; the distinct names are then a plain equi
    semi-join, so no square is compared with a cell it cannot reach. ``half`` is half a
    square's side, one number or a column of ``squares``.
    """
    touched = assign_cells(squares, resolution, "all", half).select(*keys, "q", "r").distinct()
    return cells.join(touched, [*keys, "q", "r"], "left_semi")
