"""Pieces of oracle SQL: index values, hexagon tests, map projection."""

from __future__ import annotations

from terrafold.functions import projection as P
from terrafold.functions.hexgrid import SQRT3, apothem_m, edge_m

S8, A8 = edge_m(8), apothem_m(8)


def refl(dn: str) -> str:
    return f"CASE WHEN {dn} <> 0 THEN {dn}*2.75e-5 - 2e-1 END"


def nd(a: str, b: str) -> str:
    return f"({a} - {b}) / nullif({a} + {b}, 0)"


def indices(source: str, keep: str) -> str:
    """Index columns of a source with b3, b4, b5, b7."""
    bands = ", ".join(f"{refl(b)} AS r{b[1]}" for b in ("b3", "b4", "b5", "b7"))
    return (
        f"SELECT {keep}, {nd('r5', 'r4')} AS ndvi, {nd('r5', 'r7')} AS nbr, {nd('r3', 'r5')} AS ndwi "
        f"FROM (SELECT *, {bands} FROM {source})"
    )


def cells_touched(source: str, half: float, s: float = S8) -> str:
    """Every (row, cell) where the square of half side ``half`` meets the cell, by trying
    all cells whose envelope is in reach; no rounding to an own cell is involved."""
    a = s * SQRT3 / 2
    wide, high = s * SQRT3, 1.5 * s
    reach_x, reach_y = a + half, s + half
    diag = f"{a + half * (0.5 + SQRT3 / 2)!r}"
    dx, dy = f"(x - {wide!r}*(q + r/2e0))", f"(y - {high!r}*r)"
    rows = (
        f"SELECT *, unnest(generate_series(CAST(ceil((y - {reach_y!r})/{high!r}) AS bigint),"
        f" CAST(floor((y + {reach_y!r})/{high!r}) AS bigint))) AS r FROM {source}"
    )
    cols = (
        f"SELECT *, unnest(generate_series(CAST(ceil((x - {reach_x!r})/{wide!r} - r/2e0) AS bigint),"
        f" CAST(floor((x + {reach_x!r})/{wide!r} - r/2e0) AS bigint))) AS q FROM ({rows})"
    )
    return (
        f"SELECT * FROM ({cols}) WHERE abs({dx}*5e-1 + {dy}*{SQRT3 / 2!r}) <= {diag}"
        f" AND abs({dx}*-5e-1 + {dy}*{SQRT3 / 2!r}) <= {diag}"
    )


def cell(res: int = 8) -> str:
    return f"'hx{res}_' || CAST(q AS string) || '_' || CAST(r AS string)"


def cells_centred(source: str, res: int = 8) -> str:
    """Cells whose centre lies in ``min_x .. max_y`` of each row."""
    s = edge_m(res)
    wide, high = s * SQRT3, 1.5 * s
    rows = (
        f"SELECT *, unnest(generate_series(CAST(floor(min_y/{high!r}) AS bigint),"
        f" CAST(ceil(max_y/{high!r}) AS bigint))) AS r FROM {source}"
    )
    cols = (
        f"SELECT *, unnest(generate_series(CAST(floor(min_x/{wide!r} - r/2e0) AS bigint),"
        f" CAST(ceil(max_x/{wide!r} - r/2e0) AS bigint))) AS q FROM ({rows})"
    )
    return (
        f"SELECT * FROM (SELECT *, {wide!r}*(q + r/2e0) AS cx, {high!r}*r AS cy FROM ({cols}))"
        " WHERE cx BETWEEN min_x AND max_x AND cy BETWEEN min_y AND max_y"
    )


def project(source: str, lon: str = "lon", lat: str = "lat", x: str = "x", y: str = "y", meridian: str = "-123e0") -> str:
    """Grid coordinates of a northern zone, of zone 10 by default, beside all columns of the source."""
    e = P._E
    lam = f"radians({lon} - ({meridian}))"
    t = f"SELECT *, sinh(atanh(sin(radians({lat}))) - {e!r}*atanh({e!r}*sin(radians({lat})))) AS t_, {lam} AS l_ FROM {source}"
    xe = f"SELECT *, atan2(t_, cos(l_)) AS xi_, atanh(sin(l_)/sqrt(1 + t_*t_)) AS eta_ FROM ({t})"
    k = repr(P.SCALE_K0 * P.RADIUS)
    es = "".join(f" + {a!r}*cos({2 * j}*xi_)*sinh({2 * j}*eta_)" for j, a in enumerate(P._ALPHA, 1))
    ns = "".join(f" + {a!r}*sin({2 * j}*xi_)*cosh({2 * j}*eta_)" for j, a in enumerate(P._ALPHA, 1))
    return (
        f"SELECT * EXCLUDE (t_, l_, xi_, eta_), 5e5 + {k}*(eta_{es}) AS {x}, {k}*(xi_{ns}) AS {y} FROM ({xe})"
    )


def unproject(source: str, x: str = "x", y: str = "y", lon: str = "lon", lat: str = "lat", meridian: str = "-123e0") -> str:
    """Longitude and latitude beside all columns of the source."""
    k = repr(P.SCALE_K0 * P.RADIUS)
    a = f"SELECT *, {y}/{k} AS xi_, ({x} - 5e5)/{k} AS eta_ FROM {source}"
    xs = "".join(f" - {b!r}*sin({2 * j}*xi_)*cosh({2 * j}*eta_)" for j, b in enumerate(P._BETA, 1))
    es = "".join(f" - {b!r}*cos({2 * j}*xi_)*sinh({2 * j}*eta_)" for j, b in enumerate(P._BETA, 1))
    b = f"SELECT *, xi_{xs} AS x1_, eta_{es} AS e1_ FROM ({a})"
    c = f"SELECT *, asin(sin(x1_)/cosh(e1_)) AS chi_, atan2(sinh(e1_), cos(x1_)) AS lam_ FROM ({b})"
    ds = "".join(f" + {d!r}*sin({2 * j}*chi_)" for j, d in enumerate(P._DELTA, 1))
    return (
        f"SELECT * EXCLUDE (xi_, eta_, x1_, e1_, chi_, lam_), degrees(lam_) + ({meridian}) AS {lon},"
        f" degrees(chi_{ds}) AS {lat} FROM ({c})"
    )


def stat(index: str, name: str) -> str:
    fn = {"mean": "avg", "std": "stddev_pop", "min": "min", "max": "max", "count": "count"}[name]
    return f"{fn}({index})" if name == "count" else f"round({fn}({index}), 6)"


def wide_stats(source: str, keys: str, stats: tuple[str, ...], indices=("ndvi", "nbr", "ndwi")) -> str:
    """Rounded statistics and the pixel count of the last index with data."""
    cols = ", ".join(f"{stat(i, s)} AS {i}_{s}" for i in indices for s in stats)
    counts = ", ".join(f"nullif(count({i}), 0)" for i in reversed(indices))
    return (
        f"SELECT * FROM (SELECT {keys}, {cols}, coalesce({counts}) AS pixel_count FROM {source}"
        f" GROUP BY {keys}) WHERE pixel_count IS NOT NULL"
    )


def near_line(buffer: float, half: float = 15.0) -> str:
    """Distance from the square at (x, y) to the segment x0,y0-x1,y1 is within the buffer.

    Written as a minimum of distances: zero when they meet (the segment clipped to the
    square is not empty), else corner to segment and end to square."""
    dx, dy = "(x1 - x0)", "(y1 - y0)"

    def clip(p0: str, d: str, c: str) -> tuple[str, str]:
        # Parameter interval in which the segment is inside one slab of the square.
        lo, hi = f"(({c} - {half}) - {p0})", f"(({c} + {half}) - {p0})"
        inside = f"{lo} <= 0 AND {hi} >= 0"
        enter = f"CASE WHEN {d} <> 0 THEN least({lo}/nullif({d},0), {hi}/nullif({d},0)) WHEN {inside} THEN 0e0 ELSE 2e0 END"
        leave = f"CASE WHEN {d} <> 0 THEN greatest({lo}/nullif({d},0), {hi}/nullif({d},0)) WHEN {inside} THEN 1e0 ELSE -1e0 END"
        return enter, leave

    ex, lx = clip("x0", dx, "x")
    ey, ly = clip("y0", dy, "y")
    meets = f"greatest({ex}, {ey}, 0e0) <= least({lx}, {ly}, 1e0)"
    ends = " , ".join(
        f"sqrt(pow(greatest(abs({px} - x) - {half}, 0e0), 2) + pow(greatest(abs({py} - y) - {half}, 0e0), 2))"
        for px, py in (("x0", "y0"), ("x1", "y1"))
    )

    def corner(sx: float, sy: float) -> str:
        cx, cy = f"(x + {sx})", f"(y + {sy})"
        t = (
            f"least(greatest(coalesce((({cx} - x0)*{dx} + ({cy} - y0)*{dy})"
            f"/nullif({dx}*{dx} + {dy}*{dy}, 0), 0e0), 0e0), 1e0)"
        )
        return f"sqrt(pow({cx} - x0 - {t}*{dx}, 2) + pow({cy} - y0 - {t}*{dy}, 2))"

    corners = ", ".join(corner(sx, sy) for sx in (-half, half) for sy in (-half, half))
    return f"({meets} OR least({ends}, {corners}) <= {buffer})"


def line_pixels(source: str, buffer: float = 100.0, half: float = 15.0) -> str:
    """All (pixel, line) pairs in reach, tested pair by pair without tiles."""
    pad = buffer + half
    return (
        f"SELECT p.*, l.* FROM {source} p JOIN lines l"
        f" ON x BETWEEN least(x0, x1) - {pad} AND greatest(x0, x1) + {pad}"
        f" AND y BETWEEN least(y0, y1) - {pad} AND greatest(y0, y1) + {pad}"
        f" WHERE {near_line(buffer, half)}"
    )
