"""Exact largest inner products by dual-tree search over cover trees.

Vectors are dealt to the nearest of some pivots and, within a pivot, to blocks of bounded
size; queries likewise to groups. A task holds one block and the groups that visit it, indexes
both in cover trees and walks pairs of nodes: a pair is dropped when centres and covering
radii bound its products below the worst kth score of the query node. Every group first
visits the block of its own pivot; the kth scores found there then decide, by the same bound,
which other pivots' cells and then which of their blocks it visits at all. Products are of
integers and exact at any size; bounds have a margin for their rounding, and where numbers are
too large for bounds nothing is pruned.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.common import keep, small_side

#: Results for each query; scale of the integers.
K, SCALE = 20, 64
#: Vectors of a block, queries of a group, queries that visit a block in one task.
BLOCK, GROUP, WAVE = 4096, 256, 1 << 16
#: Rows that pivots are chosen from, vectors for each pivot, most pivots.
SAMPLE, PER_PIVOT, PIVOTS = 2048, 2048, 256
#: Points of a leaf of data and of queries, and children of a node.
LEAF, QUERY_LEAF, FANOUT = 512, 64, 8
NOTHING = np.iinfo(np.int64).min
#: What stands for scores below and above a long.
LOW, HIGH = NOTHING + 1, np.iinfo(np.int64).max
#: Coordinates from here on have no squares to prune by.
HUGE = 1e100


def scaled(x: np.ndarray) -> np.ndarray:
    """The integers of components, as floating point; infinite where 64 times them is."""
    with np.errstate(over="ignore"):
        return np.floor(SCALE * x)


def integers(x: np.ndarray) -> np.ndarray:
    """The integers of components, as Python's."""
    flat = [int(c) * SCALE if abs(c) >= 2.0**53 else math.floor(SCALE * c) for c in x.ravel().tolist()]
    return np.array(flat, object).reshape(x.shape)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows of components; in floating point only where that is exact.

    Products above or below a long become ``HIGH`` and ``LOW``.
    """
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    u, v = scaled(a), scaled(b)
    most = float(np.abs(u).max()) * float(np.abs(v).max()) * a.shape[1]
    if most < 2**52:
        return (u @ v.T).astype(np.int64)
    if most < 2**62 and max(np.abs(u).max(), np.abs(v).max()) < 2**62:
        return u.astype(np.int64) @ v.astype(np.int64).T
    out = np.empty((len(a), len(b)), np.int64)
    wide, left = integers(b).T, integers(a)
    for i in range(len(a)):
        out[i] = [min(max(p, LOW), HIGH) for p in left[i] @ wide]
    return out


class Tree:
    """A cover tree built from the top: children are far apart and cover their parent."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.leaf = leaf
        self.points = scaled(points)
        self.huge = bool(self.points.size) and float(np.abs(self.points).max()) > HUGE
        if self.huge:  # one leaf with a ball of any size
            self.points = np.zeros_like(self.points)
        self.square = (self.points**2).sum(1)
        #: Per node: centre (a point), covering radius, norm of the centre, members, children.
        self.center: list[int] = []
        self.radius: list[float] = []
        self.members: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.root = self._node(np.arange(len(points)), int(((self.points - self.points.mean(0)) ** 2).sum(1).argmin()))
        self.norm = np.sqrt(self.square[self.center])

    def _far(self, members: np.ndarray, center: int) -> np.ndarray:
        square = self.square[members] + self.square[center] - 2 * (self.points[members] @ self.points[center])
        return np.sqrt(np.maximum(square, 0))

    def _node(self, members: np.ndarray, center: int) -> int:
        far = self._far(members, center)
        number, radius = len(self.center), np.inf if self.huge else float(far.max())
        self.center.append(center)
        self.radius.append(radius)
        self.members.append(members)
        self.children.append([])
        if len(members) <= self.leaf or radius == 0 or self.huge:
            return number
        centers, near = [center], np.zeros(len(members), np.int64)
        while len(centers) < FANOUT and far.max() > radius / 2:
            new = int(members[far.argmax()])
            to_new = self._far(members, new)
            near[to_new < far] = len(centers)
            far = np.minimum(far, to_new)
            centers.append(new)
        if len(centers) > 1:
            self.children[number] = [self._node(members[near == j], c) for j, c in enumerate(centers) if (near == j).any()]
        return number


def bound(dot, radius_a, norm_a, radius_b, norm_b):
    """Above every inner product of a point of one ball with a point of the other.

    No number, where a ball has no bounds; that is greater than any.
    """
    out = dot + radius_a * norm_b + radius_b * norm_a + radius_a * radius_b
    return out + 1e-9 * (radius_a + norm_a) * (radius_b + norm_b) + 1e-6


class Search:
    """Best ``k`` of a block for each query, kept in order of score, then id."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, k: int):
        self.queries, self.ids, self.k = queries, query_ids, k
        #: Known to be reached by k candidates elsewhere; lower scores cannot count.
        self.floor = floor
        self.score = np.full((len(queries), k), NOTHING, np.int64)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max, np.int64)

    def worst(self, members: np.ndarray) -> int:
        return int(np.maximum(self.score[members, -1], self.floor[members]).min())

    def offer(self, members: np.ndarray, points: np.ndarray, ids: np.ndarray) -> None:
        score = exact_products(self.queries[members], points)
        least = np.maximum(self.score[members, -1], self.floor[members])
        good = (score >= least[:, None]) & (ids[None, :] != self.ids[members][:, None])
        some = np.flatnonzero(good.any(1))
        if not len(some):
            return
        rows = members[some]
        scores = np.concatenate([self.score[rows], np.where(good[some], score[some], NOTHING)], axis=1)
        known = np.where(good[some], ids[None, :], np.iinfo(np.int64).max)
        found = np.concatenate([self.found[rows], known], axis=1)
        order = np.lexsort((found, -scores.clip(NOTHING + 1), scores == NOTHING), axis=-1)[:, : self.k]
        self.score[rows] = np.take_along_axis(scores, order, 1)
        self.found[rows] = np.take_along_axis(found, order, 1)

    def walk(self, own: Tree, data: Tree, data_ids: np.ndarray, data_points: np.ndarray) -> None:
        """Both trees together; the most promising pair of nodes first."""
        stack = [(own.root, data.root, np.inf)]
        while stack:
            q, d, top = stack.pop()
            if top < self.worst(own.members[q]):
                continue
            parts_q, parts_d = own.children[q], data.children[d]
            if not parts_q and not parts_d:
                self.offer(own.members[q], data_points[data.members[d]], data_ids[data.members[d]])
                continue
            # Open the wider node; a leaf stays.
            if parts_d and (not parts_q or data.radius[d] >= own.radius[q]):
                pairs = [(q, x) for x in parts_d]
            else:
                pairs = [(x, d) for x in parts_q]
            a, b = ([p[i] for p in pairs] for i in (0, 1))
            dot = (own.points[np.array(own.center)[a]] * data.points[np.array(data.center)[b]]).sum(1)
            with np.errstate(invalid="ignore"):
                tops = bound(dot, np.array(own.radius)[a], own.norm[a], np.array(data.radius)[b], data.norm[b])
            tops = np.where(np.isnan(tops), np.inf, tops)
            stack += [(*pairs[i], float(tops[i])) for i in np.argsort(tops)]


def whole(vectors: pd.Series) -> np.ndarray:
    """Components of the rows."""
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 1))


def search_block(key, queries: pd.DataFrame, data: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    if len(queries) and len(data):
        points, ids = whole(data["v"]), data["vec_id"].to_numpy(np.int64)
        tree = Tree(points, LEAF)
        for _, group in queries.groupby("qg", sort=True):
            own = whole(group["v"])
            search = Search(own, group["vec_id"].to_numpy(np.int64), group["floor"].to_numpy(np.int64), k)
            search.walk(Tree(own, QUERY_LEAF), tree, ids, points)
            row, at = np.nonzero(search.score != NOTHING)
            out.append(pd.DataFrame({"query_id": search.ids[row], "vec_id": search.found[row, at], "score": search.score[row, at]}))
    return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})


def prepared(vectors: DataFrame) -> DataFrame:
    """Rows that take part: components of every vector as bytes, and its dimension."""

    def run(frames):
        for f in frames:
            out = []
            for vec_id, x in zip(f["vec_id"], f["embedding"], strict=True):
                if x is None or vec_id is None or vec_id != vec_id or not len(x):
                    continue
                v = np.array([np.nan if c is None else c for c in x], np.float64)
                if np.isfinite(v).all():
                    out.append((int(vec_id), v.tobytes(), len(v)))
            yield pd.DataFrame(out, columns=["vec_id", "v", "dim"]).astype({"vec_id": "int64", "dim": "int32"})

    narrow = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter("vec_id is not null and embedding is not null")
    return narrow.mapInPandas(run, "vec_id long, v binary, dim int")


def spread(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of the sample, each the furthest from those before."""
    chosen, far = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def dealt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pivot (``cell``) of every row and how far it is; the pivots themselves.

    Pivots come from a bounded sample and are at most ``PIVOTS`` for each dimension.
    """
    draw = F.pmod(F.xxhash64("vec_id", F.lit("pivot")), F.lit(1 << 40))
    count = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}
    pivots: dict[int, np.ndarray] = {}
    for dim, n in sorted(count.items()):
        drawn = rows.filter((F.col("dim") == dim) & (draw < int((1 << 40) * min(1.0, SAMPLE / n)))).select("vec_id", "v").collect()
        sample = np.array([np.frombuffer(r["v"], np.float64) for r in sorted(drawn, key=lambda r: (r["vec_id"], bytes(r["v"])))])
        sample = scaled(sample).clip(-HUGE, HUGE) if len(sample) else np.zeros((1, dim))
        pivots[dim] = spread(sample, max(1, min(PIVOTS, n // PER_PIVOT)))

    def run(frames):
        for f in frames:
            cell, far = np.zeros(len(f), np.int32), np.zeros(len(f))
            for dim, own in pivots.items():
                at = np.flatnonzero(f["dim"].to_numpy() == dim)
                if len(at):
                    x = scaled(whole(f["v"].iloc[at]))
                    near = ((own**2).sum(1)[None, :] - 2 * x.clip(-HUGE, HUGE) @ own.T).argmin(1)
                    huge = (np.abs(x) > HUGE).any(1)
                    cell[at] = near
                    far[at] = np.where(huge, np.inf, np.sqrt(((x.clip(-HUGE, HUGE) - own[near]) ** 2).sum(1)) * (1 + 1e-9))
            yield f.assign(cell=cell, far=far)

    centers = [(d, c, p.tolist(), float(np.sqrt((p**2).sum()))) for d, own in pivots.items() for c, p in enumerate(own)]
    named = rows.sparkSession.createDataFrame(centers, "dim int, cell int, p_center array<double>, p_norm double")
    return rows.mapInPandas(run, "vec_id long, v binary, dim int, cell int, far double"), named


def grouped(rows: DataFrame, name: str, most: int) -> DataFrame:
    """Cut cells into groups of about ``most`` rows; the group's name is a column."""
    sizes = rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / most).alias("parts"))
    joined = rows.join(small_side(keep(sizes, "sizes"), "16"), ["dim", "cell"])
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    return joined.withColumn(name, F.concat_ws(":", "dim", "cell", part)).drop("parts")


def balls(rows: DataFrame, name: str, extra: str | None = None) -> DataFrame:
    """Centre, covering radius and norm of the centre of every group."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        x = scaled(whole(f["v"]))
        huge = float(np.abs(x).max()) > HUGE
        x = np.zeros_like(x) if huge else x
        center = x.mean(0)
        radius = np.inf if huge else float(np.sqrt(((x - center) ** 2).sum(1).max()))
        row = {name: f[name].iloc[0], "dim": f["dim"].iloc[0], "cell": f["cell"].iloc[0], "center": center, "radius": radius, "norm": float(np.sqrt((center**2).sum()))}
        return pd.DataFrame([row | ({extra: int(f[extra].min())} if extra else {})])

    schema = f"{name} string, dim int, cell int, center array<double>, radius double, norm double" + (f", {extra} long" if extra else "")
    return rows.groupBy(name).applyInPandas(run, schema)


def visits(queries: DataFrame, data: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Search every (``qg``, ``db``) of ``pairs``; ``queries`` have their ``floor``."""
    pairs = keep(pairs.select("qg", "db"), "pairs")
    sizes = queries.groupBy("qg").count()
    load = pairs.join(sizes, "qg").groupBy("db").agg(F.ceil(F.sum("count") / WAVE).cast("int").alias("waves"))
    targets = pairs.join(load, "db").withColumn("wave", F.pmod(F.xxhash64("qg"), F.col("waves")).cast("int"))
    asked = queries.join(targets, "qg").select("db", "wave", "qg", "vec_id", "v", "floor")
    held = data.join(load.withColumn("wave", F.explode(F.sequence(F.lit(0), F.col("waves") - 1))), "db").select("db", "wave", "vec_id", "v")

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return search_block(key, left, right, k)

    return asked.groupBy("db", "wave").cogroup(held.groupBy("db", "wave")).applyInPandas(run, "query_id long, vec_id long, score long")


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_products(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """The ``k`` rows of largest inner product with each query, ties to the smaller id.

    ``is_query``: a condition on ``vec_id``. Takes ``vec_id`` and ``embedding``; other columns
    are left out. Rows with a null id, a null or empty vector, or a null or non-finite
    component take no part; all others do, however large. A result whose score is not below
    the largest and above the two smallest numbers of a long stops the query. Vectors meet
    only those of their dimension.
    A candidate with the query's id is its own row; of queries that repeat an id the one of
    least bytes asks; repeated candidates count each. Fewer than ``k`` candidates are all
    returned; an empty table gives none.
    """
    placed, pivots = dealt(keep(prepared(vectors), "vectors"))
    rows = keep(placed, "dealt")
    data = keep(grouped(rows, "db", BLOCK), "data")
    one = Window.partitionBy("vec_id").orderBy("v")
    asking = rows.filter(is_query).withColumn("_n", F.row_number().over(one)).filter("_n = 1").drop("_n")
    queries = keep(grouped(asking, "qg", GROUP), "queries")
    blocks = keep(balls(data, "db"), "blocks")
    none = queries.withColumn("floor", F.lit(int(NOTHING)))
    # Every cell has a block 0 unless all its ids hash elsewhere; then its first one.
    own_cell = data.groupBy("dim", "cell").agg(F.min("db").alias("db"))
    seeds = queries.select("qg", "dim", "cell").distinct().join(own_cell, ["dim", "cell"]).select("qg", "db")
    seeds = keep(seeds, "seeds")
    first = keep(visits(none, data, seeds, k), "first")
    floors = best(first, k).groupBy("query_id").agg(F.min("score").alias("s"), F.count("*").alias("n"))
    floors = floors.select(F.col("query_id").alias("vec_id"), F.when(F.col("n") == k, F.col("s")).otherwise(F.lit(int(NOTHING))).alias("floor"))
    queries = keep(queries.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(int(NOTHING)))), "floors")
    groups = balls(queries, "qg", "floor").toDF("qg", "dim", "q_cell", "q_center", "q_radius", "q_norm", "floor").drop("q_cell")
    reach = data.groupBy("dim", "cell").agg(F.max("far").alias("p_radius"))
    # As many cells as pivots, so they go to every group; only blocks of cells in reach follow.
    cells = F.broadcast(pivots.join(reach, ["dim", "cell"]))

    def above(center: str, radius: str, norm: str):
        dot = F.aggregate(F.zip_with("q_center", center, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        return bound(dot, F.col("q_radius"), F.col("q_norm"), F.col(radius), F.col(norm)) >= F.col("floor").cast("double")

    near = groups.join(cells, "dim").filter(above("p_center", "p_radius", "p_norm")).drop("p_center", "p_radius", "p_norm")
    pairs = near.join(blocks, ["dim", "cell"]).filter(above("center", "radius", "norm")).select("qg", "db")
    rest = visits(queries, data, pairs.join(seeds, ["qg", "db"], "left_anti"), k)
    found = best(first.union(rest), k).select("query_id", "rank", "vec_id", "score")
    wrong = F.concat(F.lit("the score of vectors "), F.col("query_id"), F.lit(" and "), F.col("vec_id"), F.lit(" is no long"))
    fits = F.when((F.col("score") > LOW) & (F.col("score") < HIGH), F.col("score")).otherwise(F.raise_error(wrong).cast("long"))
    return found.withColumn("score", fits)
