"""Exact k nearest neighbours within one table of points, without comparing all pairs.

A tree of pivots cuts the points into leaves of bounded size: every cell that is too large is
split by pivots of its own, level by level, with no limit on their number. A point first
searches its own leaf, which bounds its k-th distance. It is then sent down the tree, to the
cells that can hold a nearer point by the triangle inequality, and visits the leaves it reaches
nearest first: a few per round, after which its smaller bound drops most of the others.
Whatever meets in a task is bounded on both sides: a leaf, or the children of one cell, with a
block of points that ask for it.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rareclass.functions.hashing import hash_int, hash_key
from rareclass.session import materialize

BLOCK_POINTS = 4096
FAN = 32
FIRST_VISITS = 2
LARGEST = 1e150  # squares and products of smaller values are finite
_ROOT = "0"


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        diff = a[:, j, None] - b[None, :, j]
        out += diff * diff
    return out


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def _ids(block: pd.DataFrame) -> np.ndarray:
    """Ids as a typed array, numbers or texts alike."""
    return np.asarray(block["pid"].tolist())


def _candidates(q: np.ndarray, m: np.ndarray, same: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of every pair that can be among the ``k`` nearest of its row, in order.

    Distances by one matrix product choose them, with room for the rounding of the product.
    """
    qq, mm = (q * q).sum(axis=1), (m * m).sum(axis=1)
    near = qq[:, None] + mm[None, :] - 2 * (q @ m.T)
    near[same] = np.inf
    room = 8 * (q.shape[1] + 8) * np.finfo(float).eps * (qq + mm.max())
    kth = np.partition(near, k - 1, axis=1)[:, k - 1]
    return np.nonzero((near <= (kth + room)[:, None]) & ~same)


def nearest_in_block(queries: pd.DataFrame, members: pd.DataFrame, k: int, step: int = 512) -> pd.DataFrame:
    """The k nearest members of each query, itself excluded; ties go to the smaller id."""
    qid, mid = _ids(queries), _ids(members)
    by_id = np.argsort(mid, kind="stable")
    mid, m_all = mid[by_id], _matrix(members["x"])[by_id]
    q_all = _matrix(queries["x"])
    finite = bool((np.abs(q_all) < LARGEST).all() and (np.abs(m_all) < LARGEST).all())
    center = m_all.mean(axis=0)
    q_near, m_near = q_all - center, m_all - center
    kk = min(k, len(mid))
    asked, picked, dist = [], [], []
    for at in range(0, len(qid), step):
        same = qid[at:at + step, None] == mid[None, :]
        if finite:
            row, column = _candidates(q_near[at:at + step], m_near, same, kk)
        else:
            row, column = np.nonzero(~same)
        near = np.zeros(len(row))
        for j in range(q_all.shape[1]):
            diff = q_all[at + row, j] - m_all[column, j]
            near += diff * diff
        kept = np.isfinite(near)
        row, column, near = row[kept], column[kept], near[kept]
        order = np.lexsort((column, near, row))
        row, column, near = row[order], column[order], near[order]
        first = np.searchsorted(row, row)
        keep = np.arange(len(row)) - first < kk
        asked.append(at + row[keep])
        picked.append(column[keep])
        dist.append(near[keep])
    return pd.DataFrame({"pid": list(qid[np.concatenate(asked)]), "d2": np.concatenate(dist),
                         "nid": list(mid[np.concatenate(picked)])})


def _id_type(points: DataFrame) -> str:
    return points.schema["pid"].dataType.simpleString()


def _met(left: DataFrame, right: DataFrame, run, schema: str, block: int) -> DataFrame:
    """``run(rows of left, rows of right)`` of every cell, at most about ``block`` rows of the left at a time."""
    blocks = left.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    side = hash_int(8, hash_key("block", F.col("pid")))
    a = left.join(blocks, "cell").withColumn("part", (side % F.col("blocks")).cast("int")).drop("blocks")
    b = (right.join(blocks, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks"))
    names = [c.split()[0] for c in schema.split(", ")]

    def both(_, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if len(x) and len(y):
            return run(x, y)
        return pd.DataFrame({c: pd.Series([], dtype=object) for c in names})

    # Fresh column identities: both sides may stem from the same points.
    a, b = a.toDF(*a.columns), b.toDF(*b.columns)
    return a.groupBy("cell", "part").cogroup(b.groupBy("cell", "part")).applyInPandas(both, schema)


def _split(points: pd.DataFrame, children: pd.DataFrame) -> pd.DataFrame:
    """Every point to the child with the nearest pivot."""
    d = squared_distances(_matrix(points["x"]), _matrix(children["pivot"]))
    return pd.DataFrame({"pid": points["pid"], "x": points["x"], "cell": children["child"].to_numpy()[d.argmin(axis=1)],
                         "far": np.sqrt(d.min(axis=1))})


def _tree(points: DataFrame, block: int, fan: int) -> tuple[DataFrame, list[DataFrame]]:
    """(points with their leaf, ``(cell, child, pivot, radius)`` of every level of the tree)."""
    active, leaves, levels = points.select("pid", "x", F.lit(_ROOT).alias("cell")), [], []
    while True:
        large = materialize(active.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(f"n > {block}"), "large-cells")
        leaves.append(active.join(large, "cell", "left_anti").select("pid", "x", "cell"))
        if large.isEmpty():
            return reduce(DataFrame.union, leaves), levels
        inside = active.join(large, "cell")
        # Pivots follow the density of the points: the first of a cell in hash order.
        drawn = F.row_number().over(Window.partitionBy("cell").orderBy(hash_key("pivot", F.col("cell"), F.col("pid"))))
        pivots = (inside.withColumn("number", drawn).where(f"number <= {fan}").where(f"number <= ceil(2 * n / {block})")
                  .select("cell", F.concat_ws(".", "cell", F.col("number").cast("string")).alias("child"), F.col("x").alias("pivot")))
        pivots = materialize(pivots, "pivots")
        active = materialize(_met(inside.select("cell", "pid", "x"), pivots, _split,
                                  f"pid {_id_type(points)}, x array<double>, cell string, far double", block), "cells")
        radius = active.groupBy(F.col("cell").alias("child")).agg(F.max("far").alias("radius"))
        levels.append(materialize(pivots.join(radius, "child"), "level"))


def _lower_bounds(points: pd.DataFrame, children: pd.DataFrame) -> pd.DataFrame:
    """The children that can hold a point within ``bound``, with the least distance it can have."""
    pivots = _matrix(children["pivot"])
    d = np.sqrt(squared_distances(_matrix(points["x"]), pivots))
    gap = np.sqrt(squared_distances(pivots, pivots))
    home = d.argmin(axis=1)
    own = d[np.arange(len(d)), home]
    # Distance to the plane between two pivots, and to the ball around a pivot.
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (d * d - (own * own)[:, None]) / (2 * gap[home])
    low = np.maximum(np.nan_to_num(plane, nan=0.0, posinf=0.0, neginf=0.0), d - children["radius"].to_numpy()[None, :])
    low = np.maximum(low, points["low"].to_numpy()[:, None])
    row, child = np.nonzero(low <= _slack(points["bound"].to_numpy())[:, None])
    out = points.iloc[row][["pid", "x", "bound", "home"]].copy()
    out["cell"], out["low"] = children["child"].to_numpy()[child], low[row, child]
    return out


def _slack(bound):
    """Room for rounding; it can only add cells."""
    return bound * (1 + 1e-9) + 1e-9


def _reached(asked: DataFrame, levels: list[DataFrame], block: int) -> DataFrame:
    """``(pid, x, cell, low)``: the leaves, other than its own, that a point's bound reaches."""
    frontier = asked.withColumn("cell", F.lit(_ROOT)).withColumn("low", F.lit(0.0))
    schema = f"pid {_id_type(asked)}, x array<double>, bound double, home string, cell string, low double"
    leaves = []
    for level, below in zip(levels, [*levels[1:], None]):
        frontier = materialize(_met(frontier, level, _lower_bounds, schema, block), "frontier")
        parents = None if below is None else below.select("cell").distinct()
        leaves.append(frontier if below is None else frontier.join(parents, "cell", "left_anti").select(*frontier.columns))
        if below is not None:
            frontier = frontier.join(parents, "cell", "left_semi")
    return reduce(DataFrame.unionByName, leaves).where("cell <> home").select("pid", "x", "cell", "low")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("pid").orderBy("d2", "nid")
    return found.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}").drop("rank")


def _searched(points: DataFrame, k: int, block: int, fan: int) -> tuple[DataFrame, list[DataFrame]]:
    """(the k best ``(pid, d2, nid)`` of each point, the ``pid`` of every visit to a leaf)."""
    placed, levels = _tree(points, block, fan)
    kind = _id_type(points)

    def search(asked: DataFrame) -> DataFrame:
        return _met(asked.select("cell", "pid", "x"), placed.select("cell", "pid", "x"),
                    lambda x, y: nearest_in_block(x, y, k), f"pid {kind}, d2 double, nid {kind}", block)

    if levels:
        placed = materialize(placed, "leaves")
    best, visits = materialize(search(placed), "best"), [placed.select("pid")]
    if not levels:
        return best, visits

    def bounds() -> DataFrame:
        return best.groupBy("pid").agg(F.when(F.count(F.lit(1)) == k, F.sqrt(F.max("d2"))).alias("bound"))

    endless = F.coalesce("bound", F.lit(float("inf")))  # fewer than k found so far
    asked = placed.join(bounds(), "pid", "left").select("pid", "x", F.col("cell").alias("home"), endless.alias("bound"))
    rest, step = materialize(_reached(asked, levels, block), "visits"), FIRST_VISITS
    nearest_first = Window.partitionBy("pid").orderBy("low", "cell")
    while True:
        open_visits = rest.join(bounds(), "pid", "left").where(F.col("low") <= _slack(endless)).drop("bound")
        ranked = materialize(open_visits.withColumn("rank", F.row_number().over(nearest_first)), "ranked-visits")
        if ranked.isEmpty():
            return best, visits
        now, rest = ranked.where(f"rank <= {step}"), ranked.where(f"rank > {step}").drop("rank")
        best = materialize(_top(best.unionByName(search(now)), k), "best")
        visits.append(now.select("pid"))
        step *= 4


def nearest_neighbors(points: DataFrame, k: int, block: int = BLOCK_POINTS, fan: int = FAN) -> DataFrame:
    """``points`` (pid, x, m; x distinct) -> (pid, nn) with nn = array of (d2, nid, nx, nm).

    At most ``k`` neighbours of each point, nearest first, ties by the smaller id. ``block``
    bounds leaves and the points that ask for one at a time, ``fan`` the children of a cell.
    """
    points = materialize(points.select("pid", "x", F.col("m").cast("bigint").alias("m")), "points")
    best, _ = _searched(points, k, block, fan)
    other = points.select(F.col("pid").alias("nid"), F.col("x").alias("nx"), F.col("m").alias("nm"))
    item = F.struct("d2", "nid", "nx", "nm")  # k at most for a point
    return best.join(other, "nid").groupBy("pid").agg(F.array_sort(F.collect_list(item)).alias("nn"))


def leaf_visits(points: DataFrame, k: int, block: int = BLOCK_POINTS, fan: int = FAN) -> DataFrame:
    """``(pid, visits)``: the number of leaves that the search for each point compares it with."""
    points = materialize(points.select("pid", "x"), "points")
    _, visits = _searched(points, k, block, fan)
    return reduce(DataFrame.union, visits).groupBy("pid").agg(F.count(F.lit(1)).alias("visits"))
