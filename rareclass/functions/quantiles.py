"""Exact quantiles (linear interpolation) of many columns, without collecting a group.

Spark's ``percentile`` keeps every distinct value of a group in one task, so it is used
only where a count has shown that a group is small. Larger groups are narrowed first: a
sample proposes cut points around the wanted ranks, and every value is counted in the interval
between cuts where it lies, so that the counts decide and the sample never affects the result.
What is left around a rank is counted by value (copies collapse before the shuffle) and the
ranks are read off.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_ROUNDS = 60
GRID = 200  # sample quantiles per bracket


@dataclass
class _Rank:
    """One wanted order statistic; the open bracket (lo, hi) holds it."""

    group: object
    column: int
    rank: int
    lo: float
    hi: float
    below: int
    inside: int
    value: float | None = None


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], by: str | None = None,
                    leaf_rows: int = 200_000, sample_rows: int = 20_000) -> dict:
    """``{(group, column, prob): value}``; NULLs are skipped, an empty column gives None.

    ``by`` names a column with few values (a class label). The result has
    groups * columns * probs entries, a size set by the schema and not by the data.
    """
    group = F.lit(0) if by is None else F.col(by)
    wide = df.select(group.alias("g"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    places = [f"c{i}" for i in range(len(columns))]
    counts = wide.groupBy("g").agg(*[F.count(p).alias(p) for p in places]).collect()
    out = {}
    if max((r[p] for r in counts for p in places), default=0) <= leaf_rows:
        grid = F.array(*map(F.lit, probs))
        found = wide.groupBy("g").agg(*[F.percentile(p, grid).alias(p) for p in places]).collect()
        for r in found:
            for p, c in zip(places, columns):
                for i, q in enumerate(probs):
                    out[(r["g"], c, q)] = None if r[p] is None else r[p][i]
    else:
        out = _narrowed(wide, counts, places, columns, probs, leaf_rows, sample_rows)
    return {((None if by is None else g), c, q): v for (g, c, q), v in out.items()}


def _narrowed(wide, counts, places, columns, probs, leaf_rows, sample_rows) -> dict:
    ranks: dict[tuple, _Rank] = {}
    for r in counts:
        for i, p in enumerate(places):
            for q in probs:
                for k in {math.floor(q * (r[p] - 1)), math.ceil(q * (r[p] - 1))} if r[p] else ():
                    ranks.setdefault((r["g"], i, k), _Rank(r["g"], i, k, -math.inf, math.inf, 0, r[p]))
    for _ in range(MAX_ROUNDS):
        large = [t for t in ranks.values() if t.value is None and t.inside > leaf_rows]
        if not large:
            break
        _narrow(wide, large, sample_rows)
    else:
        raise RuntimeError(f"Quantiles were not found in {MAX_ROUNDS} rounds.")
    _read(wide, [t for t in ranks.values() if t.value is None])
    out = {}
    for r in counts:
        for i, (p, c) in enumerate(zip(places, columns)):
            for q in probs:
                if not r[p]:
                    out[(r["g"], c, q)] = None
                    continue
                h = q * (r[p] - 1)
                a, b = ranks[(r["g"], i, math.floor(h))].value, ranks[(r["g"], i, math.ceil(h))].value
                out[(r["g"], c, q)] = a + (b - a) * (h - math.floor(h))
    return out


def _brackets(ranks: list[_Rank]) -> dict[tuple, list[_Rank]]:
    """Ranks by ``(group, column, lo)``: those of one group and column lie in one open interval or in two that do not meet."""
    out: dict[tuple, list[_Rank]] = {}
    for t in ranks:
        out.setdefault((t.group, t.column, t.lo), []).append(t)
    return out


def _per_column(wide: DataFrame, asked: set[tuple], one, schema: str) -> DataFrame:
    """``one(group, column, values, random)`` of every batch, for the asked groups and columns.

    ``one`` gives arrays in the order of ``schema``; each value is looked at once a pass.
    """
    fields = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng((17, TaskContext.get().partitionId()))
        for batch in batches:
            group = batch.column("g").to_numpy(zero_copy_only=False)
            for g, c in asked:
                column = batch.column(f"c{c}")
                values = column.filter(pa.compute.and_(column.is_valid(), pa.array(group == g))).to_numpy()
                if len(values):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in one(g, c, values, rng)], names=fields)

    return wide.mapInArrow(run, schema)


def _slots(cuts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Slot ``2 * i`` lies between cuts, ``2 * i + 1`` is the cut itself."""
    return np.searchsorted(cuts, values, "left") + np.searchsorted(cuts, values, "right")


def _narrow(wide: DataFrame, large: list[_Rank], sample_rows: int) -> None:
    """One round of narrowing for every rank whose bracket still holds many rows.

    A sample of each bracket proposes cut points; all values of a group and column are then
    counted by the interval between cuts that they lie in, by one binary search each.
    """
    brackets = _brackets(large)
    number = {key: i for i, key in enumerate(brackets)}
    edges: dict[tuple, list[tuple]] = {}
    for (g, c, lo), ranks in brackets.items():
        edges.setdefault((g, c), []).append((lo, ranks[0].hi, number[(g, c, lo)], min(1.0, sample_rows / ranks[0].inside)))
    tables = {k: tuple(np.array(x) for x in zip(*sorted(v))) for k, v in edges.items()}

    def sample(g, c, values, rng):
        lo, hi, t, share = tables[(g, c)]
        at = np.maximum(np.searchsorted(lo, values, "left") - 1, 0)
        keep = (values > lo[at]) & (values < hi[at]) & (rng.random(len(values)) < share[at])
        return t[at[keep]], values[keep]

    grid = [i / GRID for i in range(GRID + 1)]
    found = {r["t"]: r["q"] for r in _per_column(wide, set(tables), sample, "t bigint, v double").groupBy("t").agg(
        F.percentile("v", F.array(*map(F.lit, grid))).alias("q")).collect()}
    slack = 2.0 / math.sqrt(sample_rows) + 1.0 / GRID
    proposed: dict[tuple, set] = {}
    for key, ranks in brackets.items():
        q = found.get(number[key])
        for t in ranks:
            at = (t.rank - t.below) / t.inside
            trial = (q[max(0, bisect.bisect_right(grid, at - slack) - 1)], q[min(GRID, bisect.bisect_left(grid, at + slack))]) if q else ()
            proposed.setdefault(key[:2], set()).update(x for x in (t.lo, t.hi, *trial) if math.isfinite(x))
    cuts = {k: np.array(sorted(v)) for k, v in proposed.items()}

    def count(g, c, values, rng):
        slot, n = np.unique(_slots(cuts[(g, c)], values), return_counts=True)
        return np.full(len(slot), g), np.full(len(slot), c), slot, n

    counted = _per_column(wide, set(cuts), count, "g bigint, c bigint, slot bigint, n bigint")
    totals = {k: np.zeros(2 * len(v) + 1, dtype=np.int64) for k, v in cuts.items()}
    for r in counted.groupBy("g", "c", "slot").agg(F.sum("n").alias("n")).collect():  # two per cut at most
        totals[(r["g"], r["c"])][r["slot"]] = r["n"]
    for (g, c, _), ranks in brackets.items():
        n, points = totals[(g, c)], cuts[(g, c)]
        upto = np.cumsum(n)
        for t in ranks:
            slot = int(np.searchsorted(upto, t.rank, "right"))
            if slot % 2:
                t.value = float(points[slot // 2])
            else:
                t.below, t.inside = int(upto[slot] - n[slot]), int(n[slot])
                t.lo = float(points[slot // 2 - 1]) if slot else -math.inf
                t.hi = float(points[slot // 2]) if slot // 2 < len(points) else math.inf


def _read(wide: DataFrame, left: list[_Rank]) -> None:
    """Order statistics among the values left in each bracket."""
    if not left:
        return
    brackets = _brackets(left)
    number = {key: i for i, key in enumerate(brackets)}
    edges: dict[tuple, list[tuple]] = {}
    for (g, c, lo), ranks in brackets.items():
        edges.setdefault((g, c), []).append((lo, ranks[0].hi, number[(g, c, lo)]))
    tables = {k: tuple(np.array(x) for x in zip(*sorted(v))) for k, v in edges.items()}

    def inside(g, c, values, rng):
        lo, hi, t = tables[(g, c)]
        at = np.maximum(np.searchsorted(lo, values, "left") - 1, 0)
        keep = (values > lo[at]) & (values < hi[at])
        value, n = np.unique(values[keep], return_counts=True)
        return t[np.maximum(np.searchsorted(lo, value, "left") - 1, 0)], value, n

    spark = wide.sparkSession
    counted = _per_column(wide, set(tables), inside, "t bigint, v double, n bigint").groupBy("t", "v").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("t").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("upto", F.sum("n").over(w))
    wanted = [(number[(t.group, t.column, t.lo)], t.rank - t.below) for t in left]
    asked = spark.createDataFrame(sorted(set(wanted)), "t bigint, r bigint")
    hits = upto.join(F.broadcast(asked), "t").where("r < upto and r >= upto - n")  # one literal row per rank
    at = {(h["t"], h["r"]): h["v"] for h in hits.select("t", "r", "v").collect()}
    for t, key in zip(left, wanted):
        t.value = at[key]


def quantile_frame(df: DataFrame, columns: list[str], probs: list[float], by: str | None = None, **kw) -> DataFrame:
    """The result of :func:`exact_quantiles` as rows ``(group, feature, prob, value)``."""
    found = exact_quantiles(df, columns, probs, by, **kw)
    rows = [(g, c, p, v) for (g, c, p), v in found.items()]
    return df.sparkSession.createDataFrame(rows, "group int, feature string, prob double, value double")
