"""Random forests of histogram trees, several forests on one table grown side by side.

The rows are binned once, one byte per feature, and written in blocks. A level of all trees is
one pass: a task walks the rows of a block down every tree to the nodes that are open, adds them
to the histograms of the node's own features, and sends these on; a second step adds up the
histograms of a few nodes and finds their best cuts. Nothing is kept per row and tree: a row's
number of draws is made again from the seed of its tree and block. The result is a model of the
library, which scores and saves it as its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from rareclass.errors import DatasetError
from rareclass.session import materialize, parallel, scratch, shared_dir

BLOCK_ROWS = 32_768
CHUNK_CELLS = 262_144  # cells of the histograms that travel and are added up together
MIN_SAMPLE = 10_000
MAX_CLASSES = 100
_EPSILON = np.finfo(float).eps


# --- bins ---------------------------------------------------------------------------------

def cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` cuts between the distinct values, with about equally many values between them."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) <= bins - 1:
        return middles
    stride, upto = len(values) / bins, np.cumsum(counts)
    out, target = [], stride
    for i in range(1, len(distinct)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(middles[i - 1])
            target += stride
    return np.array(out)


@dataclass
class Binned:
    """Rows in blocks ``(part, block, bins, label)``: a byte or two for each feature of a row, one for its class."""

    blocks: DataFrame | None
    cuts: list[np.ndarray]
    classes: int

    @property
    def bins(self) -> int:
        return max(len(c) for c in self.cuts) + 1

    @property
    def kind(self) -> type:
        return np.uint8 if self.bins <= 256 else np.uint16


def bin_rows(rows: DataFrame, label: str, max_bins: int, seed: int, block_rows: int = BLOCK_ROWS) -> Binned:
    """``rows(features, label)`` in bins. Cuts come from a sample, as the library takes them, and only place them."""
    rows = rows.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"))
    odd = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    bad = F.col("x").isNull() | odd | F.col("y").isNull() | F.isnan("y") | (F.col("y") < 0) | (F.col("y") != F.floor("y"))
    n, wrong, last = rows.agg(F.count(F.lit(1)), F.count_if(bad), F.max("y")).first()
    if not n or wrong or last >= MAX_CLASSES:
        raise DatasetError(f"A forest needs rows of finite features and classes 0, 1, ... below {MAX_CLASSES}; {wrong} of {n} rows are others.")
    wanted = max(max_bins * max_bins, MIN_SAMPLE)
    seen = rows.select("x") if n <= wanted else rows.select("x").sample(wanted / n, seed)
    found = seen.toArrow()["x"].combine_chunks()  # about max_bins**2 rows
    values = found.flatten().to_numpy().reshape(len(found), -1)
    cuts = [cut_points(values[:, j], min(max_bins, n)) for j in range(values.shape[1])]
    binned = Binned(None, cuts, int(last) + 1)
    kind = binned.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, waiting = TaskContext.get().partitionId(), 0, []

        def flushed(last_one: bool):
            nonlocal block, waiting
            while waiting and (last_one or sum(len(y) for _, y in waiting) >= block_rows):
                x, y = (np.concatenate(v) for v in zip(*waiting))
                waiting = [(x[block_rows:], y[block_rows:])] if len(y) > block_rows else []
                x, y = x[:block_rows], y[:block_rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part]), pa.array([block]), pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())],
                    names=["part", "block", "bins", "label"])
                block += 1

        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                placed = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1).astype(kind)
                waiting.append((placed, batch.column("y").to_numpy().astype(np.uint8)))
                yield from flushed(False)
        yield from flushed(True)

    blocks = materialize(rows.mapInArrow(run, "part bigint, block bigint, bins binary, label binary"), "forest-rows")
    # As many tasks as cores, of equal size: each sends on its histograms once in a pass.
    binned.blocks = blocks.repartition(rows.sparkSession.sparkContext.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)
    return binned


# --- trees --------------------------------------------------------------------------------

def features_per_node(strategy: str, n: int, trees: int) -> int:
    """How many of ``n`` features a node chooses from, by the library's names of strategies."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    named = {"all": n, "sqrt": math.ceil(math.sqrt(n)), "log2": max(1, math.ceil(math.log2(n))), "onethird": math.ceil(n / 3)}
    if strategy in named:
        return named[strategy]
    return min(n, int(strategy)) if strategy.isdigit() else math.ceil(float(strategy) * n)


@dataclass
class _Tree:
    """Nodes in order of their making; ``child`` is the left one, the right one follows it, -1 is no child."""

    seed: list[int]
    depth: int
    least: int
    rate: float
    bootstrap: bool
    per_node: int
    features: int
    draws: np.random.Generator = field(init=False)
    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])
    child: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    counts: list[np.ndarray] = field(default_factory=lambda: [None])
    open: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.intp))
    subsets: np.ndarray = None
    level: int = 0

    def __post_init__(self):
        self.draws = np.random.default_rng([*self.seed, 0])
        self._draw()

    def _draw(self) -> None:
        """The features from which each open node chooses, in their order."""
        order = self.draws.random((len(self.open), self.features)).argsort(axis=1)
        self.subsets = np.sort(order[:, :self.per_node], axis=1)

    def split(self, found: list) -> None:
        """Take the best cuts ``(gain, feature's place, cut, left counts, all counts)`` of the open nodes."""
        opened = []
        for at, node in enumerate(self.open):
            gain, place, cut, left, total = found[at]
            self.counts[node] = total
            if gain <= 0 or self.level >= self.depth:
                continue
            self.feature[node], self.cut[node], self.gain[node] = int(self.subsets[at, place]), cut, gain
            self.child[node] = len(self.child)
            for counts in (left, total - left):
                if self.level + 1 < self.depth and abs(_gini(counts, counts.sum())) >= _EPSILON:
                    opened.append(len(self.child))
                for column, value in ((self.feature, 0), (self.cut, 0), (self.child, -1), (self.gain, -1.0), (self.counts, counts)):
                    column.append(value)
        self.level += 1
        self.open = np.array(opened, dtype=np.intp)
        self._draw()

    def path(self, slots: np.ndarray) -> tuple[np.ndarray, ...]:
        """(feature, cut, child, slot of a node, whether one of ``slots`` lies at or below it, levels) for a pass over the rows."""
        child, slot = np.array(self.child), np.full(len(self.child), -1)
        slot[self.open[slots]] = np.arange(len(slots))
        toward = slot >= 0
        for node in range(len(child) - 1, -1, -1):
            if child[node] >= 0:
                toward[node] |= toward[child[node]] | toward[child[node] + 1]
        return np.array(self.feature), np.array(self.cut), child, slot, toward, self.level

    def nodes(self, cuts: list[np.ndarray]) -> list[tuple]:
        """The library's rows of the tree, parents before children; sister leaves of one class are one leaf."""
        child, best = list(self.child), [int(c.argmax()) for c in self.counts]
        for node in range(len(child) - 1, -1, -1):
            left = child[node]
            if left >= 0 and child[left] < 0 and child[left + 1] < 0 and best[left] == best[left + 1]:
                child[node] = -1
        order, waiting = [], [0]
        while waiting:
            node = waiting.pop()
            order.append(node)
            if child[node] >= 0:
                waiting += [child[node] + 1, child[node]]
        number, out = {node: i for i, node in enumerate(order)}, []
        for node in order:
            counts, leaf = self.counts[node], child[node] < 0
            rule = (-1, [], -1) if leaf else (self.feature[node], [float(cuts[self.feature[node]][self.cut[node]])], -1)
            out.append((number[node], float(best[node]), float(_gini(counts, counts.sum())), [float(c) for c in counts], int(counts.sum()),
                        -1.0 if leaf else float(self.gain[node]), *((-1, -1) if leaf else (number[child[node]], number[child[node] + 1])), rule))
        return out


def _gini(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Impurity of the class counts along the last axis; 0 where there are no rows."""
    out = np.ones(np.shape(total))
    for k in range(counts.shape[-1]):
        share = counts[..., k] / np.maximum(total, 1)
        out = out - share * share
    return np.where(total == 0, 0.0, out)


def _weights(n: int, seed: list[int], rate: float, bootstrap: bool) -> np.ndarray:
    """How often a tree draws each of the ``n`` rows of a block."""
    if not bootstrap and rate >= 1:
        return np.ones(n, dtype=np.uint8)
    u = np.random.default_rng(seed).random(n, dtype=np.float32)
    if not bootstrap:
        return (u < rate).astype(np.uint8)
    out, chance, upto = np.zeros(n, dtype=np.uint8), math.exp(-rate), 0.0
    for k in range(1, 200):
        upto += chance
        above = u >= np.float32(upto)
        if not above.any() or chance < 1e-12 and k > rate:
            break
        out += above
        chance *= rate / k
    return out


def _codes(bins: np.ndarray, label: np.ndarray, classes: int) -> np.ndarray:
    """``bin * classes + class`` of every value, feature after feature, so that one look-up finds both."""
    kind = np.uint8 if (int(bins.max(initial=0)) + 1) * classes <= 256 else np.int32
    return np.ascontiguousarray((bins.astype(kind) * kind(classes) + label.astype(kind)[:, None]).T)


def _reached(codes: np.ndarray, classes: int, rows: np.ndarray, path: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of the rows that come to a node with a slot; others are dropped where their way parts."""
    feature, cut, child, slot, toward, levels = path
    flat, node = codes.ravel(), np.zeros(len(rows), dtype=np.intp)
    start, last = feature * codes.shape[1], cut * classes + classes - 1
    for _ in range(levels):
        node = child[node] + (flat[start[node] + rows] > last[node])
        kept = toward[node]
        if not kept.all():
            rows, node = rows[kept], node[kept]
    return rows, slot[node]


def _add(sums: np.ndarray, codes: np.ndarray, w: np.ndarray, rows: np.ndarray, slot: np.ndarray, subsets: np.ndarray) -> None:
    """Add ``rows`` with their weights to the histograms ``sums[slot, place of the feature, bin, class]``."""
    slots, places, bins, classes = sums.shape
    size, flat, weight = slots * bins * classes, codes.ravel(), w[rows]
    dense, first = size <= 4 * len(rows), slot * (bins * classes)
    weight = weight.astype(float) if dense else weight.astype(sums.dtype)
    for j, start in enumerate((subsets * codes.shape[1]).T.copy()):
        found = flat[start[slot] + rows]
        if dense:
            sums[:, j] += np.bincount(first + found, weight, size).reshape(slots, bins, classes).astype(sums.dtype)
        else:
            np.add.at(sums.reshape(-1), first * places + (j * bins * classes) + found, weight)


def _best_cuts(sums: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(gain, place, cut, left counts, all counts) of the best cut of each histogram; the first of equals."""
    slots, _, bins, classes = sums.shape
    left = np.cumsum(sums, axis=2)
    total = left[:, :1, -1:, :]
    left = left[:, :, :-1, :]
    if bins == 1:
        none = np.zeros(slots, dtype=np.int64)
        return np.full(slots, -np.inf), none, none, np.zeros((slots, classes), dtype=np.int64), total[:, 0, 0]
    right = total - left
    n, nl, nr = total.sum(-1), left.sum(-1), right.sum(-1)
    share = np.maximum(n, 1)
    gain = _gini(total, n) - nl / share * _gini(left, nl) - nr / share * _gini(right, nr)
    gain = np.where((nl < least) | (nr < least), -np.inf, gain).reshape(slots, -1)
    at, each = gain.argmax(axis=1), np.arange(slots)
    place, cut = at // (bins - 1), at % (bins - 1)
    return gain[each, at], place, cut, left[each, place, cut], total[:, 0, 0]


def _pass(binned: Binned, trees: list[_Tree], group: list[tuple[int, np.ndarray]]) -> dict:
    """Best cuts ``{(tree, place in open): ...}`` of the open nodes in ``group``, by one pass over the rows."""
    bins, classes, width, binned_kind = binned.bins, binned.classes, len(binned.cuts), binned.kind
    work, chunks = [], []
    for t, slots in group:
        tree = trees[t]
        step = max(1, CHUNK_CELLS // (tree.per_node * bins * classes))
        numbers = list(range(len(chunks), len(chunks) + math.ceil(len(slots) / step)))
        chunks += [(t, slots[i:i + step]) for i in range(0, len(slots), step)]
        work.append((tree.seed, tree.rate, tree.bootstrap, tree.path(slots), tree.subsets[slots], step, numbers))
    shapes = [(trees[t].per_node, trees[t].least) for t, _ in chunks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for part, block, xs, ys in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "bins", "label"))):
                codes = _codes(np.frombuffer(xs, dtype=binned_kind).reshape(-1, width), np.frombuffer(ys, dtype=np.uint8), classes)
                for i, (seed, rate, bootstrap, path, subsets, _, _) in enumerate(work):
                    w = _weights(len(ys), [*seed, 1, part, block], rate, bootstrap)
                    rows, slot = _reached(codes, classes, np.flatnonzero(w), path)
                    if len(rows):
                        if i not in sums:
                            sums[i] = np.zeros((len(subsets), subsets.shape[1], bins, classes), dtype=np.int32)
                        _add(sums[i], codes, w, rows, slot, subsets)
        for i, found in sums.items():
            step, numbers = work[i][-2:]
            for number, at in zip(numbers, range(0, len(found), step)):
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([found[at:at + step].tobytes()], pa.binary())],
                                                 names=["chunk", "sums"])

    def best(table: pa.Table) -> pa.Table:
        number = table["chunk"][0].as_py()
        places, least = shapes[number]
        total = np.zeros(len(table["sums"][0].as_buffer()) // 4, dtype=np.int64)
        for one in table["sums"]:
            total += np.frombuffer(one.as_buffer(), dtype=np.int32)
        gain, place, cut, left, every = _best_cuts(total.reshape(-1, places, bins, classes), least)
        kinds = pa.list_(pa.int64())
        return pa.table({"chunk": pa.array(np.full(len(gain), number)), "at": pa.array(np.arange(len(gain))), "gain": pa.array(gain),
                         "place": pa.array(place.astype(np.int64)), "cut": pa.array(cut.astype(np.int64)),
                         "left_counts": pa.array(left.tolist(), kinds), "all_counts": pa.array(every.tolist(), kinds)})

    added = binned.blocks.mapInArrow(run, "chunk bigint, sums binary").groupBy("chunk").applyInArrow(
        best, "chunk bigint, at bigint, gain double, place bigint, cut bigint, left_counts array<bigint>, all_counts array<bigint>")
    out = {}
    for c, at, gain, place, cut, left, every in zip(*added.toArrow().to_pydict().values()):  # one row per open node
        t, slots = chunks[c]
        out[(t, int(slots[at]))] = (gain, place, cut, np.array(left), np.array(every))
    return out


def _groups(trees: list[_Tree], cells: int, memory: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Open nodes in groups whose histograms take at most ``memory`` bytes in a task, one node at least."""
    group, room = [], memory
    for t, tree in enumerate(trees):
        cost, at = tree.per_node * cells * 4, 0
        while at < len(tree.open):
            fits = min(len(tree.open) - at, max(room // cost, 0 if group else 1))
            if fits:
                group.append((t, np.arange(at, at + fits)))
                at, room = at + fits, room - fits * cost
            if at < len(tree.open):
                yield group
                group, room = [], memory
    if group:
        yield group


def _grow(binned: Binned, trees: list[_Tree], memory: int) -> None:
    empty = (-math.inf, 0, 0, np.zeros(binned.classes, dtype=np.int64), np.zeros(binned.classes, dtype=np.int64))
    while any(len(t.open) for t in trees):
        found = {}
        for group in _groups(trees, binned.bins * binned.classes, memory):
            found |= _pass(binned, trees, group)
        for i, tree in enumerate(trees):
            if len(tree.open):
                tree.split([found.get((i, at), empty) for at in range(len(tree.open))])


def fit_forests(rows: DataFrame, forests: list[RandomForestClassifier], block_rows: int = BLOCK_ROWS) -> list[RandomForestClassificationModel]:
    """The models of ``forests`` on ``rows``, grown side by side; they share label, bins and seed.

    Bins, draws of rows and features, cuts and the merging of leaves follow the library's own
    fit; the drawn numbers are others. Every tree draws by its own seed, so what grows beside
    it and how many nodes a pass takes change nothing.
    """
    first, spark = forests[0], rows.sparkSession
    if any((f.getLabelCol(), f.getMaxBins(), f.getSeed()) != (first.getLabelCol(), first.getMaxBins(), first.getSeed()) for f in forests):
        raise ValueError("Forests that grow together share label, bins and seed.")
    if any(f.getImpurity() != "gini" for f in forests):
        raise ValueError("Forests are grown by Gini impurity.")
    with scratch(spark):
        binned = bin_rows(rows, first.getLabelCol(), first.getMaxBins(), first.getSeed(), block_rows)
        try:
            width = len(binned.cuts)
            made = [[_Tree([f.getSeed(), i], f.getMaxDepth(), f.getMinInstancesPerNode(), f.getSubsamplingRate(), f.getBootstrap(),
                           features_per_node(f.getFeatureSubsetStrategy(), width, f.getNumTrees()), width) for i in range(f.getNumTrees())]
                    for f in forests]
            _grow(binned, [t for trees in made for t in trees], first.getMaxMemoryInMB() * 2**20)
        finally:
            binned.blocks.unpersist()
        return parallel(spark, len(forests), [lambda f=f, trees=trees: _model(spark, f, trees, binned) for f, trees in zip(forests, made)])


def _model(spark, forest: RandomForestClassifier, trees: list[_Tree], binned: Binned) -> RandomForestClassificationModel:
    """The library's model with these trees: a stub's saved form, whose nodes are replaced."""
    path, label = shared_dir(spark, "forest"), forest.getLabelCol()
    stub = spark.createDataFrame([([0.0] * len(binned.cuts), float(k)) for k in range(binned.classes)], f"x array<double>, `{label}` double")
    forest.fit(stub.select(array_to_vector("x").alias("features"), label).coalesce(1)).write().save(path)
    kind = spark.read.parquet(f"{path}/data").schema
    nodes = [(i, node) for i, tree in enumerate(trees) for node in tree.nodes(binned.cuts)]
    spark.createDataFrame(nodes, kind).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
