"""Learned preprocessing as ``pyspark.ml`` stages: impute, scale, rank and select.

Every statistic comes from the rows given to ``fit``. A fitted stage only evaluates
expressions on literals.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rareclass.config import FEATURES, ROBUST_COLUMNS, ROW_ID, SEED, TARGET
from rareclass.functions.hashing import hash_int, hash_key
from rareclass.functions.quantiles import exact_quantiles
from rareclass.functions.scalars import no_nan
from rareclass.operators.split import bounded_sample
from rareclass.session import materialize


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "feature columns", TypeConverters.toListString)

    def columns(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class MedianImputer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Exact column medians; a column without any value is filled with 0."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._setDefault(inputCols=FEATURES)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df):
        found = exact_quantiles(df.select(*[no_nan(F.col(c).cast("double")).alias(c) for c in self.columns()]),
                                self.columns(), [0.5])
        medians = [found.get((None, c, 0.5)) for c in self.columns()]
        return MedianImputerModel(inputCols=self.columns(), medians=[0.0 if m is None else m for m in medians])


class MedianImputerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "fill values", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCols=None, medians=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df):
        fills = dict(zip(self.columns(), self.getOrDefault(self.medians)))
        return df.withColumns({c: F.coalesce(no_nan(F.col(c).cast("double")), F.lit(m)) for c, m in fills.items()})


class MixedScaler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Median and quartile range for the robust columns, mean and population std for the others."""

    robustCols = Param(Params._dummy(), "robustCols", "columns scaled by quartiles", TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCols=None, robustCols=None):
        super().__init__()
        self._setDefault(inputCols=FEATURES, robustCols=ROBUST_COLUMNS)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df):
        robust = [c for c in self.getOrDefault(self.robustCols) if c in self.columns()]
        standard = [c for c in self.columns() if c not in robust]
        center, scale = {}, {}
        if robust:
            q = exact_quantiles(df, robust, [0.25, 0.5, 0.75])
            for c in robust:
                center[c] = q[(None, c, 0.5)]
                scale[c] = q[(None, c, 0.75)] - q[(None, c, 0.25)]
        if standard:
            row = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in standard]).first()
            for c in standard:
                center[c], scale[c] = row[c]["m"], row[c]["s"]
        return MixedScalerModel(
            inputCols=self.columns(), center=[center[c] for c in self.columns()],
            scale=[scale[c] if scale[c] else 1.0 for c in self.columns()])


class MixedScalerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    center = Param(Params._dummy(), "center", "subtracted value of each column", TypeConverters.toListFloat)
    scale = Param(Params._dummy(), "scale", "divisor of each column; 1 where the spread is 0", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCols=None, center=None, scale=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df):
        params = zip(self.columns(), self.getOrDefault(self.center), self.getOrDefault(self.scale))
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in params})


# --- mutual information -------------------------------------------------------------------

GRID_STEP = 1e-6
GRID_CELLS = 2.0**42  # with 20 bits for ties a place fits a long
BUCKET_ROWS = 1_000_000
SAMPLE_ROWS = 100_000
_COUNTS, _SHARED, _ENDS = 0, 1, 2  # what a row of a bucket's result is


def _long_points(df: DataFrame, features: list[str], key: str, label: str, seed, steps: list[float]) -> DataFrame:
    """(f, label, x, again): each value of feature number f on an integer grid, ties broken by a hash of the row.

    Integers make ``x - r`` and ``x + r`` exact. The hash replaces the tiny noise that the
    nearest-neighbour estimate needs for repeated values. ``again`` is the row's key, in a
    struct, where rows share one; null for all others.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("f"), F.lit(c).alias("feature"), (F.col(c).cast("double") / step).alias("v"))
                      for i, (c, step) in enumerate(zip(features, steps))])
    long = df.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"), "again", F.explode(cells).alias("c")).where("c.v is not null")
    tie = hash_int(5, hash_key(seed, F.col("c.feature"), F.col("key")))
    x = F.round(F.col("c.v")).cast("bigint") * F.lit(2**20) + tie
    return long.select(F.col("c.f").alias("f"), "label", x.alias("x"), "again")


def _marked(df: DataFrame, key: str) -> DataFrame:
    """Adds ``again``: the key, in a struct, of rows that share it with others."""
    shared = materialize(df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_k"), "shared-keys")
    kind = df.schema[key].dataType
    if shared.isEmpty():
        return df.withColumn("again", F.lit(None).cast(f"struct<key: {kind.simpleString()}>"))
    marked = df.join(shared.withColumn("_s", F.lit(True)), F.col(key).eqNullSafe(F.col("_k")), "left")
    return marked.withColumn("again", F.when(F.col("_s"), F.struct(F.col(key).alias("key")))).drop("_k", "_s")


def _cuts(points: DataFrame, n_features: int, rows: int, bucket_rows: int) -> list[np.ndarray]:
    """Per feature the ends of ranges of about ``bucket_rows`` rows; any cut points give the same counts.

    They come from a sample and only balance the work.
    """
    buckets = math.ceil(rows / bucket_rows)
    cuts = [np.zeros(0, dtype=np.int64)] * n_features
    if buckets > 1:
        grid = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
        for r in points.groupBy("f").agg(F.percentile_approx("x", grid, 100 * buckets).alias("at")).collect():
            cuts[r["f"]] = np.unique(np.array(r["at"], dtype=np.int64))
    return cuts


def _placed(points: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Adds ``b``, the number of cuts of the feature at or below the place."""
    if not any(len(c) for c in cuts):
        return points.withColumn("b", F.lit(0))

    @F.pandas_udf("int")
    def bucket(f: pd.Series, at: pd.Series) -> pd.Series:
        out = np.zeros(len(f), dtype=np.int32)
        for i in np.unique(f):
            mine = (f == i).to_numpy()
            out[mine] = np.searchsorted(cuts[i], at.to_numpy()[mine], side="right")
        return pd.Series(out)

    return points.withColumn("b", bucket("f", "x"))


def _radius(x: np.ndarray, kk: int) -> np.ndarray:
    """Distance of each of the sorted places to its kk-th neighbour; the largest integer if there are fewer."""
    out = np.full(len(x), np.iinfo(np.int64).max)
    for below in range(kk + 1):  # so many of the neighbours lie below
        n = len(x) - kk
        if n > 0:
            at = x[below:below + n]
            out[below:below + n] = np.minimum(out[below:below + n], np.maximum(x[kk:] - at, at - x[:n]))
    return np.maximum(out, 1)


def _nearer(x: np.ndarray, at: np.ndarray, r: np.ndarray) -> np.ndarray:
    """How many of the sorted places ``x`` lie nearer than ``r`` to each place ``at``."""
    ends = np.iinfo(np.int64)
    above = at + np.minimum(r, ends.max - np.maximum(at, 0))
    below = at - np.minimum(r, ends.max + np.minimum(at, 0))
    return np.searchsorted(x, above, "left") - np.searchsorted(x, below, "right")


def _count_bucket(table: pa.Table, cuts: list[np.ndarray], sizes: dict, k: int) -> dict:
    """Counts of a bucket's points, and the points at its ends.

    A point is settled if its k-th neighbour in the bucket is as near as the bucket's ends:
    then all points nearer than that lie in the bucket. All others are among the k first or
    last of their class, whose own neighbours are among the 2k first or last.
    """
    f, b = table["f"][0].as_py(), table["b"][0].as_py()
    kept = np.flatnonzero(np.isin(table["label"].to_numpy(), [c for g, c in sizes if g == f]))
    x = table["x"].to_numpy()[kept]
    order = np.argsort(x, kind="stable")
    place, x = kept[order], x[order]
    label = table["label"].to_numpy()[place]
    again = table["again"].combine_chunks()
    shared = again.is_valid().to_numpy(zero_copy_only=False)[place]
    room = np.full(len(x), np.iinfo(np.int64).max)
    if b > 0:
        room = np.minimum(room, x - cuts[f][b - 1] + 1)
    if b < len(cuts[f]):
        room = np.minimum(room, cuts[f][b] - x)
    out = {n: [] for n in ("kind", "label", "x", "place", "m", "w")}

    def add(kind, c, at, spot, m, w):
        n = len(m)
        for name, value in zip(out, (np.full(n, kind), np.full(n, c), at, spot, m, w)):
            out[name].append(np.broadcast_to(value, n))

    for c in np.unique(label):
        mine = np.flatnonzero(label == c)
        r = _radius(x[mine], min(k, sizes[(f, c)] - 1))
        settled = r <= room[mine]
        m = _nearer(x, x[mine][settled], r[settled])
        alone = ~shared[mine][settled]
        value, w = np.unique(m[alone], return_counts=True)
        add(_COUNTS, c, 0, -1, value, w)
        add(_SHARED, c, 0, place[mine][settled][~alone], m[~alone], 1)
        if len(cuts[f]):
            end = np.zeros(len(mine), dtype=bool)
            end[:2 * k] = end[len(mine) - min(2 * k, len(mine)):] = True
            add(_ENDS, c, x[mine][end], place[mine][end], settled[end].astype(np.int64), 1)
    columns = {n: np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for n, v in out.items()}
    spot = pa.array(columns.pop("place"), mask=columns["kind"] == _COUNTS) if len(columns["kind"]) else pa.array([], pa.int64())
    return pa.table({"f": pa.array(np.full(len(columns["kind"]), f), pa.int32()),
                     **{n: pa.array(columns[n].astype(np.int64), pa.int64()) for n in ("kind", "label", "x", "m", "w")},
                     "again": again.take(spot)})


def mutual_information_ksg(df: DataFrame, features: list[str], key: str = ROW_ID, label: str = TARGET,
                           k: int = 3, seed=SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(feature, mutual_information) by the nearest-neighbour estimate for a continuous and a
    discrete variable.

    The radius of a point is its distance to the k-th neighbour of its own class; points of any
    class nearer than that are counted. A feature is walked in buckets of about ``bucket_rows``
    rows, each sorted once. Only the few points at a bucket's ends can need rows of others: their
    neighbours are among the points at the ends of all buckets, and one more pass counts what is
    nearer. NULLs have no place and are left out; rows that share a key count as one.
    """
    classes = F.col(label).cast("int").alias("label")
    numbers = df.groupBy(classes).agg(
        F.count(F.lit(1)).alias("rows"), *[F.max(F.abs(F.col(c).cast("double"))).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.count(F.col(c).cast("double")).alias(f"n{i}") for i, c in enumerate(features)]).collect()  # one row per class
    steps = [max(GRID_STEP, max((r[f"m{i}"] or 0.0 for r in numbers), default=0.0) / GRID_CELLS) for i in range(len(features))]
    sizes = {(i, r["label"]): r[f"n{i}"] for r in numbers for i in range(len(features)) if r["label"] is not None and r[f"n{i}"] > 1}
    rows = sum(r["rows"] for r in numbers)
    wide = _marked(df.select(*dict.fromkeys([key, label, *features])), key)
    place = lambda t: _long_points(t, features, key, label, seed, steps)
    share = min(1.0, SAMPLE_ROWS / max(rows, 1))
    cuts = _cuts(place(wide.where(F.rand(11) < share) if share < 1 else wide), len(features), rows, bucket_rows)
    points = _placed(place(wide), cuts)
    apart = any(len(c) for c in cuts)
    if apart:
        points = materialize(points, "points")
    kind = points.schema["again"].dataType.simpleString()
    found = materialize(points.groupBy("f", "b").applyInArrow(
        lambda t: _count_bucket(t, cuts, sizes, k),
        f"f int, kind bigint, label bigint, x bigint, m bigint, w bigint, again {kind}"), "counts")
    if apart:
        found = found.unionByName(_crossing(points, found, sizes, k))
    spark = df.sparkSession
    known = spark.createDataFrame([(i, features[i], c, n, min(k, n - 1)) for (i, c), n in sizes.items()],
                                  "f int, feature string, label bigint, n_label bigint, kk int")
    counted = found.where(f"kind <> {_ENDS}").join(F.broadcast(known), ["f", "label"])
    shared = counted.where(f"kind = {_SHARED}").groupBy("feature", "again", "n_label", "kk").agg(F.sum("m").alias("m"), F.lit(1).cast("bigint").alias("w"))
    # digamma(n) = H(n-1) - gamma for integers; the four gammas cancel.
    stats = (counted.where(f"kind = {_COUNTS}").select("feature", "n_label", "kk", "m", "w")
             .unionByName(shared.drop("again")).groupBy("feature", "n_label", "kk", "m").agg(F.sum("w").alias("w")))
    total = Window.partitionBy("feature")
    stats = stats.withColumn("n", F.sum("w").over(total))
    value = (_digamma("n") + _digamma("kk") - _digamma("n_label") - _digamma("m"))
    mi = stats.groupBy("feature").agg((F.sum(value * F.col("w")) / F.max("n")).alias("mi"))
    return mi.select("feature", F.greatest(F.col("mi"), F.lit(0.0)).alias("mutual_information"))


def _crossing(points: DataFrame, found: DataFrame, sizes: dict, k: int) -> DataFrame:
    """Counts of the points whose neighbours lie in several buckets: at most 2k per bucket and class."""
    ends = found.where(f"kind = {_ENDS}")
    asked: dict[int, list] = {}  # feature -> [(label, place, radius, again)]
    by_class: dict[tuple, list] = {}
    for r in ends.collect():  # at most 4k rows per bucket and class
        by_class.setdefault((r["f"], r["label"]), []).append((r["x"], r["m"], r["again"]))
    for (f, c), group in by_class.items():
        group.sort(key=lambda t: t[0])
        x = np.array([t[0] for t in group])
        r = _radius(x, min(k, sizes[(f, c)] - 1))
        asked.setdefault(f, []).extend((c, *t[::2], int(d)) for t, d in zip(group, r) if not t[1])
    # Points below each of these places are counted.
    edges = np.iinfo(np.int64)
    bounds = {f: [(min(x + d, edges.max), max(x - d + 1, edges.min)) for _, x, _, d in rows] for f, rows in asked.items()}
    marks = {f: np.unique(np.array(b, dtype=np.int64)) for f, b in bounds.items()}
    present = {f: [c for g, c in sizes if g == f] for f in marks}

    def run(batches):
        for batch in batches:
            number, label, x = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("f", "label", "x"))
            for f in np.unique(number):
                if f in marks:
                    mine = (number == f) & np.isin(label, present[f])
                    slot, n = np.unique(np.searchsorted(marks[f], x[mine], "right"), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slot), f, dtype=np.int32)), pa.array(slot), pa.array(n)],
                                                     names=["f", "slot", "n"])

    counted = points.select("f", "label", "x").mapInArrow(run, "f int, slot bigint, n bigint").groupBy("f", "slot").agg(F.sum("n").alias("n"))
    upto = {f: np.zeros(len(m) + 1, dtype=np.int64) for f, m in marks.items()}
    for r in counted.collect():  # one row per asked place
        upto[r["f"]][r["slot"]] = r["n"]
    upto = {f: np.cumsum(n) for f, n in upto.items()}
    rows = []
    for f, group in asked.items():
        for (c, _, again, _), (above, below) in zip(group, bounds[f]):
            m = int(upto[f][np.searchsorted(marks[f], above)] - upto[f][np.searchsorted(marks[f], below)])
            rows.append((f, _COUNTS if again is None else _SHARED, c, 0, m, 1, again))
    return found.sparkSession.createDataFrame(rows, found.schema)


def _digamma(column: str):
    """digamma(n) + gamma of a positive integer: exact sum up to 20, else its series."""
    n = F.col(column).cast("double")
    small = F.element_at(F.array(*[F.lit(sum(1.0 / i for i in range(1, j))) for j in range(1, 21)]),
                         F.least(F.col(column), F.lit(20)).cast("int"))
    gamma = 0.5772156649015329
    series = (F.log(n) - 1 / (2 * n) - 1 / (12 * n * n) + 1 / (120 * n * n * n * n)
              - 1 / (252 * n * n * n * n * n * n) + F.lit(gamma))
    return F.when(F.col(column) <= 20, small).otherwise(series)


def mutual_information_binned(df: DataFrame, features: list[str], label: str = TARGET, bins: int = 32) -> DataFrame:
    """(feature, mutual_information) over exact quantile bins; works on tables of any size."""
    probs = [i / bins for i in range(1, bins)]
    cuts = exact_quantiles(df, features, probs)
    edges = [sorted({cuts[(None, c, p)] for p in probs if cuts[(None, c, p)] is not None}) or [0.0] for c in features]
    names = [f"b{i}" for i in range(len(features))]
    # Bin = number of cut points at or below the value; a missing value has no bin.
    cut = Bucketizer(splitsArray=[[-math.inf, *e, math.inf] for e in edges], inputCols=features,
                     outputCols=names, handleInvalid="keep")
    binned = cut.transform(df.select(F.col(label).cast("int").alias("label"),
                                     *[F.col(c).cast("double").alias(c) for c in features]))
    cells = [F.struct(F.lit(c).alias("feature"), F.when(F.col(c).isNotNull(), F.col(b)).alias("bin"))
             for c, b in zip(features, names)]
    long = binned.select("label", F.explode(F.array(*cells)).alias("c")).where("c.bin is not null")
    joint = long.groupBy("c.feature", "c.bin", "label").agg(F.count(F.lit(1)).alias("n"))
    # Small tables from here on: features * bins * classes rows.
    by = lambda *cols: F.sum("n").over(Window.partitionBy(*cols)).cast("double")
    t = joint.select("feature", "n", by("feature").alias("all"), by("feature", "bin").alias("nb"),
                     by("feature", "label").alias("nl"))
    term = F.col("n") / F.col("all") * F.log(F.col("n") * F.col("all") / (F.col("nb") * F.col("nl")))
    return t.groupBy("feature").agg(F.greatest(F.sum(term), F.lit(0.0)).alias("mutual_information"))


def rank_features(scores: DataFrame, features: list[str], k: int) -> DataFrame:
    """(feature, mutual_information, selected), best first; ties go to the later column."""
    place = F.array_position(F.array(*map(F.lit, features)), F.col("feature"))
    by_score = Window.partitionBy(F.lit(1)).orderBy(F.desc("mutual_information"), place.desc())  # one row per feature
    return (scores.withColumn("selected", F.row_number().over(by_score) <= k)
            .select("feature", "mutual_information", "selected").orderBy(F.desc("mutual_information"), "feature"))


class MutualInformationSelector(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Keep the ``k`` features with the highest mutual information with the label.

    Both methods rank on a stratified sample of ``maxRows`` rows, or on all rows if that is 0.
    """

    k = Param(Params._dummy(), "k", "features kept", TypeConverters.toInt)
    maxRows = Param(Params._dummy(), "maxRows", "rows of the ranking sample; 0 means all", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "sampling seed", TypeConverters.toInt)
    method = Param(Params._dummy(), "method", "ksg or binned", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector of selected features", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, k=20, maxRows=60_000, seed=SEED, method="ksg", outputCol="features"):
        super().__init__()
        self._setDefault(inputCols=FEATURES, k=20, maxRows=60_000, seed=SEED, method="ksg", outputCol="features")
        self._set(**{k_: v for k_, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df):
        cols, k = self.columns(), self.getOrDefault(self.k)
        method, cap = self.getOrDefault(self.method), self.getOrDefault(self.maxRows)
        if method not in ("ksg", "binned"):
            raise ValueError(f"Unknown method: {method}")
        if method == "ksg":
            sample = bounded_sample(df, cap or None, self.getOrDefault(self.seed))
            scores = mutual_information_ksg(sample, cols, seed=self.getOrDefault(self.seed))
        else:
            sample = bounded_sample(df, cap or None, self.getOrDefault(self.seed))
            scores = mutual_information_binned(sample, cols)
        ranked = rank_features(scores, cols, k).collect()
        size = sample.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(TARGET).cast("bigint")).alias("p")).first()
        value = {r["feature"]: r["mutual_information"] for r in ranked}
        chosen = {r["feature"] for r in ranked if r["selected"]}
        return MutualInformationSelectorModel(
            inputCols=cols, scores=[value.get(c, 0.0) for c in cols], selected=[c for c in cols if c in chosen],
            outputCol=self.getOrDefault(self.outputCol), rankingRows=int(size["n"]), rankingFrauds=int(size["p"] or 0))


class MutualInformationSelectorModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    scores = Param(Params._dummy(), "scores", "mutual information of each column", TypeConverters.toListFloat)
    selected = Param(Params._dummy(), "selected", "kept columns in input order", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "vector of selected features", TypeConverters.toString)
    rankingRows = Param(Params._dummy(), "rankingRows", "rows used for the ranking", TypeConverters.toInt)
    rankingFrauds = Param(Params._dummy(), "rankingFrauds", "positives used for the ranking", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols=None, scores=None, selected=None, outputCol=None, rankingRows=None, rankingFrauds=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def selected_features(self) -> list[str]:
        return self.getOrDefault(self.selected)

    def support(self) -> list[bool]:
        kept = set(self.selected_features())
        return [c in kept for c in self.columns()]

    def ranking(self, spark) -> DataFrame:
        rows = list(zip(self.columns(), self.getOrDefault(self.scores), self.support()))
        return (spark.createDataFrame(rows, "feature string, mutual_information double, selected boolean")
                .orderBy(F.desc("mutual_information"), "feature"))

    def project(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Selection as a plain projection."""
        return df.select(*(keep or []), *self.selected_features())

    def _transform(self, df):
        vector = VectorAssembler(inputCols=self.selected_features(), outputCol=self.getOrDefault(self.outputCol))
        return vector.transform(df)


def preprocessing_stages(config) -> list:
    return [
        MedianImputer(inputCols=FEATURES),
        MixedScaler(inputCols=FEATURES, robustCols=ROBUST_COLUMNS),
        MutualInformationSelector(inputCols=FEATURES, k=config.selected_k, maxRows=config.selection_max_rows or 0,
                                  seed=config.seed, method=config.selection_method),
    ]


