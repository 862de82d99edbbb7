"""Tables behind the profile of the training rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rareclass.config import FEATURES, ROW_ID, SEED, TARGET
from rareclass.functions.quantiles import exact_quantiles
from rareclass.operators.split import class_quota_sample


def log_amount() -> Column:
    return F.log1p("Amount")


def hours() -> Column:
    return F.col("Time") / 3600


def class_profile(df: DataFrame, features: list[str] = FEATURES, label: str = TARGET) -> DataFrame:
    """(Class, feature, mean, median, std): sample std, exact median."""
    spark = df.sparkSession
    moments = df.groupBy(label).agg(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in features])
    long = (moments.unpivot([label], features, "feature", "m")
            .select(label, "feature", F.col("m.mean").alias("mean"), F.col("m.std").alias("std")))
    found = exact_quantiles(df, features, [0.5], label)
    medians = spark.createDataFrame([(g, c, v) for (g, c, _), v in found.items()],
                                    f"{label} int, feature string, median double")
    return long.join(medians, [label, "feature"]).select(label, "feature", "mean", "median", "std")


def class_median(df: DataFrame, column: str, label: str = TARGET) -> DataFrame:
    found = exact_quantiles(df, [column], [0.5], label)
    return df.sparkSession.createDataFrame([(g, v) for (g, _, _), v in found.items()],
                                           f"{label} int, median double")


def _pair_sums(columns: list[str], centre: list[float]):
    """Per task: sums over the rows where both columns of a pair have a value."""
    k = len(columns)
    upper = [(i, j) for i in range(k) for j in range(i + 1, k)]
    left, right = [i for i, _ in upper], [j for _, j in upper]

    def run(batches):
        total = None
        for batch in batches:
            x = np.column_stack([batch[c].to_numpy(dtype=float, na_value=np.nan) for c in columns]) - centre
            seen = ~np.isnan(x)
            x, m = np.where(seen, x, 0.0), seen.astype(float)
            sq = x * x
            parts = np.stack([m.T @ m, x.T @ m, m.T @ x, sq.T @ m, m.T @ sq, x.T @ x])
            total = parts if total is None else total + parts
        if total is not None:
            picked = total[:, left, right]
            yield pd.DataFrame({"i": left, "j": right, **dict(zip(PAIR_SUMS, picked))})

    return run


PAIR_SUMS = ["n", "sa", "sb", "saa", "sbb", "sab"]


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Upper triangle of the Pearson matrix as ``(a, b, r)``; pairs skip their own NULLs.

    Each task multiplies its Arrow batches once for all pairs and emits one row per pair;
    only those rows are shuffled. Values are centred first to keep the sums exact enough.
    """
    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    means = data.agg(*[F.avg(c) for c in columns]).first()
    centre = [m or 0.0 for m in means]
    parts = data.mapInPandas(_pair_sums(columns, centre),
                             "i int, j int, " + ", ".join(f"{c} double" for c in PAIR_SUMS))
    s = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in PAIR_SUMS])
    n, sa, sb, saa, sbb, sab = (F.col(c) for c in PAIR_SUMS)
    cov, va, vb = sab - sa * sb / n, saa - sa * sa / n, sbb - sb * sb / n
    names = F.array(*map(F.lit, columns))
    return s.where(n > 0).select(
        F.element_at(names, F.col("i") + 1).alias("a"), F.element_at(names, F.col("j") + 1).alias("b"),
        F.try_divide(cov, F.sqrt(va * vb)).alias("r"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """The full square matrix in long form, diagonal 1."""
    upper = correlations(df, columns)
    cells = F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    both = upper.select(F.explode(cells).alias("c")).select("c.*")
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], "a string, b string, r double")
    return both.unionByName(diagonal)


def target_correlations(df: DataFrame, features: list[str] = FEATURES, label: str = TARGET) -> DataFrame:
    one = df.agg(*[F.corr(c, F.col(label).cast("double")).alias(c) for c in features])
    return one.unpivot([], features, "feature", "r")


def top_correlated(df: DataFrame, k: int = 4, features: list[str] = FEATURES, label: str = TARGET) -> DataFrame:
    """The ``k`` features with the largest absolute target correlation."""
    return (target_correlations(df, features, label).withColumn("abs_r", F.abs("r"))
            .orderBy(F.desc("abs_r"), "feature").limit(k))


def top_components(df: DataFrame, k: int = 2) -> list[str]:
    """The first ``k`` V columns among the top four."""
    names = [r["feature"] for r in top_correlated(df).orderBy(F.desc("abs_r"), "feature").collect()]
    return [n for n in names if n.startswith("V")][:k]


def bin_index(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin of x; the last bin is closed on the right."""
    width = (hi - lo) / bins
    return F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")


def class_histogram(df: DataFrame, value: Column, bins: int, label: str = TARGET) -> DataFrame:
    """(Class, bin, bin_start, rows, density): bins over the joint range, each class normalised alone."""
    data = df.select(label, value.alias("x")).where(F.col("x").isNotNull())
    lo, hi = data.agg(F.min("x"), F.max("x")).first()
    width = (hi - lo) / bins
    counted = (data.groupBy(label, bin_index(F.col("x"), lo, hi, bins).alias("bin"))
               .agg(F.count(F.lit(1)).alias("rows")))
    grid = (counted.select(label).distinct()
            .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))))
    per_class = Window.partitionBy(label)  # at most ``bins`` rows
    return (grid.join(counted, [label, "bin"], "left").na.fill(0, ["rows"])
            .withColumn("density", F.col("rows") / (F.sum("rows").over(per_class) * F.lit(width)))
            .withColumn("bin_start", F.lit(lo) + F.col("bin") * F.lit(width))
            .select(label, "bin", "bin_start", "rows", "density"))


def box_stats(df: DataFrame, columns: list[str], label: str = TARGET) -> DataFrame:
    """(Class, feature, q1, median, q3, whisker_low, whisker_high), whiskers within 1.5 IQR."""
    probs = [0.25, 0.5, 0.75]
    found = exact_quantiles(df, columns, probs, label)
    classes = sorted({g for g, _, _ in found})
    exprs, keys = [], []
    for g in classes:
        for c in columns:
            q1, med, q3 = (found[(g, c, p)] for p in probs)
            if q1 is None:
                continue
            reach = 1.5 * (q3 - q1)
            mine = F.col(label) == F.lit(g)
            i = len(keys)
            exprs += [F.min(F.when(mine & (F.col(c) >= q1 - reach), F.col(c))).alias(f"l{i}"),
                      F.max(F.when(mine & (F.col(c) <= q3 + reach), F.col(c))).alias(f"h{i}")]
            keys.append((g, c, q1, med, q3))
    edges = df.agg(*exprs).first()
    rows = [(*k, min(edges[f"l{i}"], k[2]), max(edges[f"h{i}"], k[4])) for i, k in enumerate(keys)]
    return df.sparkSession.createDataFrame(
        rows, f"{label} int, feature string, q1 double, median double, q3 double, "
              "whisker_low double, whisker_high double")


def scatter_sample(df: DataFrame, negatives: int = 3000, seed=SEED) -> DataFrame:
    """At most ``negatives`` rows of class 0 and every row of class 1, with hours."""
    kept = class_quota_sample(df, {0: negatives, 1: None}, seed)
    return kept.select(ROW_ID, hours().alias("hours"), "Amount", TARGET)
