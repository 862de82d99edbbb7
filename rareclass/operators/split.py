"""Exact, stratified splits, samples and folds without a global sort.

Rows of each class are ordered by ``md5(seed:key)``. A split, a sample or a fold is a
range of ranks in that order. The hash at each cut rank is found by counting hash
prefixes, refining only the prefixes that hold a cut; the split itself is then a
comparison with a few literals, so the rows are never shuffled or sorted.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rareclass.config import ROW_ID, SEED, TARGET, TrainingConfig
from rareclass.errors import DatasetError
from rareclass.functions.hashing import hash_key

PREFIX_STEP = 3
HASH_DIGITS = 32


class HashOrder:
    """Hash order of the rows of each class of ``df``; ``key`` must be unique."""

    def __init__(self, df: DataFrame, key: str = ROW_ID, label: str = TARGET, seed=SEED,
                 leaf_rows: int = 200_000):
        self.df, self.key, self.label, self.seed, self.leaf_rows = df, key, label, seed, leaf_rows
        self._keyed = df.select(label, key, hash_key(seed, F.col(key)).alias("_h"))
        self._prefixes = self._count(self._keyed, PREFIX_STEP)
        self.totals: dict[int, int] = {}
        for (cls, _), rows in self._prefixes.items():
            self.totals[cls] = self.totals.get(cls, 0) + rows

    def _count(self, keyed: DataFrame, digits: int) -> dict[tuple[int, str], int]:
        # At most classes * 16**PREFIX_STEP rows for each refined prefix.
        rows = keyed.groupBy(self.label, F.substring("_h", 1, digits).alias("p")).count().collect()
        return {(r[self.label], r["p"]): r["count"] for r in rows}

    def _inside(self, prefixes) -> Column:
        return reduce(lambda a, b: a | b, [
            (F.col(self.label) == F.lit(cls)) & F.col("_h").startswith(p) for cls, p in sorted(prefixes)])

    def keys_at(self, wanted: dict[int, list[int]]) -> dict[tuple[int, int], tuple[str, object]]:
        """(class, rank) -> (hash, key) of the row at that 1-based rank."""
        open_cuts = {}
        for cls, ranks in wanted.items():
            for rank in ranks:
                if 0 < rank < self.totals.get(cls, 0):
                    open_cuts[(cls, rank)] = ("", rank)
        counts, digits = self._prefixes, PREFIX_STEP
        leaves: dict[tuple[int, int], tuple[str, int]] = {}
        while open_cuts:
            by_parent: dict[tuple[int, str], list[tuple[str, int]]] = {}
            for (cls, p), rows in sorted(counts.items()):
                by_parent.setdefault((cls, p[: digits - PREFIX_STEP]), []).append((p, rows))
            refine = {}
            for cut, (parent, left) in open_cuts.items():
                for p, rows in by_parent[(cut[0], parent)]:
                    if left <= rows:
                        full = digits + PREFIX_STEP > HASH_DIGITS
                        (leaves if rows <= self.leaf_rows or full else refine)[cut] = (p, left)
                        break
                    left -= rows
            open_cuts = refine
            if open_cuts:
                digits += PREFIX_STEP
                narrow = self._keyed.where(self._inside({(c[0], v[0]) for c, v in open_cuts.items()}))
                counts = self._count(narrow, digits)
        return self._leaf_keys(leaves)

    def _leaf_keys(self, leaves) -> dict:
        if not leaves:
            return {}
        found = {}
        by_len: dict[int, dict] = {}
        for cut, (p, left) in leaves.items():
            by_len.setdefault(len(p), {})[cut] = (p, left)
        for digits, group in by_len.items():
            prefixes = {(cut[0], p) for cut, (p, _) in group.items()}
            w = Window.partitionBy(self.label, "p").orderBy("_h", self.key)
            ranked = (self._keyed.where(self._inside(prefixes))
                      .withColumn("p", F.substring("_h", 1, digits))
                      .withColumn("r", F.row_number().over(w)))
            hit = reduce(lambda a, b: a | b, [
                (F.col(self.label) == F.lit(cut[0])) & (F.col("p") == p) & (F.col("r") == left)
                for cut, (p, left) in group.items()])
            at = {(r[self.label], r["p"], r["r"]): (r["_h"], r[self.key])
                  for r in ranked.where(hit).collect()}
            for cut, (p, left) in group.items():
                found[cut] = at[(cut[0], p, left)]
        return found

    def below(self, bounds: dict[int, int]) -> Column:
        """True for the first ``bounds[class]`` rows of each class."""
        return self.bands({cls: [n] for cls, n in bounds.items()}) == 0

    def bands(self, cuts: dict[int, list[int]]) -> Column:
        """Number of the rank range a row lies in, given ascending cut ranks per class."""
        keys = self.keys_at(cuts)
        h, k = hash_key(self.seed, F.col(self.key)), F.col(self.key)
        out = None
        for cls, ranks in sorted(cuts.items()):
            band = F.lit(len(ranks))
            for i in reversed(range(len(ranks))):
                rank = ranks[i]
                if rank >= self.totals.get(cls, 0):
                    band = F.lit(i)
                elif rank > 0:
                    h0, k0 = keys[(cls, rank)]
                    band = F.when((h < h0) | ((h == h0) & (k <= F.lit(k0))), F.lit(i)).otherwise(band)
            mine = F.col(self.label) == F.lit(cls)
            out = F.when(mine, band) if out is None else out.when(mine, band)
        return out


def _positive_share(draw: int, totals: dict[int, int]) -> dict[int, int]:
    """Largest-remainder share of ``draw`` rows for two classes; a tie goes to class 1."""
    rows = sum(totals.values())
    pos = (2 * draw * totals.get(1, 0) + rows) // (2 * rows)
    return {0: draw - pos, 1: pos}


def split_quotas(totals: dict[int, int], config: TrainingConfig) -> dict[str, dict[int, int]]:
    """Rows of each class in each partition; a two-stage split, test first."""
    if not 0 < config.test_size + config.validation_size < 1:
        raise DatasetError("Test and validation rows leave nothing to train on.")
    rows = sum(totals.values())
    n_dev = rows - math.ceil(config.test_size * rows)
    dev = _positive_share(n_dev, totals)
    # Rounding hides the last-digit error of the quotient of two decimal fractions.
    fraction = round(config.validation_size / (1 - config.test_size), 12)
    n_train = n_dev - math.ceil(fraction * n_dev)
    train = _positive_share(n_train, dev)
    return {
        "test": {c: totals.get(c, 0) - dev[c] for c in (0, 1)},
        "validation": {c: dev[c] - train[c] for c in (0, 1)},
        "train": train,
    }


def stratified_split(df: DataFrame, config: TrainingConfig | None = None, key: str = ROW_ID,
                     label: str = TARGET) -> DataFrame:
    """Add ``partition``: train, validation or test, with equal class shares."""
    config = config or TrainingConfig()
    order = HashOrder(df, key, label, config.seed)
    q = split_quotas(order.totals, config)
    cuts = {c: [q["test"][c], q["test"][c] + q["validation"][c]] for c in (0, 1)}
    names = F.array(F.lit("test"), F.lit("validation"), F.lit("train"))
    return df.withColumn("partition", F.element_at(names, order.bands(cuts) + 1))


def bounded_sample(df: DataFrame, max_rows: int | None, seed=SEED, key: str = ROW_ID,
                   label: str = TARGET) -> DataFrame:
    """Exactly ``max_rows`` rows at natural class shares; all rows if there are no more."""
    if max_rows is None:
        return df
    order = HashOrder(df, key, label, seed)
    if sum(order.totals.values()) <= max_rows:
        return df
    return df.where(order.below(_positive_share(max_rows, order.totals)))


def class_quota_sample(df: DataFrame, quotas: dict[int, int | None], seed=SEED, key: str = ROW_ID,
                       label: str = TARGET) -> DataFrame:
    """The first rows of each class in hash order; a quota of None keeps the whole class."""
    order = HashOrder(df, key, label, seed)
    return df.where(order.below({c: order.totals.get(c, 0) if q is None else q for c, q in quotas.items()}))


def fold_cuts(totals: dict[int, int], k: int) -> dict[int, list[int]]:
    """Cut ranks of k folds whose sizes differ by at most one row, overall and per class."""
    cuts, start = {}, 0
    for cls in sorted(totals):
        end = start + totals[cls]
        sizes = [(end - i + k - 1) // k - (start - i + k - 1) // k for i in range(k)]
        cuts[cls] = [sum(sizes[: i + 1]) for i in range(k - 1)]
        start = end
    return cuts


def stratified_folds(df: DataFrame, k: int = 3, seed=SEED, key: str = ROW_ID,
                     label: str = TARGET) -> DataFrame:
    """Add ``fold`` = 1..k."""
    order = HashOrder(df, key, label, seed)
    return df.withColumn("fold", order.bands(fold_cuts(order.totals, k)) + 1)


def first_rows_per_class(df: DataFrame, n: int = 3, order_by: str = ROW_ID, label: str = TARGET) -> DataFrame:
    """The first ``n`` rows of class 0, then of class 1; two top-n scans."""
    picks = [df.where(F.col(label) == c).orderBy(order_by).limit(n) for c in (0, 1)]
    return picks[0].unionByName(picks[1])


def membership(split: DataFrame, key: str = ROW_ID) -> DataFrame:
    return split.select(key, "partition")


def split_summary(split: DataFrame, label: str = TARGET) -> DataFrame:
    return split.groupBy("partition").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(label) == 0).alias("legitimate"),
        F.count_if(F.col(label) == 1).alias("frauds"),
        F.avg(F.col(label).cast("double")).alias("fraud_rate"))


def split_overlap(members: DataFrame, key: str = ROW_ID) -> DataFrame:
    """One row: keys in all, keys in more than one partition, keys seen twice."""
    per_key = members.groupBy(key).agg(
        F.min("partition").alias("lo"), F.max("partition").alias("hi"), F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("lo") != F.col("hi")).alias("in_several_partitions"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"))


def shared_keys(members: DataFrame, left: str, right: str, key: str = ROW_ID) -> DataFrame:
    """Keys that two partitions share (a semi join; empty for a correct split)."""
    a = members.where(F.col("partition") == left).select(key)
    b = members.where(F.col("partition") == right).select(key)
    return a.join(b, key, "left_semi")


def fold_summary(folds: DataFrame, label: str = TARGET) -> DataFrame:
    """Rows and positives inside and outside each fold."""
    inside = folds.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("p"))
    every = Window.partitionBy(F.lit(1))  # one row per fold
    return inside.select(
        "fold",
        (F.sum("n").over(every) - F.col("n")).alias("train_rows"),
        (F.sum("p").over(every) - F.col("p")).alias("train_frauds"),
        F.col("n").alias("validation_rows"),
        F.col("p").alias("validation_frauds"))
