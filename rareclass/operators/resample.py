"""Synthetic minority rows (SMOTE), inside training only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareclass.config import ROW_ID, SEED, TARGET
from rareclass.errors import DatasetError
from rareclass.functions.hashing import hash_int, hash_key, hash_unit
from rareclass.operators.neighbors import BLOCK_POINTS, nearest_neighbors
from rareclass.operators.split import HashOrder

EMIT_BLOCK = 10_000


def synthetic_rows_needed(majority: int, minority: int, ratio: float, k: int) -> int:
    if minority <= k:
        raise DatasetError(f"SMOTE needs more than {k} minority rows, found {minority}.")
    n_new = int(majority * ratio) - minority
    if n_new < 0:
        raise DatasetError("The minority class already exceeds the requested ratio.")
    return n_new


def smote(df: DataFrame, vector: str = "x", ratio: float = 0.10, k: int = 5, seed=SEED, key: str = ROW_ID,
          label: str = TARGET, block: int = BLOCK_POINTS) -> DataFrame:
    """Synthetic rows ``(pid, draw, neighbor, u, x)``; ``vector`` is an array of features.

    Every minority row is a base equally often, give or take one; which rows get one more is
    decided by hash order. Each draw moves from the base towards one of its ``k`` nearest
    minority rows. Equal vectors are kept as one point with a count, so a vector that many
    rows share costs no more than any other.
    """
    n_new, minority_x, per_row = _plan(df, vector, ratio, k, seed, key, label)
    if n_new == 0:
        kind = df.schema[key].dataType.simpleString()
        return df.sparkSession.createDataFrame(
            [], f"pid {kind}, draw bigint, neighbor int, u double, x array<double>")
    points = minority_x.groupBy("x").agg(
        F.count(F.lit(1)).alias("m"), F.min(key).alias("pid"), F.sum(per_row).alias("draws"))
    near = nearest_neighbors(points, k, block)
    both = points.join(near, "pid").where("draws > 0")
    own = F.array_repeat(F.col("x"), F.least(F.col("m") - 1, F.lit(k)).cast("int"))
    others = F.flatten(F.transform("nn", lambda n: F.array_repeat(n["nx"], F.least(n["nm"], F.lit(k)).cast("int"))))
    both = both.select("pid", "x", "draws", F.slice(F.concat(own, others), 1, k).alias("near"))
    # A point with very many draws is emitted in blocks that land in different tasks.
    blocks = both.withColumn("b", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor((F.col("draws") - 1) / EMIT_BLOCK))))
    limit = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks.repartition(min(limit, math.ceil(n_new / EMIT_BLOCK)), "pid", "b")
    first = F.col("b") * EMIT_BLOCK
    draws = blocks.withColumn("draw", F.explode(F.sequence(
        first + 1, F.least(first + EMIT_BLOCK, F.col("draws")))))
    h = hash_key(seed, F.col("pid"), F.col("draw"))
    draws = (draws.withColumn("neighbor", (hash_int(8, F.substring(h, 17, 8)) % F.lit(k)).cast("int"))
             .withColumn("u", hash_unit(h)))
    moved = F.zip_with("x", F.element_at("near", F.col("neighbor") + 1), lambda a, b: a + F.col("u") * (b - a))
    return draws.select("pid", "draw", "neighbor", "u", moved.alias("x"))


def _plan(df, vector, ratio, k, seed, key, label):
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    n_min = counts.get(1, 0)
    n_new = synthetic_rows_needed(counts.get(0, 0), n_min, ratio, k)
    minority = df.where(F.col(label) == 1).select(key, label, F.col(vector).alias("x"))
    order = HashOrder(minority, key, label, seed)
    extra = F.when(order.below({1: n_new % n_min}), 1).otherwise(0)
    return n_new, minority, (F.lit(n_new // n_min) + extra).cast("bigint")


def smote_counts(df: DataFrame, ratio: float = 0.10, label: str = TARGET) -> DataFrame:
    """One row: majority, minority, synthetic rows and positives after resampling."""
    n = df.agg(F.count_if(F.col(label) == 0).alias("majority"), F.count_if(F.col(label) == 1).alias("minority"))
    new = F.floor(F.col("majority") * F.lit(ratio)).cast("bigint") - F.col("minority")
    return n.withColumn("synthetic", new).withColumn("minority_after", F.col("minority") + new)
