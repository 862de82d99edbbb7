"""The canonical transaction view over the given tables, and fixed scorers.

Each event becomes one transaction; its 28 components are the first entries of the
embedding that the event points at. Missing components, exact copies and bad texts are
injected by rule, so that the checks have something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rareclass.config import ALGORITHMS, COMPONENTS, FEATURES, ROW_ID, TARGET
from rareclass.session import spread

# Injection rules of the test view.
NULL_PERIOD = 89
COPY_PERIOD = 97
POSITIVE_TYPES = ["error", "purchase"]

BROADCAST_VECTORS = 50_000  # about 20 MB of vectors; a larger table takes the shuffle join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def component_columns() -> list[Column]:
    texts = [f"CAST(embedding[{i}] AS DOUBLE)" for i in range(len(COMPONENTS))]
    for i in range(3):
        texts[i] = f"CASE WHEN event_id % {NULL_PERIOD} <> {i + 1} THEN {texts[i]} END"
    return [F.expr(f"{t} AS {c}") for t, c in zip(texts, COMPONENTS)]


def micros(col: Column) -> Column:
    return F.unix_micros(col.cast("timestamp"))


def join_transactions(events: DataFrame, vectors: DataFrame, n_vectors: int, start_micros: int) -> DataFrame:
    """Events with their vector. An equi-join on a computed key that is uniform by design."""
    e = events.select("event_id", "ts", "event_type", "value", (F.col("event_id") % n_vectors).alias("vec_id"))
    side = vectors.select("vec_id", "embedding", "label")
    # Left to itself, the planner broadcasts a small event side and scans on in one task.
    joined = e.join(F.broadcast(side) if n_vectors <= BROADCAST_VECTORS else side, "vec_id")
    positive = (F.col("label") == 0) & F.col("event_type").isin(POSITIVE_TYPES)
    return joined.select(
        F.col("event_id").alias(ROW_ID), "ts",
        ((micros(F.col("ts")) - start_micros).cast("double") / 1000000).alias("Time"),
        *component_columns(),
        F.col("value").alias("Amount"),
        F.when(positive, 1).otherwise(0).alias(TARGET))


def fixture_scalars(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """Number of vectors and first event time: two one-row aggregates."""
    n = table(spark, sf_dir, "embeddings").count()
    start = table(spark, sf_dir, "events").agg(micros(F.min("ts"))).first()[0]
    return n, start


def transactions_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, start = fixture_scalars(spark, sf_dir)
    events = spread(table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value"))
    return join_transactions(events, table(spark, sf_dir, "embeddings"), n, start)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean view: row_id, 30 features and Class; what the dedup job would have written."""
    return transactions_ts(spark, sf_dir).drop("ts")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean view with exact copies added; one scan and one join."""
    copies = F.when(F.col(ROW_ID) % COPY_PERIOD == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return transactions(spark, sf_dir).withColumn("_copy", F.explode(copies)).drop("_copy")


def text_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw view as a CSV reader delivers it: texts, some of them bad."""
    tx = raw_transactions(spark, sf_dir)
    r = F.col(ROW_ID) % NULL_PERIOD
    amount = F.col("Amount").cast("string")
    changed = (F.when(r == 4, F.lit("N/A")).when(r == 5, F.lit("12,50")).when(r == 6, F.lit("inf"))
               .when(r == 7, F.concat(F.lit("-"), amount)).when(r == 8, F.lit("")).otherwise(amount))
    label = F.when(r == 9, F.lit("2")).when(r == 10, F.lit("")).otherwise(F.col(TARGET).cast("string"))
    return tx.select(
        ROW_ID, *[F.col(c).cast("string").alias(c) for c in FEATURES[:-1]],
        changed.alias("Amount"), label.alias(TARGET))


# Fixed scorers, so that every metric has an exact oracle: experiment -> (bias, weights of V1..V7).
SCORED_COMPONENTS = COMPONENTS[:7]


def scorers() -> dict[tuple[str, str, str], tuple[float, list[float]]]:
    out = {}
    for a, algorithm in enumerate(ALGORITHMS):
        for m, imbalance in enumerate(["None", "SMOTE"]):
            for s, stage in enumerate(["baseline", "tuned"]):
                weights = [0.0] * len(SCORED_COMPONENTS)
                for j in range(5):
                    weights[a + j] = (j + 1) * (0.5 + 0.25 * s) * (-1) ** (a + j)
                out[(algorithm, imbalance, stage)] = (-3.0 + 1.5 * m + 0.25 * s, weights)
    return out


def experiment_name(key: tuple[str, str, str]) -> str:
    return " | ".join(key)


FLAGSHIP = ("Random Forest", "None", "baseline")


def _logistic(bias: Column, weights: list[Column]) -> Column:
    """Rounding gives real ties and hides last-digit differences of exp."""
    z = bias
    for name, w in zip(SCORED_COMPONENTS, weights):
        z = z + w * F.coalesce(F.col(name), F.lit(0.0))
    return F.round(1 / (1 + F.exp(-z)), 4)


def fixed_score(key: tuple[str, str, str] = FLAGSHIP) -> Column:
    bias, weights = scorers()[key]
    return _logistic(F.lit(bias), [F.lit(w) for w in weights])


def long_scores(tx: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(row_id, label, experiment, algorithm, imbalance, stage, score): one scan, no join.

    A literal table of weights is exploded beside each row, so one short expression serves
    all experiments and the generated code stays small enough to be compiled.
    """
    names = [f"w{i}" for i in range(len(SCORED_COMPONENTS))]
    table_of_weights = F.array(*[
        F.struct(F.lit(experiment_name(k)).alias("experiment"), F.lit(k[0]).alias("algorithm"),
                 F.lit(k[1]).alias("imbalance"), F.lit(k[2]).alias("stage"), F.lit(bias).alias("bias"),
                 *[F.lit(w).alias(n) for n, w in zip(names, weights)])
        for k, (bias, weights) in scorers().items()])
    kept = [c for c in (keep or []) if c not in (ROW_ID, TARGET)]
    wide = tx.select(ROW_ID, F.col(TARGET).alias("label"), *kept, *SCORED_COMPONENTS,
                     F.explode(table_of_weights).alias("m"))
    score = _logistic(F.col("m.bias"), [F.col(f"m.{n}") for n in names])
    return wide.select(ROW_ID, "label", *kept, "m.experiment", "m.algorithm", "m.imbalance", "m.stage",
                       score.alias("score"))
