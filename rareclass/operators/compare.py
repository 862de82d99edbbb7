"""Comparison and choice of experiments. All tables here have one row per experiment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareclass.config import DUMMY_EXPERIMENT
from rareclass.operators.metrics import GROUP, metric_rows_of_curve

# Columns of the comparison tables.
PAIRED_METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "average_precision", "pr_auc"]
COMPARISON_COLUMNS = [
    "experiment", "algorithm", "imbalance", "stage", "partition", "fit_seconds", "train_average_precision",
    "train_f1", "threshold", "accuracy", "precision", "recall", "f1", "roc_auc", "average_precision", "pr_auc",
    "tn", "fp", "fn", "tp", "rows", "fraud_rate"]


def only(metrics: DataFrame, partition: str, stages: list[str]) -> DataFrame:
    return metrics.where((F.col("partition") == partition) & F.col("stage").isin(stages))


def ranked(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("average_precision"), F.desc("f1"), "experiment")


def select_experiment(metrics: DataFrame) -> DataFrame:
    """The winner on validation: average precision, then F1, then name."""
    return ranked(only(metrics, "validation", ["baseline", "tuned"])).limit(1)


def before_after(metrics: DataFrame) -> DataFrame:
    """Baseline beside tuned for each algorithm and imbalance treatment."""
    keys = ["algorithm", "imbalance"]
    valid = metrics.where(F.col("partition") == "validation")

    def side(stage: str, suffix: str) -> DataFrame:
        return valid.where(F.col("stage") == stage).select(
            *keys, *[F.col(m).alias(f"{m}_{suffix}") for m in PAIRED_METRICS])

    joined = side("baseline", "before").join(side("tuned", "after"), keys)
    return joined.select(*keys, *[f"{m}_{s}" for m in PAIRED_METRICS for s in ("before", "after")])


def _pivoted(metrics: DataFrame, keys: list[str], by: str, values: list[str], columns: list[str]) -> DataFrame:
    return metrics.groupBy(*keys).pivot(by, values).agg(*[F.first(c).alias(c) for c in columns])


def resampling_effect(metrics: DataFrame, partition: str = "validation") -> DataFrame:
    """SMOTE minus None for each algorithm and stage."""
    cols = ["average_precision", "precision", "recall", "fp"]
    p = _pivoted(only(metrics, partition, ["baseline", "tuned"]), ["algorithm", "stage"], "imbalance",
                 ["None", "SMOTE"], cols)
    names = {"average_precision": "delta_ap", "precision": "delta_precision", "recall": "delta_recall",
             "fp": "delta_false_alerts"}
    return p.select("algorithm", "stage", *[
        (F.col(f"SMOTE_{c}") - F.col(f"None_{c}")).alias(names[c]) for c in cols])


def tuning_effect(metrics: DataFrame, partition: str = "validation") -> DataFrame:
    """Tuned minus baseline for each algorithm and imbalance treatment."""
    p = _pivoted(only(metrics, partition, ["baseline", "tuned"]), ["algorithm", "imbalance"], "stage",
                 ["baseline", "tuned"], ["average_precision", "f1"])
    return p.select("algorithm", "imbalance",
                    (F.col("tuned_average_precision") - F.col("baseline_average_precision")).alias("delta_ap"),
                    (F.col("tuned_f1") - F.col("baseline_f1")).alias("delta_f1"))


def generalisation_gap(metrics: DataFrame) -> DataFrame:
    return metrics.select("experiment", "partition", "train_average_precision", "average_precision",
                          (F.col("train_average_precision") - F.col("average_precision")).alias("ap_gap"))


def with_names(metric_table: DataFrame) -> DataFrame:
    """Split the experiment key into algorithm, imbalance and stage."""
    parts = F.split("experiment", r" \| ")
    return (metric_table.withColumn("algorithm", parts[0]).withColumn("imbalance", parts[1])
            .withColumn("stage", parts[2]))


def dummy_points(points: DataFrame) -> DataFrame:
    """Curve of the constant score 0: one point per partition with all rows of one experiment."""
    sizes = points.groupBy(*GROUP).agg(F.max("p").alias("p"), F.max("n").alias("n"))
    one = sizes.groupBy("partition").agg(F.max("p").alias("p"), F.max("n").alias("n"))
    return one.select(
        F.lit(DUMMY_EXPERIMENT).alias("experiment"), "partition", F.lit(0.0).alias("score"),
        F.col("p").alias("pos"), F.col("n").alias("neg"), F.col("p").alias("tp"), F.col("n").alias("fp"), "p", "n")


# Names in the comparison table.
REFERENCE_NAME = "Dummy reference"
SELECTED_STAGE = "selected threshold"


def comparison_table(points: DataFrame, fits: DataFrame, chosen: str, threshold: float) -> DataFrame:
    """All experiments on validation and test, the constant model, and the chosen model at its
    threshold. ``fits`` has one row per experiment: names, fit seconds, train metrics."""
    scored = metric_rows_of_curve(points).join(fits, "experiment")
    dummy = (metric_rows_of_curve(dummy_points(points))
             .withColumns({"algorithm": F.lit(REFERENCE_NAME), "imbalance": F.lit("None"),
                           "stage": F.lit("reference"), "fit_seconds": F.lit(0.0)}))
    best = (metric_rows_of_curve(points.where(F.col("experiment") == chosen), threshold)
            .join(fits, "experiment")
            .withColumn("experiment", F.concat("experiment", F.lit(f" | {SELECTED_STAGE}")))
            .withColumn("stage", F.lit(SELECTED_STAGE)))
    every = scored.unionByName(dummy, allowMissingColumns=True).unionByName(best)
    return every.select(*COMPARISON_COLUMNS)
