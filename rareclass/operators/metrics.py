"""Exact ranking and threshold metrics for many models at once.

Input is one long table ``(experiment, partition, label, score)``. Rows collapse to one
row per distinct score before anything is ordered. Running totals are taken inside score
buckets of bounded size and shifted by the totals of the buckets above, so that no model's
whole curve is sorted in one task.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rareclass.errors import DatasetError
from rareclass.functions.scalars import f1_of, ratio
from rareclass.session import materialize

GROUP = ["experiment", "partition"]
BUCKET_ROWS = 1_000_000
SAMPLE_ROWS = 200_000


def metric_input_violations(scores: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Groups whose input is not usable: one class only, or scores missing or outside [0, 1]."""
    s = F.col("score")
    return scores.groupBy(*group).agg(
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count_if(F.col("label") == 0).alias("negatives"),
        F.count_if(~F.coalesce(F.col("label").isin(0, 1), F.lit(False))).alias("bad_labels"),
        F.count_if(s.isNull() | F.isnan(s) | (s < 0) | (s > 1)).alias("bad_scores"),
    ).where("positives = 0 or negatives = 0 or bad_labels > 0 or bad_scores > 0")


def require_metric_input(scores: DataFrame, threshold: float = 0.5, group: list[str] = GROUP) -> None:
    if not 0 <= threshold <= 1:
        raise DatasetError(f"A threshold lies in [0, 1]; got {threshold!r}.")
    bad = metric_input_violations(scores, group).limit(5).collect()
    if bad:
        r = bad[0]
        why = (f"{r['bad_scores']} scores outside [0, 1]" if r["bad_scores"] else
               f"{r['positives']} positive, {r['negatives']} negative and {r['bad_labels']} other labels")
        raise DatasetError(f"No metrics for {' | '.join(str(r[g]) for g in group)}: {why}.")


def distinct_scores(scores: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """(group, score, pos, neg); equal scores collapse on the map side."""
    return scores.groupBy(*group, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))


def score_splits(scores: DataFrame, bucket_rows: int = BUCKET_ROWS) -> list[float]:
    """Cut points that leave about ``bucket_rows`` rows of ``scores`` between them; none for a small table.

    They come from a sample and only balance the work: any cut points give the same curve.
    """
    rows = scores.count()
    buckets = math.ceil(rows / bucket_rows)
    if buckets <= 1:
        return []
    share = min(1.0, SAMPLE_ROWS / rows)
    sample = scores.select("score").where(F.rand(11) < share) if share < 1 else scores.select("score")
    grid = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    cuts = sample.agg(F.percentile("score", grid)).first()[0] or []
    return sorted(set(cuts))


def curve(scores: DataFrame, group: list[str] = GROUP, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per distinct score, highest first in meaning:
    ``pos, neg`` at the score, ``tp, fp`` at or above it, ``p, n`` in the group, and
    ``next_pos, next_neg`` of the next lower score.

    ``scores`` is evaluated once: its distinct scores are written, and all else reads those.
    """
    points = materialize(distinct_scores(scores, group), "points")
    splits = score_splits(points, bucket_rows)
    if not splits:
        down = Window.partitionBy(*group).orderBy(F.desc("score"))
        run = down.rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy(*group)
        return points.select(
            "*", F.sum("pos").over(run).alias("tp"), F.sum("neg").over(run).alias("fp"),
            F.sum("pos").over(whole).alias("p"), F.sum("neg").over(whole).alias("n"),
            F.lead("pos").over(down).alias("next_pos"), F.lead("neg").over(down).alias("next_neg"))
    cut = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol="score", outputCol="b")
    points = cut.transform(points)
    # One row per group and bucket.
    totals = points.groupBy(*group, "b").agg(
        F.sum("pos").alias("bp"), F.sum("neg").alias("bn"),
        F.max_by(F.struct("pos", "neg"), "score").alias("top"))
    down_b = Window.partitionBy(*group).orderBy(F.desc("b"))
    above = down_b.rowsBetween(Window.unboundedPreceding, -1)
    whole_b = Window.partitionBy(*group)
    shifts = totals.select(
        *group, "b",
        F.coalesce(F.sum("bp").over(above), F.lit(0)).alias("sp"),
        F.coalesce(F.sum("bn").over(above), F.lit(0)).alias("sn"),
        F.sum("bp").over(whole_b).alias("p"), F.sum("bn").over(whole_b).alias("n"),
        F.lead("top").over(down_b).alias("next_top"))
    down = Window.partitionBy(*group, "b").orderBy(F.desc("score"))
    run = down.rowsBetween(Window.unboundedPreceding, 0)
    return points.join(shifts, [*group, "b"]).select(
        *group, "score", "pos", "neg",
        (F.col("sp") + F.sum("pos").over(run)).alias("tp"),
        (F.col("sn") + F.sum("neg").over(run)).alias("fp"), "p", "n",
        F.coalesce(F.lead("pos").over(down), F.col("next_top.pos")).alias("next_pos"),
        F.coalesce(F.lead("neg").over(down), F.col("next_top.neg")).alias("next_neg"))


# Expressions over a row of ``curve``.
def _precision():
    return ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def _recall():
    return ratio(F.col("tp"), F.col("p"))


def roc_auc_expr():
    """Trapezoid area in pairs of ranks; ties count half."""
    area = F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") / 2.0)
    return ratio(F.sum(area), F.max("p") * F.max("n")).alias("roc_auc")


def average_precision_expr():
    return ratio(F.sum(F.col("pos") * _precision()), F.max("p")).alias("average_precision")


def pr_auc_expr():
    """Trapezoid area; the curve starts at recall 0, precision 1."""
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    before = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(ratio(tp0, tp0 + fp0))
    return ratio(F.sum(F.col("pos") * (before + _precision()) / 2.0), F.max("p")).alias("pr_auc")


def ranking_metrics(points: DataFrame, group: list[str] = GROUP) -> DataFrame:
    return points.groupBy(*group).agg(roc_auc_expr(), average_precision_expr(), pr_auc_expr())


def _counts_at(points_or_scores_pos, points_or_scores_neg, threshold):
    hit = F.col("score") >= threshold
    return [
        F.sum(F.when(~hit, points_or_scores_neg).otherwise(0)).alias("tn"),
        F.sum(F.when(hit, points_or_scores_neg).otherwise(0)).alias("fp"),
        F.sum(F.when(~hit, points_or_scores_pos).otherwise(0)).alias("fn"),
        F.sum(F.when(hit, points_or_scores_pos).otherwise(0)).alias("tp"),
    ]


def confusion(scores: DataFrame, threshold: float = 0.5, group: list[str] = GROUP) -> DataFrame:
    """tn, fp, fn, tp with a positive where score >= threshold; no ordering needed."""
    y = F.col("label").cast("bigint")
    return scores.groupBy(*group).agg(*_counts_at(y, 1 - y, F.lit(threshold)))


def with_rates(counts: DataFrame) -> DataFrame:
    """Add accuracy, precision, recall, f1, with 0 for 0/0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return (counts.withColumn("accuracy", ratio(tp + tn, tp + tn + fp + fn))
            .withColumn("precision", ratio(tp, tp + fp))
            .withColumn("recall", ratio(tp, tp + fn))
            .withColumn("f1", f1_of(tp, fp, fn)))


def threshold_metrics(scores: DataFrame, threshold: float = 0.5, group: list[str] = GROUP) -> DataFrame:
    return with_rates(confusion(scores, threshold, group)).withColumn("threshold", F.lit(float(threshold)))


def multi_threshold_metrics(scores: DataFrame, thresholds: dict[str, float], group: list[str] = GROUP) -> DataFrame:
    """Threshold metrics for a few named thresholds in one pass over the scores."""
    y = F.col("label").cast("bigint")
    cells, exprs = [], []
    for i, (name, t) in enumerate(thresholds.items()):
        counted = _counts_at(y, 1 - y, F.lit(t))
        names = ["tn", "fp", "fn", "tp"]
        exprs += [e.alias(f"{n}{i}") for n, e in zip(names, counted)]
        cells.append(F.struct(F.lit(name).alias("threshold_name"), F.lit(float(t)).alias("threshold"),
                              *[F.col(f"{n}{i}").alias(n) for n in names]))
    wide = scores.groupBy(*group).agg(*exprs)
    return with_rates(wide.select(*group, F.explode(F.array(*cells)).alias("c")).select(*group, "c.*"))


# Metric columns of the result tables.
METRIC_COLUMNS = ["threshold", "accuracy", "precision", "recall", "f1", "roc_auc", "average_precision",
                  "pr_auc", "tn", "fp", "fn", "tp", "rows", "fraud_rate"]


def metric_rows(scores: DataFrame, threshold: float = 0.5, group: list[str] = GROUP,
                bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """All metrics of each group, from one pass over its curve."""
    return metric_rows_of_curve(curve(scores, group, bucket_rows), threshold, group)


def metric_rows_of_curve(points: DataFrame, threshold: float = 0.5, group: list[str] = GROUP) -> DataFrame:
    renamed = [e.alias(f"_{n}") for e, n in
               zip(_counts_at(F.col("pos"), F.col("neg"), F.lit(threshold)), ("tn", "fp", "fn", "tp"))]
    one = points.groupBy(*group).agg(
        *renamed, roc_auc_expr(), average_precision_expr(), pr_auc_expr(),
        F.sum(F.col("pos") + F.col("neg")).alias("rows"),
        ratio(F.max("p"), F.sum(F.col("pos") + F.col("neg"))).alias("fraud_rate"))
    for n in ("tn", "fp", "fn", "tp"):
        one = one.withColumnRenamed(f"_{n}", n)
    return with_rates(one).withColumn("threshold", F.lit(float(threshold))).select(*group, *METRIC_COLUMNS)


def roc_curve(points: DataFrame, group: list[str] = GROUP, drop_intermediate: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) with the start (0, 0); inner points of straight runs are dropped."""
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    last = F.col("next_pos").isNull()
    bend = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    kept = points.where(first | last | bend) if drop_intermediate else points
    body = kept.select(*group, F.col("score").alias("threshold"),
                       ratio(F.col("fp"), F.col("n")).alias("fpr"), ratio(F.col("tp"), F.col("p")).alias("tpr"))
    start = points.where(first).select(*group, F.lit(float("inf")).alias("threshold"),
                                       F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return body.unionByName(start)


def pr_curve(points: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """(threshold, precision, recall) and the end point recall 0, precision 1."""
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    body = points.select(*group, F.col("score").alias("threshold"),
                         _precision().alias("precision"), _recall().alias("recall"))
    anchor = points.where(first).select(*group, F.lit(None).cast("double").alias("threshold"),
                                        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return body.unionByName(anchor)


def threshold_sweep(points: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """(threshold, precision, recall, f1) at every distinct score."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("p") - F.col("tp")
    return points.select(*group, F.col("score").alias("threshold"), _precision().alias("precision"),
                         _recall().alias("recall"), f1_of(tp, fp, fn).alias("f1"))


def threshold_view(sweep: DataFrame) -> DataFrame:
    """The part of a sweep that is shown."""
    return sweep.where(F.col("threshold").between(0.001, 0.999))


def best_threshold(points: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Threshold of the highest F1; the highest threshold wins an exact tie."""
    sweep = threshold_sweep(points, group)
    best = F.max(F.struct("f1", "threshold", "precision", "recall")).alias("b")
    return sweep.groupBy(*group).agg(best).select(*group, "b.threshold", "b.f1", "b.precision", "b.recall")


def no_skill(scores: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Reference levels: prevalence for precision, 0.5 for ROC-AUC."""
    return scores.groupBy(*group).agg(F.avg(F.col("label").cast("double")).alias("no_skill_precision")) \
        .withColumn("no_skill_roc_auc", F.lit(0.5))
