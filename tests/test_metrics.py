import numpy as np
import pytest

from rareclass.errors import DatasetError
from rareclass.operators import compare, metrics


def scores(spark, labels, values, name="m"):
    return spark.createDataFrame([(name, "validation", int(y), float(s)) for y, s in zip(labels, values)],
                                 "experiment string, partition string, label int, score double")


GOLD = ([0, 0, 0, 1, 1], [.1, .6, .2, .8, .3])


def test_golden_vector(spark):
    r = metrics.metric_rows(scores(spark, *GOLD)).first()
    assert [r[c] for c in ("tn", "fp", "fn", "tp")] == [2, 1, 1, 1]
    assert r["accuracy"] == 0.6 and r["precision"] == r["recall"] == r["f1"] == 0.5
    assert r["average_precision"] == pytest.approx(5 / 6) and r["roc_auc"] == pytest.approx(5 / 6)
    assert r["pr_auc"] == pytest.approx(0.7916666667) and r["rows"] == 5 and r["fraud_rate"] == 0.4
    assert metrics.best_threshold(metrics.curve(scores(spark, *GOLD))).first()["threshold"] == 0.3


def test_constant_scores(spark):
    r = metrics.metric_rows(scores(spark, [0] * 999 + [1], [0.0] * 1000)).first()
    assert r["accuracy"] == 0.999 and r["precision"] == r["recall"] == r["f1"] == 0
    assert r["average_precision"] == pytest.approx(0.001) and r["roc_auc"] == 0.5
    assert r["pr_auc"] == pytest.approx((1 + 0.001) / 2)


@pytest.mark.parametrize("labels, values, message", [
    ([0, 0], [.1, .2], "0 positive"), ([0, 1], [.1, 1.2], "1 scores outside"),
    ([0, 1], [.1, float("nan")], "1 scores outside"), ([0, 1], [-0.1, .2], "1 scores outside")])
def test_bad_inputs(spark, labels, values, message):
    with pytest.raises(DatasetError, match=message):
        metrics.require_metric_input(scores(spark, labels, values))
    with pytest.raises(DatasetError):
        metrics.require_metric_input(scores(spark, *GOLD), threshold=-0.1)


def brute(y, s):
    order = np.unique(s)[::-1]
    tp = np.array([((s >= t) & (y == 1)).sum() for t in order])
    fp = np.array([((s >= t) & (y == 0)).sum() for t in order])
    p, n = (y == 1).sum(), (y == 0).sum()
    prec, rec = tp / (tp + fp), tp / p
    ap = np.sum(np.diff(np.r_[0, rec]) * prec)
    roc = np.trapezoid(np.r_[0, tp / p], np.r_[0, fp / n])
    pr = np.trapezoid(np.r_[1, prec], np.r_[0, rec])
    return roc, ap, pr


@pytest.mark.parametrize("bucket_rows", [10_000, 100, 7])
def test_against_brute_force_with_skewed_scores(spark, bucket_rows):
    rng = np.random.default_rng(3)
    y = (rng.random(2000) < 0.05).astype(int)
    s = np.where(rng.random(2000) < 0.35, 0.0, rng.beta(0.05, 5, 2000))  # a third on one score, most near zero
    s = np.clip(np.where(y == 1, s + rng.random(2000) * 0.2, s), 0, 1)
    df = scores(spark, y, s)
    r = metrics.metric_rows(df, bucket_rows=bucket_rows).first()
    assert [r["roc_auc"], r["average_precision"], r["pr_auc"]] == pytest.approx(list(brute(y, s)))


def test_bucketed_curve_equals_plain_curve(spark):
    rng = np.random.default_rng(4)
    y, s = (rng.random(1500) < 0.2).astype(int), rng.random(1500).round(2)
    df = scores(spark, y, s, "a").unionByName(scores(spark, 1 - y, s ** 3, "b"))
    cols = ["experiment", "partition", "score", "pos", "neg", "tp", "fp", "p", "n", "next_pos", "next_neg"]
    plain = metrics.curve(df).select(cols)
    for bucket_rows in (50, 500):
        cut = metrics.curve(df, bucket_rows=bucket_rows).select(cols)
        assert plain.exceptAll(cut).isEmpty() and cut.exceptAll(plain).isEmpty()


def test_roc_curve_drops_only_inner_points(spark):
    y, s = [1, 1, 0, 0, 1], [.9, .8, .7, .6, .5]
    pts = metrics.curve(scores(spark, y, s))
    full = metrics.roc_curve(pts, drop_intermediate=False).count()
    got = sorted((r["fpr"], round(r["tpr"], 6)) for r in metrics.roc_curve(pts).collect())
    assert full == 6
    assert got == [(0, 0), (0, round(1 / 3, 6)), (0, round(2 / 3, 6)), (1, round(2 / 3, 6)), (1, 1)]


def test_best_threshold_takes_the_highest_of_equal_f1(spark):
    # F1 is 2/3 at 0.9 (1 of 2 positives, no false alert) and again at 0.2.
    best = metrics.best_threshold(metrics.curve(scores(spark, [1, 0, 0, 1], [.9, .5, .4, .2]))).first()
    assert best["threshold"] == 0.9


def test_selection_ties_and_pairs(spark):
    rows = [("b | None | baseline", .5, .4), ("a | None | baseline", .5, .4), ("c | None | baseline", .5, .3)]
    df = spark.createDataFrame([(n, "validation", ap, f1) for n, ap, f1 in rows],
                               "experiment string, partition string, average_precision double, f1 double")
    assert compare.select_experiment(compare.with_names(df)).first()["experiment"] == "a | None | baseline"
