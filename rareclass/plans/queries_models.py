"""Registered queries that fit models: small problems that SQL can solve too, and real fits."""

from __future__ import annotations

import functools
import re

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from rareclass.config import ALGORITHMS, FEATURES, NEGATIVE_NAME, POSITIVE_NAME, ROW_ID, TARGET, TrainingConfig
from rareclass.operators import metrics, models, score, split
from rareclass.operators.features import MedianImputer, MixedScaler
from rareclass.operators.logistic import fit_together, scores_together
from rareclass.plans.catalog import query, rounded
from rareclass.plans.experiment import (
    CANDIDATE_COLUMNS, TUNING_COLUMNS, Prepared, _frame, _parallel, candidate_table, fold_scores, score_parts, shared_frames)
from rareclass.plans.fixture import transactions
from rareclass.plans.oracle import FOLDED, rnd, sql, union
from rareclass.session import materialize, shared_dir

# The settings of a real run, on all rows; the ranking is the one for tables of any size.
CONFIG = TrainingConfig(selection_method="binned", selection_max_rows=None, tuning_max_rows=None)


def _split(spark, d):
    return materialize(split.stratified_split(transactions(spark, d)), "model-split")


def _frames(parted):
    part = lambda n: parted.where(F.col("partition") == n).drop("partition")
    return shared_frames(part("train"), {"validation": part("validation"), "test": part("test")}, CONFIG)


def _baseline(spark, d, algorithm):
    frames = _frames(_split(spark, d))

    def scored(use_smote):
        rows, params = frames.fit_rows[use_smote], models.default_params(algorithm, CONFIG)
        clf = (models.forests_together(rows, [params], CONFIG.seed)[0] if algorithm == "Random Forest"
               else models.fit_classifier(rows, algorithm, params, CONFIG.seed))
        return score_parts(clf, models.experiment_key(algorithm, use_smote, "baseline"), frames.parts)

    plain, smote = _parallel(spark, CONFIG.n_jobs, [lambda: scored(False), lambda: scored(True)])
    out = materialize(metrics.metric_rows(plain.unionByName(smote)), "baseline-metrics")
    frames.release()
    return out


@query("lr_baseline_metrics")
def lr_baseline_metrics(spark, d):
    return _baseline(spark, d, "Logistic Regression")


@query("dt_baseline_metrics")
def dt_baseline_metrics(spark, d):
    return _baseline(spark, d, "Decision Tree")


@query("rf_baseline_metrics")
def rf_baseline_metrics(spark, d):
    return _baseline(spark, d, "Random Forest")


@query("rf_importance")
def rf_importance(spark, d):
    parted = _split(spark, d)
    frames = _frames(parted)
    names = frames.prefix.stages[-1].selected_features()
    params = {"n_estimators": CONFIG.report_trees, "max_depth": 12, "min_samples_leaf": 2, "max_features": "sqrt",
              "max_samples": 1.0}
    forest = models.fit_classifier(frames.fit_rows[False], "Random Forest", params, CONFIG.seed)
    frames.release()
    return models.top_importances(models.feature_importance(forest, names, spark))


@functools.lru_cache(maxsize=1)
def _searched(spark, d):
    """The whole search of one table: settings tried, results of every fold, size of the sample."""
    parted = _split(spark, d)
    sample = parted.where("partition = 'train'").drop("partition")
    space = {a: models.sample_candidates(a, CONFIG.tuning_iterations, CONFIG.seed) for a in ALGORITHMS}
    p = Prepared(spark, shared_dir(spark, "search"), CONFIG, "", parted)
    results = fold_scores(p, sample, {(a, s): space[a] for a, s in models.GRID})
    size = sample.agg(F.count(F.lit(1)), F.sum(F.col(TARGET).cast("bigint"))).first()
    return space, results, size


@query("cv_candidates")
def cv_candidates(spark, d):
    space, results, _ = _searched(spark, d)
    tried = [(models.experiment_key(a, s, "tuned"), i, models.params_json(q)) for a, s in models.GRID
             for i, q in enumerate(space[a], 1)]
    params = spark.createDataFrame(tried, "experiment string, candidate bigint, params string")
    return candidate_table(spark, results).join(params, ["experiment", "candidate"]).select(*CANDIDATE_COLUMNS)


@query("tuned_search")
def tuned_search(spark, d):
    space, results, size = _searched(spark, d)
    best: dict[str, dict] = {}
    for r in candidate_table(spark, results).orderBy(F.desc("mean_cv_ap"), "candidate").collect():
        best.setdefault(r["experiment"], r.asDict())
    rows = [{"experiment": n, "algorithm": (a := n.split(" | ")[0]), "imbalance": n.split(" | ")[1], "search_rows": size[0],
             "search_frauds": size[1], "candidates": len(space[a]), "folds": CONFIG.cv_folds,
             "cv_average_precision": r["mean_cv_ap"], "cv_ap_std": r["std_cv_ap"],
             "best_params": models.params_json(space[a][r["candidate"] - 1])} for n, r in best.items()]
    return _frame(spark, rows, [c for c in TUNING_COLUMNS if not c.endswith("seconds")])


@query("model_scored_rows")
def model_scored_rows(spark, d):
    """Raw rows through a fitted pipeline: impute, scale, select and score in one narrow pass."""
    parted = _split(spark, d)
    frames = _frames(parted)
    clf = models.fit_classifier(frames.fit_rows[True], "Logistic Regression",
                                models.default_params("Logistic Regression", CONFIG), CONFIG.seed)
    pipeline = models.assemble(frames.prefix, clf)
    frames.release()
    raw = parted.where("partition = 'test'").select(ROW_ID, *FEATURES, TARGET)
    return score.apply_model(raw, pipeline, 0.5).select(
        ROW_ID, TARGET, score.SCORE, "predicted_class", "prediction", "decision_threshold")


# --- fits that SQL can solve ----------------------------------------------------------------

_RATE_GROUP = "CASE WHEN COALESCE(V1, 0) > 0.05 THEN 1 ELSE 0 END"


@query("lr_group_rates", sql(f"""SELECT g AS "group", COUNT(*) AS rows, {rnd("AVG(Class)", "score", 4)}
 FROM (SELECT Class, {_RATE_GROUP} AS g FROM tx) GROUP BY g""", "tx"))
def lr_group_rates(spark, d):
    """Logistic regression on one binary feature with next to no penalty gives each group's rate."""
    tx = transactions(spark, d).withColumn("g", F.expr(_RATE_GROUP))
    rows = tx.select(array_to_vector(F.array(F.col("g").cast("double"))).alias("features"), F.col(TARGET).cast("double").alias(TARGET), "g")
    model = models.fit_classifier(rows, "Logistic Regression", {"C": 1e8, "tol": 1e-12}, CONFIG.seed)
    scored = models.positive_score(rows, model, ["g"])
    return scored.groupBy(F.col("g").alias("group")).agg(F.count(F.lit(1)).alias("rows"), F.round(F.max("score"), 4).alias("score"))


# Few-valued features: every cut between two values is tried by tree and SQL alike.
# The classes are balanced: MLlib merges leaves that predict the same class.
_STUMP_LABEL = "CASE WHEN V5 * 20 + row_id % 3 > 1 THEN 1 ELSE 0 END"
_STUMP = {"amount": "LEAST(FLOOR(Amount / 40), 7)", "v1": "FLOOR(COALESCE(V1, 0) * 20)", "v5": "FLOOR(V5 * 20)"}


def _stump_sql() -> str:
    levels = union(f"SELECT '{n}' AS feature, {i} AS place, v, COUNT(*) AS n, CAST(SUM(y) AS BIGINT) AS p FROM "
                   f"(SELECT {e} AS v, {_STUMP_LABEL} AS y FROM tx) GROUP BY v" for i, (n, e) in enumerate(_STUMP.items()))
    gini = lambda p, n: f"({n} - ({p} * {p} + ({n} - {p}) * ({n} - {p}))::DOUBLE / {n})"  # noqa: E731  size times impurity
    return sql(
        f"""SELECT feature, {rnd("threshold")}, n AS left_rows, tn - n AS right_rows, {rnd("p::DOUBLE / n", "left_score")},
 {rnd("(tp - p)::DOUBLE / (tn - n)", "right_score")} FROM cuts ORDER BY {gini("p", "n")} + {gini("(tp - p)", "(tn - n)")}, place, threshold LIMIT 1""",
        "tx", extra=[
            ("levels", levels),
            ("run", """SELECT feature, place, v, LEAD(v) OVER w AS up, SUM(n) OVER c AS n, SUM(p) OVER c AS p,
 SUM(n) OVER (PARTITION BY feature) AS tn, SUM(p) OVER (PARTITION BY feature) AS tp FROM levels
 WINDOW w AS (PARTITION BY feature ORDER BY v), c AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)"""),
            ("cuts", """SELECT feature, place, (v + up) / 2 AS threshold, CAST(n AS BIGINT) AS n, CAST(p AS BIGINT) AS p,
 CAST(tn AS BIGINT) AS tn, CAST(tp AS BIGINT) AS tp FROM run WHERE up IS NOT NULL""")])


def _stump_rows(spark, d):
    return transactions(spark, d).select(
        array_to_vector(F.array(*[F.expr(e).cast("double") for e in _STUMP.values()])).alias("features"),
        F.expr(_STUMP_LABEL).cast("double").alias(TARGET))


def _lone_forest(rows):
    """A forest of one tree of depth one on all features and rows: nothing about it is drawn."""
    return models.fit_classifier(rows, "Random Forest", {
        "n_estimators": 1, "max_depth": 1, "min_samples_leaf": 1, "max_features": "all", "max_samples": 1.0,
        "bootstrap": False}, CONFIG.seed)


@query("forest_stump", _stump_sql())
def forest_stump(spark, d):
    """A forest of one stump on all rows is the best Gini cut too."""
    rows = _stump_rows(spark, d)
    return _sides(rows, _lone_forest(rows))


@query("forest_importance", f"WITH best AS ({_stump_sql()}) SELECT f AS feature, CASE WHEN f = feature THEN 1.0 ELSE 0.0 END::DOUBLE AS importance"
       f" FROM best CROSS JOIN (VALUES {', '.join(f'({n!r})' for n in _STUMP)}) AS t(f) ORDER BY importance DESC, f LIMIT 2")
def forest_importance(spark, d):
    """All impurity that a forest of one stump takes away is its feature's."""
    model = _lone_forest(_stump_rows(spark, d))
    return models.top_importances(models.feature_importance(model, list(_STUMP), spark), 2)


@query("tree_stump", _stump_sql())
def tree_stump(spark, d):
    """A tree of depth one is the best Gini cut over all features and values."""
    rows = _stump_rows(spark, d)
    return _sides(rows, models.fit_classifier(
        rows, "Decision Tree", {"criterion": "gini", "max_depth": 1, "min_samples_leaf": 1}, CONFIG.seed))


def _sides(rows, model):
    """The cut of a stump, and size and score of its two sides."""
    # The one split is the only text that holds a comparison.
    place, threshold = re.search(r"feature (\d+) <= (-?[\d.Ee-]+)", model.toDebugString).groups()
    sides = models.positive_score(rows, model, ["features"]).select(
        (vector_to_array("features")[int(place)] <= float(threshold)).alias("left"), "score")
    at = lambda side, agg: agg(F.when(F.col("left") == side, F.col("score")))
    return rounded(sides.agg(
        F.lit(list(_STUMP)[int(place)]).alias("feature"), F.lit(float(threshold)).alias("threshold"),
        at(True, F.count).alias("left_rows"), at(False, F.count).alias("right_rows"),
        at(True, F.max).alias("left_score"), at(False, F.max).alias("right_score")))


# Two candidates whose single feature is binary: every score is its group's rate in the fit rows.
_SIGNS = {"v1": _RATE_GROUP, "amount": "CASE WHEN Amount > 100 THEN 1 ELSE 0 END"}


def _cv_sql() -> str:
    marked = union(f"SELECT row_id, Class, fold, '{n}' AS candidate, {e} AS g FROM tx JOIN ({FOLDED}) USING (row_id, Class)"
                   for n, e in _SIGNS.items())
    return sql(
        f"""SELECT candidate, {rnd("AVG(ap) FILTER (side = 'train')", "mean_train_ap")}, {rnd("AVG(ap) FILTER (side = 'held_out')", "mean_cv_ap")},
 {rnd("STDDEV_POP(ap) FILTER (side = 'held_out')", "std_cv_ap")} FROM aps GROUP BY candidate""", "tx", "tot", extra=[
            ("marked", marked),
            ("each", "SELECT m.*, f.fold AS out_fold FROM marked m CROSS JOIN (VALUES (1), (2), (3)) AS f(fold)"),
            ("rates", "SELECT candidate, out_fold, g, ROUND(AVG(Class), 6) AS score FROM each WHERE fold <> out_fold GROUP BY ALL"),
            ("points", """SELECT candidate, out_fold, CASE WHEN fold = out_fold THEN 'held_out' ELSE 'train' END AS side, score,
 SUM(Class) AS pos, COUNT(*) AS n FROM each JOIN rates USING (candidate, out_fold, g) GROUP BY ALL"""),
            ("run", """SELECT *, SUM(pos) OVER w AS tp, SUM(n) OVER w AS upto, SUM(pos) OVER (PARTITION BY candidate, out_fold, side) AS p
 FROM points WINDOW w AS (PARTITION BY candidate, out_fold, side ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"""),
            ("aps", "SELECT candidate, out_fold, side, SUM(pos * tp::DOUBLE / upto) / MAX(p) AS ap FROM run GROUP BY ALL")])


@query("cv_group_rates", _cv_sql())
def cv_group_rates(spark, d):
    """The search's folds, side-by-side fits, curve and candidate table on a problem that SQL can solve."""
    tx = transactions(spark, d)
    folds = materialize(split.stratified_folds(tx, 3, CONFIG.seed), "rate-folds")
    results = []
    for n, (name, expr) in enumerate(_SIGNS.items(), 1):
        rows = folds.withColumn("features", array_to_vector(F.array(F.expr(expr).cast("double"))))
        for fold in (1, 2, 3):
            fit, held = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
            weights = fit_together(fit, [{"C": 1e9, "tol": 1e-12}])
            scores = [scores_together(df, weights, [name], [ROW_ID, TARGET]).select(
                "experiment", F.lit(side).alias("partition"), ROW_ID, F.col(TARGET).cast("int").alias("label"),
                F.round("score", 6).alias("score")) for side, df in (("train", fit), ("held_out", held))]
            judged = metrics.ranking_metrics(metrics.curve(scores[0].unionByName(scores[1]))).collect()
            results += [{"experiment": r["experiment"], "candidate": n, "side": r["partition"], "ap": r["average_precision"]} for r in judged]
    table = candidate_table(spark, results)
    return rounded(table.select(F.col("experiment").alias("candidate"), "mean_train_ap", "mean_cv_ap", "std_cv_ap"))


_SIGN = "CASE WHEN V1 IS NOT NULL THEN CASE WHEN V1 > 0.05 THEN 1.0 ELSE 0.0 END END"


@query("scored_group_rates", sql(f"""SELECT row_id, score AS fraud_probability, CASE WHEN score >= 0.2 THEN 1 ELSE 0 END AS predicted_class,
 CASE WHEN score >= 0.2 THEN '{POSITIVE_NAME}' ELSE '{NEGATIVE_NAME}' END AS prediction, 0.2::DOUBLE AS decision_threshold
 FROM filled JOIN rates USING (g) WHERE "partition" = 'test'""", "split", extra=[
    ("middle", f"SELECT MEDIAN({_SIGN}::DOUBLE) AS m FROM split WHERE \"partition\" = 'train'"),
    ("filled", f"SELECT row_id, Class, \"partition\", COALESCE({_SIGN}::DOUBLE, m) AS g FROM split CROSS JOIN middle"),
    ("rates", "SELECT g, ROUND(AVG(Class), 6) AS score FROM filled WHERE \"partition\" = 'train' GROUP BY g")]))
def scored_group_rates(spark, d):
    """Raw test rows through a pipeline that imputes, scales and scores, learned on the training rows."""
    marked = _split(spark, d).withColumn("V1", F.expr(_SIGN).cast("double"))
    train = marked.where("partition = 'train'")
    prefix = Pipeline(stages=[MedianImputer(inputCols=["V1"]), MixedScaler(inputCols=["V1"], robustCols=[]),
                              VectorAssembler(inputCols=["V1"], outputCol="features")]).fit(train)
    clf = models.fit_classifier(prefix.transform(train).select("features", F.col(TARGET).cast("double").alias(TARGET)),
                                "Logistic Regression", {"C": 1e9, "tol": 1e-12}, CONFIG.seed)
    raw = marked.where("partition = 'test'").select(ROW_ID, *FEATURES, TARGET)
    scored = score.apply_model(raw, models.assemble(prefix, clf), 0.2).select(ROW_ID, *score.RESULT_COLUMNS)
    return scored.withColumn(score.SCORE, F.round(score.SCORE, 6))
