"""Registered queries: evaluation, comparison, scoring and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from rareclass.config import COMPONENTS, FEATURES, ROW_ID, TARGET
from rareclass.operators import compare, contract, metrics, models, score
from rareclass.operators.split import stratified_folds, stratified_split
from rareclass.plans import fixture
from rareclass.plans.catalog import query, rounded
from rareclass.plans.fixture import FLAGSHIP, experiment_name, fixed_score, long_scores, transactions
from rareclass.plans.oracle import FOLDED, fixed_score_sql, fold_score_sql, rate_columns, rnd, sql
from rareclass.session import materialize, shared_dir
from rareclass.streaming import alerts

THRESHOLD = 0.1
FLAG = experiment_name(FLAGSHIP)


def scored(spark, d, partitions=("validation", "test")):
    """Long score table of all fixed scorers on the evaluation partitions."""
    split = stratified_split(transactions(spark, d)).where(F.col("partition").isin(*partitions))
    return long_scores(split, keep=["partition"])


def points(spark, d):
    return metrics.curve(scored(spark, d))


# --- threshold metrics --------------------------------------------------------------------

# One fault kind per imbalance and stage: scores above 1, NaN scores, one class only, other labels.
_FAULTY_SCORE = """CASE WHEN experiment LIKE '%| None | baseline' THEN score + 0.999::DOUBLE
 WHEN experiment LIKE '%| None | tuned' AND row_id % 7 = 0 THEN 'NaN'::DOUBLE ELSE score END"""
_FAULTY_LABEL = """CASE WHEN experiment LIKE '%| SMOTE | baseline' THEN 1
 WHEN experiment LIKE '%| SMOTE | tuned' AND row_id % 5 = 0 THEN 2 ELSE label END"""


@query("metric_inputs", sql(f"""SELECT experiment, "partition", COUNT(*) FILTER (l = 1) AS positives,
 COUNT(*) FILTER (l = 0) AS negatives, COUNT(*) FILTER (l NOT IN (0, 1)) AS bad_labels, COUNT(*) FILTER (isnan(s) OR s > 1) AS bad_scores
 FROM (SELECT *, {_FAULTY_SCORE} AS s, {_FAULTY_LABEL} AS l FROM scores WHERE "partition" <> 'train') GROUP BY ALL
 HAVING bool_or(isnan(s) OR s > 1 OR l NOT IN (0, 1)) OR bool_and(l = 1)""", "scores"))
def metric_inputs(spark, d):
    spoilt = scored(spark, d).withColumn("score", F.expr(_FAULTY_SCORE.replace("::DOUBLE", "D").replace("'NaN'D", "double('NaN')")))
    return metrics.metric_input_violations(spoilt.withColumn("label", F.expr(_FAULTY_LABEL)))


@query("confusion", sql("SELECT * FROM conf", "conf"))
def confusion(spark, d):
    return metrics.confusion(scored(spark, d))


@query("threshold_metrics", sql(f'SELECT experiment, "partition", tn, fp, fn, tp, {rate_columns()}, 0.5::DOUBLE AS threshold FROM conf', "conf"))
def threshold_metrics(spark, d):
    return rounded(metrics.threshold_metrics(scored(spark, d)))


_NAMED = {"default": 0.5, "frozen": THRESHOLD}


@query("multi_threshold_metrics", sql(
    f"""SELECT *, {rate_columns()} FROM (SELECT experiment, "partition", t.name AS threshold_name, t.t AS threshold,
 COUNT(*) FILTER (score < t AND label = 0) AS tn, COUNT(*) FILTER (score >= t AND label = 0) AS fp,
 COUNT(*) FILTER (score < t AND label = 1) AS fn, COUNT(*) FILTER (score >= t AND label = 1) AS tp
 FROM scores CROSS JOIN (VALUES {", ".join(f"('{n}', {t}::DOUBLE)" for n, t in _NAMED.items())}) AS t(name, t)
 WHERE "partition" <> 'train' GROUP BY ALL)""", "scores"))
def multi_threshold_metrics(spark, d):
    return rounded(metrics.multi_threshold_metrics(scored(spark, d), _NAMED))


# --- curves and areas ---------------------------------------------------------------------

@query("roc_auc", sql(f'SELECT experiment, "partition", {rnd("roc_auc", digits=8)} FROM areas', "areas"))
def roc_auc(spark, d):
    return rounded(points(spark, d).groupBy(*metrics.GROUP).agg(metrics.roc_auc_expr()), 8)


@query("average_precision", sql(f'SELECT experiment, "partition", {rnd("average_precision", digits=8)} FROM areas', "areas"))
def average_precision(spark, d):
    return rounded(points(spark, d).groupBy(*metrics.GROUP).agg(metrics.average_precision_expr()), 8)


@query("pr_auc", sql(f'SELECT experiment, "partition", {rnd("pr_auc", digits=8)} FROM areas', "areas"))
def pr_auc(spark, d):
    return rounded(points(spark, d).groupBy(*metrics.GROUP).agg(metrics.pr_auc_expr()), 8)


_KEEP = "tp = pos AND fp = neg OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg"


@query("roc_curve", sql(f"""SELECT experiment, "partition", {rnd("score", "threshold")}, {rnd("fp::DOUBLE / n", "fpr", 8)}, {rnd("tp::DOUBLE / p", "tpr", 8)}
 FROM cur WHERE {_KEEP} UNION ALL SELECT DISTINCT experiment, "partition", 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM cur""", "cur"))
def roc_curve(spark, d):
    c = metrics.roc_curve(points(spark, d))
    return c.select("experiment", "partition", "threshold", F.round("fpr", 8).alias("fpr"), F.round("tpr", 8).alias("tpr"))


@query("pr_curve", sql(f"""SELECT experiment, "partition", score AS threshold, {rnd("tp::DOUBLE / (tp + fp)", "precision", 8)}, {rnd("tp::DOUBLE / p", "recall", 8)}
 FROM cur UNION ALL SELECT DISTINCT experiment, "partition", NULL::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM cur""", "cur"))
def pr_curve(spark, d):
    return rounded(metrics.pr_curve(points(spark, d)), 8)


_SWEEP = f"""SELECT experiment, "partition", score AS threshold, {rnd("tp::DOUBLE / (tp + fp)", "precision", 8)},
 {rnd("tp::DOUBLE / p", "recall", 8)}, {rnd("(2 * tp)::DOUBLE / (2 * tp + fp + (p - tp))", "f1", 8)} FROM cur"""


@query("threshold_sweep", sql(f"SELECT * FROM ({_SWEEP}) WHERE threshold BETWEEN 0.001 AND 0.999", "cur"))
def threshold_sweep(spark, d):
    return rounded(metrics.threshold_view(metrics.threshold_sweep(points(spark, d))), 8)


@query("best_threshold", sql(f"""SELECT experiment, "partition", threshold, {rnd("f1", digits=8)}, {rnd("precision", digits=8)}, {rnd("recall", digits=8)}
 FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY experiment, "partition" ORDER BY f1 DESC, threshold DESC) AS k FROM
 (SELECT experiment, "partition", score AS threshold, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / p AS recall,
 (2 * tp)::DOUBLE / (tp + fp + p) AS f1 FROM cur)) WHERE k = 1""", "cur"))
def best_threshold(spark, d):
    return rounded(metrics.best_threshold(points(spark, d)), 8)


@query("no_skill", sql(f'SELECT experiment, "partition", {rnd("AVG(label)", "no_skill_precision", 8)}, 0.5::DOUBLE AS no_skill_roc_auc FROM scores WHERE "partition" <> \'train\' GROUP BY ALL', "scores"))
def no_skill(spark, d):
    return rounded(metrics.no_skill(scored(spark, d)), 8)


def _rows_sql(where: str = "TRUE") -> str:
    return f"""SELECT c.experiment, c."partition", 0.5::DOUBLE AS threshold, {rate_columns(8)}, {rnd("roc_auc", digits=8)},
 {rnd("average_precision", digits=8)}, {rnd("pr_auc", digits=8)}, tn, fp, fn, tp, tn + fp + fn + tp AS rows,
 {rnd("(fn + tp)::DOUBLE / (tn + fp + fn + tp)", "fraud_rate", 8)} FROM conf c
 JOIN areas a ON c.experiment = a.experiment AND c."partition" = a."partition" WHERE {where}"""


@query("metric_row", sql(_rows_sql(), "conf", "areas"))
def metric_row(spark, d):
    return rounded(metrics.metric_rows(scored(spark, d)), 8)


@query("metric_row_bucketed", sql(_rows_sql(), "conf", "areas"))
def metric_row_bucketed(spark, d):
    """The same through the bucketed curve that large tables take."""
    s = scored(spark, d)
    return rounded(metrics.metric_rows(s, bucket_rows=max(1, s.count() // 64)), 8)


_DUMMY = f"""SELECT 'Always legitimate' AS experiment, "partition", 0.5::DOUBLE AS threshold, {rnd("(n - p)::DOUBLE / n", "accuracy", 8)},
 0.0::DOUBLE AS precision, 0.0::DOUBLE AS recall, 0.0::DOUBLE AS f1, 0.5::DOUBLE AS roc_auc, {rnd("p::DOUBLE / n", "average_precision", 8)},
 {rnd("(1 + p::DOUBLE / n) / 2", "pr_auc", 8)}, n - p AS tn, 0::BIGINT AS fp, p AS fn, 0::BIGINT AS tp, n AS rows,
 {rnd("p::DOUBLE / n", "fraud_rate", 8)} FROM (SELECT "partition", COUNT(*) AS n, CAST(SUM(Class) AS BIGINT) AS p FROM split
 WHERE "partition" <> 'train' GROUP BY ALL)"""


@query("dummy_metrics", sql(_DUMMY, "split"))
def dummy_metrics(spark, d):
    split = stratified_split(transactions(spark, d)).where("partition <> 'train'")
    s = split.select("partition", F.lit("Always legitimate").alias("experiment"), F.col(TARGET).alias("label"),
                     F.lit(0.0).alias("score"))
    return rounded(metrics.metric_rows(s), 8)


@query("fold_score_summary", sql(f"""SELECT experiment, {rnd("AVG(ap)", "mean_cv_ap", 8)}, {rnd("STDDEV_POP(ap)", "std_cv_ap", 8)} FROM
 (SELECT experiment, fold, SUM(pos * (tp::DOUBLE / (tp + fp))) / MAX(p)::DOUBLE AS ap FROM (SELECT *, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp,
 SUM(pos) OVER (PARTITION BY experiment, fold) AS p FROM (SELECT w.experiment, fold, {fold_score_sql()} AS score,
 CAST(SUM(tx.Class) AS BIGINT) AS pos, CAST(SUM(1 - tx.Class) AS BIGINT) AS neg FROM folds JOIN tx ON folds.row_id = tx.row_id CROSS JOIN weights w GROUP BY ALL)
 WINDOW w AS (PARTITION BY experiment, fold ORDER BY score DESC ROWS UNBOUNDED PRECEDING)) GROUP BY ALL) GROUP BY experiment""",
    "tx", "tot", "weights", extra=[("folds", FOLDED)]))
def fold_score_summary(spark, d):
    """Mean and population std over folds of each candidate's average precision."""
    folds = stratified_folds(transactions(spark, d), 3)
    s = long_scores(folds, keep=["fold"]).withColumn("partition", F.col("fold").cast("string"))
    ap = metrics.curve(s).groupBy(*metrics.GROUP).agg(metrics.average_precision_expr())
    return rounded(ap.groupBy("experiment").agg(
        F.avg("average_precision").alias("mean_cv_ap"), F.stddev_pop("average_precision").alias("std_cv_ap")), 8)


# --- comparison of experiments ------------------------------------------------------------

# Fit records of the fixed scorers: fixed seconds, train metrics measured on the train rows.
def _fits(rows):
    train = rows.where("partition = 'train'").select(
        "experiment", F.col("average_precision").alias("train_average_precision"), F.col("f1").alias("train_f1"))
    return compare.with_names(train).withColumn("fit_seconds", F.lit(1.0))


def _all_points(spark, d):
    """Curves of all partitions, written once: the comparison reads them several times."""
    return materialize(metrics.curve(scored(spark, d, ["train", "validation", "test"])), "curves")


_TRAIN = [
    ("tpts", """SELECT experiment, score, CAST(SUM(label) AS BIGINT) AS pos, CAST(SUM(1 - label) AS BIGINT) AS neg
 FROM scores WHERE "partition" = 'train' GROUP BY ALL"""),
    ("tcur", """SELECT *, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp, SUM(pos) OVER (PARTITION BY experiment) AS p FROM tpts
 WINDOW w AS (PARTITION BY experiment ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"""),
    ("fits", """SELECT a.experiment, tap, (2 * tp)::DOUBLE / (2 * tp + fp + fn) AS tf1 FROM
 (SELECT experiment, SUM(pos * (tp::DOUBLE / (tp + fp))) / MAX(p)::DOUBLE AS tap FROM tcur GROUP BY 1) a JOIN
 (SELECT experiment, COUNT(*) FILTER (score >= 0.5 AND label = 1) AS tp, COUNT(*) FILTER (score >= 0.5 AND label = 0) AS fp,
 COUNT(*) FILTER (score < 0.5 AND label = 1) AS fn FROM scores WHERE "partition" = 'train' GROUP BY 1) b ON a.experiment = b.experiment"""),
    ("mrow", _rows_sql()),
    ("named", """SELECT m.*, f.tap, f.tf1, w.algorithm, w.imbalance, w.stage FROM mrow m JOIN fits f ON m.experiment = f.experiment
 JOIN weights w ON m.experiment = w.experiment"""),
    ("best", """SELECT experiment FROM named WHERE "partition" = 'validation' ORDER BY average_precision DESC, f1 DESC, experiment LIMIT 1"""),
]
_METRICS8 = "accuracy, precision, recall, f1, roc_auc, average_precision, pr_auc, tn, fp, fn, tp, rows, fraud_rate"


def _named(spark, d):
    return compare.with_names(rounded(metrics.metric_rows(scored(spark, d)), 8))


@query("model_comparison", sql(
    f"""SELECT experiment, algorithm, imbalance, stage, "partition", 1.0::DOUBLE AS fit_seconds, {rnd("tap", "train_average_precision", 8)},
 {rnd("tf1", "train_f1", 8)}, 0.5::DOUBLE AS threshold, {_METRICS8} FROM named
 UNION ALL SELECT experiment, 'Dummy reference', 'None', 'reference', "partition", 0.0::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, 0.5::DOUBLE, {_METRICS8} FROM ({_DUMMY})
 UNION ALL SELECT experiment || ' | selected threshold', algorithm, imbalance, 'selected threshold', "partition", 1.0::DOUBLE,
 {rnd("tap", "a", 8)}, {rnd("tf1", "b", 8)}, {THRESHOLD}::DOUBLE, {rate_columns(8)}, roc_auc, average_precision, pr_auc, tn, fp, fn, tp, rows, fraud_rate
 FROM (SELECT n.* EXCLUDE (tn, fp, fn, tp, accuracy, precision, recall, f1), t.tn, t.fp, t.fn, t.tp FROM named n JOIN
 (SELECT experiment, "partition", COUNT(*) FILTER (score < {THRESHOLD} AND label = 0) AS tn, COUNT(*) FILTER (score >= {THRESHOLD} AND label = 0) AS fp,
 COUNT(*) FILTER (score < {THRESHOLD} AND label = 1) AS fn, COUNT(*) FILTER (score >= {THRESHOLD} AND label = 1) AS tp FROM scores GROUP BY ALL) t
 ON n.experiment = t.experiment AND n."partition" = t."partition" WHERE n.experiment IN (SELECT experiment FROM best))""",
    "conf", "areas", "weights", extra=_TRAIN))
def model_comparison(spark, d):
    every = _all_points(spark, d)
    rows = metrics.metric_rows_of_curve(every)
    named = compare.with_names(rounded(rows, 8))
    chosen = compare.select_experiment(named).first()["experiment"]
    tested = every.where("partition <> 'train'")
    return rounded(compare.comparison_table(tested, _fits(rows), chosen, THRESHOLD), 8)


@query("select_experiment", sql(f"SELECT experiment, average_precision, f1 FROM named WHERE experiment IN (SELECT experiment FROM best) AND \"partition\" = 'validation'",
                                "conf", "areas", "weights", extra=_TRAIN))
def select_experiment(spark, d):
    return compare.select_experiment(_named(spark, d)).select("experiment", "average_precision", "f1")


_PAIR = ", ".join(f"b.{m} AS {m}_before, t.{m} AS {m}_after" for m in compare.PAIRED_METRICS)


@query("before_after", sql(f"""SELECT b.algorithm, b.imbalance, {_PAIR} FROM named b JOIN named t ON b.algorithm = t.algorithm AND b.imbalance = t.imbalance
 WHERE b.stage = 'baseline' AND t.stage = 'tuned' AND b."partition" = 'validation' AND t."partition" = 'validation'""",
                           "conf", "areas", "weights", extra=_TRAIN))
def before_after(spark, d):
    return compare.before_after(_named(spark, d))


@query("resampling_effect", sql(
    f"""SELECT a.algorithm, a.stage, {rnd("b.average_precision - a.average_precision", "delta_ap")}, {rnd("b.precision - a.precision", "delta_precision")},
 {rnd("b.recall - a.recall", "delta_recall")}, b.fp - a.fp AS delta_false_alerts FROM named a JOIN named b ON a.algorithm = b.algorithm AND a.stage = b.stage
 WHERE a.imbalance = 'None' AND b.imbalance = 'SMOTE' AND a."partition" = 'validation' AND b."partition" = 'validation'""",
    "conf", "areas", "weights", extra=_TRAIN))
def resampling_effect(spark, d):
    return rounded(compare.resampling_effect(_named(spark, d)))


@query("tuning_effect", sql(
    f"""SELECT a.algorithm, a.imbalance, {rnd("b.average_precision - a.average_precision", "delta_ap")}, {rnd("b.f1 - a.f1", "delta_f1")}
 FROM named a JOIN named b ON a.algorithm = b.algorithm AND a.imbalance = b.imbalance
 WHERE a.stage = 'baseline' AND b.stage = 'tuned' AND a."partition" = 'validation' AND b."partition" = 'validation'""",
    "conf", "areas", "weights", extra=_TRAIN))
def tuning_effect(spark, d):
    return rounded(compare.tuning_effect(_named(spark, d)))


@query("generalisation_gap", sql(
    f"""SELECT experiment, "partition", {rnd("tap", "train_average_precision")}, {rnd("average_precision")}, {rnd("tap - average_precision", "ap_gap")} FROM named""",
    "conf", "areas", "weights", extra=_TRAIN))
def generalisation_gap(spark, d):
    rows = metrics.metric_rows_of_curve(_all_points(spark, d))
    train = _fits(rows).select("experiment", "train_average_precision")
    return rounded(compare.generalisation_gap(rows.where("partition <> 'train'").join(train, "experiment")))


@query("experiment_lookup", sql("""SELECT DISTINCT experiment, algorithm || ' | ' || imbalance || ' | ' || stage AS rebuilt FROM scores
 WHERE "partition" = 'test' AND stage IN ('baseline', 'tuned')""", "scores"))
def experiment_lookup(spark, d):
    s = scored(spark, d, ["test"]).where(F.col("stage").isin("baseline", "tuned"))
    return s.select("experiment", models.experiment_column().alias("rebuilt")).distinct()


# --- scoring ------------------------------------------------------------------------------

_SCORED = f"SELECT *, {fixed_score_sql(FLAGSHIP)} AS fraud_probability FROM tx"
_FINITE = " AND ".join(f"{c} IS NOT NULL" for c in COMPONENTS[:3])


def _score_rows(df):
    return score.with_decision(df, fixed_score(), THRESHOLD)


@query("scored_rows", sql(f"""SELECT row_id, Amount, fraud_probability, CASE WHEN fraud_probability >= {THRESHOLD} THEN 1 ELSE 0 END AS predicted_class,
 CASE WHEN fraud_probability >= {THRESHOLD} THEN 'Potential fraud' ELSE 'Legitimate' END AS prediction, {THRESHOLD}::DOUBLE AS decision_threshold
 FROM ({_SCORED}) WHERE {_FINITE}""", "tx"))
def scored_rows(spark, d):
    valid, _ = contract.quarantine(transactions(spark, d))
    return _score_rows(valid).select(
        ROW_ID, "Amount", score.SCORE, "predicted_class", "prediction", "decision_threshold")


@query("batch_summary", sql(f"""SELECT COUNT(*) AS transactions, COUNT(*) FILTER (fraud_probability >= {THRESHOLD}) AS flagged,
 {rnd(f"AVG(CASE WHEN fraud_probability >= {THRESHOLD} THEN 1 ELSE 0 END)", "flagged_share")}, MAX(fraud_probability) AS max_score FROM ({_SCORED})""", "tx"))
def batch_summary(spark, d):
    return rounded(score.batch_summary(_score_rows(transactions(spark, d))))


@query("alert_split", sql(f"""SELECT CASE WHEN fraud_probability >= {THRESHOLD} THEN 'alert' ELSE 'below' END AS side, COUNT(*) AS rows,
 CAST(SUM(Class) AS BIGINT) AS frauds FROM ({_SCORED}) GROUP BY 1""", "tx"))
def alert_split(spark, d):
    below, hit = score.alerts(_score_rows(transactions(spark, d)))
    both = below.withColumn("side", F.lit("below")).unionByName(hit.withColumn("side", F.lit("alert")))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(TARGET).cast("bigint")).alias("frauds"))


@query("score_hist", sql(f"""SELECT g.alert, CAST(g.bin AS INTEGER) AS bin, {rnd("g.bin * (upper / 16)", "bin_start")}, COALESCE(h.rows, 0) AS rows
 FROM (SELECT a.alert, b.bin FROM (VALUES (TRUE), (FALSE)) AS a(alert), range(16) AS b(bin)) g CROSS JOIN lim LEFT JOIN
 (SELECT fraud_probability >= {THRESHOLD} AS alert, LEAST(CAST(FLOOR(fraud_probability / (upper / 16)) AS BIGINT), 15) AS bin, COUNT(*) AS rows
 FROM s CROSS JOIN lim GROUP BY ALL) h ON h.alert = g.alert AND h.bin = g.bin""", "tx", extra=[
    ("s", _SCORED), ("lim", f"SELECT LEAST(1.0::DOUBLE, GREATEST(0.08::DOUBLE, MAX(fraud_probability) * 1.12::DOUBLE, {THRESHOLD}::DOUBLE * 1.12::DOUBLE)) AS upper FROM s")]))
def score_hist(spark, d):
    return rounded(score.score_histogram(_score_rows(transactions(spark, d)), THRESHOLD))


@query("score_quality", sql("SELECT COUNT(*) FILTER (row_id % 11 IN (0, 1, 2)) AS invalid_scores FROM tx", "tx"))
def score_quality(spark, d):
    """Every eleventh row each with a NULL, NaN and infinite score."""
    r = F.col(ROW_ID) % 11
    spoilt = F.when(r == 1, F.lit(float("nan"))).when(r == 2, F.lit(float("inf"))).when(r > 2, F.col(score.SCORE))
    return score.invalid_scores(_score_rows(transactions(spark, d)).withColumn(score.SCORE, spoilt))


# --- streams ------------------------------------------------------------------------------

def _event_stream(spark, d):
    """The transactions view over a stream of event files; vectors are a static side."""
    n, start = fixture.fixture_scalars(spark, d)
    events = alerts.stream_parquet(spark, f"{d}/events.parquet")
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))  # event time needs an instant
    return fixture.join_transactions(events, fixture.table(spark, d, "embeddings"), n, start)


def _run(stream, spark, name):
    out, check = shared_dir(spark, name), shared_dir(spark, f"{name}-checkpoint")
    alerts.write_available(stream, out, check).awaitTermination()
    return spark.read.parquet(out)


def _routed(spark, d, name):
    """One table of a pass that writes scored and rejected rows side by side."""
    out, check = shared_dir(spark, "stream-routed"), shared_dir(spark, "stream-routed-checkpoint")
    alerts.write_routed(_event_stream(spark, d), alerts.scored_and_rejected(_score_rows), out, check).awaitTermination()
    return alerts.read_routed(spark, out, name)


@query("stream_scored", sql(f"""SELECT row_id, fraud_probability, CASE WHEN fraud_probability >= {THRESHOLD} THEN 1 ELSE 0 END AS predicted_class
 FROM ({_SCORED}) WHERE {_FINITE}""", "tx"))
def stream_scored(spark, d):
    return _routed(spark, d, "scored").select(ROW_ID, score.SCORE, "predicted_class")


@query("stream_rejected", sql(f"SELECT row_id FROM tx WHERE NOT ({_FINITE})", "tx"))
def stream_rejected(spark, d):
    return _routed(spark, d, "rejected").select(ROW_ID)


@query("stream_dedup", sql("SELECT row_id, Amount FROM tx", "tx"))
def stream_dedup(spark, d):
    stream = _event_stream(spark, d)
    copies = F.when(F.col(ROW_ID) % fixture.COPY_PERIOD == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    doubled = stream.withColumn("_copy", F.explode(copies)).drop("_copy")
    return _run(alerts.unique_rows(doubled, [ROW_ID, *FEATURES, TARGET], "1 hour").select(ROW_ID, "Amount"), spark, "stream-dedup")


@query("stream_window_summary", sql(f"""SELECT date_trunc('day', ts) AS window_start, COUNT(*) AS transactions,
 COUNT(*) FILTER (fraud_probability >= {THRESHOLD}) AS flagged,
 {rnd(f"AVG(CASE WHEN fraud_probability >= {THRESHOLD} THEN 1 ELSE 0 END)", "flagged_share")}, MAX(fraud_probability) AS max_score
 FROM (SELECT *, {fixed_score_sql(FLAGSHIP)} AS fraud_probability FROM txts) GROUP BY 1
 HAVING date_trunc('day', MIN(ts)) + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR""", "txts"))
def stream_window_summary(spark, d):
    out = _run(alerts.window_summary(_score_rows(_event_stream(spark, d))), spark, "stream-windows")
    return rounded(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


