"""Registered queries: profiles, distributions, learned preprocessing, resampling."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from rareclass.config import COMPONENTS, FEATURES, ROBUST_COLUMNS, ROW_ID, TARGET
from rareclass.operators import features, profile, resample, score
from rareclass.operators.split import stratified_split
from rareclass.plans.catalog import query, rounded
from rareclass.plans.fixture import transactions
from rareclass.plans.oracle import RANKED, hash_int_sql, hash_sql, hash_unit_sql, rnd, sql, union
from rareclass.session import materialize

COLUMNS = [*FEATURES, TARGET]


def split_table(spark, d):
    """The split, written once as the pipeline does, for queries that read it several times."""
    return materialize(stratified_split(transactions(spark, d)), "split")


def training_table(spark, d):
    return split_table(spark, d).where("partition = 'train'").drop("partition")


def training(spark, d):
    """Training rows for queries of one or two passes; nothing is written."""
    return stratified_split(transactions(spark, d)).where("partition = 'train'").drop("partition")


# --- class profiles and correlations ------------------------------------------------------

@query("class_feature_profile", sql(union(
    f"""SELECT Class, '{c}' AS feature, {rnd(f"AVG({c})", "mean", 5)}, {rnd(f"MEDIAN({c})", "median", 5)},
 {rnd(f"STDDEV_SAMP({c})", "std", 5)} FROM train GROUP BY Class""" for c in FEATURES), "train"))
def class_feature_profile(spark, d):
    return rounded(profile.class_profile(training_table(spark, d)), 5)


@query("class_amount_median", sql(f"SELECT Class, {rnd('MEDIAN(Amount)', 'median')} FROM train GROUP BY Class", "train"))
def class_amount_median(spark, d):
    return rounded(profile.class_median(training(spark, d), "Amount"))


@query("corr_matrix", sql(union(
    [f"SELECT '{a}' AS a, '{b}' AS b, {rnd(f'CORR({a}, {b})', 'r')} FROM train" for a, b in combinations(COLUMNS, 2)]
    + [f"SELECT '{b}', '{a}', {rnd(f'CORR({a}, {b})', 'r')} FROM train" for a, b in combinations(COLUMNS, 2)]
    + [f"SELECT '{c}', '{c}', 1.0" for c in COLUMNS]), "train"))
def corr_matrix(spark, d):
    return rounded(profile.correlation_matrix(training(spark, d), COLUMNS))


_TARGET_CORR = union(f"SELECT '{c}' AS feature, CORR({c}, Class) AS r FROM train" for c in FEATURES)


@query("target_corr_topk", sql(
    f"SELECT feature, {rnd('r')}, {rnd('ABS(r)', 'abs_r')} FROM ({_TARGET_CORR}) ORDER BY ABS(r) DESC, feature LIMIT 4", "train"))
def target_corr_topk(spark, d):
    return rounded(profile.top_correlated(training(spark, d)))


# --- distributions ------------------------------------------------------------------------

def _hist_sql(value: str, bins: int) -> str:
    return sql(f"""SELECT g.Class, CAST(g.bin AS INTEGER) AS bin, {rnd(f"lo + g.bin * ((hi - lo) / {bins})", "bin_start")},
 COALESCE(h.rows, 0) AS rows, {rnd(f"COALESCE(h.rows, 0) / (t.total * ((hi - lo) / {bins}))", "density")}
 FROM (SELECT c.Class, b.bin FROM (SELECT DISTINCT Class FROM x) c, range({bins}) AS b(bin)) g CROSS JOIN lim
 JOIN (SELECT Class, COUNT(*) AS total FROM x GROUP BY Class) t ON t.Class = g.Class
 LEFT JOIN (SELECT Class, LEAST(CAST(FLOOR((v - lo) / ((hi - lo) / {bins})) AS BIGINT), {bins - 1}) AS bin, COUNT(*) AS rows
 FROM x CROSS JOIN lim GROUP BY ALL) h ON h.Class = g.Class AND h.bin = g.bin""", "train",
               extra=[("x", f"SELECT Class, {value} AS v FROM train"), ("lim", "SELECT MIN(v) AS lo, MAX(v) AS hi FROM x")])


@query("hist_log_amount", _hist_sql("LN(1 + Amount)", 45))
def hist_log_amount(spark, d):
    return rounded(profile.class_histogram(training(spark, d), profile.log_amount(), 45))


@query("hist_hours", _hist_sql("Time / 3600", 48))
def hist_hours(spark, d):
    return rounded(profile.class_histogram(training(spark, d), profile.hours(), 48))


_TOP2 = f"""SELECT feature FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY ABS(r) DESC, feature) AS k FROM ({_TARGET_CORR}))
 WHERE k <= 4 AND feature LIKE 'V%' ORDER BY k LIMIT 2"""


@query("box_stats", sql(f"""SELECT q.Class, q.feature, {rnd("q1")}, {rnd("med", "median")}, {rnd("q3")},
 {rnd("LEAST(MIN(v) FILTER (v >= q1 - 1.5 * (q3 - q1)), q1)", "whisker_low")},
 {rnd("GREATEST(MAX(v) FILTER (v <= q3 + 1.5 * (q3 - q1)), q3)", "whisker_high")}
 FROM long JOIN (SELECT Class, feature, QUANTILE_CONT(v, 0.25) AS q1, QUANTILE_CONT(v, 0.5) AS med,
 QUANTILE_CONT(v, 0.75) AS q3 FROM long GROUP BY ALL) q ON q.Class = long.Class AND q.feature = long.feature
 WHERE q.feature IN (SELECT feature FROM top2) GROUP BY q.Class, q.feature, q1, med, q3""", "train", extra=[
    ("long", union(f"SELECT Class, '{c}' AS feature, {c} AS v FROM train" for c in COMPONENTS)), ("top2", _TOP2)]))
def box_stats(spark, d):
    train = training_table(spark, d)
    return rounded(profile.box_stats(train, profile.top_components(train)))


@query("scatter_sample", sql(
    f"""SELECT row_id, {rnd("Time / 3600", "hours")}, {rnd("Amount", "Amount")}, Class FROM
 (SELECT *, {RANKED} AS r FROM train) WHERE Class = 1 OR r <= 3000""", "train"))
def scatter_sample(spark, d):
    return rounded(profile.scatter_sample(training(spark, d)))


@query("derived_columns", sql(
    f"SELECT row_id, {rnd('LN(1 + Amount)', 'log_amount')}, {rnd('Time / 3600', 'hours')} FROM tx", "tx"))
def derived_columns(spark, d):
    return rounded(transactions(spark, d).select(
        ROW_ID, profile.log_amount().alias("log_amount"), profile.hours().alias("hours")))


@query("wide_to_long", sql(union(f"SELECT row_id, '{c}' AS feature, {c} AS value FROM train" for c in ["Time", "V1", "Amount"]), "train"))
def wide_to_long(spark, d):
    return training(spark, d).unpivot([ROW_ID], ["Time", "V1", "Amount"], "feature", "value")


# --- learned preprocessing ----------------------------------------------------------------

_IMPUTED = "SELECT row_id, Class, \"partition\", " + ", ".join(
    f"COALESCE({c}, (SELECT COALESCE(MEDIAN({c}), 0) FROM train)) AS {c}" for c in FEATURES) + " FROM split"
_SCALE = {c: (f"(SELECT MEDIAN({c}) FROM itrain)", f"(SELECT QUANTILE_CONT({c}, 0.75) - QUANTILE_CONT({c}, 0.25) FROM itrain)")
          if c in ROBUST_COLUMNS else (f"(SELECT AVG({c}) FROM itrain)", f"(SELECT STDDEV_POP({c}) FROM itrain)")
          for c in FEATURES}
_PREP = [("imputed", _IMPUTED), ("itrain", "SELECT * FROM imputed WHERE \"partition\" = 'train'")]


@query("impute_median", sql("SELECT row_id, " + ", ".join(rnd(c) for c in ["V1", "V2", "V3"]) + " FROM imputed",
                            "split", "train", extra=_PREP[:1]))
def impute_median(spark, d):
    split = split_table(spark, d)
    model = features.MedianImputer().fit(split.where("partition = 'train'"))
    return rounded(model.transform(split).select(ROW_ID, "V1", "V2", "V3"))


@query("imputer_statistics", sql(union(
    f"SELECT '{c}' AS feature, {rnd(f'COALESCE(MEDIAN({c}), 0)', 'median', 5)} FROM train" for c in FEATURES), "train"))
def imputer_statistics(spark, d):
    m = features.MedianImputer().fit(training_table(spark, d))
    return rounded(spark.createDataFrame(list(zip(m.columns(), m.getOrDefault("medians"))), "feature string, median double"), 5)


@query("scaler_statistics", sql(union(
    f"SELECT '{c}' AS feature, {rnd(_SCALE[c][0], 'center', 5)}, {rnd(_SCALE[c][1], 'scale', 5)}" for c in FEATURES),
    "split", "train", extra=_PREP))
def scaler_statistics(spark, d):
    train = training_table(spark, d)
    m = features.MixedScaler().fit(features.MedianImputer().fit(train).transform(train))
    rows = list(zip(m.columns(), m.getOrDefault("center"), m.getOrDefault("scale")))
    return rounded(spark.createDataFrame(rows, "feature string, center double, scale double"), 5)


@query("scaled_features", sql("SELECT row_id, " + ", ".join(
    rnd(f"({c} - {_SCALE[c][0]}) / {_SCALE[c][1]}", c, 5) for c in FEATURES) + " FROM imputed",
    "split", "train", extra=_PREP))
def scaled_features(spark, d):
    split = split_table(spark, d)
    train = split.where("partition = 'train'")
    imputer = features.MedianImputer().fit(train)
    scaler = features.MixedScaler().fit(imputer.transform(train))
    return rounded(scaler.transform(imputer.transform(split)).select(ROW_ID, *FEATURES), 5)


BINS = 32


def _binned_sql() -> str:
    cells = []
    for c in FEATURES:
        cuts = ", ".join(str(i / BINS) for i in range(1, BINS))
        cells.append(f"""SELECT '{c}' AS feature, len(list_filter(list_distinct(q.e), lambda t: t <= train.{c})) AS bin, Class
 FROM train CROSS JOIN (SELECT QUANTILE_CONT({c}, [{cuts}]) AS e FROM train) q WHERE train.{c} IS NOT NULL""")
    return sql("""SELECT feature, ROUND(GREATEST(SUM(n / al * LN(n * al / (nb * nl))), 0), 6) + 0.0::DOUBLE AS mutual_information FROM (
 SELECT feature, n::DOUBLE AS n, SUM(n) OVER (PARTITION BY feature)::DOUBLE AS al, SUM(n) OVER (PARTITION BY feature, bin)::DOUBLE AS nb,
 SUM(n) OVER (PARTITION BY feature, Class)::DOUBLE AS nl FROM (SELECT feature, bin, Class, COUNT(*) AS n FROM long GROUP BY ALL))
 GROUP BY feature""", "train", extra=[("long", union(cells))])


_BINNED = _binned_sql()


@query("mi_binned", _BINNED)
def mi_binned(spark, d):
    return rounded(features.mutual_information_binned(training_table(spark, d), FEATURES, bins=BINS))


@query("mi_ranking", f"""SELECT feature, mutual_information, ROW_NUMBER() OVER (ORDER BY mutual_information DESC,
 list_position([{', '.join(f"'{c}'" for c in FEATURES)}], feature) DESC) <= 20 AS selected FROM ({_BINNED})""")
def mi_ranking(spark, d):
    scores = rounded(features.mutual_information_binned(training_table(spark, d), FEATURES, bins=BINS))
    return features.rank_features(scores, FEATURES, 20)


SELECTED = 5


@query("select_topk", sql(f"""SELECT l.row_id, l.feature, l.value FROM ({union(
    f"SELECT row_id, '{c}' AS feature, {c} AS value FROM train" for c in FEATURES)}) l JOIN (SELECT feature FROM ({_BINNED})
 ORDER BY mutual_information DESC, list_position([{', '.join(f"'{c}'" for c in FEATURES)}], feature) DESC LIMIT {SELECTED}) k
 ON l.feature = k.feature""", "train"))
def select_topk(spark, d):
    """Selection applied as a projection, then reshaped so that the chosen names are values."""
    train = training_table(spark, d)
    scores = rounded(features.mutual_information_binned(train, FEATURES, bins=BINS))
    kept = {r["feature"] for r in features.rank_features(scores, FEATURES, SELECTED).where("selected").collect()}
    names = [c for c in FEATURES if c in kept]
    return train.select(ROW_ID, *names).unpivot([ROW_ID], names, "feature", "value")


_SERIES = ("LN(n) - 1 / (2 * n) - 1 / (12 * n * n) + 1 / (120 * n * n * n * n) - 1 / (252 * n * n * n * n * n * n)"
           " + 0.5772156649015329")


def _psi(col: str) -> str:
    small = "[" + ", ".join(repr(sum(1.0 / i for i in range(1, j))) for j in range(1, 21)) + "]"
    series = _SERIES.replace("LN(n)", f"LN({col}::DOUBLE)").replace(" n", f" {col}::DOUBLE")
    return f"(CASE WHEN {col} <= 20 THEN {small}[CAST({col} AS INTEGER)]::DOUBLE ELSE {series} END)"


def _ksg_sql() -> str:
    long = union(
        f"""SELECT '{c}' AS feature, row_id, Class, CAST(ROUND((({c} - {_SCALE[c][0]}) / {_SCALE[c][1]}) / 1e-6::DOUBLE) AS BIGINT) * {2**20}
 + {hash_int_sql(5, hash_sql(f"'{c}'", "row_id"))} AS x FROM itrain""" for c in FEATURES)
    near = ", ".join([f"LEAD(x, {i}) OVER w - x" for i in (1, 2, 3)] + [f"x - LAG(x, {i}) OVER w" for i in (1, 2, 3)])
    return sql(
        f"""SELECT feature, {rnd(f"GREATEST(AVG({_psi('n')} + {_psi('kk')} - {_psi('nl')} - {_psi('m')}), 0)", "mutual_information")}
 FROM counted GROUP BY feature""", "split", "train", extra=[
            *_PREP, ("long", long),
            ("d", f"""SELECT *, list_sort(list_filter([{near}], lambda t: t IS NOT NULL)) AS ds, COUNT(*) OVER (PARTITION BY feature, Class) AS nl
 FROM long WINDOW w AS (PARTITION BY feature, Class ORDER BY x)"""),
            ("rad", "SELECT *, LEAST(3, nl - 1) AS kk, GREATEST(ds[CAST(LEAST(3, nl - 1) AS INTEGER)], 1) - 1 AS r FROM d WHERE nl > 1"),
            ("counted", """SELECT feature, nl, kk, COUNT(*) OVER (PARTITION BY feature) AS n, COUNT(*) OVER (PARTITION BY feature ORDER BY x
 RANGE BETWEEN r PRECEDING AND r FOLLOWING) AS m FROM rad""")])


@query("mi_ksg", _ksg_sql())
def mi_ksg(spark, d):
    """All imputed and scaled features of all training rows."""
    train = training_table(spark, d)
    imputed = features.MedianImputer().fit(train).transform(train)
    return rounded(features.mutual_information_ksg(features.MixedScaler().fit(imputed).transform(imputed), FEATURES))


# --- resampling ---------------------------------------------------------------------------

@query("smote_counts", sql("""SELECT majority, minority, CAST(FLOOR(majority * 0.1::DOUBLE) AS BIGINT) - minority AS synthetic,
 CAST(FLOOR(majority * 0.1::DOUBLE) AS BIGINT) AS minority_after FROM (SELECT COUNT(*) FILTER (Class = 0) AS majority,
 COUNT(*) FILTER (Class = 1) AS minority FROM tx)""", "tx"))
def smote_counts(spark, d):
    return resample.smote_counts(transactions(spark, d))


def _smote_sql() -> str:
    vec = "[" + ", ".join(f"({c} - {_SCALE[c][0]}) / {_SCALE[c][1]}" for c in FEATURES) + "]"
    d2 = " + ".join(f"(a.x[{i}] - b.x[{i}]) * (a.x[{i}] - b.x[{i}])" for i in range(1, len(FEATURES) + 1))
    draw = hash_sql("pid", "draw")
    moved = ", ".join(rnd(f"x[{i}] + u * (near[neighbor + 1][{i}] - x[{i}])", c, 5) for i, c in enumerate(FEATURES, 1))
    return sql(
        f"""SELECT pid, draw, neighbor, {rnd("u", "u", 8)}, {moved} FROM drawn""",
        "split", "train", extra=[
            *_PREP, ("fit", f"SELECT row_id, Class, {vec} AS x FROM itrain"),
            ("need", """SELECT p, CAST(FLOOR((n - p) * 0.1::DOUBLE) AS BIGINT) - p AS new FROM (SELECT COUNT(*) AS n, CAST(SUM(Class) AS BIGINT) AS p FROM fit)"""),
            ("mino", f"""SELECT row_id, x, new // p + CASE WHEN r <= new % p THEN 1 ELSE 0 END AS c
 FROM (SELECT *, {RANKED} AS r FROM fit) CROSS JOIN need WHERE Class = 1"""),
            ("points", "SELECT x, COUNT(*) AS m, MIN(row_id) AS pid, CAST(SUM(c) AS BIGINT) AS draws FROM mino GROUP BY x"),
            ("pairs", f"SELECT a.pid, b.x, LEAST(b.m, 5) AS m, {d2} AS d2, b.pid AS nid FROM points a JOIN points b ON a.pid <> b.pid"),
            ("top", """SELECT pid, flatten(list(list_resize([x], m, x) ORDER BY d2, nid)) AS near FROM (SELECT *, ROW_NUMBER() OVER
 (PARTITION BY pid ORDER BY d2, nid) AS k FROM pairs) WHERE k <= 5 GROUP BY pid"""),
            ("joined", """SELECT p.pid, p.x, draws, (list_resize(CAST([] AS DOUBLE[][]), LEAST(m - 1, 5), p.x) || near)[1:5] AS near
 FROM points p JOIN top t ON p.pid = t.pid"""),
            ("hashed", f"SELECT *, {draw} AS h FROM (SELECT *, UNNEST(range(1, draws + 1)) AS draw FROM joined)"),
            ("drawn", f"""SELECT *, CAST({hash_int_sql(8, "substr(h, 17, 8)")} % 5 AS INTEGER) AS neighbor, {hash_unit_sql("h")} AS u FROM hashed"""),
        ])


@query("smote_rows", _smote_sql())
def smote_rows(spark, d):
    """Synthetic rows of the training rows, in the space of all imputed and scaled features."""
    train = training_table(spark, d)
    imputed = features.MedianImputer().fit(train).transform(train)
    scaled = features.MixedScaler().fit(imputed).transform(imputed)
    new = resample.smote(scaled.select(ROW_ID, TARGET, F.array(*FEATURES).alias("x")))
    return new.select("pid", "draw", "neighbor", F.round("u", 8).alias("u"),
                      *[F.round(F.col("x")[i], 5).alias(c) for i, c in enumerate(FEATURES)])


# --- context of a row ---------------------------------------------------------------------

_LONG = union(f"SELECT row_id, {i} AS i, '{c}' AS component, {c} AS value FROM tx WHERE {c} IS NOT NULL"
              for i, c in enumerate(COMPONENTS))


@query("top_components", sql(f"""SELECT row_id, CAST(ROW_NUMBER() OVER (PARTITION BY row_id ORDER BY value, i) AS INTEGER) AS position, component, value
 FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY row_id ORDER BY ABS(value) DESC, i) AS k FROM ({_LONG})) WHERE k <= 12""", "tx"))
def top_components(spark, d):
    return score.top_components(transactions(spark, d))
