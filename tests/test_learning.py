import numpy as np
import pytest
from fixtures import training_frame, transactions_frame, with_ids
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rareclass.config import FEATURES, TrainingConfig
from rareclass.errors import DatasetError
from rareclass.operators import features, logistic, models, profile, resample
from rareclass.operators.neighbors import leaf_visits, nearest_neighbors, squared_distances


def test_preprocessing_learns_from_training_rows_only(spark):
    frame = transactions_frame(300, 60, seed=7)
    frame.loc[4, "V2"] = np.nan
    df = with_ids(spark, frame)
    config = TrainingConfig(selection_max_rows=200)
    model = Pipeline(stages=features.preprocessing_stages(config)).fit(df)
    imputer, scaler, selector = model.stages
    assert imputer.getOrDefault("medians") == pytest.approx(frame[FEATURES].median().tolist())
    at = dict(zip(scaler.columns(), zip(scaler.getOrDefault("center"), scaler.getOrDefault("scale"))))
    iqr = frame["Amount"].quantile(.75) - frame["Amount"].quantile(.25)
    assert at["Amount"] == pytest.approx((frame["Amount"].median(), iqr))
    filled = frame["V2"].fillna(frame["V2"].median())
    assert at["V2"] == pytest.approx((filled.mean(), filled.std(ddof=0)))
    assert (selector.getOrDefault("rankingRows"), selector.getOrDefault("rankingFrauds")) == (200, 40)
    before = dict(at)
    held_out = df.limit(3).withColumn("Time", F.lit(1e9))
    rows = model.transform(held_out).select(vector_to_array("features").alias("x")).collect()
    assert len(rows) == 3 and all(len(r["x"]) == 20 and np.isfinite(r["x"]).all() for r in rows)
    assert before == dict(zip(scaler.columns(), zip(scaler.getOrDefault("center"), scaler.getOrDefault("scale"))))
    assert selector.selected_features() == [c for c in FEATURES if c in set(selector.selected_features())]


def test_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(i, None, 5.0, float(i)) for i in range(9)], "row_id long, a double, b double, c double")
    imp = features.MedianImputer(inputCols=["a", "b", "c"]).fit(df)
    assert imp.getOrDefault("medians") == [0.0, 5.0, 4.0]
    sc = features.MixedScaler(inputCols=["a", "b", "c"], robustCols=["b"]).fit(imp.transform(df))
    assert sc.getOrDefault("scale")[:2] == [1.0, 1.0]
    assert [r["b"] for r in sc.transform(imp.transform(df)).collect()] == [0.0] * 9


def test_mutual_information_finds_the_informative_feature(spark):
    df = with_ids(spark, training_frame())
    for scores in (features.mutual_information_ksg(df, FEATURES), features.mutual_information_binned(df, FEATURES, bins=8)):
        got = {r["feature"]: r["mutual_information"] for r in scores.collect()}
        assert set(got) == set(FEATURES) and min(got.values()) >= 0
        assert max(got, key=got.get) == "V14"


def test_ksg_against_brute_force(spark):
    from math import log

    rng = np.random.default_rng(0)
    y = np.array([0] * 150 + [1] * 50)
    x = rng.normal(size=200) + 2 * y
    df = spark.createDataFrame([(i, int(y[i]), float(x[i])) for i in range(200)], "row_id long, Class int, x double")
    got = features.mutual_information_ksg(df, ["x"]).first()["mutual_information"]
    psi = lambda n: sum(1 / i for i in range(1, n)) - 0.5772156649015329
    total = 0.0
    for i in range(200):
        same = np.sort(np.abs(x[y == y[i]] - x[i]))[3]
        total += psi(200) + psi(3) - psi((y == y[i]).sum()) - psi((np.abs(x - x[i]) < same).sum())
    assert got == pytest.approx(total / 200, abs=1e-3) and got < log(2)
    # Buckets of any size and a grid for large values give the same estimate.
    for rows in (7, 50):
        again = features.mutual_information_ksg(df, ["x"], bucket_rows=rows).first()["mutual_information"]
        assert again == pytest.approx(got, abs=1e-12)
    large = features.mutual_information_ksg(df.withColumn("x", F.col("x") * 1e12), ["x"]).first()["mutual_information"]
    assert large == pytest.approx(got, abs=1e-3)


def test_ksg_settles_a_bucket_in_one_sort():
    """All points of a bucket but a few at its ends are counted without rows of other buckets."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    x, label = np.sort(rng.choice(100_000, 3000, replace=False)), rng.integers(0, 2, 3000)
    cuts, own = [np.array([30_000, 70_000])], (x >= 30_000) & (x < 70_000)
    sizes = {(0, c): int((label == c).sum()) for c in (0, 1)}
    table = pa.table({"f": np.zeros(own.sum(), dtype=np.int32), "b": np.ones(own.sum(), dtype=np.int32), "x": x[own], "label": label[own],
                      "again": pa.nulls(int(own.sum()), pa.struct([("key", pa.int64())]))})
    found = features._count_bucket(table, cuts, sizes, 3).to_pandas()
    ends, want = found[found["kind"] == 2], {}
    assert len(ends) <= 4 * 3 * 2 and (ends["m"] == 0).sum() <= 2 * 3 * 2
    unsettled = set(ends[ends["m"] == 0]["x"])
    for at, c in zip(x[own], label[own]):
        if at not in unsettled:
            r = np.sort(np.abs(x[label == c] - at))[3]
            m = int((np.abs(x - at) < r).sum())
            want[(c, m)] = want.get((c, m), 0) + 1
    counts = found[found["kind"] == 0]
    assert {(c, m): w for c, m, w in zip(counts["label"], counts["m"], counts["w"])} == want


def test_ksg_with_shared_keys_and_missing_labels(spark):
    """Rows that share a key count as one, with the counts of all; rows without a label are left out."""
    rows = [(i, i % 2, float(i * i % 101) + (i % 2) * 40) for i in range(200)]
    got = []
    for extra in ([], [(300 + i, None, float(i)) for i in range(50)], [(i, i % 2, rows[i][2]) for i in range(60)]):
        df = spark.createDataFrame(rows + extra, "row_id long, Class int, x double")
        each = {features.mutual_information_ksg(df, ["x"], bucket_rows=n).first()["mutual_information"] for n in (9, 60, 10_000)}
        assert max(each) - min(each) < 1e-12
        got.append(max(each))
    assert got[0] == pytest.approx(got[1], abs=1e-12) and got[0] > 0 and got[2] != got[0]


def test_nearest_in_block_compares_by_one_product(monkeypatch):
    """No distance is summed coordinate by coordinate but those of candidates; results stay exact."""
    import pandas as pd

    from rareclass.operators import neighbors

    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 6)) + 1e4  # far from zero, where the product rounds most
    x[5], x[400:430] = 1e9, np.round(x[400:430] - 1e4) + 1e4  # an outlier and ties
    want = squared_distances(x, x)
    np.fill_diagonal(want, np.inf)
    monkeypatch.setattr(neighbors, "squared_distances", lambda a, b: pytest.fail("all pairs, coordinate by coordinate"))
    block = pd.DataFrame({"pid": np.arange(900), "x": list(x)})
    got = neighbors.nearest_in_block(block, block, 5)
    near = np.argsort(want, axis=1, kind="stable")[:, :5]
    assert got["nid"].to_numpy().reshape(900, 5).tolist() == near.tolist()
    assert got["d2"].to_numpy().reshape(900, 5).tolist() == np.take_along_axis(want, near, axis=1).tolist()
    huge = pd.DataFrame({"pid": [1, 2, 3], "x": [np.array([1e200]), np.array([0.0]), np.array([1.0])]})
    assert neighbors.nearest_in_block(huge, huge, 1)[["pid", "nid"]].to_numpy().tolist() == [[2, 3], [3, 2]]


@pytest.mark.parametrize("block, fan", [(5000, 8), (60, 16), (20, 3)])
def test_neighbors_are_exact(spark, block, fan):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4))
    x[:100] = x[:100] * 0.01 + 4  # a dense third
    df = spark.createDataFrame([(i, x[i].tolist(), 1) for i in range(300)], "pid long, x array<double>, m long")
    got = {r["pid"]: [n["nid"] for n in r["nn"]] for r in nearest_neighbors(df, 5, block, fan).collect()}
    d = squared_distances(x, x)
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1, kind="stable")[:, :5]
    assert got == {i: want[i].tolist() for i in range(300)}


def test_visits_do_not_grow_with_the_table(spark):
    """Clusters in ten dimensions, four times as many of them: a point still visits as few leaves."""
    rng, mean = np.random.default_rng(2), []
    for n in (2000, 8000):
        centres = rng.uniform(-50, 50, size=(n // 100, 10))
        x = centres[rng.integers(len(centres), size=n)] + rng.normal(size=(n, 10)) * .1
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "pid long, x array<double>")
        visits = leaf_visits(df, 5, block=128, fan=8).toPandas()["visits"]
        assert len(visits) == n
        mean.append(visits.mean())
    assert mean[1] < 1.3 * mean[0] and mean[1] < 6


def test_neighbors_with_few_points_and_text_ids(spark):
    rows = [(f"p{i}", [float(i), 0.0], 2) for i in range(4)]
    df = spark.createDataFrame(rows, "pid string, x array<double>, m int")
    got = {r["pid"]: [(n["nid"], n["nm"]) for n in r["nn"]] for r in nearest_neighbors(df, 9, block=2, fan=2).collect()}
    assert got["p0"] == [("p1", 2), ("p2", 2), ("p3", 2)] and len(got) == 4
    assert nearest_neighbors(df.where("false"), 5).count() == 0


def _vectors(spark, frame):
    return with_ids(spark, frame).select("row_id", "Class", F.array("V1", "V2", "V14").alias("x"))


def test_smote_counts_and_hull(spark):
    frame = training_frame()
    new = resample.smote(_vectors(spark, frame), ratio=0.5).collect()
    assert len(new) == 175
    x = frame.loc[frame["Class"] == 1, ["V1", "V2", "V14"]].to_numpy()
    for r in new[:40]:
        v, u = np.array(r["x"]), r["u"]
        base = x[r["pid"] - 450]
        near = x[np.argsort(((x - base) ** 2).sum(axis=1), kind="stable")[1:6]]
        assert np.min(np.abs(base + u * (near - base) - v).sum(axis=1)) < 1e-9
    per_row = np.bincount([r["pid"] - 450 for r in new], minlength=50)
    assert set(per_row) == {3, 4}
    again = resample.smote(_vectors(spark, frame).repartition(5), ratio=0.5).collect()
    assert sorted(map(tuple, ((r["pid"], r["draw"], *r["x"]) for r in new))) == sorted(
        map(tuple, ((r["pid"], r["draw"], *r["x"]) for r in again)))


def test_smote_with_one_vector_shared_by_many_rows(spark):
    rows = [(i, 0, [float(i)]) for i in range(900)] + [(1000 + i, 1, [0.0] if i < 30 else [float(i)]) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, Class int, x array<double>")
    new = resample.smote(df, ratio=0.2, k=5).collect()
    assert len(new) == 140
    hot = [r for r in new if r["pid"] == 1000]
    assert len(hot) >= 30 * 3 and all(r["x"] == [0.0] for r in hot)


def test_smote_errors(spark):
    df = _vectors(spark, training_frame())
    with pytest.raises(DatasetError):
        resample.smote(df, ratio=0.01)
    with pytest.raises(DatasetError):
        resample.smote(df, ratio=0.5, k=50)


def test_resampling_happens_in_fit_only(spark, monkeypatch):
    df = with_ids(spark, training_frame())
    config = TrainingConfig(selection_max_rows=200, smote_ratio=0.5)
    stages = [*features.preprocessing_stages(config), models.ResampledClassifier("Logistic Regression", True, config)]
    model = Pipeline(stages=stages).fit(df)
    monkeypatch.setattr(models, "smote", lambda *a, **k: pytest.fail("scoring must not resample"))
    rows = models.positive_score(df.limit(7), model, ["row_id"]).collect()
    assert len(rows) == 7 and all(0 <= r["score"] <= 1 for r in rows)
    one = [models.positive_score(df.where(F.col("row_id") == r["row_id"]), model, ["row_id"]).first()["score"] for r in rows[:3]]
    assert one == pytest.approx([r["score"] for r in rows[:3]], abs=1e-12)
    ap = models.AveragePrecisionEvaluator().evaluate(model.transform(df))
    assert 0.5 < ap <= 1


def test_logistic_penalty_matches_a_direct_solution(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 2))
    y = (rng.random(400) < 1 / (1 + np.exp(-(x[:, 0] * 2 - 1)))).astype(float)
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x.tolist(), y)], ["features", "Class"])
    m = models.fit_classifier(df, "Logistic Regression", {"C": 1.0, "tol": 1e-9}, 42)
    w = np.zeros(3)
    z = np.c_[x, np.ones(400)]
    for _ in range(50):  # Newton steps on the penalised sum of losses
        p = 1 / (1 + np.exp(-z @ w))
        g = z.T @ (p - y) + np.r_[w[:2], 0]
        w -= np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + np.diag([1, 1, 0]), g)
    assert [*m.coefficients, m.intercept] == pytest.approx(w.tolist(), abs=1e-4)


def test_search_space_and_candidates():
    sizes = {a: len(models.sample_candidates(a, 10_000, 1)) for a in models.SEARCH_SPACE}
    assert sizes == {"Logistic Regression": 8, "Decision Tree": 32, "Random Forest": 108}
    a = models.sample_candidates("Random Forest", 5, 42)
    assert a == models.sample_candidates("Random Forest", 5, 42) and len({models.params_json(q) for q in a}) == 5
    with pytest.raises(ValueError):
        models.default_params("Other", TrainingConfig())


def test_profile_matches_pandas(spark):
    frame = transactions_frame(300, 60)
    frame.loc[3, "V2"] = np.nan
    df = with_ids(spark, frame)
    got = {(r["Class"], r["feature"]): r for r in profile.class_profile(df).collect()}
    want = frame.groupby("Class")[FEATURES].agg(["mean", "median", "std"])
    for g in (0, 1):
        for c in FEATURES:
            r = got[(g, c)]
            assert [r["mean"], r["median"], r["std"]] == pytest.approx(want.loc[g, c].tolist())
    corr = frame.corr()
    for r in profile.correlation_matrix(df, list(frame.columns)).collect():
        assert r["r"] == pytest.approx(corr.loc[r["a"], r["b"]])
    hist = profile.class_histogram(df, profile.log_amount(), 45).where("Class = 1").orderBy("bin").collect()
    x = np.log1p(frame["Amount"])
    dens, _ = np.histogram(x[frame["Class"] == 1], bins=np.linspace(x.min(), x.max(), 46), density=True)
    assert [r["density"] for r in hist] == pytest.approx(dens.tolist())


def test_stage_persistence(spark, tmp_path):
    df = with_ids(spark, training_frame())
    model = Pipeline(stages=features.preprocessing_stages(TrainingConfig())).fit(df)
    path = str(tmp_path / "prefix")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a, b = (m.transform(df).select("row_id", vector_to_array("features").alias("x")) for m in (model, again))
    assert a.exceptAll(b).isEmpty()


def test_logistic_fits_side_by_side_equal_single_fits(spark):
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 6)) * [1, 1, 5, .1, 1, 1]
    y = (rng.random(900) < 1 / (1 + np.exp(2 - x[:, 0] - .3 * x[:, 2]))).astype(float)
    df = spark.createDataFrame([(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(x, y))], "row_id long, x array<double>, Class double")
    df = df.select("row_id", array_to_vector("x").alias("features"), "Class").repartition(4).persist()
    space = [{"C": c, "tol": 1e-9} for c in (.01, .1, 1.0, 10.0)]
    weights = logistic.fit_together(df, space)
    names = [str(q["C"]) for q in space]
    scores = {(r["experiment"], r["row_id"]): r["score"] for r in logistic.scores_together(df, weights, names, ["row_id"]).collect()}
    assert len(scores) == 4 * 900
    for q, w in zip(space, weights):
        single = models.fit_classifier(df, "Logistic Regression", {**q, "tol": 1e-12}, 1)
        assert np.allclose(w[:-1], single.coefficients.toArray(), atol=2e-4) and w[-1] == pytest.approx(single.intercept, abs=2e-4)
        for r in models.positive_score(df.limit(20), single, ["row_id"]).collect():
            assert scores[str(q["C"]), r["row_id"]] == pytest.approx(r["score"], abs=1e-4)
    # Separable rows and a strong signal need shorter steps and still settle.
    far = df.withColumn("Class", F.expr("double(row_id % 2)")).withColumn("features", array_to_vector(F.array(F.expr("double(row_id % 2) * 50 - 25"))))
    assert np.isfinite(logistic.fit_together(far, space)).all()
