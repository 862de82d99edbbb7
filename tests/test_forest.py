import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rareclass.config import TARGET
from rareclass.errors import DatasetError
from rareclass.operators import forest, models

DRAWN = {"n_estimators": 6, "max_depth": 5, "min_samples_leaf": 2, "max_features": "sqrt", "max_samples": 0.7}
UNDRAWN = {"n_estimators": 2, "max_depth": 6, "min_samples_leaf": 3, "max_features": "all", "max_samples": 1.0, "bootstrap": False}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 6))
    x[:, 3], x[:, 5] = np.round(x[:, 3]), 1.0  # a few values, and one only
    y = (x[:, 0] + x[:, 3] + rng.normal(size=3000) > 1.5).astype(float)
    df = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)], f"x array<double>, {TARGET} double")
    return df.select(array_to_vector("x").alias("features"), TARGET).repartition(3).cache()


def _trees(model) -> str:
    return model.toDebugString.split("\n", 1)[1]


def _made(params):
    return models.make_classifier("Random Forest", params, 0, 1)


def test_a_forest_keeps_no_row_in_the_library(rows, monkeypatch):
    """The library's fit sees a stub of one row per class; it kept over a kilobyte for each row of the table."""
    fit, seen = RandomForestClassifier.fit, []
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, *a: seen.append(df.count()) or fit(self, df, *a))
    models.forests_together(rows, [DRAWN], 1)
    assert seen == [2]


def test_without_draws_the_trees_are_the_library_s(rows, monkeypatch):
    """Node for node, in blocks of any size and with any number of nodes in a pass."""
    want = _made(UNDRAWN).fit(rows)
    passes = []
    one = forest._pass
    monkeypatch.setattr(forest, "_pass", lambda *a: passes.append(1) or one(*a))
    got, = forest.fit_forests(rows, [_made(UNDRAWN)], block_rows=700)
    assert len(passes) <= 6
    narrow, = forest.fit_forests(rows, [_made(UNDRAWN).setMaxMemoryInMB(0)], block_rows=700)  # a node at a time
    assert _trees(got) == _trees(narrow) == _trees(want)
    assert np.array_equal(got.featureImportances.toArray(), want.featureImportances.toArray())
    scores = [models.positive_score(rows, m, [TARGET]).agg(F.sum("score")).first()[0] for m in (got, want)]
    assert scores[0] == pytest.approx(scores[1], rel=1e-12)


def test_what_grows_beside_a_forest_changes_nothing(rows):
    alone, = forest.fit_forests(rows, [_made(DRAWN)])
    beside = models.forests_together(rows, [UNDRAWN, DRAWN], 1)
    assert _trees(beside[1]) == _trees(alone) and _trees(beside[0]) == _trees(_made(UNDRAWN).fit(rows))
    assert len({_trees(t) for t in alone.trees}) == 6  # every tree draws by its own seed
    assert alone.trees[0].depth <= 5 and alone.getNumTrees == 6


def test_drawn_forests_judge_as_the_library_s(rows):
    judge = models.AveragePrecisionEvaluator()
    params = {**DRAWN, "n_estimators": 40}
    ours, theirs = (m.transform(rows) for m in (models.forests_together(rows, [params], 1)[0], models.fit_classifier(rows, "Random Forest", params, 1)))
    assert judge.evaluate(ours) == pytest.approx(judge.evaluate(theirs), abs=0.02)


@pytest.mark.parametrize("rate", [0.5, 0.7, 1.0, 3.0])
def test_rows_are_drawn_as_often_as_they_should(rate):
    drawn = forest._weights(400_000, [1, 2], rate, True)
    for k in range(4):
        assert (drawn == k).mean() == pytest.approx(math.exp(-rate) * rate**k / math.factorial(k), abs=0.004)
    assert (forest._weights(400_000, [1, 2], rate, False) == 1).mean() == pytest.approx(min(rate, 1.0), abs=0.004)


def test_few_values_many_classes_and_empty_tables(spark, rows):
    df = spark.createDataFrame([([float(i % 5), 2.0], float(i % 3)) for i in range(60)], f"x array<double>, {TARGET} double")
    df = df.select(array_to_vector("x").alias("features"), TARGET)
    assert _trees(forest.fit_forests(df, [_made(UNDRAWN)])[0]) == _trees(_made(UNDRAWN).fit(df))
    lone = df.where(f"{TARGET} = 0").select("features", F.lit(0.0).alias(TARGET))
    assert "If" not in forest.fit_forests(lone, [_made(DRAWN)])[0].toDebugString
    constant = df.select(array_to_vector(F.array(F.lit(1.0))).alias("features"), TARGET)
    assert "If" not in forest.fit_forests(constant, [_made(DRAWN)])[0].toDebugString
    for bad in (df.limit(0), df.withColumn(TARGET, F.lit(None).cast("double")), df.withColumn(TARGET, F.lit(0.5))):
        with pytest.raises(DatasetError):
            forest.fit_forests(bad, [_made(DRAWN)])


def test_features_of_a_node_by_strategy():
    each = {"all": 20, "sqrt": 5, "log2": 5, "onethird": 7, "0.5": 10, "4": 4, "1.0": 20, "auto": 5}
    assert {s: forest.features_per_node(s, 20, 3) for s in each} == each
    assert forest.features_per_node("auto", 20, 1) == 20


def test_the_search_grows_the_forests_of_a_fold_together(spark, rows, monkeypatch):
    """The candidates of a fold share binned rows and passes; each is scored on all parts."""
    from types import SimpleNamespace

    from rareclass.config import ROW_ID, TrainingConfig
    from rareclass.plans import experiment

    binned, one = [], forest.bin_rows
    monkeypatch.setattr(forest, "bin_rows", lambda *a: binned.append(1) or one(*a))
    part = rows.withColumn(ROW_ID, F.monotonically_increasing_id())
    frames = SimpleNamespace(fit_rows={False: rows}, parts={"train": part, "held_out": part.limit(50)})
    p = SimpleNamespace(spark=spark, config=TrainingConfig())
    space = [DRAWN, {**DRAWN, "max_depth": 2}, {**DRAWN, "n_estimators": 3}]
    seconds, scores = experiment._candidate_scores(p, frames, "Random Forest", False, space)
    assert binned == [1] and set(seconds) == {1, 2, 3} and len(set(seconds.values())) == 1
    found = {(r["experiment"], r["partition"]): r["count"] for r in scores.groupBy("experiment", "partition").count().collect()}
    assert found == {(f"Random Forest | None | tuned | {i}", n): k for i in (1, 2, 3) for n, k in (("train", 3000), ("held_out", 50))}
