"""Classifiers, search spaces and resampling inside ``fit`` only."""

from __future__ import annotations

import json
import random

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from rareclass.config import ALGORITHMS, ROW_ID, TARGET, TrainingConfig
from rareclass.operators.forest import fit_forests
from rareclass.operators.metrics import curve, ranking_metrics
from rareclass.operators.resample import smote

MAX_TREE_DEPTH = 30  # deepest tree the library grows; stands for "unlimited"
MAX_BINS = 128
TREE_MEMORY_MB = 256  # per task: one histogram group of nodes


# The search spaces.
SEARCH_SPACE = {
    "Logistic Regression": {"C": [0.01, 0.1, 1.0, 10.0], "tol": [1e-4, 1e-3]},
    "Decision Tree": {"max_depth": [4, 8, 12, None], "min_samples_leaf": [1, 2, 5, 10],
                      "criterion": ["gini", "entropy"]},
    "Random Forest": {"n_estimators": [40, 60, 80], "max_depth": [8, 14, None], "min_samples_leaf": [1, 2, 5],
                      "max_features": ["sqrt", 0.5], "max_samples": [0.5, 0.7]},
}


def default_params(algorithm: str, config: TrainingConfig) -> dict:
    if algorithm == "Logistic Regression":
        return {"C": 1.0, "tol": 1e-4}
    if algorithm == "Decision Tree":
        return {"max_depth": 10, "min_samples_leaf": 2, "criterion": "gini"}
    if algorithm == "Random Forest":
        return {"n_estimators": config.forest_trees, "max_depth": 14, "min_samples_leaf": 2,
                "max_features": "sqrt", "max_samples": 0.7}
    raise ValueError(f"Unknown algorithm: {algorithm}")


def sample_candidates(algorithm: str, n: int, seed: int) -> list[dict]:
    """``n`` different combinations of the search space, drawn without replacement."""
    combos = [{}]
    for name, values in SEARCH_SPACE[algorithm].items():
        combos = [{**c, name: v} for c in combos for v in values]
    return random.Random(seed).sample(combos, min(n, len(combos)))


def params_json(params: dict) -> str:
    return json.dumps(params, sort_keys=True)


def make_classifier(algorithm: str, params: dict, train_rows: int, seed: int, label: str = TARGET):
    """``train_rows`` turns the inverse penalty C into a penalty on the mean loss."""
    if algorithm == "Logistic Regression":
        return LogisticRegression(
            featuresCol="features", labelCol=label, maxIter=1000, tol=params["tol"],
            regParam=1.0 / (params["C"] * train_rows), elasticNetParam=0.0, standardization=False)
    tree = {
        "featuresCol": "features", "labelCol": label, "seed": seed, "maxBins": MAX_BINS,
        "maxDepth": MAX_TREE_DEPTH if params["max_depth"] is None else params["max_depth"],
        "minInstancesPerNode": params["min_samples_leaf"], "maxMemoryInMB": TREE_MEMORY_MB}
    if algorithm == "Decision Tree":
        return DecisionTreeClassifier(impurity=params["criterion"], **tree)
    if algorithm == "Random Forest":
        # A row keeps its node in every tree, so that a level does not walk all trees from their roots again.
        return RandomForestClassifier(
            numTrees=params["n_estimators"], subsamplingRate=params["max_samples"], bootstrap=params.get("bootstrap", True),
            featureSubsetStrategy=str(params["max_features"]), cacheNodeIds=True, **tree)
    raise ValueError(f"Unknown algorithm: {algorithm}")


def training_rows(prepared: DataFrame, use_smote: bool, config: TrainingConfig, label: str = TARGET) -> DataFrame:
    """(features, label, synthetic) of all original rows, plus synthetic rows if asked for."""
    real = prepared.select("features", F.col(label).cast("double").alias(label), F.lit(False).alias("synthetic"))
    return real.unionByName(synthetic_rows(prepared, config, label)) if use_smote else real


def synthetic_rows(prepared: DataFrame, config: TrainingConfig, label: str = TARGET) -> DataFrame:
    """(features, label, synthetic) of the rows that SMOTE adds."""
    arrays = prepared.select(ROW_ID, F.col(label).cast("int").alias(label), vector_to_array("features").alias("x"))
    new = smote(arrays, "x", config.smote_ratio, config.smote_neighbors, config.seed, label=label)
    return new.select(array_to_vector("x").alias("features"), F.lit(1.0).alias(label), F.lit(True).alias("synthetic"))


class ResampledClassifier(Estimator):
    """Resample, then fit. The fitted stage is the bare classifier, so scoring never resamples."""

    def __init__(self, algorithm: str, use_smote: bool, config: TrainingConfig, params: dict | None = None):
        super().__init__()
        self.algorithm, self.use_smote, self.config = algorithm, use_smote, config
        self.params_ = params or default_params(algorithm, config)

    def _fit(self, df):
        rows = training_rows(df, self.use_smote, self.config).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return fit_classifier(rows, self.algorithm, self.params_, self.config.seed)
        finally:
            rows.unpersist()


def fit_classifier(rows: DataFrame, algorithm: str, params: dict, seed: int):
    n = rows.count() if algorithm == "Logistic Regression" else 0
    return make_classifier(algorithm, params, n, seed).fit(rows.select("features", TARGET))


def forests_together(rows: DataFrame, candidates: list[dict], seed: int) -> list:
    """The forests of all ``candidates`` on the same rows, grown side by side; their draws are not those of ``fit_classifier``."""
    return fit_forests(rows.select("features", TARGET), [make_classifier("Random Forest", q, 0, seed) for q in candidates])


def positive_score(df: DataFrame, model, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``score`` = P(class 1)."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias("score"))


def constant_scores(df: DataFrame, label: str = TARGET) -> DataFrame:
    """The reference model that always answers "negative"."""
    return df.select(ROW_ID, F.col(label).alias("label"), F.lit(0.0).alias("score"))


def feature_importance(model, names: list[str], spark) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def top_importances(importance: DataFrame, k: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)


class AveragePrecisionEvaluator(Evaluator):
    """Average precision without interpolation, for tuning by score name."""

    def __init__(self, labelCol: str = TARGET, probabilityCol: str = "probability"):
        super().__init__()
        self.labelCol, self.probabilityCol = labelCol, probabilityCol

    def _evaluate(self, dataset):
        scores = dataset.select(
            F.lit("model").alias("experiment"), F.lit("data").alias("partition"),
            F.col(self.labelCol).cast("int").alias("label"), vector_to_array(self.probabilityCol)[1].alias("score"))
        row = ranking_metrics(curve(scores)).first()
        return 0.0 if row is None else float(row["average_precision"])

    def isLargerBetter(self):
        return True


def assemble(prefix: PipelineModel, classifier) -> PipelineModel:
    return PipelineModel([*prefix.stages, classifier])


def experiment_key(algorithm: str, use_smote: bool, stage: str) -> str:
    return f"{algorithm} | {'SMOTE' if use_smote else 'None'} | {stage}"


def experiment_column(algorithm="algorithm", imbalance="imbalance", stage="stage"):
    return F.concat_ws(" | ", algorithm, imbalance, stage)


GRID = [(a, s) for a in ALGORITHMS for s in (False, True)]
