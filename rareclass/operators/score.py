"""Scoring of raw rows with a frozen model, and summaries of a scored batch."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rareclass.config import COMPONENTS, FEATURES, NEGATIVE_NAME, POSITIVE_NAME, ROW_ID
from rareclass.errors import PredictionError
from rareclass.functions.scalars import is_infinite
from rareclass.operators.contract import check_threshold, number, quarantine, require_columns, validate_scoring

SCORE = "fraud_probability"
# Columns that scoring appends.
RESULT_COLUMNS = [SCORE, "predicted_class", "prediction", "decision_threshold"]


BAD_SCORE = "The model gave a score that is not finite."


def with_decision(df: DataFrame, score: Column, threshold: float) -> DataFrame:
    """Append the four result columns; positive means score >= threshold."""
    flagged = F.col(SCORE) >= F.lit(threshold)
    return (df.withColumn(SCORE, score)
            .withColumn("predicted_class", F.when(flagged, 1).otherwise(0))
            .withColumn("prediction", F.when(flagged, POSITIVE_NAME).otherwise(NEGATIVE_NAME))
            .withColumn("decision_threshold", F.lit(float(threshold))))


def apply_model(df: DataFrame, model, threshold: float) -> DataFrame:
    """Score valid rows; every input column, features as given included, is kept."""
    # A table that was scored before gets its result columns anew.
    df = df.drop(*RESULT_COLUMNS)
    packed = df.select(F.struct("*").alias("_in"), *[number(df, c).alias(c) for c in FEATURES])
    scored = model.transform(packed)
    out = scored.select("_in", finite_score(vector_to_array("probability")[1]).alias(SCORE))
    return with_decision(out.select("_in.*", SCORE), F.col(SCORE), threshold)


def finite_score(score: Column) -> Column:
    """The score itself; a row whose score is not finite fails when it is computed, without a pass of its own."""
    bad = score.isNull() | F.isnan(score) | is_infinite(score)
    return F.when(~bad, score).otherwise(F.raise_error(F.lit(BAD_SCORE)).cast("double"))


def predict(df: DataFrame, bundle, threshold: float | None = None, strict: bool = True) -> DataFrame:
    """Strict: any bad row fails the batch with a readable error. Otherwise bad rows are left
    out; :func:`predict_or_reject` returns them."""
    threshold = check_threshold(bundle.metadata["threshold"] if threshold is None else threshold)
    if strict:
        validate_scoring(df)
        return apply_model(df, bundle.pipeline, threshold)
    return predict_or_reject(df, bundle, threshold)[0]


def predict_or_reject(df: DataFrame, bundle, threshold: float | None = None) -> tuple[DataFrame, DataFrame]:
    threshold = check_threshold(bundle.metadata["threshold"] if threshold is None else threshold)
    require_columns(df.columns, FEATURES, PredictionError)
    valid, rejected = quarantine(df)
    return apply_model(valid, bundle.pipeline, threshold), rejected


def invalid_scores(scored: DataFrame, column: str = SCORE) -> DataFrame:
    """One row: how many scores are not finite."""
    s = F.col(column)
    return scored.agg(F.count_if(s.isNull() | F.isnan(s) | is_infinite(s)).alias("invalid_scores"))


def require_finite_scores(scored: DataFrame, column: str = SCORE) -> None:
    if invalid_scores(scored, column).first()[0]:
        raise PredictionError(BAD_SCORE)


def batch_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("transactions"), F.sum(F.col("predicted_class").cast("bigint")).alias("flagged"),
        F.avg(F.col("predicted_class").cast("double")).alias("flagged_share"), F.max(SCORE).alias("max_score"))


def alerts(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(below threshold, at or above threshold)."""
    hit = F.col(SCORE) >= F.col("decision_threshold")
    return scored.where(~hit), scored.where(hit)


def score_histogram(scored: DataFrame, threshold: float, bins: int = 16) -> DataFrame:
    """(alert, bin, bin_start, rows) on [0, upper]; upper leaves room above score and threshold."""
    top = scored.agg(F.max(SCORE)).first()[0] or 0.0
    upper = min(1.0, max(0.08, top * 1.12, threshold * 1.12))
    width = upper / bins
    b = F.least(F.floor(F.col(SCORE) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counted = (scored.groupBy((F.col(SCORE) >= F.lit(threshold)).alias("alert"), b.alias("bin"))
               .agg(F.count(F.lit(1)).alias("rows")))
    # The grid of 2 * bins cells is a literal.
    cells = [(a, i, i * width) for a in (False, True) for i in range(bins)]
    grid = scored.sparkSession.createDataFrame(cells, "alert boolean, bin int, bin_start double")
    return grid.join(counted, ["alert", "bin"], "left").na.fill(0, ["rows"])


def top_components(df: DataFrame, k: int = 12, key: str = ROW_ID) -> DataFrame:
    """(key, position, component, value): the k largest components of each row by size, in
    signed order. Sorted inside the row, so nothing is shuffled."""
    cells = F.array(*[F.struct((-F.abs(F.col(c))).alias("size"), F.lit(i).alias("i"), F.lit(c).alias("component"),
                               F.col(c).alias("value")) for i, c in enumerate(COMPONENTS)])
    present = F.filter(cells, lambda c: c["value"].isNotNull())
    largest = F.slice(F.array_sort(present), 1, k)
    signed = F.array_sort(F.transform(largest, lambda c: F.struct(c["value"], c["i"], c["component"])))
    return (df.select(key, F.posexplode(signed).alias("position", "c"))
            .select(key, (F.col("position") + 1).alias("position"), "c.component", "c.value"))


def top_components_ranked(df: DataFrame, k: int = 12, key: str = ROW_ID) -> DataFrame:
    """The same choice by a ranked window over the long form."""
    long = df.unpivot([key], COMPONENTS, "component", "value").where("value is not null")
    number_of = F.substring("component", 2, 2).cast("int")
    w = Window.partitionBy(key).orderBy(F.desc(F.abs("value")), number_of)
    return long.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r")
