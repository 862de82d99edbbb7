"""Readers for labelled and unlabelled transaction files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rareclass.config import FEATURES, TARGET
from rareclass.errors import DatasetError, PredictionError
from rareclass.operators.contract import project, require_columns, validate_scoring, validate_training


_RECORD = "_malformed"


def _places(spark: SparkSession, path: str, error: type[Exception]) -> list[str | None]:
    """Column names in the header; None where a column has no name."""
    head = spark.read.option("header", False).csv(path).limit(1).collect()
    found = list(head[0]) if head else []
    names = [v for v in found if v is not None]
    if not names:
        raise error(f"Cannot read CSV: {path} is empty.")
    require_columns(names, [], error)
    return found


def _records(spark: SparkSession, path: str, places: list[str | None]) -> tuple[DataFrame, list[str]]:
    """All columns as text under names of their own, and the record itself where its fields do not fit the header."""
    own = [v if v is not None else f"_unnamed_{i}" for i, v in enumerate(places)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*own, _RECORD]])
    rows = (spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", _RECORD)
            .option("columnPruning", False).option("enforceSchema", None in places).csv(path))
    return rows, own


def _faults(rows: DataFrame, own: list[str]) -> DataFrame:
    """``(record, fields, expected, reason)`` of records with too many or too few fields."""
    # The reader refuses to give the record alone, so a column takes part, with nothing of it.
    expected, record = len(own), F.concat(_RECORD, F.coalesce(F.substring(F.col(f"`{own[0]}`"), 1, 0), F.lit("")))
    outside = F.regexp_replace(_RECORD, r'"(?:[^"\\]|\\.|"")*"', "")  # separators in quotes are text
    fields = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    return (rows.where(record.isNotNull()).select(record.alias("record"), fields.alias("fields"))
            .withColumn("expected", F.lit(expected))
            .withColumn("reason", F.when(F.col("fields") > expected, "too_many_fields").otherwise("too_few_fields")))


def malformed_rows(spark: SparkSession, path: str, error: type[Exception] = DatasetError) -> DataFrame:
    """``(record, fields, expected, reason)``: the records of a CSV whose fields do not fit its header."""
    try:
        places = _places(spark, path, error)
        return _faults(*_records(spark, path, places))
    except AnalysisException as exc:
        raise error(f"Cannot read {path}: {exc.getCondition() or 'not readable'}.") from exc


def read_text_csv(spark: SparkSession, path: str, error: type[Exception] = DatasetError) -> DataFrame:
    """CSV with a header, every column as text, so that all bad values can be reported.

    A record with more fields than the header is an error, as its values may stand under wrong
    names. One with fewer has nulls in the columns it lacks, which the checks report as missing.
    ``malformed_rows`` lists both. A column without a name, such as a written row index, keeps
    its place and is dropped.
    """
    try:
        places = _places(spark, path, error)
        rows, own = _records(spark, path, places)
        long = _faults(rows, own).where("reason = 'too_many_fields'").agg(
            F.count(F.lit(1)).alias("n"), F.max("fields").alias("most"), F.min("record").alias("record")).first()
    except AnalysisException as exc:
        raise error(f"Cannot read {path}: {exc.getCondition() or 'not readable'}.") from exc
    if long["n"]:
        raise error(f"Cannot read {path}: {long['n']} records have more than the {len(places)} fields of the header, "
                    f"up to {long['most']}; one is {long['record'][:100]!r}.")
    return rows.select(*[F.col(f"`{n}`") for n, v in zip(own, places) if v is not None])


def load_training(spark: SparkSession, path: str, fmt: str = "csv", keep: list[str] | None = None) -> DataFrame:
    """Validated training table: kept keys, 30 features and Class, typed."""
    raw = read_text_csv(spark, path) if fmt == "csv" else _read_parquet(spark, path, DatasetError)
    validate_training(raw)
    return project(raw, keep)


def load_scoring(spark: SparkSession, path: str, fmt: str = "csv", strict: bool = True) -> DataFrame:
    """Rows to score, all their columns kept; a label is not needed and is ignored."""
    raw = read_text_csv(spark, path, PredictionError) if fmt == "csv" else _read_parquet(spark, path, PredictionError)
    require_columns(raw.columns, FEATURES, PredictionError)
    if strict:
        validate_scoring(raw)
    return raw


def _read_parquet(spark: SparkSession, path: str, error: type[Exception]) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        raise error(f"Cannot read {path}: {exc.getCondition() or 'not readable'}.") from exc


def read_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A result table; the text ``None`` is a value ("no resampling") and stays text."""
    return spark.read.schema(schema).option("header", True).csv(path)


TRAINING_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in FEATURES] + [T.StructField(TARGET, T.ByteType())])
