"""Data contract of a transaction table: checks, typing, quarantine."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rareclass.config import FEATURES, MIN_CLASS_ROWS, NON_NEGATIVE, TARGET
from rareclass.errors import DatasetError, PredictionError
from rareclass.functions.scalars import INF, is_bad_number, is_infinite, no_nan, parse_number


def require_columns(names: list[str], required: list[str], error: type[Exception]) -> None:
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise error(f"These columns occur more than once: {', '.join(repeated)}.")
    missing = sorted(set(required) - set(names))
    if missing:
        raise error(f"The table lacks {len(missing)} required columns: {', '.join(missing)}.")


def check_threshold(threshold) -> float:
    good = isinstance(threshold, (int, float)) and not isinstance(threshold, bool)
    if not good or not math.isfinite(threshold) or not 0 <= threshold <= 1:
        raise PredictionError(f"A threshold lies in [0, 1]; got {threshold!r}.")
    return float(threshold)


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def number(df: DataFrame, name: str) -> Column:
    """The column as double; bad or missing texts and NaN become NULL."""
    c = F.col(f"`{name}`")
    return parse_number(c) if _is_text(df, name) else no_nan(c.cast("double"))


def project(df: DataFrame, keep: list[str] | None = None, with_label: bool = True) -> DataFrame:
    """Canonical columns in canonical order: kept keys, 30 features as double, label as byte."""
    label = [number(df, TARGET).try_cast("tinyint").alias(TARGET)] if with_label else []
    return df.select(*(keep or []), *[number(df, c).alias(c) for c in FEATURES], *label)


def _cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """Long form ``(i, x, bad)``: value and bad-text flag of each column of each row.

    One short expression per value keeps the generated code compiled; the rows collapse to
    one per column on the map side of the aggregation that follows.
    """
    if any(_is_text(df, c) for c in columns):
        texts = F.array(*[F.col(f"`{c}`").cast("string") for c in columns])
        cell = df.select(F.posexplode(texts).alias("i", "t")).withColumn("x", parse_number(F.col("t")))
        return cell.select("i", "x", is_bad_number(F.col("t"), F.col("x")).alias("bad"))
    values = F.array(*[number(df, c) for c in columns])
    return df.select(F.posexplode(values).alias("i", "x")).withColumn("bad", F.lit(False))


def _column_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: how many of its values break each rule."""
    x = F.col("x")
    names = F.element_at(F.array(*map(F.lit, columns)), F.col("i") + 1)
    return (_cells(df, columns).groupBy("i").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("bad").alias("not_numeric"),
        F.count_if(x.isNull()).alias("missing"),
        F.count_if(is_infinite(x)).alias("infinite"),
        F.count_if(x < 0).alias("below_zero"),
        F.count_if(x == 0).alias("zeros"),
        F.count_if(x == 1).alias("ones"))
        .withColumn("column_name", names)
        .withColumn("negative", F.when(F.col("column_name").isin(NON_NEGATIVE), F.col("below_zero")).otherwise(0)))


def training_violations(df: DataFrame, features: list[str] = FEATURES, label: str = TARGET,
                        min_class_rows: int = MIN_CLASS_ROWS) -> DataFrame:
    """Rows ``(check, column_name, rows)``, one for each broken rule; one aggregation."""
    name = F.col("column_name")
    is_label = name == label
    short = [F.struct(F.lit("few_rows").alias("check"), F.lit(f"{label}={value}").alias("column_name"),
                      F.when(is_label & (F.col(c) < min_class_rows), min_class_rows - F.col(c)).otherwise(0)
                      .cast("bigint").alias("rows")) for value, c in ((0, "zeros"), (1, "ones"))]

    def cell(check: str, rows: Column):
        return F.struct(F.lit(check).alias("check"), name, rows.cast("bigint").alias("rows"))

    found = F.array(
        cell("not_numeric", F.col("not_numeric")),
        cell("label_missing", F.when(is_label, F.col("missing")).otherwise(0)),
        cell("label_value", F.when(is_label, F.col("total") - F.col("missing") - F.col("zeros") - F.col("ones"))
             .otherwise(0)),
        cell("infinite", F.when(is_label, 0).otherwise(F.col("infinite"))),
        cell("negative", F.col("negative")),
        cell("entirely_missing", F.when(~is_label & (F.col("missing") == F.col("total")), F.col("total")).otherwise(0)),
        *short)
    counts = _column_counts(df, [*features, label])
    return counts.select(F.explode(found).alias("c")).select("c.*").where("rows > 0")


# The first of these rules that is broken is reported.
TRAINING_MESSAGES = {
    "not_numeric": "Text that is no number in {0}.",
    "label_missing": "Rows without a label in {0}.",
    "label_value": "Labels other than 0 and 1 in {0}.",
    "infinite": "Infinity among the values of {0}.",
    "negative": "Values below zero in {0}.",
    "entirely_missing": "Not a single value in {0}.",
    "few_rows": f"A class has fewer than {MIN_CLASS_ROWS} rows: {{0}}.",
}


def validate_training(df: DataFrame) -> None:
    """Raise for the first broken rule, naming the columns."""
    require_columns(df.columns, [*FEATURES, TARGET], DatasetError)
    found: dict[str, list[str]] = {}
    for r in training_violations(df).collect():
        found.setdefault(r["check"], []).append(r["column_name"])
    for check, text in TRAINING_MESSAGES.items():
        if check in found:
            raise DatasetError(text.format(", ".join(found[check])))


def _finite(x: Column) -> Column:
    return F.coalesce(F.abs(x) < INF, F.lit(False))  # NaN is above infinity


def is_scorable(df: DataFrame, features: list[str] = FEATURES) -> Column:
    """True for a row whose features are all finite numbers within their limits.

    Texts are tested by one short lambda over an array: thirty inlined parsers would exceed
    what the JVM compiles.
    """
    texts = [c for c in features if _is_text(df, c)]
    good = F.lit(True)
    for c in features:
        if c not in texts:
            x = F.col(f"`{c}`").cast("double")
            good = good & _finite(x) & ((x >= 0) if c in NON_NEGATIVE else F.lit(True))
    if texts:
        limited = [c for c in texts if c in NON_NEGATIVE]
        every = F.array(*[F.col(f"`{c}`") for c in texts])
        good = good & F.forall(every, lambda t: _finite(parse_number(t)))
        if limited:
            good = good & F.forall(F.array(*[F.col(f"`{c}`") for c in limited]), lambda t: parse_number(t) >= 0)
    return good


def reject_reasons(df: DataFrame, features: list[str] = FEATURES) -> Column:
    """Text such as ``V1:missing,Amount:negative``."""
    none = {True: "CAST(NULL AS DOUBLE)", False: "CAST(NULL AS STRING)"}
    cells = F.expr("array(%s)" % ", ".join(
        f"named_struct('name', '{c}', 'x', {none[True] if _is_text(df, c) else f'CAST(`{c}` AS DOUBLE)'}, "
        f"'t', {f'`{c}`' if _is_text(df, c) else none[False]}, 'limited', {c in NON_NEGATIVE})" for c in features))

    def reason(c: Column) -> Column:
        x = F.coalesce(no_nan(c["x"]), parse_number(c["t"]))
        why = (F.when(x.isNull() & is_bad_number(c["t"], x), "not_numeric").when(x.isNull(), "missing")
               .when(is_infinite(x), "infinite").when(c["limited"] & (x < 0), "negative"))
        return F.concat(c["name"], F.lit(":"), why)

    return F.array_join(F.transform(cells, reason), ",")


def quarantine(df: DataFrame, features: list[str] = FEATURES) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reasons``): two filters; reasons only for rejects."""
    good = is_scorable(df, features)
    return df.where(good), df.where(~good).withColumn("reasons", reject_reasons(df, features))


def scoring_violations(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Rows ``(column_name, not_numeric, not_finite, negative)`` for columns with bad values."""
    return (_column_counts(df, features)
            .select("column_name", "not_numeric", (F.col("missing") + F.col("infinite")).alias("not_finite"),
                    F.col("negative").cast("bigint").alias("negative"))
            .where("not_numeric > 0 or not_finite > 0 or negative > 0"))


def validate_scoring(df: DataFrame) -> None:
    """Raise if any row of the batch cannot be scored; an empty batch is an error too."""
    require_columns(df.columns, FEATURES, PredictionError)
    if df.isEmpty():
        raise PredictionError("The batch to score is empty.")
    rows = scoring_violations(df).collect()
    for key, text in [("not_numeric", "Text that is no number in {0}."), ("not_finite", "Rows without a finite value in {0}."),
                      ("negative", "Values below zero in {0}.")]:
        cols = [r["column_name"] for r in rows if r[key] > 0]
        if cols:
            raise PredictionError(text.format(", ".join(cols)))
