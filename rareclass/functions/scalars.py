"""Small expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that a CSV reader takes for a missing value.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Fixed value: decimal literals, for texts that hold a letter which Java reads as a type
# suffix or as a base.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+|inf|infinity)$"

INF = float("inf")


def ratio(num: Column, den: Column) -> Column:
    """num / den, and 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def f1_of(tp: Column, fp: Column, fn: Column) -> Column:
    """F1 from integer counts, so that equal models tie exactly."""
    return ratio(2 * tp, 2 * tp + fp + fn)


def no_nan(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def is_infinite(col: Column) -> Column:
    return F.abs(col) == F.lit(INF)


def _is_missing_text(text: Column) -> Column:
    return text.isNull() | F.trim(text).isin(MISSING_TOKENS)


def parse_number(text: Column) -> Column:
    """Text to double; missing and bad texts become NULL. The cheap cast decides most rows."""
    odd = text.rlike("[dDfFxX]") & ~F.lower(F.trim(text)).rlike(NUMBER_PATTERN)
    return F.when(~odd, F.nanvl(text.try_cast("double"), F.lit(None).cast("double")))


def is_bad_number(text: Column, value: Column) -> Column:
    """Text that is neither missing nor a number, given its parsed ``value``."""
    return value.isNull() & ~_is_missing_text(text)
