"""Writers for result tables, records and split membership."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add finished rows to a result table, so that they survive a later failure."""
    df.write.mode("append").parquet(path)


def write_scored(scored: DataFrame, path: str) -> None:
    """A scored batch as CSV: the result columns first, then the columns it came with."""
    from rareclass.operators.score import RESULT_COLUMNS

    write_csv(scored.select(*RESULT_COLUMNS, *[c for c in scored.columns if c not in RESULT_COLUMNS]), path)


def write_records(df: DataFrame, path: str) -> None:
    """Records as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_json(spark: SparkSession, text: str, path: str) -> None:
    """One small JSON document."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> str:
    return "\n".join(r["value"] for r in spark.read.text(path).collect())


def write_members(split: DataFrame, path: str, key: str = "row_id") -> None:
    """Split membership, one folder per partition."""
    split.select(key, "partition").write.mode("overwrite").partitionBy("partition").parquet(path)


def read_members(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("partition", F.col("partition").cast("string"))
