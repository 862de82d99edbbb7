"""Duplicates, label conflicts, audit record and fingerprints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rareclass.config import FEATURES, ROW_ID, TARGET
from rareclass.errors import DatasetError


def distinct_rows(df: DataFrame, columns: list[str], key: str | None = ROW_ID) -> DataFrame:
    """Exact full-row dedup; the copy with the smallest key is kept.

    Copies collapse before the shuffle, so a row that makes up a third of the table
    reaches its reducer once per map task. NULLs are equal to each other.
    """
    if key is None:
        return df.select(*columns).distinct()
    return df.groupBy(*columns).agg(F.min(key).alias(key)).select(key, *columns)


def row_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))


def duplicate_count(df: DataFrame, columns: list[str]) -> DataFrame:
    return row_counts(df, columns).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"))


def label_conflicts(df: DataFrame, features: list[str] = FEATURES, label: str = TARGET) -> DataFrame:
    """Feature combinations that carry both labels."""
    return (df.groupBy(*features).agg(F.min(label).alias("min_label"), F.max(label).alias("max_label"))
            .where("min_label <> max_label"))


def require_no_conflicts(df: DataFrame) -> None:
    if not label_conflicts(df).isEmpty():
        raise DatasetError("Some rows with the same features carry two labels; they must be settled before the split.")


def audit_row(df: DataFrame, columns: list[str], label: str = TARGET) -> DataFrame:
    """Rows, positives and rates before and after dedup; one shuffle for both."""
    y = F.col(label).cast("bigint")
    return row_counts(df, columns).agg(
        F.sum("copies").alias("raw_rows"),
        F.sum(y * F.col("copies")).alias("raw_frauds"),
        (F.sum(y * F.col("copies")) / F.sum("copies")).alias("raw_fraud_rate"),
        F.sum(F.col("copies") - 1).alias("duplicates_removed"),
        F.count(F.lit(1)).alias("clean_rows"),
        F.sum(y).alias("clean_frauds"),
        (F.sum(y) / F.count(F.lit(1))).alias("clean_fraud_rate"))


def missing_by_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``(column_name, missing)``."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot([], columns, "column_name", "missing")


def missing_map(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same as one row with a map column."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = reduce(lambda a, c: a + [F.lit(c), F.col(c)], columns, [])
    return one.select(F.create_map(*cells).alias("missing_values"))


def class_distribution(df: DataFrame, label: str = TARGET) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    every = Window.partitionBy(F.lit(1))  # one row per class
    return counts.withColumn("percent", 100.0 * F.col("rows") / F.sum("rows").over(every))


def row_hash(columns: list[str], portable: bool = False) -> Column:
    """Hash of a row as a long. ``portable`` hashes texts with md5, which other engines repeat."""
    if not portable:
        return F.xxhash64(*columns)
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def fingerprint(df: DataFrame, columns: list[str], portable: bool = False) -> DataFrame:
    """Order-insensitive digest of a table; one row ``(rows, digest)``."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(row_hash(columns, portable)).alias("digest"))


def _path(column: Column) -> Column:
    """One way to write a local file's address; sources differ in the slashes after the scheme."""
    return F.regexp_replace(column, "^file:/+", "file:/")


def file_digests(spark: SparkSession, path: str, columns: list[str], known: DataFrame | None = None,
                 portable: bool = False) -> DataFrame:
    """``(file, changed_at, bytes, rows, digest)`` of every parquet file under ``path``.

    Files of ``known``, an earlier result, are not read again unless their size or time differ;
    those that are gone drop out. The list of files to read passes through the driver, as it
    does in every scan.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
              .select(_path(F.col("path")).alias("file"), F.col("modificationTime").alias("changed_at"), F.col("length").alias("bytes")))
    same = ["file", "changed_at", "bytes"]
    fresh = listed if known is None else listed.join(known, same, "left_anti")
    told = None if known is None else known.join(listed, same, "left_semi")
    paths = [r["file"] for r in fresh.collect()]
    if paths:
        hashed = (spark.read.parquet(*paths).groupBy(_path(F.col("_metadata.file_path")).alias("file"))
                  .agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(row_hash(columns, portable)).alias("digest")))
        new = fresh.join(hashed, "file", "left").select(*same, F.coalesce("rows", F.lit(0)).alias("rows"), "digest")
        return new if told is None else told.unionByName(new)
    return told if told is not None else fresh.withColumns({"rows": F.lit(0).cast("bigint"), "digest": F.lit(None).cast("bigint")})


def merged_fingerprint(digests: DataFrame) -> DataFrame:
    """The ``fingerprint`` of the whole table, from those of its files."""
    return digests.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.bit_xor("digest").alias("digest"))


def provenance(df: DataFrame, expected_rows: int, expected_frauds: int, expected_digest: int,
               columns: list[str], label: str = TARGET, portable: bool = False) -> DataFrame:
    """Compare rows, positives and digest with the recorded values, in one pass."""
    seen = df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("bigint")).alias("frauds"),
        F.bit_xor(row_hash(columns, portable)).alias("digest"))
    return seen.withColumn("as_expected", (F.col("rows") == expected_rows) & (F.col("frauds") == expected_frauds)
                           & (F.col("digest") == expected_digest))
