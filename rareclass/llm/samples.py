"""Bounded samples that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hash_sample(df: DataFrame, rows: int, seed: int, *columns: str) -> DataFrame:
    """The ``rows`` rows with the least hashes of ``columns``, or all of a smaller table.

    A large table is first cut to about twice as many rows by their hash, so that what is
    sorted in one task is bounded by ``rows`` and not by the number of partitions.
    """
    hashed = F.xxhash64(F.lit(seed), *columns)
    n = df.count()
    if n > 4 * rows:
        df = df.where(hashed < int(-(2**63) + 2**64 * (2 * rows / n)))
    return df.orderBy(hashed, *columns).limit(rows)
