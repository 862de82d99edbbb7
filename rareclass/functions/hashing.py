"""Deterministic, partition-independent randomness from row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_SCALE = float(2**52)


def hash_key(seed, *parts: Column) -> Column:
    """md5 of ``seed:part:part...`` as 32 hexadecimal digits."""
    texts = [p.cast("string") for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))


def hash_int(digits: int, key: Column) -> Column:
    """The first ``digits`` (at most 15) hexadecimal digits of a hash as a long."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("bigint")


def hash_unit(key: Column) -> Column:
    """Uniform in [0, 1) with 52 random bits."""
    return hash_int(13, key).cast("double") / F.lit(_UNIT_SCALE)


def content_key(*columns: str) -> Column:
    """Row identity from the row's own values; unique once exact copies are removed."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
