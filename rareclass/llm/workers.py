"""What a Python worker holds: one large object at a time, and Arrow batches of bounded size."""

from __future__ import annotations

import gc
import re
from collections.abc import Callable

from pyspark.sql import SparkSession

BATCH_BYTES = 16 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
_held: dict = {}


def held(key, build: Callable):
    """``build()``, kept for the next tasks of this worker until another object takes its place."""
    if key not in _held:
        release()
        _held[key] = build()
    return _held[key]


def release() -> None:
    """Let go of what an earlier operator left in this worker."""
    if _held:
        _held.clear()
        gc.collect()


def bound_batches(spark: SparkSession) -> None:
    """Batches between the JVM and Python of at most 16 MB, for the rest of the session, unless it has set less.

    Whole texts pass through them, several at once on each executor; the rows are the same.
    """
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)i?b?", spark.conf.get(_LIMIT).lower()).groups()
    size = int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]
    if size <= 0 or size > BATCH_BYTES:
        spark.conf.set(_LIMIT, str(BATCH_BYTES))
