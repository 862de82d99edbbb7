"""Exact nearest binary codes by incremental multi-index hashing.

A 64-bit code is cut into segments of about log2(codes / 8) bits; a table per segment finds codes
by that segment's value. Two codes at distance d agree on some segment up to d / segments bits,
so once all keys within r bits of a query's segments have been looked up, every code at distance
up to ``segments * (r + 1) - 1`` has been met. The radius grows until the k-th distance found lies
within that, query by query. A bounded sample gives a first bound on the k-th distance, which
the joins use to keep only codes that can still count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rareclass.llm.samples import hash_sample
from rareclass.session import materialize

BITS = 64


@dataclass(frozen=True)
class TopKConfig:
    """``sample`` codes give the first bound; it and ``segments`` affect the work and not the result.

    Without ``segments`` their number follows from the number of codes, so that a key of one
    segment is met by about eight codes. Three are the fewest: the keys of a query with no near
    code at all grow with the segment's bits, and 22 of them have at most 705,432 at a radius.
    """

    k: int = 10
    segments: int | None = None
    sample: int = 2048
    seed: int = 3

    def sized(self, codes: int) -> TopKConfig:
        return self if self.segments else replace(self, segments=max(3, math.ceil(BITS / max(4, math.log2(max(codes, 1)) - 3))))

    @property
    def edges(self) -> list[int]:
        """First bit of every segment, and the number of bits."""
        return [BITS * i // self.segments for i in range(self.segments + 1)]

    @property
    def longest(self) -> int:
        return -(-BITS // self.segments)


def sign_codes(vectors: DataFrame) -> DataFrame:
    """``(id, code)``: bit i tells whether component i is above zero, for the first 64.

    A null or missing component is not above zero, NaN is. Null vectors have no code.
    """
    bits = F.expr("""aggregate(transform(slice(embedding, 1, 64), (x, i) -> if(x > 0, shiftleft(1L, i), 0L)),
                     0L, (a, b) -> a | b)""")
    return (vectors.where("embedding is not null and vec_id is not null")
            .select(F.col("vec_id").cast("bigint").alias("id"), bits.alias("code")))


def _keys(codes: np.ndarray, config: TopKConfig) -> np.ndarray:
    """Segment values with the segment's number above them, one column per segment."""
    edges = np.array(config.edges, dtype=np.uint64)
    value = (codes.view(np.uint64)[:, None] >> edges[:-1]) & ((np.uint64(1) << np.diff(edges)) - np.uint64(1))
    return value.astype(np.int64) | (np.arange(config.segments) << 48)


def _table(codes: DataFrame, config: TopKConfig) -> DataFrame:
    """``(key, code)`` for every segment of every code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column("code").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(_keys(code, config).ravel()),
                                              pa.array(np.repeat(code, config.segments))], names=["key", "code"])

    return codes.select("code").mapInArrow(run, "key bigint, code bigint")


def _probes(queries: DataFrame, radius: int, config: TopKConfig) -> DataFrame:
    """``(key, query, bound)``: the keys at exactly ``radius`` bits from each query's segments.

    A code within ``bound`` bits that no smaller radius has met agrees up to ``radius`` bits on
    one of the segments ``j`` with ``segments * radius + j <= bound``; the others are not asked.
    """
    edges = config.edges
    flips = [np.array([sum(1 << b for b in chosen) for chosen in combinations(range(high - low), radius)], dtype=np.int64)
             for low, high in zip(edges, edges[1:])]
    widest = sum(map(len, flips))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, (1 << 20) // max(1, widest))
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                own, bound = _keys(part.column("query").to_numpy(), config), part.column("bound").to_numpy()
                for j, flip in enumerate(flips):
                    asked = np.flatnonzero(config.segments * radius + j <= bound)
                    each = pa.array(np.repeat(asked, len(flip)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((own[asked, j][:, None] ^ flip).ravel()), part.column("query").take(each),
                         part.column("bound").take(each)], names=["key", "query", "bound"])

    return queries.select("query", "bound").mapInArrow(run, "key bigint, query bigint, bound int")


def _first_bounds(queries: DataFrame, sample: np.ndarray, need: int) -> DataFrame:
    """``(query, bound)``: the distance of the ``need``-th code of the sample, or all bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            query = batch.column("query").to_numpy()
            bound = np.full(len(query), BITS, dtype=np.int32)
            for at in range(0, len(query) if len(sample) >= need else 0, 256):
                far = np.bitwise_count(query[at:at + 256].view(np.uint64)[:, None] ^ sample.view(np.uint64)[None, :])
                bound[at:at + 256] = np.partition(far, need - 1, axis=1)[:, need - 1]
            yield pa.RecordBatch.from_arrays([batch.column("query"), pa.array(bound)], names=["query", "bound"])

    return queries.mapInArrow(run, "query bigint, bound int")


def _best(met: DataFrame, need: int) -> DataFrame:
    """The ``need`` nearest ``(query, distance, id)`` of each query, least ids first on ties."""
    order = Window.partitionBy("query").orderBy("distance", "id")
    return met.withColumn("n", F.row_number().over(order)).where(f"n <= {need}").drop("n")


def exact_top_k(base: DataFrame, queries: DataFrame, config: TopKConfig = TopKConfig()) -> DataFrame:
    """``(query_id, rank, id, distance)``: for each row of ``queries(id, code)`` the ``k`` nearest of ``base``.

    Nearest by Hamming distance, then by id; a row is not its own neighbour (equal id). With
    fewer other rows than ``k`` all of them are returned. Rows without a code or id take no
    part, and rows that repeat an id and code count once.
    """
    need = config.k + 1  # a query may meet itself
    base, queries = (x.where("id is not null and code is not null").select("id", "code") for x in (base, queries))
    least = Window.partitionBy("code").orderBy("id")
    # Of equal codes only the least ids can be among the nearest.
    index = materialize(base.distinct().withColumn("n", F.row_number().over(least)).where(f"n <= {need}")
                        .groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "codes")
    sample = np.array([r["code"] for r in hash_sample(index.select("code"), config.sample, config.seed, "code").collect()],
                      dtype=np.int64)
    queries = queries.distinct()
    active = materialize(_first_bounds(queries.select(F.col("code").alias("query")).distinct(), sample, need), "bounds")
    config = config.sized(index.count())
    table = materialize(_table(index, config), "segments")
    best, done = None, []
    for radius in range(config.longest + 1):
        # Probes are many times the rows that the planner expects, so they are never broadcast.
        met = (_probes(active, radius, config).hint("merge").join(table, "key")
               .where("bit_count(query ^ code) <= bound").select("query", "code").distinct())
        met = met.join(index, "code").select(
            "query", F.expr("cast(bit_count(query ^ code) as int)").alias("distance"), F.explode("ids").alias("id"))
        if best is not None:
            met = met.union(best.join(active, "query", "left_semi").select("query", "distance", "id")).distinct()
        best = materialize(_best(met, need), "best")
        covered = config.segments * (radius + 1) - 1
        reached = best.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"))
        state = materialize(active.join(reached, "query", "left").select(
            "query", F.when(F.col("n") >= need, F.least("far", "bound")).otherwise(F.col("bound")).alias("bound")), "state")
        # A bound is the k-th distance or above it; all codes up to it have been met.
        done.append(best.join(state.where(F.col("bound") <= covered), "query", "left_semi"))
        active = state.where(F.col("bound") > covered)
        if active.isEmpty():
            break
    else:
        done.append(best.join(active, "query", "left_semi"))
    found = done[0]
    for part in done[1:]:
        found = found.union(part)
    mine = (queries.select(F.col("id").alias("query_id"), F.col("code").alias("query")).join(found, "query")
            .where("id != query_id"))
    order = Window.partitionBy("query_id", "query").orderBy("distance", "id")
    return (mine.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= config.k)
            .select("query_id", "rank", "id", "distance"))
