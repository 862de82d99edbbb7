"""Near-duplicate vectors: ITQ codes, multi-index Hamming tables, reranking by cosine.

A bounded sample teaches rotations that give balanced binary codes with little quantisation
error. Vectors with one code form a cell; cells meet in tables over segments of the code, of
which one side also tries every key a few bits away. Cells near enough in Hamming distance are
compared on their original vectors, block against block, inside a task: what leaves it are
counts per vector and links enough to merge components, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareclass.llm.components import connected_components
from rareclass.llm.samples import hash_sample
from rareclass.session import materialize


@dataclass(frozen=True)
class EmbeddingConfig:
    """``sample_rows`` bounds the vectors that the rotations are learned from.

    A length of which the sample holds fewer than ``least_learned`` vectors gets random directions.
    ``radius`` is six standard deviations above the mean distance of the codes of such pairs.

    Without ``segments`` their number, and the bits that may differ within one, follow from the
    number of cells: at cosine 0.93 a bit differs with probability 0.12, and of all choices by
    which some segment is met with probability ``recall`` the one with the fewest probes and
    chance meetings is taken.
    """

    cosine: float = 0.93
    rotations: int = 2
    segments: int | None = None
    probed_bits: int = 1
    recall: float = 0.99
    radius: int = 40
    sample_rows: int = 8192
    least_learned: int = 64
    rounds: int = 50
    block: int = 256
    seed: int = 5

    @property
    def edges(self) -> list[int]:
        """First bit of every segment, and the number of bits."""
        return [64 * self.rotations * i // self.segments for i in range(self.segments + 1)]

    def sized(self, cells: int) -> EmbeddingConfig:
        if self.segments:
            return self
        differs, bits, best = math.acos(self.cosine) / math.pi, 64 * self.rotations, None
        for segments in range(bits // 32, bits // 8 + 1):
            width, met, probes = bits // segments, 0.0, 0
            for probed in range(width + 1):
                met += math.comb(width, probed) * differs ** probed * (1 - differs) ** (width - probed)
                probes += math.comb(width, probed)
                if 1 - (1 - met) ** segments >= self.recall:
                    break
            cost = segments * probes * (1 + cells / 2 ** width)
            if best is None or cost < best[0]:
                best = cost, segments, probed
        return replace(self, segments=best[1], probed_bits=best[2])


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, embedding)`` of rows that can link at all, one per id.

    From here on the vector's length is part of its label, as only equal lengths can link. Of an
    id that repeats the row with the least (label, vector) stays.
    """
    return (vectors.select(F.col("vec_id").cast("bigint"), "label", F.col("embedding").cast("array<double>"))
            .where("vec_id is not null and label is not null and embedding is not null and size(embedding) > 0")
            .where("forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
            .where("exists(embedding, x -> x <> 0)").groupBy("vec_id")
            .agg(F.min(F.struct("label", "embedding")).alias("one"))
            .select("vec_id", F.expr("struct(one.label, size(one.embedding) AS size)").alias("label"), "one.embedding"))


def _turned(x: np.ndarray, config: EmbeddingConfig) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projections) by ITQ on unit vectors of one length."""
    mean = x.mean(axis=0)
    x = x - mean
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, :64]
    low = x @ axes
    rng, parts = np.random.default_rng(config.seed), []
    for _ in range(config.rotations):
        turn = np.linalg.qr(rng.normal(size=(low.shape[1], low.shape[1])))[0]
        for _ in range(config.rounds):
            u, _, v = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
            turn = (u @ v).T
        # Vectors shorter than a code get the missing bits from random directions.
        part = rng.normal(size=(x.shape[1], 64)) / math.sqrt(x.shape[1])
        part[:, :low.shape[1]] = axes @ turn
        parts.append(part)
    return mean, np.concatenate(parts, axis=1)


def learn_rotations(vectors: DataFrame, config: EmbeddingConfig) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(mean, projections) per vector length, from a sample of at most ``sample_rows`` vectors."""
    rows = hash_sample(vectors, config.sample_rows, config.seed, "vec_id").select("embedding").toPandas()["embedding"]
    found = {}
    for size, some in rows.groupby(rows.map(len)):
        x = np.array(some.tolist())
        if len(x) >= config.least_learned:
            found[int(size)] = _turned(x / np.linalg.norm(x, axis=1, keepdims=True), config)
    return found


def _projection(size: int, learned: dict, config: EmbeddingConfig) -> tuple[np.ndarray, np.ndarray]:
    """What was learned for a length, or random directions for one that the sample hardly holds."""
    if size not in learned:
        rng = np.random.default_rng((config.seed, size))
        learned[size] = np.zeros(size), rng.normal(size=(size, 64 * config.rotations))
    return learned[size]


def encode(vectors: DataFrame, learned: dict[int, tuple[np.ndarray, np.ndarray]], config: EmbeddingConfig) -> DataFrame:
    """``(vec_id, label, vector, code)``: doubles and codes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(learned)
        for batch in batches:
            sizes = np.diff(batch.column("embedding").offsets.to_numpy())
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                x = part.column("embedding").flatten().to_numpy().reshape(-1, size)
                mean, projection = _projection(int(size), known, config)
                bits = np.packbits((x / np.linalg.norm(x, axis=1, keepdims=True) - mean) @ projection > 0, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), pa.array([r.tobytes() for r in x]),
                     pa.array([r.tobytes() for r in bits])], names=["vec_id", "label", "vector", "code"])

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id bigint, label {label}, vector binary, code binary")


def _keys(cells: DataFrame, config: EmbeddingConfig, probe: bool) -> DataFrame:
    """``(label, key, code)`` per segment; with ``probe`` also all keys up to ``probed_bits`` away."""
    edges = config.edges
    flips = [np.array([sum(1 << b for b in chosen) for r in range(config.probed_bits + 1 if probe else 1)
                       for chosen in combinations(range(high - low), r)], dtype=np.int64) for low, high in zip(edges, edges[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, (1 << 20) // sum(map(len, flips)))
            for part in (batch.slice(at, rows) for at in range(0, batch.num_rows, rows)):
                bits = np.unpackbits(np.frombuffer(b"".join(part.column("code").to_pylist()), dtype=np.uint8)
                                     .reshape(part.num_rows, -1), axis=1).astype(np.int64)
                keys = []
                for j, (low, high) in enumerate(zip(edges, edges[1:])):
                    value = bits[:, low:high] @ (1 << np.arange(high - low, dtype=np.int64))
                    keys.append((value[:, None] ^ flips[j]) | (j << 48))
                key = np.concatenate(keys, axis=1)
                at = pa.array(np.repeat(np.arange(part.num_rows), key.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("label").take(at), pa.array(key.ravel()), part.column("code").take(at)],
                    names=["label", "key", "code"])

    label = cells.schema["label"].dataType.simpleString()
    return cells.select("label", "code").mapInArrow(run, f"label {label}, key bigint, code binary")


def _near_cells(cells: DataFrame, config: EmbeddingConfig) -> DataFrame:
    """Pairs ``(label, code_u, code_v)`` of different cells within the radius, each once."""
    radius = config.radius

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            u, v = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
                    for c in ("code_u", "code_v"))
            yield batch.filter(pa.array(np.bitwise_count(u ^ v).sum(axis=1) <= radius))

    index = _keys(cells, config, False).withColumnRenamed("code", "code_u")
    probes = _keys(cells, config, True).withColumnRenamed("code", "code_v")
    label = cells.schema["label"].dataType.simpleString()
    met = index.hint("merge").join(probes, ["label", "key"]).where("code_u != code_v")
    ordered = met.select("label", F.least("code_u", "code_v").alias("code_u"), F.greatest("code_u", "code_v").alias("code_v"))
    return ordered.mapInArrow(run, f"label {label}, code_u binary, code_v binary").distinct()


def _blocks(items: DataFrame, config: EmbeddingConfig) -> DataFrame:
    """``(label, code, block, vec_id, weight, vector)``: the vectors of cells in bounded lists."""
    size = items.groupBy("label", "code").agg(F.ceil(F.count(F.lit(1)) / config.block).cast("bigint").alias("blocks"))
    return (items.join(size, ["label", "code"])
            .withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks"))
            .groupBy("label", "code", "block", "blocks")
            .agg(F.collect_list(F.struct("vec_id", "weight", "vector")).alias("items"))
            .select("label", "code", "block", "blocks", F.expr("items.vec_id").alias("vec_id"),
                    F.expr("items.weight").alias("weight"), F.expr("items.vector").alias("vector")))


def _local_roots(link: np.ndarray, same: bool) -> np.ndarray:
    """Least row (columns follow rows) that each row and column of the link matrix reaches."""
    n, m = link.shape
    rows = np.arange(n)
    columns = rows.copy() if same else n + np.arange(m)
    while True:
        new_columns = np.minimum(columns, np.where(link, rows[:, None], n + m).min(axis=0, initial=n + m))
        new_rows = np.minimum(rows, np.where(link, new_columns[None, :], n + m).min(axis=1, initial=n + m))
        if same:
            new_columns = new_rows = np.minimum(new_rows, new_columns)
        if (new_rows == rows).all() and (new_columns == columns).all():
            return rows if same else np.concatenate([rows, columns])
        rows, columns = new_rows, new_columns


def _compared(pairs: DataFrame, config: EmbeddingConfig) -> DataFrame:
    """``(u, v, n)``: ``n`` linked vectors of ``u``, and a link to ``v`` where that is not null."""
    limit = config.cosine

    def side(batch, name, row):
        ids, weight, vector = (batch.column(f"{c}_{name}")[row] for c in ("vec_id", "weight", "vector"))
        x = np.array([np.frombuffer(v, dtype=np.float64) for v in vector.as_py()])
        return ids.values.to_numpy(), weight.values.to_numpy(), x, np.linalg.norm(x, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, n = [], [], []
            for row in range(batch.num_rows):
                same = batch.column("same")[row].as_py()
                a, weight_a, x, norm_x = side(batch, "u", row)
                b, weight_b, y, norm_y = (a, weight_a, x, norm_x) if same else side(batch, "v", row)
                link = (x @ y.T) / (norm_x[:, None] * norm_y[None, :]) >= limit
                if same:
                    np.fill_diagonal(link, False)
                if not link.any():
                    continue
                ids = a if same else np.concatenate([a, b])
                count = link @ weight_b if same else np.concatenate([link @ weight_b, weight_a @ link])
                root = ids[_local_roots(link, same)]
                some = count > 0
                u.append(ids[some])
                v.append(root[some])
                n.append(count[some])
            if u:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x), pa.int64()) for x in (u, v, n)], names=["u", "v", "n"])

    return pairs.mapInArrow(run, "u bigint, v bigint, n bigint")


def near_duplicate_vectors(vectors: DataFrame, config: EmbeddingConfig = EmbeddingConfig()) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors(vec_id, embedding, label)``.

    Vectors link when their labels are equal and not null and their cosine, in double
    precision, is at least ``cosine``. A vector that is null, empty, zero, or has null or
    non-finite components links with nothing, and vectors of different lengths do not link.
    ``n_links`` counts other ids. Rows without an id have no component and are kept; an id that
    repeats counts once, by the row with the least label and vector.
    """
    valid = valid_vectors(vectors)
    coded = materialize(encode(valid, learn_rotations(valid, config), config), "coded")
    # Equal vectors are one item with a weight, named by its least id.
    items = materialize(coded.groupBy("label", "code", "vector").agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("weight")), "items")
    copies = (coded.join(items.withColumnRenamed("vec_id", "item"), ["label", "code", "vector"])
              .select("vec_id", "item", "weight"))
    blocks = materialize(_blocks(items, config), "blocks")
    cells = blocks.where("block = 0").select("label", "code")
    cells = cells.union(blocks.where("block > 0").select("label", "code")).distinct()
    cells = materialize(cells, "cells")
    near = materialize(_near_cells(cells, config.sized(cells.count())), "near-cells")
    u, v = (blocks.select("label", *[F.col(c).alias(f"{c}_{s}") for c in ("code", "block", "vec_id", "weight", "vector")])
            for s in "uv")
    columns = ["vec_id_u", "weight_u", "vector_u", "vec_id_v", "weight_v", "vector_v", "same"]
    across = near.join(u, ["label", "code_u"]).join(v, ["label", "code_v"]).withColumn("same", F.lit(False))
    within = (u.join(v, (u.label == v.label) & (u.code_u == v.code_v)).where("block_u <= block_v")
              .withColumn("same", F.expr("block_u = block_v")))
    found = materialize(_compared(across.select(*columns).union(within.select(*columns)), config), "found")
    links = found.groupBy(F.col("u").alias("item")).agg(F.sum("n").alias("n"))
    parts = connected_components(found.select("u", "v").union(
        copies.where("vec_id != item").select(F.col("vec_id").alias("u"), F.col("item").alias("v"))))
    counted = (copies.join(links, "item", "left")
               .select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    out = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    return (out.join(counted, "vec_id", "left").join(parts.withColumnRenamed("node", "vec_id"), "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.expr("vec_id = component_id"), F.lit(True))))
