"""Toxic texts: a linear classifier on character n-grams, scaled by naive Bayes ratios.

A text is the set of its distinct words; a feature counts in how many of them an n-gram of
characters occurs, word ends included. Counts are multiplied by the n-gram's log-count ratio
between the two classes, and a logistic regression is fitted on the products. As the score is
a sum over distinct words, every distinct word of a piece of the table is scored once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareclass.llm.samples import hash_sample
from rareclass.llm.words import RangeHash, Words, kept_and_text, pieces, words
from rareclass.llm.workers import bound_batches, release
from rareclass.session import materialize


@dataclass(frozen=True)
class ToxicityConfig:
    """``max_rows`` bounds the labelled rows of a fit; larger label tables are sampled by hash, class by
    class, so that a rare class gives up to half of the rows.

    The regression takes the ``fitted_features`` n-grams whose log-count ratio stands out most
    for how often they occur. Its penalty is on absolute weights: most n-grams get none, so that
    a long text gathers no score from thousands of small ones.
    """

    shortest: int = 3
    longest: int = 5
    bits: int = 17
    smoothing: float = 1.0
    fitted_features: int = 8192
    regularisation: float = 2e-4
    iterations: int = 40
    max_rows: int = 10_000
    seed: int = 11

    @property
    def dimension(self) -> int:
        return 1 << self.bits


@dataclass(frozen=True)
class ToxicityModel:
    """``score = sigmoid(bias + sum of weights)``; a model has ``dimension`` weights, at most a few MB."""

    config: ToxicityConfig
    weights: np.ndarray
    bias: float


def _distinct(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of the piece (one place each), and the (text, word) pairs, each once."""
    _, at, code = np.unique(w.hash, return_index=True, return_inverse=True)
    pairs = np.unique(w.doc.astype(np.int64) * len(at) + code) if len(at) else np.zeros(0, dtype=np.int64)
    return at, pairs // max(1, len(at)), pairs % max(1, len(at))


def word_grams(w: Words, at: np.ndarray, config: ToxicityConfig) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) for every n-gram of the words at the given places."""
    data = w.data.tobytes()
    text = " " + " ".join(data[w.start[i]:w.end[i]].decode() for i in at) + " "
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    space = np.concatenate([[0], np.cumsum(codes == 32)])
    hashes = RangeHash(codes.astype(np.uint64) + np.uint64(1))
    of, feature = [], []
    for n in range(config.shortest, config.longest + 1):
        start = np.arange(max(0, len(codes) - n + 1))
        start = start[space[start + n - 1] == space[start + 1]]  # only its ends may be spaces
        of.append(space[start + 1] - 1)
        feature.append(hashes(start, start + n) >> np.uint64(64 - config.bits))
    return np.concatenate(of), np.concatenate(feature).astype(np.int64)


def features(docs: DataFrame, config: ToxicityConfig) -> DataFrame:
    """``(toxic, places, counts)``: the sparse features of each row of ``docs(toxic, text)``."""

    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for piece in pieces(batches, "text"):
            w = words(piece.column("text"), lower=True)
            at, text, word = _distinct(w)
            of, feature = word_grams(w, at, config)
            order = np.argsort(of, kind="stable")
            feature, first = feature[order], np.searchsorted(of[order], np.arange(len(at) + 1))
            places, counts = [], []
            edges = np.searchsorted(text, np.arange(piece.num_rows + 1))
            for i in range(piece.num_rows):
                own = [feature[first[x]:first[x + 1]] for x in word[edges[i]:edges[i + 1]]]
                place, count = np.unique(np.concatenate(own) if own else feature[:0], return_counts=True)
                places.append(place)
                counts.append(count.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [piece.column("toxic"), pa.array(places, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.float64()))],
                names=["toxic", "places", "counts"])

    return docs.select(F.col("toxic").cast("int"), F.col("text").cast("string")).mapInArrow(
        run, "toxic int, places array<bigint>, counts array<double>")


def training_rows(docs: DataFrame, labels: DataFrame, config: ToxicityConfig) -> DataFrame:
    """``(toxic, text)`` of at most ``max_rows`` labelled documents, least hashes first."""
    known = (labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    known = materialize(known.join(ids, "doc_id").where("toxic in (0, 1)"), "toxic-labels")
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    half = config.max_rows // 2
    shares = {c: min(counts.get(c, 0), max(half, config.max_rows - counts.get(1 - c, 0))) for c in (0, 1)}
    chosen = None
    for c, n in shares.items():
        part = hash_sample(known.where(F.col("toxic") == c), n, config.seed, "doc_id") if n else known.where("false")
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The sample has max_rows rows of two numbers at most; of an id that repeats the least text counts.
    return (texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
            .agg(F.first("toxic").alias("toxic"), F.min(F.coalesce("text", F.lit(""))).alias("text")).select("toxic", "text"))


def fit(rows: DataFrame, config: ToxicityConfig = ToxicityConfig()) -> ToxicityModel:
    """A model of ``rows(toxic, text)``. With one class or no rows it gives that class's rate."""
    seen = materialize(features(rows, config), "toxic-features")
    totals = {r["toxic"]: r["n"] for r in seen.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(totals.get(0, 0), totals.get(1, 0)) == 0:
        rate = (totals.get(1, 0) + config.smoothing) / (sum(totals.values()) + 2 * config.smoothing)
        return ToxicityModel(config, np.zeros(config.dimension), float(np.log(rate / (1 - rate))))
    sums = (seen.select("toxic", F.explode(F.arrays_zip("places", "counts")).alias("x"))
            .groupBy(F.col("x.places").alias("place")).agg(
                F.sum(F.when(F.col("toxic") == 1, F.col("x.counts"))).alias("p"),
                F.sum(F.when(F.col("toxic") == 0, F.col("x.counts"))).alias("q")).toPandas())  # one row per feature
    count = np.full((2, config.dimension), config.smoothing)
    count[0, sums["place"]] += sums["p"].fillna(0)
    count[1, sums["place"]] += sums["q"].fillna(0)
    ratio = np.log(count[0] / count[0].sum()) - np.log(count[1] / count[1].sum())
    chosen = np.argsort(-np.abs(ratio) * np.sqrt(count.sum(axis=0)), kind="stable")[:config.fitted_features]
    chosen.sort()
    slot = np.full(config.dimension, -1, dtype=np.int32)
    slot[chosen] = np.arange(len(chosen))
    kept, size = ratio[chosen], len(chosen)

    @F.udf(VectorUDT())
    def scaled(places, counts):
        at = slot[places]
        inside = at >= 0
        return Vectors.sparse(size, at[inside], kept[at[inside]] * np.array(counts)[inside])

    # Written once, so that no iteration calls Python again.
    vectors = materialize(seen.select(F.col("toxic").cast("double").alias("label"),
                                      scaled("places", "counts").alias("features")), "toxic-vectors")
    fitted = LogisticRegression(maxIter=config.iterations, regParam=config.regularisation, elasticNetParam=1.0,
                                standardization=False).fit(vectors)
    weights = np.zeros(config.dimension)
    weights[chosen] = fitted.coefficients.toArray() * kept
    return ToxicityModel(config, weights, float(fitted.intercept))


def score(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """The columns in ``keep`` and ``score`` (0 to 1) for every row; null texts are empty."""
    bound_batches(docs.sparkSession)
    source, names = kept_and_text(docs, keep)
    weights, bias, config = model.weights.astype(np.float64), model.bias, model.config

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for piece in pieces(batches, "text"):
            w = words(piece.column("text"), lower=True)
            at, text, word = _distinct(w)
            of, feature = word_grams(w, at, config)
            each = np.bincount(of, weights=weights[feature], minlength=len(at))
            total = bias + np.bincount(text, weights=each[word], minlength=piece.num_rows)
            yield pa.RecordBatch.from_arrays(
                [piece.column(c) for c in names] + [pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))],
                names=[*names, "score"])

    out = source.select(*names).schema.add("score", "double")
    return source.mapInArrow(run, out).select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "score")


def held_out(doc_id) -> F.col:
    """Whether a document's label is kept out of every fit."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, config: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs(doc_id, text)``.

    The model learns from labels of documents that are not held out. Null and empty texts get
    the score of no words. Without labels of both classes the score is one rate for all rows.
    Rows with a null id are scored and never learned from; of rows that repeat an id the least
    text is learned from. Labels other than 0 and 1 teach nothing.
    """
    known = labels.where(~held_out(F.col("doc_id")))
    model = fit(training_rows(docs, known, config), config)
    return (score(docs, model, ["doc_id"]).withColumn("held_out", held_out(F.col("doc_id")))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
            .select(F.col("doc_id").cast("bigint"), "held_out", "score", "predicted"))
