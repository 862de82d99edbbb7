"""Many penalised logistic regressions on one table, fitted side by side.

Newton's method for all candidates at once: a pass over the rows multiplies every Arrow batch
with the stacked weights of all candidates and sums losses, gradients and curvatures, which a
grouped sum brings to the driver as a few numbers per candidate. A candidate whose step does
not lower its loss halves the step in the next pass; one that has settled drops out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareclass.config import TARGET

MAX_PASSES = 200


@dataclass
class _Fit:
    """A candidate's accepted weights with their loss, and the step that is being tried."""

    penalty: np.ndarray
    tol: float
    weights: np.ndarray
    step: np.ndarray
    loss: float = np.inf
    slope: float = 0.0
    scale: float = 1.0
    settled: bool = False

    @property
    def trial(self) -> np.ndarray:
        return self.weights - self.scale * self.step

    def take(self, loss: float, gradient: np.ndarray, curvature: np.ndarray) -> None:
        """The mean loss at the trial with its derivatives; accept it or shorten the step."""
        at = self.trial
        loss += 0.5 * float(self.penalty @ (at * at))
        if loss > self.loss - 1e-4 * self.scale * self.slope and self.scale > 1e-9:
            self.scale /= 2
            return
        self.settled = bool(self.loss - loss <= self.tol * 1e-3 * max(loss, 1e-300)) or self.scale <= 1e-9
        gradient = gradient + self.penalty * at
        self.weights, self.loss, self.scale = at, loss, 1.0
        self.step = np.linalg.lstsq(curvature + np.diag(self.penalty), gradient, rcond=None)[0]
        self.slope = float(gradient @ self.step)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
    return np.concatenate([x, np.ones((batch.num_rows, 1))], axis=1)


def _sums(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Per candidate the sums of loss, gradient and curvature over all rows, as one row of numbers."""
    size = weights.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(weights), 1 + size + size * size))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _matrix(batch), batch.column("y").to_numpy()
            margin = x @ weights.T
            p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            total[:, 0] += (np.logaddexp(0, margin) - y[:, None] * margin).sum(axis=0)
            total[:, 1:1 + size] += (p - y[:, None]).T @ x
            for i, w in enumerate((p * (1 - p)).T):
                total[i, 1 + size:] += (x.T @ (x * w[:, None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "value"])

    found = rows.mapInArrow(run, "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value")).toPandas()
    out = np.zeros(len(weights) * (1 + size + size * size))
    out[found["place"]] = found["value"]
    return out.reshape(len(weights), -1)


def fit_together(rows: DataFrame, candidates: list[dict], label: str = TARGET) -> np.ndarray:
    """Weights of all ``candidates`` (``C`` and ``tol``) on ``rows(features, label)``, intercepts last.

    A candidate minimises the mean logistic loss plus ``|w|**2 / (2 * C * rows)``, intercept
    left out, as the library's single fit does, and settles when a step lowers the loss by
    less than a thousandth of ``tol``, relatively.
    """
    rows = rows.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"))
    n, size = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    fits = [_Fit(np.array([1 / (q["C"] * n)] * size + [0.0]), q["tol"], np.zeros(size + 1), np.zeros(size + 1)) for q in candidates]
    for _ in range(MAX_PASSES):
        active = [f for f in fits if not f.settled]
        if not active:
            return np.array([f.weights for f in fits])
        sums = _sums(rows, np.array([f.trial for f in active])) / n
        for f, row in zip(active, sums):
            f.take(row[0], row[1:2 + size], row[2 + size:].reshape(size + 1, size + 1))
    raise RuntimeError(f"Logistic regressions did not settle in {MAX_PASSES} passes.")


def scores_together(df: DataFrame, weights: np.ndarray, names: list[str], keep: list[str]) -> DataFrame:
    """``(experiment, *keep, score)``: P(class 1) of every row under every candidate."""
    source = df.select(*keep, vector_to_array("features").alias("x"))
    kept = source.drop("x").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            p = 1 / (1 + np.exp(-np.clip(_matrix(batch) @ weights.T, -700, 700)))
            for i, name in enumerate(names):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * batch.num_rows), *[batch.column(c) for c in keep], pa.array(np.ascontiguousarray(p[:, i]))],
                    names=["experiment", *keep, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    return source.mapInArrow(run, f"experiment string, {fields}, score double")
