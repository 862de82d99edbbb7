"""Small synthetic tables in the shape of the contract."""

from __future__ import annotations

import numpy as np
import pandas as pd

from rareclass.config import COMPONENTS, FEATURES, TARGET


def transactions_frame(rows: int = 600, positives: int = 60, seed: int = 42) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    df = pd.DataFrame(rng.normal(size=(rows, 28)), columns=COMPONENTS)
    df.insert(0, "Time", np.arange(rows, dtype=float))
    df["Amount"] = rng.uniform(0, 1000, rows)
    df[TARGET] = [0] * (rows - positives) + [1] * positives
    return df[[*FEATURES, TARGET]]


def training_frame() -> pd.DataFrame:
    df = transactions_frame(500, 50)
    df["Time"] = np.random.default_rng(1).uniform(0, 1000, 500)
    df["Amount"] = np.random.default_rng(2).uniform(0, 100, 500)
    df.loc[df[TARGET] == 1, "V14"] -= 3
    return df


def with_ids(spark, frame: pd.DataFrame):
    data = frame.copy()
    data.insert(0, "row_id", np.arange(len(data), dtype="int64"))
    return spark.createDataFrame(data.astype({TARGET: "int32"}))


def as_text(spark, frame: pd.DataFrame):
    """All columns as text, the way a CSV reader delivers them."""
    texts = frame.astype(object).map(lambda v: None if v is None or v != v else str(v))
    return spark.createDataFrame(texts, ", ".join(f"`{c}` string" for c in frame.columns))
