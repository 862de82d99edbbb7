"""Column contract and experiment settings."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

# The column contract of a transaction table.
FEATURES = ["Time"] + [f"V{i}" for i in range(1, 29)] + ["Amount"]
COMPONENTS = [f"V{i}" for i in range(1, 29)]
TARGET = "Class"
NON_NEGATIVE = ["Time", "Amount"]
ROBUST_COLUMNS = ["Time", "Amount"]
ROW_ID = "row_id"
SEED = 42

# Names used in result tables.
ALGORITHMS = ["Logistic Regression", "Decision Tree", "Random Forest"]
NEGATIVE_NAME = "Legitimate"
POSITIVE_NAME = "Potential fraud"
DUMMY_EXPERIMENT = "Always legitimate"
MIN_CLASS_ROWS = 30


@dataclass(frozen=True)
class TrainingConfig:
    """Settings of one experiment; ``validation_size`` is a share of all clean rows."""

    # The settings of the reference experiment.
    seed: int = SEED
    test_size: float = 0.20
    validation_size: float = 0.20
    selected_k: int = 20
    selection_max_rows: int | None = 60_000
    selection_method: str = "ksg"
    smote_ratio: float = 0.10
    smote_neighbors: int = 5
    cv_folds: int = 3
    tuning_iterations: int = 3
    tuning_max_rows: int | None = 60_000
    n_jobs: int = 2
    forest_trees: int = 80
    report_trees: int = 40

    def to_dict(self) -> dict:
        return asdict(self)

    def to_json(self) -> str:
        return json.dumps(self.to_dict(), sort_keys=True)
