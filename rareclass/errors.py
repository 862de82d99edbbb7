"""Readable errors; each names the columns or values that caused it."""


class DatasetError(ValueError):
    """A labelled table does not meet the training contract."""


class PredictionError(ValueError):
    """Rows or parameters cannot be scored."""


class ArtifactError(RuntimeError):
    """Saved model artifacts are missing or disagree."""
