"""Saved model bundles and the manifest of finished stages."""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rareclass.config import FEATURES, TrainingConfig
from rareclass.errors import ArtifactError
from rareclass.operators.features import MixedScalerModel, MutualInformationSelectorModel
from rareclass.sources.sinks import append_rows, read_json, write_json


@dataclass
class ModelBundle:
    pipeline: PipelineModel
    prefix: PipelineModel
    scaler: MixedScalerModel
    selected_features: list[str]
    metadata: dict


def stage_of(pipeline: PipelineModel, kind):
    for s in pipeline.stages:
        if isinstance(s, kind):
            return s
    raise ArtifactError(f"The saved pipeline has no {kind.__name__}.")


def _described(pipeline: PipelineModel, scaler: MixedScalerModel, selected: list[str]) -> dict[str, str]:
    """A digest of what each part of a bundle says about the model."""
    inside = stage_of(pipeline, MixedScalerModel)

    def scale(s: MixedScalerModel) -> list:
        return [list(s.getOrDefault(p)) for p in ("center", "scale")]

    told = {"inputs": pipeline.stages[0].columns(), "scaler of the model": scale(inside), "scaler": scale(scaler),
            "features of the model": stage_of(pipeline, MutualInformationSelectorModel).selected_features(),
            "features": selected}
    return {k: hashlib.sha256(json.dumps(v).encode()).hexdigest() for k, v in told.items()}


# Stands for what is being written.
_OPEN = {"unfinished": True}


def save_bundle(spark: SparkSession, pipeline: PipelineModel, metadata: dict, path: str) -> None:
    """Whole pipeline, preprocessing prefix, scaler, selected features and metadata.

    The metadata make the bundle valid: they go before any part is replaced, and come last.
    """
    write_json(spark, json.dumps(_OPEN), f"{path}/metadata")
    selected = stage_of(pipeline, MutualInformationSelectorModel).selected_features()
    scaler = stage_of(pipeline, MixedScalerModel)
    pipeline.write().overwrite().save(f"{path}/pipeline")
    PipelineModel(pipeline.stages[:-1]).write().overwrite().save(f"{path}/prefix")
    scaler.write().overwrite().save(f"{path}/scaler")
    write_json(spark, json.dumps(selected), f"{path}/selected_features")
    full = {**metadata, "raw_features": FEATURES, "selected_features": selected,
            "versions": {"spark": spark.version}, "parts": _described(pipeline, scaler, selected)}
    write_json(spark, json.dumps(full, default=str), f"{path}/metadata")


def _usable_threshold(value) -> bool:
    return type(value) in (int, float) and 0 <= value <= 1  # NaN and infinities fail the comparison


def _faults(spark: SparkSession, metadata: dict, found: dict[str, str]) -> list[str]:
    """Every check that the parts of a bundle fail."""
    saved = metadata.get("parts", {})
    checks = {
        f"it was written by Spark {metadata.get('versions', {}).get('spark')}, this is {spark.version}":
            metadata.get("versions", {}).get("spark") == spark.version,
        "its decision threshold is not a number from 0 to 1": _usable_threshold(metadata.get("threshold")),
        "its input columns are not the contract's": metadata.get("raw_features") == FEATURES,
        "its feature lists do not agree": found["features"] == found["features of the model"]
            == hashlib.sha256(json.dumps(metadata.get("selected_features")).encode()).hexdigest(),
        "its scaler is not the model's": found["scaler"] == found["scaler of the model"],
        **{f"its {name} changed after it was saved": found[name] == digest for name, digest in saved.items()},
    }
    return [text for text, passed in checks.items() if not passed]


def load_bundle(spark: SparkSession, path: str) -> ModelBundle:
    """Read all parts, then report every way in which they do not fit together."""
    try:
        metadata = json.loads(read_json(spark, f"{path}/metadata"))
        if metadata == _OPEN:
            raise ArtifactError(f"The bundle under {path} is incomplete: it was not written to its end.")
        selected = json.loads(read_json(spark, f"{path}/selected_features"))
        pipeline, prefix = (PipelineModel.load(f"{path}/{n}") for n in ("pipeline", "prefix"))
        scaler = MixedScalerModel.load(f"{path}/scaler")
        faults = _faults(spark, metadata, _described(pipeline, scaler, selected))
    except ArtifactError:
        raise
    except Exception as exc:  # a part is absent, or is not what its name says
        kind = "incomplete" if isinstance(exc, AnalysisException) else "unreadable"
        raise ArtifactError(f"The bundle under {path} is {kind}: {str(exc).splitlines()[0][:200]}") from exc
    if faults:
        raise ArtifactError(f"The bundle under {path} cannot be used: {'; '.join(faults)}.")
    return ModelBundle(pipeline, prefix, scaler, selected, metadata)


MANIFEST_SCHEMA = "stage string, config string, digest string, payload string, step bigint, state string, token string"


class Manifest:
    """Stages as rows ``(stage, config, digest, payload)``; of a stage the latest generation counts.

    A row is one file, which is there as a whole or not at all. A stage that replaces tables in
    place says so before its first write (``begin``) and again after its last (``record``): a
    run that is killed between leaves an open generation, and its tables count as nobody's.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path}/manifest"

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST_SCHEMA).parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)

    def _newest(self, rows: DataFrame):
        """Two writers may take one number; the token then tells which of them counts, for all readers alike."""
        return rows.orderBy(F.desc("step"), F.desc("token")).first()

    def latest(self, stage: str):
        return self._newest(self.rows().where(F.col("stage") == stage))

    def finished(self, stage: str, config: TrainingConfig, digest: str) -> dict | None:
        """Payload of the stage if it was finished with this configuration and data."""
        mine = (F.col("config") == config.to_json()) & (F.col("digest") == digest) & (F.col("state") == "done")
        row = self._newest(self.rows().where(F.col("stage") == stage).where(mine))
        return None if row is None else json.loads(row["payload"])

    def current(self, stage: str, config: TrainingConfig, digest: str) -> bool:
        """Whether the stage's tables in the folder are whole, and those of this configuration and data."""
        row = self.latest(stage)
        return row is not None and (row["config"], row["digest"], row["state"]) == (config.to_json(), digest, "done")

    def require(self, stage: str, config: TrainingConfig, digest: str) -> dict | None:
        """As :meth:`finished`, but a record of other data or settings is an error."""
        found = self.finished(stage, config, digest)
        if found is None and self.latest(stage) is not None:
            raise ArtifactError(f"The saved stage '{stage}' does not match this dataset or configuration.")
        return found

    def begin(self, stage: str, config: TrainingConfig, digest: str) -> None:
        """The stage's tables are about to be replaced."""
        self._append(stage, config, digest, {}, "open")

    def record(self, stage: str, config: TrainingConfig, digest: str, payload: dict) -> None:
        self._append(stage, config, digest, payload, "done")

    def _append(self, stage: str, config: TrainingConfig, digest: str, payload: dict, state: str) -> None:
        step = (self.rows().agg(F.max("step")).first()[0] or 0) + 1
        row = (stage, config.to_json(), digest, json.dumps(payload, default=str), step, state, uuid.uuid4().hex)
        append_rows(self.spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1), self.path)
