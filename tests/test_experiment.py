import json
import os
from dataclasses import replace

import numpy as np
import pytest
from fixtures import as_text, transactions_frame, with_ids
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from rareclass.config import FEATURES, TARGET, TrainingConfig
from rareclass.errors import ArtifactError, DatasetError, PredictionError
from rareclass.operators import compare, features, models, score
from rareclass.plans import experiment
from rareclass.sources import registry
from rareclass.sources.registry import Manifest, load_bundle, save_bundle
from rareclass.sources.sinks import read_json, read_members, write_json, write_scored

CONFIG = TrainingConfig(selected_k=6, selection_method="binned", forest_trees=3, report_trees=3, tuning_iterations=1,
                        cv_folds=2, tuning_max_rows=None, smote_ratio=0.5)


def signal_frame():
    frame = transactions_frame(600, 60)
    frame.loc[frame[TARGET] == 1, ["V14", "V4"]] += 2.5
    return frame


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("run"))
    frame = signal_frame()
    raw = as_text(spark, frame.iloc[[*range(600), 0, 1]])
    return folder, raw, experiment.run_training(spark, raw, folder, CONFIG)


def test_comparison_has_all_rows_and_the_choice_follows_validation(spark, run):
    folder, _, meta = run
    table = spark.read.option("header", True).csv(f"{folder}/model_comparison")
    assert table.columns == compare.COMPARISON_COLUMNS
    assert table.count() == 28
    rows = table.where("partition = 'validation' and stage in ('baseline', 'tuned')").collect()
    best = sorted(rows, key=lambda r: (-float(r["average_precision"]), -float(r["f1"]), r["experiment"]))[0]
    assert len(rows) == 12 and best["experiment"] == meta["experiment"]
    assert table.where("imbalance = 'None'").count() > 0
    dummy = table.where("stage = 'reference'").collect()
    assert len(dummy) == 2 and all(r["train_f1"] is None and float(r["recall"]) == 0 for r in dummy)
    frozen = table.where("stage = 'selected threshold' and partition = 'test'").first()
    assert float(frozen["threshold"]) == meta["threshold"]
    assert float(frozen["f1"]) == pytest.approx(meta["final_test_metrics"]["f1"])
    assert float(best["average_precision"]) > 0.5


def test_written_tables(spark, run):
    folder, _, _ = run
    audit = spark.read.json(f"{folder}/audit").first()
    assert (audit["raw_rows"], audit["clean_rows"], audit["duplicates_removed"]) == (602, 600, 2)
    members = read_members(spark, f"{folder}/members")
    assert members.count() == members.select("row_id").distinct().count() == 600
    assert spark.read.option("header", True).csv(f"{folder}/before_after_tuning").count() == 6
    assert spark.read.option("header", True).csv(f"{folder}/tuning_summary").count() == 6
    assert spark.read.option("header", True).csv(f"{folder}/feature_selection").count() == 30
    assert spark.read.option("header", True).csv(f"{folder}/examples").count() == 6
    importance = spark.read.option("header", True).csv(f"{folder}/feature_importance")
    assert sum(float(r["importance"]) for r in importance.collect()) == pytest.approx(1)


def test_bundle_scores_raw_rows_alone_and_in_a_batch(spark, run):
    folder, _, meta = run
    bundle = load_bundle(spark, f"{folder}/bundle")
    assert bundle.selected_features == meta.get("selected_features", bundle.selected_features)
    raw = spark.read.option("header", True).csv(f"{folder}/examples").withColumn("note", F.lit("kept"))
    full = {r["V1"]: r for r in score.predict(raw, bundle).collect()}
    assert len(full) == 6
    for v, r in list(full.items())[:2]:
        one = score.predict(raw.where(F.col("V1") == v), bundle).first()
        assert one["fraud_probability"] == pytest.approx(r["fraud_probability"], abs=1e-12)
        assert r["note"] == "kept" and r["predicted_class"] == int(r["fraud_probability"] >= bundle.metadata["threshold"])
    everything = score.predict(raw, bundle, threshold=0.0).collect()
    assert {r["prediction"] for r in everything} == {"Potential fraud"}
    with pytest.raises(PredictionError, match="threshold"):
        score.predict(raw, bundle, threshold=1.5)
    with pytest.raises(PredictionError, match="finite value in V2"):
        score.predict(raw.withColumn("V2", F.lit(None).cast("string")), bundle)
    twice = score.predict(score.predict(raw, bundle), bundle)
    assert twice.columns == score.predict(raw, bundle).columns and twice.count() == 6
    write_scored(twice, f"{folder}/scored_batch")
    back = spark.read.option("header", True).csv(f"{folder}/scored_batch")
    assert back.columns[:4] == score.RESULT_COLUMNS and back.count() == 6
    good, bad = score.predict_or_reject(raw.withColumn("V2", F.when(F.col("Class") == 1, F.col("V2"))), bundle)
    assert (good.count(), bad.count()) == (3, 3)


def tables(spark, folder):
    names = ["model_comparison", "before_after_tuning", "tuning_candidates", "threshold_analysis", "examples"]
    read = lambda n: (spark.read.parquet if n == "threshold_analysis" else spark.read.option("header", True).csv)(f"{folder}/{n}")
    return {n: sorted(map(str, read(n).drop("fit_seconds", "search_seconds", "refit_seconds").collect())) for n in names}


def test_a_continued_run_and_other_settings_give_the_same_tables(spark, run):
    folder, raw, meta = run
    first = tables(spark, folder)
    assert len(meta["final_test_metrics"]) == len(meta["default_threshold_test_metrics"]) == 14
    assert meta["audit"]["duplicates_removed"] == 2
    again = experiment.run_training(spark, raw, folder, CONFIG, resume_baselines=True)
    assert tables(spark, folder) == first and again["final_test_metrics"] == meta["final_test_metrics"]
    # The same fits, four at once, in the folder of a run with other settings.
    wide = replace(CONFIG, n_jobs=4)
    p = experiment.prepare(spark, raw, folder, wide)
    frames = experiment.shared_frames(p.part("train").drop("partition"), {"validation": p.part("validation").drop("partition")}, wide)
    told = lambda rows: sorted(str({k: v for k, v in r.items() if k != "fit_seconds"}) for r in rows)
    done = Manifest(spark, folder).finished("baselines", CONFIG, p.digest)
    assert told(experiment.run_baselines(p, frames)) == told(done["rows"])
    assert p.scores([r["experiment"] for r in done["rows"]], ["fit"]).count() == 6 * 480


def test_resume_needs_the_same_data_and_settings(spark, run):
    folder, raw, _ = run
    p = experiment.prepare(spark, raw, folder, CONFIG)
    manifest = Manifest(spark, folder)
    done = manifest.require("baselines", CONFIG, p.digest)
    assert len(done["rows"]) == 6
    with pytest.raises(ArtifactError, match="does not match"):
        manifest.require("baselines", TrainingConfig(), p.digest)
    assert not manifest.current("prepare", CONFIG, "other") and manifest.require("unknown", CONFIG, "x") is None


def test_test_rows_are_scored_only_after_the_choice(spark, run, tmp_path):
    folder, raw, _ = run
    p = experiment.prepare(spark, raw, folder, CONFIG)
    fresh = experiment.Prepared(spark, str(tmp_path), CONFIG, p.digest, p.split)
    with pytest.raises(DatasetError, match="Freeze"):
        experiment.score_test(fresh, [])


def test_bundle_guards(spark, tmp_path):
    df = with_ids(spark, signal_frame())
    prefix = Pipeline(stages=features.preprocessing_stages(CONFIG)).fit(df)
    clf = models.fit_classifier(models.training_rows(prefix.transform(df), False, CONFIG), "Decision Tree",
                                models.default_params("Decision Tree", CONFIG), 42)
    path = str(tmp_path / "bundle")
    with pytest.raises(ArtifactError, match="incomplete"):
        load_bundle(spark, path)
    save_bundle(spark, models.assemble(prefix, clf), {"threshold": 0.4}, path)
    assert load_bundle(spark, path).metadata["threshold"] == 0.4
    meta = json.loads(read_json(spark, f"{path}/metadata"))
    for change, message in [({"threshold": 1.4}, "threshold"), ({"threshold": True}, "threshold"),
                            ({"versions": {"spark": "0"}}, "Spark 0"), ({"selected_features": ["V1"]}, "do not agree"),
                            ({"raw_features": FEATURES[:-1]}, "contract"),
                            ({"threshold": None, "raw_features": []}, "threshold.*contract")]:
        write_json(spark, json.dumps({**meta, **change}), f"{path}/metadata")
        with pytest.raises(ArtifactError, match=message):
            load_bundle(spark, path)


class Killed(RuntimeError):
    pass


def killed_at(monkeypatch, name, n=1, module=experiment):
    """The ``n``-th call of a writer ends the run."""
    write, calls = getattr(module, name), []

    def once(*args, **kw):
        calls.append(1)
        if len(calls) == n:
            raise Killed(name)
        return write(*args, **kw)

    monkeypatch.setattr(module, name, once)


@pytest.mark.parametrize("writer, n", [("write_table", 2), ("write_records", 1), ("write_members", 1), ("write_csv", 2)])
def test_a_run_killed_between_two_tables_is_made_again(spark, tmp_path, writer, n):
    folder, raw = str(tmp_path / "run"), as_text(spark, signal_frame())
    first = experiment.prepare(spark, raw, folder, CONFIG)
    names = ["audit", "members", "split"]
    read = lambda: [sorted(map(str, (spark.read.json if x == "audit" else spark.read.parquet)(f"{folder}/{x}").collect())) for x in names]
    before = read()
    with pytest.MonkeyPatch.context() as patch:  # other settings replace some of the tables
        killed_at(patch, writer, n)
        with pytest.raises(Killed):
            experiment.prepare(spark, raw, folder, replace(CONFIG, seed=7))
    manifest = Manifest(spark, folder)
    assert not manifest.current("prepare", CONFIG, first.digest)
    assert manifest.finished("prepare", CONFIG, first.digest) == {"rows": 600}
    experiment.prepare(spark, raw, folder, CONFIG)
    assert read() == before and manifest.current("prepare", CONFIG, first.digest)


def test_a_fit_or_bundle_killed_half_way_is_not_used(spark, run, tmp_path):
    folder, raw, _ = run
    p = experiment.prepare(spark, raw, folder, CONFIG)
    p = experiment.Prepared(spark, str(tmp_path), CONFIG, p.digest, p.split)
    frames = experiment.shared_frames(p.part("train").drop("partition"), {"validation": p.part("validation").drop("partition")}, CONFIG)
    fit = lambda resume: experiment._fit_and_describe(
        p, frames, "Decision Tree", False, "baseline", models.default_params("Decision Tree", CONFIG), resume)
    done = fit(False)
    with pytest.MonkeyPatch.context() as patch:
        killed_at(patch, "write_table")
        with pytest.raises(Killed):
            fit(False)
    name = models.experiment_key("Decision Tree", False, "baseline")
    assert experiment.finished_fit(p, name) is None
    told = lambda r: {k: v for k, v in r.items() if k != "fit_seconds"}
    assert told(fit(True)) == told(done) and told(experiment.finished_fit(p, name)) == told(done)
    clf = models.fit_classifier(frames.fit_rows[False], "Decision Tree", models.default_params("Decision Tree", CONFIG), 42)
    path, model = str(tmp_path / "bundle"), models.assemble(frames.prefix, clf)
    save_bundle(spark, model, {"threshold": 0.4}, path)
    with pytest.MonkeyPatch.context() as patch:
        killed_at(patch, "write_json", 2, registry)
        with pytest.raises(Killed):
            save_bundle(spark, model, {"threshold": 0.6}, path)
    with pytest.raises(ArtifactError, match="incomplete"):
        load_bundle(spark, path)
    save_bundle(spark, model, {"threshold": 0.6}, path)
    assert load_bundle(spark, path).metadata["threshold"] == 0.6


def test_writers_with_one_number_are_told_apart(spark, tmp_path):
    one = Manifest(spark, str(tmp_path))
    one.record("s", CONFIG, "d", {"n": 1})
    row = one.rows().first()
    twin = (*row[:3], '{"n": 2}', row["step"], "done", "0" * 32)
    spark.createDataFrame([twin], one.rows().schema).coalesce(1).write.mode("append").parquet(one.path)
    assert {Manifest(spark, str(tmp_path)).finished("s", CONFIG, "d")["n"] for _ in range(3)} == {1}
    one.begin("s", CONFIG, "d")
    assert not one.current("s", CONFIG, "d") and one.finished("s", CONFIG, "d") == {"n": 1}


def test_settings_are_checked():
    for bad in (TrainingConfig(tuning_iterations=0), TrainingConfig(tuning_max_rows=500), TrainingConfig(n_jobs=0)):
        with pytest.raises(DatasetError):
            experiment.check_config(bad)


def test_held_out_rows_do_not_move_the_fit(spark):
    df = with_ids(spark, signal_frame())
    moved = df.withColumn("Amount", F.when(F.col("row_id") % 2 == 1, F.lit(1e9)).otherwise(F.col("Amount")))
    fits = [features.MixedScaler().fit(d.where("row_id % 2 = 0")) for d in (df, moved)]
    assert np.array_equal(*[f.getOrDefault("center") for f in fits])


def test_forests_keep_the_node_of_each_row():
    forest = models.make_classifier("Random Forest", models.default_params("Random Forest", CONFIG), 0, 1)
    assert forest.getCacheNodeIds()


def test_folders_of_parallel_jobs_belong_to_the_caller(spark):
    from rareclass import session
    from rareclass.plans.experiment import _parallel

    with session.scratch(spark):
        kept = _parallel(spark, 2, [lambda i=i: session.materialize(spark.range(i), "parallel").inputFiles()[0] for i in (3, 4)])
        assert all(os.path.exists(f.removeprefix("file://")) for f in kept)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in kept)


def test_training_rows_are_kept_once(spark):
    """The fit rows with and without SMOTE read the prepared rows; only synthetic rows are kept beside them."""
    from rareclass.plans.experiment import shared_frames

    df = with_ids(spark, transactions_frame(500, 50))
    frames = shared_frames(df, {}, CONFIG)
    assert frames.parts["train"].storageLevel.useMemory and frames.synthetic.storageLevel.useMemory
    assert not any(f.storageLevel.useMemory for f in frames.fit_rows.values())
    assert frames.fit_rows[True].count() == df.count() + frames.synthetic.count() > frames.fit_rows[False].count() == df.count()
    frames.release()
