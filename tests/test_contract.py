import os

import numpy as np
import pytest
from fixtures import as_text, transactions_frame
from pyspark.sql import functions as F

from rareclass.config import FEATURES
from rareclass.errors import DatasetError, PredictionError
from rareclass.operators import audit, contract
from rareclass.sources.sinks import write_csv
from rareclass.sources.transactions import load_scoring, load_training, malformed_rows, read_results, read_text_csv


def test_good_table_passes_and_is_typed(spark, tmp_path):
    path = str(tmp_path / "tx.csv")
    transactions_frame().to_csv(path, index=False)
    df = load_training(spark, path)
    assert df.columns == [*FEATURES, "Class"]
    assert dict(df.dtypes)["Class"] == "tinyint" and dict(df.dtypes)["V1"] == "double"
    assert df.count() == 600


@pytest.mark.parametrize("change, message", [
    (lambda d: d.assign(V3=["abc"] + [1.0] * 599), "no number in V3"),
    (lambda d: d.assign(V3=["1.5f"] + [1.0] * 599), "no number in V3"),
    (lambda d: d.assign(Class=[2] + d["Class"].tolist()[1:]), "other than 0 and 1 in Class"),
    (lambda d: d.assign(Class=[None] + d["Class"].tolist()[1:]), "without a label"),
    (lambda d: d.assign(V4=[np.inf] + [0.5] * 599), "Infinity among the values of V4"),
    (lambda d: d.assign(Amount=[-1.0] + [1.0] * 599), "below zero in Amount"),
    (lambda d: d.assign(Time=[-1.0] + [1.0] * 599), "below zero in Time"),
    (lambda d: d.assign(V5=[None] * 600), "Not a single value in V5"),
    (lambda d: d.drop(columns=["V28"]), "lacks 1 required columns: V28"),
])
def test_broken_training_tables_are_named(spark, change, message):
    with pytest.raises(DatasetError, match=message):
        contract.validate_training(as_text(spark, change(transactions_frame())))


def test_too_few_positives(spark):
    with pytest.raises(DatasetError, match="Class=1"):
        contract.validate_training(as_text(spark, transactions_frame(600, 29)))


def test_missing_values_are_allowed_in_training_only(spark):
    frame = transactions_frame()
    frame.loc[4, "V2"] = np.nan
    contract.validate_training(as_text(spark, frame))
    with pytest.raises(PredictionError, match="finite value in V2"):
        contract.validate_scoring(as_text(spark, frame))


def test_missing_tokens_are_missing_and_not_bad(spark):
    row = {c: "1" for c in FEATURES} | {"V1": "N/A", "V2": " nan ", "V3": "None", "V4": "1e3", "V5": "+.5"}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    got = {r["column_name"]: r for r in contract.scoring_violations(df).collect()}
    assert set(got) == {"V1", "V2", "V3"} and all(r["not_numeric"] == 0 for r in got.values())
    assert contract.project(df, with_label=False).first()["V4"] == 1000.0


def test_files_that_cannot_be_read(spark, tmp_path):
    with pytest.raises(DatasetError, match="Cannot read"):
        load_training(spark, str(tmp_path / "absent.csv"))
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    with pytest.raises(PredictionError, match="Cannot read CSV"):
        load_scoring(spark, str(empty))
    repeated = tmp_path / "repeated.csv"
    repeated.write_text("Time,Time,V1\n1,2,3\n")
    with pytest.raises(PredictionError, match="more than once: Time"):
        read_text_csv(spark, str(repeated), PredictionError)
    short = tmp_path / "short.csv"
    short.write_text("Amount\n10\n")
    with pytest.raises(PredictionError, match="lacks 29 required"):
        load_scoring(spark, str(short))
    header = tmp_path / "header.csv"
    header.write_text(",".join(FEATURES) + "\n")
    with pytest.raises(PredictionError, match="batch to score is empty"):
        load_scoring(spark, str(header))


def test_a_csv_with_an_index_column(spark, tmp_path):
    path = str(tmp_path / "indexed.csv")
    transactions_frame().to_csv(path)  # the header begins with an empty name
    df = load_training(spark, path)
    assert df.columns == [*FEATURES, "Class"] and df.count() == 600
    assert load_scoring(spark, path).count() == 600


def test_records_that_do_not_fit_the_header(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text('a,b,c\n1,2,3\n4,5\n"x, y",2,\n6,7,8,9\n"p, q",1,2,3\n')
    told = {r["record"]: (r["fields"], r["expected"], r["reason"]) for r in malformed_rows(spark, str(path)).collect()}
    assert told == {"4,5": (2, 3, "too_few_fields"), "6,7,8,9": (4, 3, "too_many_fields"), '"p, q",1,2,3': (4, 3, "too_many_fields")}
    with pytest.raises(DatasetError, match="2 records have more than the 3 fields"):
        read_text_csv(spark, str(path))
    path.write_text('a,b,c\n1,2,3\n4,5\n')  # what a short record lacks is missing
    assert [tuple(r) for r in read_text_csv(spark, str(path)).collect()] == [("1", "2", "3"), ("4", "5", None)]
    assert malformed_rows(spark, str(path)).count() == 1


def test_text_none_survives_a_round_trip(spark, tmp_path):
    path = str(tmp_path / "results")
    write_csv(spark.createDataFrame([("a", "None", 1.0)], "experiment string, imbalance string, f1 double"), path)
    assert read_results(spark, path, "experiment string, imbalance string, f1 double").first()["imbalance"] == "None"


def test_dedup_audit_and_conflicts(spark):
    frame = transactions_frame()
    doubled = spark.createDataFrame(np.vstack([frame.to_numpy(), frame.to_numpy()[:4]]).tolist(), list(frame.columns))
    row = audit.audit_row(doubled, list(frame.columns)).first()
    assert (row["raw_rows"], row["clean_rows"], row["duplicates_removed"]) == (604, 600, 4)
    assert audit.distinct_rows(doubled, list(frame.columns), None).count() == 600
    audit.require_no_conflicts(doubled)
    clash = frame.iloc[[0]].assign(Class=1)
    bad = spark.createDataFrame(np.vstack([frame.to_numpy(), clash.to_numpy()]).tolist(), list(frame.columns))
    with pytest.raises(DatasetError, match="two labels"):
        audit.require_no_conflicts(bad)


def test_missing_values_are_equal_in_dedup(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 2.0), (3, 0.0, -0.0), (4, -0.0, 0.0)], "row_id long, a double, b double")
    assert sorted(r["row_id"] for r in audit.distinct_rows(df, ["a", "b"]).collect()) == [1, 3]


def test_fingerprint_ignores_order_and_partitions(spark):
    df = spark.range(1000).selectExpr("id as row_id", "id % 7 as x")
    a = audit.fingerprint(df, ["row_id", "x"]).first()
    b = audit.fingerprint(df.repartition(5).orderBy("x"), ["row_id", "x"]).first()
    c = audit.fingerprint(df.where("row_id <> 3"), ["row_id", "x"]).first()
    assert a == b and a["digest"] != c["digest"]


def test_only_new_files_are_hashed(spark, tmp_path):
    path, columns = str(tmp_path / "table"), ["id", "x"]
    df = spark.range(100).selectExpr("id", "id % 7 as x")
    df.where("id < 60").repartition(3).write.parquet(path)
    first = audit.file_digests(spark, path, columns)
    first = spark.createDataFrame(first.collect(), first.schema)  # as it was then
    assert first.count() == 3 and first.agg({"rows": "sum"}).first()[0] == 60
    df.where("id >= 60").coalesce(1).write.mode("append").parquet(path)
    told = first.withColumn("digest", F.lit(5).cast("bigint"))  # what is known is taken as it is
    both = {r["file"]: r["digest"] for r in audit.file_digests(spark, path, columns, told).collect()}
    assert len(both) == 4 and list(both.values()).count(5) == 3
    merged = audit.merged_fingerprint(audit.file_digests(spark, path, columns, first)).first()
    assert merged == audit.fingerprint(spark.read.parquet(path), columns).first()
    gone = first.collect()[0]["file"].removeprefix("file:")
    os.remove(gone)
    left = audit.file_digests(spark, path, columns, first)
    assert left.count() == 3 and audit.merged_fingerprint(left).first() == audit.fingerprint(spark.read.parquet(path), columns).first()


def test_quarantine_covers_every_row(spark):
    frame = transactions_frame(50, 5)
    frame.loc[1, "V7"] = np.nan
    frame.loc[2, "Amount"] = -5.0
    frame.loc[3, "V8"] = np.inf
    for df in (spark.createDataFrame(frame), as_text(spark, frame)):
        valid, rejected = contract.quarantine(df)
        assert valid.count() == 47 and valid.columns == df.columns
        assert sorted(r["reasons"] for r in rejected.collect()) == ["Amount:negative", "V7:missing", "V8:infinite"]


def test_provenance_flags_a_changed_table(spark):
    df = spark.range(100).selectExpr("id as row_id", "cast(id % 2 as int) as Class")
    digest = audit.fingerprint(df, ["row_id", "Class"]).first()["digest"]
    assert audit.provenance(df, 100, 50, digest, ["row_id", "Class"]).first()["as_expected"]
    assert not audit.provenance(df.limit(99), 100, 50, digest, ["row_id", "Class"]).first()["as_expected"]
