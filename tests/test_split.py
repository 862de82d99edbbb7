import pytest
from fixtures import transactions_frame, with_ids
from pyspark.sql import Window
from pyspark.sql import functions as F

from rareclass.config import TrainingConfig
from rareclass.errors import DatasetError
from rareclass.functions.hashing import hash_key
from rareclass.operators import split


def test_published_split_counts():
    q = split.split_quotas({0: 283726 - 473, 1: 473}, TrainingConfig())
    assert {k: sum(v.values()) for k, v in q.items()} == {"train": 170235, "validation": 56745, "test": 56746}
    assert {k: v[1] for k, v in q.items()} == {"train": 284, "validation": 94, "test": 95}


def test_published_fold_counts():
    cuts = split.fold_cuts({0: 59900, 1: 100}, 3)
    assert cuts[1] == [33, 66] and cuts[0][0] + cuts[1][0] == 20000


def test_split_is_stratified_disjoint_and_independent_of_partitions(spark):
    df = with_ids(spark, transactions_frame())
    a = split.stratified_split(df)
    rows = {r["partition"]: r for r in split.split_summary(a).collect()}
    assert {k: (r["rows"], r["frauds"]) for k, r in rows.items()} == {
        "train": (360, 36), "validation": (120, 12), "test": (120, 12)}
    b = split.stratified_split(df.repartition(8))
    one = df.coalesce(1)
    assert a.select("row_id", "partition").exceptAll(b.select("row_id", "partition")).isEmpty()
    assert a.select("row_id", "partition").exceptAll(split.stratified_split(one).select("row_id", "partition")).isEmpty()
    assert split.split_overlap(split.membership(a)).first().asDict() == {
        "keys": 600, "in_several_partitions": 0, "repeated_keys": 0}


def test_cut_search_equals_a_plain_rank_at_any_leaf_size(spark):
    df = spark.range(5000).selectExpr("id as row_id", "cast(id % 10 = 0 as int) as Class")
    w = Window.partitionBy("Class").orderBy(hash_key(42, F.col("row_id")), "row_id")
    rank = df.withColumn("r", F.row_number().over(w))
    for leaf in (1, 3, 100_000):
        order = split.HashOrder(df, leaf_rows=leaf)
        cuts = {0: [0, 7, 2000, 4500], 1: [1, 250, 499, 500]}
        got = df.withColumn("band", order.bands(cuts))
        want = rank.withColumn("band", F.when(F.col("Class") == 0, sum(
            (F.when(F.col("r") > c, 1).otherwise(0) for c in cuts[0]), F.lit(0))).otherwise(sum(
                (F.when(F.col("r") > c, 1).otherwise(0) for c in cuts[1]), F.lit(0))))
        assert got.select("row_id", "band").exceptAll(want.select("row_id", "band")).isEmpty()


def test_samples(spark):
    df = with_ids(spark, transactions_frame(300, 60))
    counts = {r["Class"]: r["count"] for r in split.bounded_sample(df, 200).groupBy("Class").count().collect()}
    assert counts == {0: 160, 1: 40}
    assert split.bounded_sample(df, 300).count() == 300 and split.bounded_sample(df, None).count() == 300
    capped = {r["Class"]: r["count"] for r in split.class_quota_sample(df, {0: 50, 1: None}).groupBy("Class").count().collect()}
    assert capped == {0: 50, 1: 60}
    assert [r["row_id"] for r in split.first_rows_per_class(df).collect()] == [0, 1, 2, 240, 241, 242]


def test_folds_differ_by_at_most_one_row(spark):
    df = with_ids(spark, transactions_frame(601, 61))
    rows = split.fold_summary(split.stratified_folds(df, 3)).collect()
    assert max(r["validation_rows"] for r in rows) - min(r["validation_rows"] for r in rows) <= 1
    assert max(r["validation_frauds"] for r in rows) - min(r["validation_frauds"] for r in rows) <= 1
    assert all(r["train_rows"] + r["validation_rows"] == 601 for r in rows)


def test_split_fractions_are_checked():
    with pytest.raises(DatasetError):
        split.split_quotas({0: 90, 1: 10}, TrainingConfig(test_size=0.6, validation_size=0.5))
