"""Every registered query against its SQL, and streams against the batch result."""

import pytest
from oracle_check import compare, connect
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from rareclass.operators.score import top_components, top_components_ranked
from rareclass.plans.catalog import QUERIES
from rareclass.plans.fixture import transactions
from rareclass.streaming import alerts

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_registry():
    assert set(ORACLES) <= set(queries()) and set(QUERIES) <= set(queries())
    assert len(ORACLES) >= 70


@pytest.mark.parametrize("name", sorted(set(ORACLES) & set(QUERIES)))
def test_query_equals_sql(spark, sf, duck, name):
    assert compare(queries()[name](spark, sf), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_model_queries_have_rows(spark, sf, name):
    assert queries()[name](spark, sf).count() > 0


def test_flagship(spark):
    assert entry(spark).count() == 24


def test_top_components_two_ways(spark, sf):
    tx = transactions(spark, sf)
    a, b = top_components(tx).select("row_id", "component"), top_components_ranked(tx).select("row_id", "component")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_stream_dedup_over_several_batches(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    df = spark.range(100).selectExpr("id as row_id", "timestamp'2024-01-01' + make_interval(0,0,0,0,0,0,id) as ts")
    df.coalesce(1).write.parquet(src)
    df.where("row_id < 50").coalesce(1).write.mode("append").parquet(src)
    stream = alerts.unique_rows(alerts.stream_parquet(spark, src, files_per_trigger=1), ["row_id"], "1 hour")
    alerts.write_available(stream, out, chk).awaitTermination()
    df.where("row_id >= 90").coalesce(1).write.mode("append").parquet(src)  # a restart continues
    again = alerts.unique_rows(alerts.stream_parquet(spark, src, files_per_trigger=1), ["row_id"], "1 hour")
    alerts.write_available(again, out, chk).awaitTermination()
    assert spark.read.parquet(out).count() == 100


def test_stream_dedup_of_a_backlog_without_order(spark, tmp_path):
    """A delay far shorter than the backlog is out of order loses no row and passes no copy."""
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    df = spark.range(40).selectExpr("id as row_id", "timestamp'2024-01-01' + make_interval(0,0,0,id,0,0,0) as ts")
    for part in ("row_id >= 30", "row_id < 10", "row_id between 10 and 29", "row_id < 10"):  # the newest comes first
        df.where(part).coalesce(1).write.mode("append").parquet(src)
    stream = alerts.unique_rows(alerts.stream_parquet(spark, src, files_per_trigger=1), ["row_id"], "10 minutes")
    alerts.write_available(stream, out, chk).awaitTermination()
    assert sorted(r.row_id for r in spark.read.parquet(out).collect()) == list(range(40))


def test_routed_batches_are_written_once(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    for at in (0, 50):
        spark.range(at, at + 50).coalesce(1).write.mode("append").parquet(src)
    broken = [True]

    def route(batch):
        tables = {"even": batch.where("id % 2 = 0"), "odd": batch.where("id % 2 = 1")}
        if broken and batch.where("id >= 50").count():  # fails after its first table is written
            tables["odd"] = tables["odd"].withColumn("id", F.raise_error(F.lit("lost")).cast("bigint"))
        return tables

    def start():
        stream = alerts.stream_parquet(spark, src, files_per_trigger=1)
        return alerts.write_routed(stream, route, out, chk)

    with pytest.raises(StreamingQueryException):
        start().awaitTermination()
    assert alerts.read_routed(spark, out, "even").count() == 50
    broken.clear()
    start().awaitTermination()
    spark.range(100, 110).coalesce(1).write.mode("append").parquet(src)
    start().awaitTermination()
    for name, rest in (("even", 0), ("odd", 1)):
        assert sorted(r.id for r in alerts.read_routed(spark, out, name).collect()) == list(range(rest, 110, 2))
