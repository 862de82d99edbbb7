"""The batch operators on unbounded tables: scoring, dedup and window summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from rareclass.functions.hashing import content_key
from rareclass.operators.contract import quarantine
from rareclass.operators.score import SCORE


def stream_parquet(spark: SparkSession, path: str, schema=None, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table as a stream; the schema is read once if not given.

    The path is turned into a glob that matches only itself, so that a table stored as a
    single file works like a folder.
    """
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    path = path.rstrip("/")
    path = f"{path[:-1]}[{path[-1]}]"
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def unique_rows(stream: DataFrame, columns: list[str], keep: str) -> DataFrame:
    """First copy of each row; a copy that arrives within ``keep`` of it is dropped.

    The state is keyed by a digest of the row and expires by the time of arrival, not by the
    row's own time: a row that comes late, however late, has its first copy passed on, and a
    backlog in no order of time loses nothing. ``keep`` bounds the state to the rows of that
    much wall time; a copy that arrives later than that counts as new.
    """
    keyed = stream.withColumn("_key", content_key(*columns)).withColumn("_arrived", F.current_timestamp())
    return keyed.withWatermark("_arrived", keep).dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_arrived")


def scored_and_rejected(score_rows):
    """A route that tells rows that can be scored from those that cannot; ``score_rows`` is the batch scorer."""
    def route(batch: DataFrame) -> dict[str, DataFrame]:
        valid, rejected = quarantine(batch)
        return {"scored": score_rows(valid), "rejected": rejected}

    return route


def write_routed(stream: DataFrame, route, folder: str, checkpoint: str) -> StreamingQuery:
    """Read the source once and write every table that ``route(batch)`` names; process what there is, and stop.

    A batch is written to a folder named by its number, in each table. A batch that is run
    again, after a failure between two tables or of the query itself, replaces its own folders
    and nothing else, so each row is in the tables exactly once.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, rows in route(batch).items():
                rows.write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_routed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """All batches of one table of ``write_routed``."""
    return spark.read.parquet(f"{folder}/{name}").drop("batch")


def window_summary(scored: DataFrame, time: str = "ts", window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Transactions, flagged rows, flagged share and highest score of each closed window."""
    w = F.window(time, window)
    return (scored.withWatermark(time, delay).groupBy(w.alias("w")).agg(
        F.count(F.lit(1)).alias("transactions"), F.sum(F.col("predicted_class").cast("bigint")).alias("flagged"),
        F.avg(F.col("predicted_class").cast("double")).alias("flagged_share"), F.max(SCORE).alias("max_score"))
        .select(F.col("w.start").alias("window_start"), "transactions", "flagged", "flagged_share", "max_score"))


def write_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything there is, append to parquet, and stop; restarts continue exactly."""
    return (df.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
