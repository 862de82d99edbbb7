"""Corpus pipeline: toxic documents out, repeated lines out, near copies out, secrets masked, packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rareclass.llm import line_dedup, near_dedup, packing, secrets, toxicity
from rareclass.llm.queries import secret_config, table, tokenizer_path
from rareclass.session import discard, materialize, scratch, shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with a new text where ``text`` is not null; its length follows."""
    return docs.withColumn("n_chars", F.when(text.isNull(), F.col("n_chars")).otherwise(
        F.length(text).cast("bigint"))).withColumn("text", F.coalesce(text, F.col("text"))).select(*COLUMNS)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go. All rows of the label table may teach, as far as they are held in.

    Null and empty texts have the score of no words. Columns beside those of ``documents`` end here.
    """
    config = toxicity.ToxicityConfig()
    known = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.fit(toxicity.training_rows(docs, known, config), config)
    return toxicity.score(docs, model, COLUMNS).where("score < 0.5").select(*COLUMNS)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that an earlier place also has go; so does a document with nothing left of it.

    A run has three lines, or 50 words. Null and empty texts have no lines and stay.
    """
    found = line_dedup.without_repeated_lines(docs, COLUMNS, long_words=line_dedup.LONG_WORDS)
    changed = F.when(F.col("n_removed") > 0, F.col("kept"))
    return _with_text(found.where("n_removed = 0 or n_removed < n_lines"), changed)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, on sets of five-word shingles.

    Every row is judged by its own text: rows that repeat an id, or have none, are documents of
    their own. Texts without words are no one's copies and stay.
    """
    rows = materialize(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "numbered")
    classes = near_dedup.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
    gone = classes.where("not kept").select(F.col("doc_id").alias("row"))
    return rows.join(gone, "row", "left_anti").select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays, null texts as they are."""
    return _with_text(secrets.scan(docs, secret_config(), COLUMNS), F.col("redacted"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document in pieces of sequences of 4096; a null or empty text is its end id."""
    return packing.pack(docs, packing.PackingConfig(tokenizer_path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("minhash_near_dedup", remove_near_duplicates),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

# A trained model, tokenizers and near-duplicate classes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next.

    What a stage has written on its way goes when it is done, its input when the next has read it.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, name)
        with scratch(spark, keep=(path,)):
            stage(spark, docs, sf_dir).write.parquet(path)
        discard(spark, *before)
        docs, before = spark.read.parquet(path), [path]
    return STAGES[-1][1](spark, docs, sf_dir)
