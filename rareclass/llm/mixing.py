"""Mixing sources to target weights by Pareto order sampling.

Each source gets a share of the mix by weight, no more than a multiple of its own size; what is
above that goes to the others. A document's expected number of copies is its source's target
over its size. The whole part of it is certain; for the rest documents are ranked by the odds
of a random number over the odds of their inclusion (Pareto order sampling), and the first of
them fill what is left of the target.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareclass.llm.running import running
from rareclass.session import materialize


@dataclass(frozen=True)
class MixConfig:
    """``weights`` repeat over the sources in order; ``percent`` is the mix's size, of all sizes."""

    weights: tuple[int, ...] = (3, 1, 2)
    percent: int = 150
    most: int = 2
    seed: int = 13


def sized_documents(docs: DataFrame, config: MixConfig) -> DataFrame:
    """``(doc_id, source, size, draw, n)``: words, a random number in (0, 1), a row number.

    ``source`` is the name after a ``+``, and ``~``, which comes last, for null. The number is
    drawn by a hash of seed, id and text, so it depends on neither order nor partitions.
    """
    text, doc_id = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("doc_id").cast("bigint")
    name = F.md5(F.concat_ws(":", F.lit(str(config.seed)), F.coalesce(doc_id.cast("string"), F.lit("-")), text))
    draw = (F.conv(F.substring(name, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    return docs.select(
        doc_id.alias("doc_id"), F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit("~")).alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("size"), draw.alias("draw"),
        F.monotonically_increasing_id().alias("n"))


def source_targets(sizes: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """``(source, source_size, target)`` of documents ``(source, size)``; sources in their order have the weights.

    With sources in ascending order of limit over weight, the first ones get their limit: as
    many as it takes until what is left, shared by weight, is within the limit of the next.
    """
    sources = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                          .withColumn("all", F.lit(0)), "sources")
    weights = F.array(*[F.lit(w) for w in config.weights])
    weighed = running(sources, ["all"], ["source"], name="sources-in-order").select(
        "all", "source", "source_size", (F.col("source_size") * config.most).alias("limit"),
        F.element_at(weights, (F.col("place") % len(config.weights) + 1).cast("int")).cast("bigint").alias("weight"))
    weighed = materialize(weighed.withColumn("turn", F.col("limit") / F.col("weight")), "sources-weighed")
    placed = running(weighed, ["all"], ["turn", "source"], sums=["limit", "weight"], name="sources-by-limit")
    total = placed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    whole, weight = (total["size"] or 0) * config.percent / 100, total["weight"] or 0
    share = (F.lit(float(whole)) - (F.col("run_limit") - F.col("limit"))) / (F.lit(weight) - (F.col("run_weight") - F.col("weight")))
    level = placed.select("place", "turn", share.alias("share")).where("turn > share").agg(
        F.min_by("share", "place")).first()[0]
    target = F.col("limit").cast("double")
    if level is not None:
        target = F.least(target, F.lit(level) * F.col("weight"))
    return placed.select("source", "source_size", target.alias("target"))


def pareto_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copies_taken``, for ``rows(source, doc_id, size, draw, copies, n)``.

    ``copies`` is the expected number of a row's copies and may differ from row to row. Its
    whole part is taken. The rest is the row's chance in a sample without replacement of each
    source, whose size in words is fixed to what the chances add up to: rows are taken in the
    order of ``odds(draw) / odds(chance)`` as long as a row brings the sum nearer to that. One
    more row closes the gap that is left, if one does: the nearest in size, lowest in rank.
    Rows that tie in everything are alike, so which of them is taken shows nowhere.
    """
    chance = F.col("copies") - F.floor("copies")
    ranked = (rows.withColumn("chance", chance).withColumn("budget_part", (F.col("chance") * F.col("size")).cast("decimal(28,9)"))
              .withColumn("rank", F.when(F.col("chance") > 0, (F.col("draw") / (1 - F.col("draw"))) / (F.col("chance") / (1 - F.col("chance"))))
                          .otherwise(F.lit(float("inf")))))
    ranked = materialize(ranked, "mix-ranks")
    budget = ranked.groupBy("source").agg(F.sum("budget_part").cast("double").alias("budget"))
    placed = running(ranked, ["source"], ["rank", "doc_id", "size", "draw", "n"], sums=["size"], name="mix-order")
    inside = F.expr("chance > 0 and 2 * run_size - size < 2 * budget")
    # Written before it is summed, so that the join may split a source that holds most rows.
    judged = materialize(placed.join(budget, "source").withColumn("inside", inside), "mix-judged")
    gap = judged.groupBy("source").agg((F.first("budget") - F.sum(F.when(F.col("inside"), F.col("size")).otherwise(0))).alias("gap"))
    order = F.struct(F.abs(F.col("gap") - F.col("size")), "rank", "place")
    closing = (judged.where("not inside and chance > 0 and size > 0").join(gap, "source").where("abs(gap - size) < abs(gap)")
               .groupBy("source").agg(F.min(order).alias("least")).select("source", F.col("least.place").alias("closing")))
    return (judged.join(closing, "source", "left")
            .withColumn("copies_taken", F.floor("copies") + F.expr("if(inside or coalesce(place = closing, false), 1, 0)"))
            .drop("chance", "budget_part", "budget", "rank", "place", "run_size", "inside", "closing"))


def mix(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row of ``docs(doc_id, source, text)``.

    Sizes are numbers of words ``[^\\x20\\x09-\\x0D]+``; a null text has none. Sources ascend by
    code point, null last. ``taken`` is ``size`` times the copies that the mix takes, ``most``
    at the most. Rows that repeat an id are documents of their own; no rows give no rows.
    """
    sizes = materialize(sized_documents(docs, config), "mix-sizes")
    targets = materialize(source_targets(sizes, config), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    found = pareto_copies(sizes.join(targets, "source").withColumn("copies", rate))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies_taken")).alias("taken"))
