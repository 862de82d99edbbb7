"""Repeated runs of lines, found by winnowing over line hashes; DataFrame functions only.

Every window of ``window_lines`` non-blank lines selects its least line hash, the rightmost on
ties. Equal windows select the same line, so any repeated run of that many lines shares a
selected position: only positions whose hash is selected at two places or more are joined
further. Their windows are matched on the hashes of their lines with the first place that has
the same lines, and matched windows side by side grow to maximal runs in both directions.
On request (``long_words``) fewer lines are a run too once they hold so many words or 8 characters
for each of these; such windows select themselves. Grouped minima are combined before their
shuffle and the joins are split by the adaptive skew join, so a line that a third of all
documents holds costs no pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rareclass.session import materialize

WINDOW_LINES = 3
LONG_WORDS = 50


def _lined(docs: DataFrame) -> DataFrame:
    """Raw lines, and the numbers and hashes of the lines that are not blank."""
    return (docs.withColumn("lines", F.split("text", "\n"))
            .withColumn("full", F.expr(
                "filter(transform(lines, (x, i) -> struct(i AS at, x AS line)), y -> btrim(y.line, ' \\t\\r\\f') <> '')")))


def _windows(docs: DataFrame, wide: int, long_words: int | None) -> DataFrame:
    """One row per window: first line and end, selected line and its hash, and 128 bits of its lines."""
    hashed = (_lined(docs).where(F.size("full") >= (wide if long_words is None else 1))
              .select("doc_id", "text_key", F.expr("full.line").alias("lines"),
                      F.expr("transform(full, y -> xxhash64(y.line))").alias("hashes"),
                      F.expr("transform(full, y -> size(split(btrim(y.line, ' \\t\\r\\f'), '\\\\s+')))").alias("words")))
    starts = "filter(sequence(0, size(lines) - 1), i -> i + {n} <= size(lines){such})"
    window = """transform({starts}, i -> struct(
        i AS start, i + {n} AS end, slice(hashes, i + 1, {n}) AS h,
        xxhash64(slice(lines, i + 1, {n})) AS a, xxhash64('second', slice(lines, i + 1, {n})) AS b))"""
    kinds = [window.format(n=wide, starts=starts.format(n=wide, such=""))]
    for n in range(1, wide) if long_words is not None else []:
        such = f""" AND (aggregate(slice(words, i + 1, {n}), 0, (x, y) -> x + y) >= {long_words}
            OR aggregate(slice(lines, i + 1, {n}), 0, (x, y) -> x + length(y)) >= {8 * long_words})"""
        kinds.append(window.format(n=n, starts=starts.format(n=n, such=such)))
    short = F.col("w.end") - F.col("w.start") < wide
    least = F.array_min("w.h")
    at = (F.col("w.start") + wide - F.array_position(F.reverse("w.h"), least).cast("int"))
    return (hashed.select("doc_id", "text_key", F.expr(f"explode(concat({', '.join(kinds)}))").alias("w"))
            .select("doc_id", "text_key", "w.start", "w.end", F.when(short, F.col("w.a")).otherwise(least).alias("selected"),
                    F.when(short, F.col("w.start")).otherwise(at).alias("at"), "w.a", "w.b"))


def repeated_runs(docs: DataFrame, wide: int = WINDOW_LINES, long_words: int | None = None) -> DataFrame:
    """``(doc_id, text_key, runs)``: per text, its maximal runs of lines that occur earlier.

    A run is ``(s, e)`` in non-blank lines, end exclusive. Earlier means a smaller
    ``(doc_id, line)``.
    """
    windows = materialize(_windows(docs, wide, long_words), "line-windows")
    # Fingerprints that are selected at two different places.
    twice = (windows.groupBy("selected").agg(
        F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1"), F.min("at").alias("p0"), F.max("at").alias("p1"))
        .where("d0 < d1 or p0 < p1").select("selected"))
    met = windows.join(twice, "selected", "left_semi").select("doc_id", "text_key", "start", "end", "a", "b")
    first = (met.groupBy("a", "b").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    later = met.join(first, ["a", "b"]).where("struct(doc_id, start) > first")
    later = later.groupBy("doc_id", "text_key", "start").agg(F.max("end").alias("end"))
    # Neighbouring matches are one run.
    by_text = Window.partitionBy("doc_id", "text_key").orderBy("start")
    before = F.max("end").over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col("start") > before).cast("int"), F.lit(1))
    runs = (later.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(by_text))
            .groupBy("doc_id", "text_key", "run").agg(F.min("start").alias("s"), F.max("end").alias("e")))
    return runs.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("runs"))


def without_repeated_lines(docs: DataFrame, keep: list[str] | None = None, wide: int = WINDOW_LINES,
                           long_words: int | None = None) -> DataFrame:
    """The columns in ``keep``, ``n_lines``, ``n_removed`` and ``kept`` for every row of ``docs``.

    Lines end at ``\\n``; lines of blanks only are not counted, and go only inside a deleted
    run. A run of ``wide`` lines or more that also begins at an earlier ``(doc_id, line)`` is
    deleted, and with ``long_words`` also a shorter one of so many words (words end at blanks)
    or 8 times so many characters; runs are judged on the input, so of a run that overlaps its own repetition the
    lines before the repetition stay. Null texts are empty. Rows without an id are kept whole
    and are no one's earlier document; rows that repeat an id are one place.
    """
    keep = ["doc_id"] if keep is None else keep
    source = docs.select(*[F.col(f"`{c}`").alias(f"k_{i}") for i, c in enumerate(keep)],
                         F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("text_key", F.xxhash64("text"))
    runs = repeated_runs(source.select("doc_id", "text_key", "text").where("doc_id is not null"), wide, long_words)
    joined = _lined(source.join(runs, ["doc_id", "text_key"], "left"))
    gone = F.expr("transform(runs, r -> struct(full[r.s].at AS s, full[r.e - 1].at + 1 AS e))")
    parts = F.expr("""transform(sequence(0, size(gone)), j -> slice(lines,
        if(j = 0, 0, gone[j - 1].e) + 1,
        if(j = size(gone), size(lines), gone[j].s) - if(j = 0, 0, gone[j - 1].e)))""")
    kept = F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(F.flatten("parts"), "\n"))
    return (joined.withColumn("gone", gone).withColumn("parts", parts).select(
        *[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)],
        F.size("full").cast("bigint").alias("n_lines"),
        F.coalesce(F.expr("aggregate(runs, 0L, (n, r) -> n + r.e - r.s)"), F.lit(0)).alias("n_removed"),
        kept.alias("kept")))
