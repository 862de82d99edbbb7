"""Repeated word passages: winnowed seeds, extended both ways to maximal repeats.

Every window of ``window_words`` words selects the least hash of its ``seed_words``-grams
(the rightmost on ties), so equal windows select the same seed at the same place. The windows
that selected one seed lie side by side; the seed, extended to both ends of them, is its
*stretch*. Equal stretches are matched as a whole on their hashes. Where a seed occurs in
several documents with different stretches, its single windows are matched. What remains is
joined per document into maximal repeated runs of words.

Each task first keeps only the least document of every key it has seen in a piece, so a
passage that a third of all documents holds reaches a shuffle once per piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rareclass.llm.words import RangeHash, Words, mix, pieces, words
from rareclass.session import materialize

_SALT = np.uint64(0x8EBC6AF09C88C6E3)
_KEY = "key bigint, second bigint, doc_id bigint, text_key bigint, span bigint, matched boolean"


@dataclass(frozen=True)
class SubstringConfig:
    """A repeat has at least ``window_words`` words; seeds are grams of ``seed_words``."""

    window_words: int = 13
    seed_words: int = 6
    combine_bytes: int = 1 << 22


@dataclass
class Seeds:
    """Seeds of some texts: hash, text, and the run of windows that selected each."""

    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray  # first window, as a position among all words
    count: np.ndarray  # number of windows


def seeds(w: Words, config: SubstringConfig) -> Seeds:
    wide, k = config.window_words, config.seed_words
    n = len(w.hash) - wide + 1
    none = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return Seeds(none.astype(np.uint64), none, none, none)
    gram = RangeHash(w.hash)(np.arange(len(w.hash) - k + 1), np.arange(k, len(w.hash) + 1))
    best, at = gram[:n].copy(), np.arange(n)
    for j in range(1, wide - k + 1):
        later = gram[j:n + j]
        better = later <= best
        np.copyto(best, later, where=better)
        np.copyto(at, np.arange(j, n + j), where=better)
    whole = np.flatnonzero(w.doc[:n] == w.doc[wide - 1:])
    if not len(whole):
        return Seeds(none.astype(np.uint64), none, none, none)
    at = at[whole]
    # Windows of one seed are neighbours: its position only grows.
    fresh = np.ones(len(whole), dtype=bool)
    fresh[1:] = (at[1:] != at[:-1]) | (whole[1:] != whole[:-1] + 1)
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(whole)))
    return Seeds(gram[at[first]], w.doc[whole[first]], whole[first], count)


def _combined(key, second, doc_id, text_key, span) -> pa.RecordBatch:
    """Rows of a piece; where a smaller document has the same keys, a row is settled."""
    order = np.lexsort((doc_id, second, key))
    key, second, doc_id, text_key, span = (x[order] for x in (key, second, doc_id, text_key, span))
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = (key[1:] != key[:-1]) | (second[1:] != second[:-1])
    least = doc_id[np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(key) else doc_id
    matched = doc_id > least
    # A settled row needs no meeting point: it is sent anywhere.
    key = np.where(matched, mix(span.view(np.uint64) ^ mix(text_key.view(np.uint64))), key)
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(second.view(np.int64)), pa.array(doc_id), pa.array(text_key),
         pa.array(span), pa.array(matched)], names=["key", "second", "doc_id", "text_key", "span", "matched"])


def _flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    if held:
        yield _combined(*(np.concatenate(x) for x in zip(*held)))
        held.clear()


def _span(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (start.astype(np.int64) << 16) | count.astype(np.int64)


def stretches(docs: DataFrame, config: SubstringConfig) -> DataFrame:
    """One row per seed: its hash, its stretch's hash, its document and run of windows."""
    wide = config.window_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in pieces(batches, "text"):
            w = words(piece.column("text"))
            found = seeds(w, config)
            # One seed has at most window_words - seed_words + 1 windows.
            stretch = RangeHash(w.hash)(found.start, found.start + found.count + wide - 1)
            doc_id, text_key = (piece.column(c).to_numpy()[found.doc] for c in ("doc_id", "text_key"))
            held.append((found.hash, stretch, doc_id, text_key, _span(found.start - w.first[found.doc], found.count)))
            size += len(w.data)
            if size >= config.combine_bytes:
                yield from _flush(held)
                size = 0
        yield from _flush(held)

    return docs.mapInArrow(run, _KEY)


def single_windows(rows: DataFrame, config: SubstringConfig) -> DataFrame:
    """One row per window of the runs in ``spans`` of each text."""
    wide = config.window_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in pieces(batches, "text"):
            w = words(piece.column("text"))
            spans = piece.column("spans")
            doc = np.repeat(np.arange(piece.num_rows), np.diff(spans.offsets.to_numpy()))
            span = spans.flatten().to_numpy()
            count = span & 0xFFFF
            start = np.repeat((span >> 16) + w.first[doc] - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
            start = start + np.arange(count.sum())
            doc = np.repeat(doc, count)
            hashes = RangeHash(w.hash)
            other = RangeHash(mix(w.hash ^ _SALT))
            doc_id, text_key = (piece.column(c).to_numpy()[doc] for c in ("doc_id", "text_key"))
            held.append((hashes(start, start + wide), other(start, start + wide), doc_id, text_key,
                         _span(start - w.first[doc], np.ones(len(start), dtype=np.int64))))
            size += len(w.data)
            if size >= config.combine_bytes:
                yield from _flush(held)
                size = 0
        yield from _flush(held)

    return rows.mapInArrow(run, _KEY)


def _matches(docs: DataFrame, config: SubstringConfig) -> DataFrame:
    """``(doc_id, text_key, span)``: runs of windows that also start in a smaller document."""
    # One shuffle and one sort serve both windows.
    seeded = stretches(docs, config).repartition("key").sortWithinPartitions("key", "second")
    by_seed, by_stretch = Window.partitionBy("key"), Window.partitionBy("key", "second")
    judged = materialize(
        seeded.select(
            "doc_id", "text_key", "span",
            (F.col("matched") | (F.col("doc_id") > F.min("doc_id").over(by_stretch))).alias("matched"),
            (~F.col("matched") & (F.min("second").over(by_seed) < F.max("second").over(by_seed))
             & (F.min("doc_id").over(by_seed) < F.max("doc_id").over(by_seed))).alias("shared"))
        .where("matched or shared"), "stretches")
    spans = (judged.where("not matched").groupBy("doc_id", "text_key").agg(F.collect_list("span").alias("spans")))
    single = single_windows(docs.join(spans, ["doc_id", "text_key"]), config)
    least = Window.partitionBy("key", "second")
    part = single.select("doc_id", "text_key", "span", (
        F.col("matched") | (F.col("doc_id") > F.min("doc_id").over(least))).alias("matched"))
    return materialize(judged.where("matched").select("doc_id", "text_key", "span").union(
        part.where("matched").drop("matched")), "matches")


def repeated_runs(docs: DataFrame, config: SubstringConfig = SubstringConfig()) -> DataFrame:
    """``(doc_id, text_key, spans)``: per text with repeats, its matched runs of windows.

    A span is ``start << 16 | count``: that many windows from word ``start`` on are repeats.
    """
    return _matches(docs, config).groupBy("doc_id", "text_key").agg(F.collect_list("span").alias("spans"))


def prepared(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("text_key", F.xxhash64("text"))


def without_repeats(docs: DataFrame, config: SubstringConfig = SubstringConfig()) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, kept_sha256)``, one row per row of ``docs``.

    A word goes if a window of ``window_words`` words of its text that covers it also starts
    in a document with a smaller id. Windows are judged on the input. ``kept`` joins the other
    words by one space. Null and empty texts have no words; a row without an id is kept whole
    and is no one's earlier document; rows that repeat an id are not earlier than each other.
    """
    docs = prepared(docs)
    known = docs.where("doc_id is not null")
    runs = repeated_runs(known, config)
    wide = config.window_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            texts, spans = piece.column("text").to_pylist(), piece.column("spans")
            n_words, n_removed, kept, digest = [], [], [], []
            for text, span in zip(texts, spans):
                parts = text.encode().split()
                n_words.append(len(parts))
                if span.is_valid:
                    span = span.values.to_numpy()
                    edges = np.zeros(len(parts) + 1, dtype=np.int64)
                    start = span >> 16
                    np.add.at(edges, start, 1)
                    np.add.at(edges, start + (span & 0xFFFF) + wide - 1, -1)
                    parts = [parts[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
                n_removed.append(n_words[-1] - len(parts))
                rest = b" ".join(parts)
                kept.append(rest.decode())
                digest.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.string()), pa.array(digest, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return docs.join(runs, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string")
