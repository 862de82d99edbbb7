"""Text to vocabulary pieces of the best total score, and back.

An Aho-Corasick automaton over the pieces reads a text once. At every position its output
links name all pieces that end there, and each relaxes the best score of that position. No
piece goes on past a space once it has another character, so a text is a row of units (spaces,
then other characters) that are solved one by one, and each distinct unit only once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareclass.llm.workers import held

SPACE_MARK = "▁"  # fixed value: how a vocabulary writes a space
_UNIT = re.compile(" *[^ ]+| +")


@dataclass(frozen=True)
class PieceConfig:
    """``model`` is a vocabulary file; a character outside it costs ``unknown_penalty`` below the least score."""

    model: str
    unknown_penalty: float = 10.0
    cached_units: int = 1 << 18


class _Solved(dict):
    """Unit -> its ids as bytes; a unit that is missing is solved. Starts anew when full."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= self.vocabulary.limit:
            self.clear()
        ids = self[unit] = np.array(self.vocabulary.solve(unit), dtype="<u4").tobytes()
        return ids


class Vocabulary:
    """Pieces with scores, bytes for characters outside them, and the automaton."""

    def __init__(self, config: PieceConfig):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=config.model)
        self.automaton, self.bytes_of, self.byte_ids = ahocorasick.Automaton(), [], {}
        self.characters, least = set(), 0.0
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = bytes([int(piece[3:5], 16)])
                self.byte_ids[value[0]] = i
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                value = b""
            else:
                text = piece.replace(SPACE_MARK, " ")
                if " " in text.lstrip(" "):
                    raise ValueError("A piece holds a space after another character.")
                self.automaton.add_word(text, (len(text), model.get_score(i), i))
                least = min(least, model.get_score(i))
                if len(text) == 1:
                    self.characters.add(text)
                value = text.encode()
            self.bytes_of.append(value)
        if len(self.byte_ids) < 256:
            raise ValueError("The vocabulary has no bytes to fall back on.")
        self.bytes_of = np.array(self.bytes_of, dtype=object)  # ids pick many at once
        self.automaton.make_automaton()
        self.unknown, self.limit = least - config.unknown_penalty, config.cached_units
        self.known = _Solved(self)

    def solve(self, unit: str) -> tuple[int, ...]:
        """Ids of the best segmentation; on ties the longer last piece wins."""
        n = len(unit)
        score, back = [0.0] + [-np.inf] * n, [None] * (n + 1)
        at = 0  # positions up to here are settled
        for end, (length, value, i) in self.automaton.iter(unit):
            while at < end:  # positions at which no piece ends
                at += 1
                self._unknown(unit, at, score, back)
            start = end + 1 - length
            total = score[start] + value
            if total > score[end + 1]:
                score[end + 1], back[end + 1] = total, (start, i)
        # A position beyond the last match, or one whose own character is unknown.
        while at < n:
            at += 1
            self._unknown(unit, at, score, back)
        out, at = [], n
        while at:
            start, i = back[at]
            out.append((i,) if i >= 0 else tuple(self.byte_ids[b] for b in unit[start:at].encode()))
            at = start
        return tuple(chain.from_iterable(reversed(out)))

    def _unknown(self, unit: str, at: int, score: list, back: list) -> None:
        """A character outside the vocabulary is one step, spelled in bytes."""
        if unit[at - 1] not in self.characters and score[at - 1] + self.unknown > score[at]:
            score[at], back[at] = score[at - 1] + self.unknown, (at - 1, -1)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, with one space put before it; none for an empty text."""
        if not text:
            return np.zeros(0, dtype="<u4")
        return np.frombuffer(b"".join(map(self.known.__getitem__, _UNIT.findall(" " + text))), dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; it undoes :meth:`encode` exactly."""
        return b"".join(self.bytes_of[ids]).decode("utf-8", "replace")[1:]


def vocabulary_of(config: PieceConfig) -> Vocabulary:
    """One automaton per worker process, whose units the next tasks find solved."""
    return held(("pieces", config), lambda: Vocabulary(config))


def encode(docs: DataFrame, config: PieceConfig, keep: list[str] | None = None) -> DataFrame:
    """The columns in ``keep`` and ``ids``, little-endian unsigned 32-bit, for every row.

    A null or empty text has no ids. Rows do not depend on each other.
    """
    return _mapped(docs, "text", "string", keep, "ids", "binary", pa.binary(), config,
                   lambda vocabulary, text: vocabulary.encode(text or "").tobytes())


def decode(encoded: DataFrame, config: PieceConfig, keep: list[str] | None = None) -> DataFrame:
    """The columns in ``keep`` and ``text`` of rows with ``ids``; null ids are an empty text."""
    return _mapped(encoded, "ids", "binary", keep, "text", "string", pa.string(), config,
                   lambda vocabulary, ids: vocabulary.decode(np.frombuffer(ids or b"", dtype="<u4")))


def _mapped(df, column, kind, keep, out, out_kind, arrow_kind, config, one) -> DataFrame:
    """``one(vocabulary, value)`` of a column as a new column, beside the columns in ``keep``."""
    keep = ["doc_id"] if keep is None else keep
    own = [f"k_{i}" for i in range(len(keep))]
    source = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, own)], F.col(column).cast(kind).alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(config)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values = [one(vocabulary, x) for x in part.column("value").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in own] + [pa.array(values, arrow_kind)], names=[*own, "made"])

    schema = source.drop("value").schema.add("made", out_kind)
    return source.mapInArrow(run, schema).select(
        *[F.col(n).alias(c) for c, n in zip(keep, own)], F.col("made").alias(out))


def checksums(encoded: DataFrame) -> DataFrame:
    """``(n_pieces, ids_crc32)`` in place of ``ids``; the checksum is over the ids' bytes."""
    return (encoded.withColumn("n_pieces", (F.octet_length("ids") / 4).cast("bigint"))
            .withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
