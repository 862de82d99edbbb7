"""Token sequences of a fixed length, balanced by attention cost.

Documents are packed in groups of about ``group_tokens`` tokens as they are read, one group
after the other in every task, so nothing is shuffled and a task holds one group at most. In
a group, pieces are taken in descending length; each goes to the cheapest sequence that has
room for it, by the estimate ``n * linear + n * n * quadratic`` summed over its pieces. Where
none has room, the piece is cut to fill the cheapest sequence with capacity left. Capacities
add up to the group's tokens exactly: full sequences, then powers of two, which need no
padding.
"""

from __future__ import annotations

import heapq
import itertools
import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareclass.llm.words import pieces, words
from rareclass.llm.workers import bound_batches, held


@dataclass(frozen=True)
class PackingConfig:
    """``tokenizer`` is the path of a tokenizers file; ``end_id`` follows every document."""

    tokenizer: str
    length: int = 4096
    end_id: int = 2
    linear: float = 1.0
    quadratic: float = 1.0 / 8192
    group_tokens: int = 1 << 21
    cached_words: int = 1 << 19

    def cost(self, n: int) -> float:
        return n * self.linear + n * n * self.quadratic


# How the word tokenizer prepares a text.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Latin letters, then other signs: two tokens before merging, whatever surrounds them.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*)([!-&(-/:;=?@]*)")


# Words that wait to be merged, and parts of words that are remembered.
_RECENT, _PARTS = 1 << 16, 1 << 16


class _Grown:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.data, self.size = np.zeros(1024, dtype=dtype), 0

    def add(self, values: np.ndarray) -> None:
        while self.size + len(values) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        self.data[self.size:self.size + len(values)] = values
        self.size += len(values)


class WordTokens:
    """Token ids of texts, word by word.

    A tokenizer that splits at white space before anything else gives a text the ids of its
    words one after the other, so each distinct word is encoded once. Plain words skip the
    tokenizer's normalizer and splitter, whose outcome is known for them, and go to its model.
    When the cache holds ``limit`` words, those met in most pieces of text stay, half of them at
    most. Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        form = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in (form["normalizer"] or {}).get("normalizers", [])]
        splits = [x.get("pattern", {}).get("Regex") for x in (form["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.by_word = steps == _NORMALIZERS and splits == [_SPLIT, None]
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._clear()

    def _clear(self) -> None:
        # Learned words: hashes in order and their places, then those learned since the last merge.
        self.keys, self.places = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.recent: dict[int, int] = {}
        self.parts: dict[str, tuple[int, ...]] = {"": ()}
        self.first, self.count, self.ids = _Grown(np.int64), _Grown(np.int64), _Grown(np.uint32)
        self.met = _Grown(np.int32)  # pieces of text that held the word

    def _word_ids(self, texts: list[str]) -> list[tuple[int, ...]]:
        """Ids of each word."""
        plain = [_PLAIN.fullmatch(x) for x in texts]
        split = [(m[1].lower(), m[2]) if m else None for m in plain]
        if len(self.parts) > _PARTS:
            self.parts = {"": ()}
        new = list({p for s in split if s for p in s if p not in self.parts})
        self.parts.update(zip(new, (tuple(e.ids) for e in self.model.encode_batch(new, add_special_tokens=False))))
        odd = [x for x, s in zip(texts, split) if s is None]
        rest = iter([tuple(e.ids) for e in self.tokenizer.encode_batch(odd, add_special_tokens=False)])
        return [next(rest) if s is None else self.parts[s[0]] + self.parts[s[1]] for s in split]

    def _learn(self, hashes: list[int], texts: list[str]) -> None:
        new = self._word_ids(texts)
        count = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
        self.recent.update(zip(hashes, range(self.first.size, self.first.size + len(new))))
        self.first.add(self.ids.size + np.cumsum(count) - count)
        self.count.add(count)
        self.met.add(np.zeros(len(new), dtype=np.int32))
        self.ids.add(np.fromiter(itertools.chain.from_iterable(new), dtype=np.uint32, count=int(count.sum())))

    def _place(self, w, distinct: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The place of each distinct word; words not met before are learned."""
        place = np.full(len(distinct), -1, dtype=np.int64)
        if len(self.keys):
            near = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
            place = np.where(self.keys[near] == distinct, self.places[near], -1)
        rest = np.flatnonzero(place < 0)
        keys = distinct[rest].tolist()
        new = [(key, i) for key, i in zip(keys, rest.tolist()) if key not in self.recent]
        if new:
            data = w.data.tobytes()
            self._learn([key for key, _ in new], [data[w.start[at[i]]:w.end[at[i]]].decode() for _, i in new])
        place[rest] = [self.recent[key] for key in keys]
        self.met.data[place] += 1
        if len(self.recent) > _RECENT:
            self._merge()
        return place

    def _merge(self) -> None:
        """Recent words join those kept in order."""
        keys = np.concatenate([self.keys, np.fromiter(self.recent, dtype=np.uint64, count=len(self.recent))])
        places = np.concatenate([self.places, np.fromiter(self.recent.values(), dtype=np.int64, count=len(self.recent))])
        order = np.argsort(keys)
        self.keys, self.places, self.recent = keys[order], places[order], {}

    def _shrink(self) -> None:
        """Words that only one piece held go, and of the others the rarest beyond half of the limit."""
        self._merge()
        met, half = self.met.data[self.places], self.limit // 2
        least = 2 if (met > 1).sum() <= half else int(np.partition(met, len(met) - half)[len(met) - half]) + 1
        stay = met >= least
        keys, old = self.keys[stay], self.places[stay]
        first, count, ids, met = self.first.data[old], self.count.data[old], self.ids.data, met[stay]
        begin = np.cumsum(count) - count
        ids = ids[np.repeat(first - begin, count) + np.arange(int(count.sum()))]
        self._clear()
        self.keys, self.places = keys, np.arange(len(keys))
        for grown, values in ((self.first, begin), (self.count, count), (self.ids, ids), (self.met, met >> 1)):
            grown.add(values)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text begins (one more than there are texts)."""
        if not self.by_word:
            found = [e.ids for e in self.tokenizer.encode_batch(
                column.fill_null("").to_pylist(), add_special_tokens=False)]
            return (np.array([i for x in found for i in x], dtype=np.uint32),
                    np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64))
        if self.first.size > self.limit:
            self._shrink()
        w = words(column)
        distinct, at, code = np.unique(w.hash, return_index=True, return_inverse=True)
        place = self._place(w, distinct, at)[code]
        first, count = self.first.data[place], self.count.data[place]
        ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        return self.ids.data[np.repeat(first - ends[:-1], count) + np.arange(ends[-1])], ends[w.first]


def word_tokens(path: str, limit: int) -> WordTokens:
    """One encoder per worker process, whose words the next tasks find learned."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are parallel already
    return held(("words", path, limit), lambda: WordTokens(path, limit))


class Room:
    """The cheapest of the sequences that have at least some capacity left."""

    def __init__(self, capacities: list[int], length: int):
        self.size = 1 << length.bit_length()
        self.heaps: dict[int, list] = {}
        self.best: list[tuple | None] = [None] * (2 * self.size)
        for sequence, capacity in enumerate(capacities):
            self.put(capacity, 0.0, sequence)

    def _lift(self, at: int) -> None:
        heap = self.heaps.get(at)
        node = at + self.size
        self.best[node] = (heap[0][0], heap[0][1], at) if heap else None
        while node > 1:
            node >>= 1
            a, b = self.best[2 * node], self.best[2 * node + 1]
            self.best[node] = a if b is None or (a is not None and a <= b) else b

    def put(self, capacity: int, cost: float, sequence: int) -> None:
        if capacity:
            heapq.heappush(self.heaps.setdefault(capacity, []), (cost, sequence))
            self._lift(capacity)

    def take(self, least: int) -> tuple[int, float, int] | None:
        """Removes and returns (capacity, cost, sequence) with ``capacity >= least``."""
        low, high, best = least + self.size, 2 * self.size, None
        while low < high:
            for node in ([low] if low & 1 else []) + ([high - 1] if high & 1 else []):
                if self.best[node] is not None and (best is None or self.best[node] < best):
                    best = self.best[node]
            low, high = (low + 1) >> 1, high >> 1
        if best is None:
            return None
        cost, sequence, capacity = best
        heapq.heappop(self.heaps[capacity])
        self._lift(capacity)
        return capacity, cost, sequence


def capacities(total: int, length: int) -> list[int]:
    """Full sequences, then the powers of two that make up the rest."""
    rest = total % length
    return [length] * (total // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(sizes: np.ndarray, config: PackingConfig) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of documents of these sizes."""
    rooms = capacities(int(sizes.sum()), config.length)
    room, out = Room(rooms, config.length), []
    used = [0] * len(rooms)
    open_pieces = [(-min(int(n) - at, config.length), doc, at)
                   for doc, n in enumerate(sizes) for at in range(0, int(n), config.length)]
    heapq.heapify(open_pieces)
    while open_pieces:
        size, doc, start = heapq.heappop(open_pieces)
        size = -size
        capacity, cost, sequence = room.take(size) or room.take(1)
        fits = min(size, capacity)
        out.append((doc, start, fits, sequence, used[sequence]))
        used[sequence] += fits
        room.put(capacity - fits, cost + config.cost(fits), sequence)
        if fits < size:
            heapq.heappush(open_pieces, (fits - size, doc, start + fits))
    return out


_SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
           "offset bigint, ids binary")


def pack(docs: DataFrame, config: PackingConfig) -> DataFrame:
    """One row per piece of a document in a sequence.

    ``ids`` are little-endian unsigned 32-bit token ids, ``ids_crc32`` their checksum. A null
    or empty text is its end id alone. Rows with a null or repeated id are documents of their
    own. ``sequence_id`` is the task's number << 40 plus a count; sequences have ``length``
    tokens, but for the last few of a group, whose lengths are powers of two.
    """

    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokens(config.tokenizer, config.cached_words)
        base = TaskContext.get().partitionId() << 40
        doc_ids, tokens, held = [], [], 0
        for piece in pieces(batches, "text"):
            ids, first = encoder.encode(piece.column("text"))
            for i, doc_id in enumerate(piece.column("doc_id").to_pylist()):
                one = np.empty(first[i + 1] - first[i] + 1, dtype="<u4")
                one[:-1] = ids[first[i]:first[i + 1]]
                one[-1] = config.end_id
                doc_ids.append(doc_id)
                tokens.append(one)
                held += len(one)
            if held >= config.group_tokens:
                yield from _packed(doc_ids, tokens, base, config)
                base += -(-held // config.length) + 16
                doc_ids, tokens, held = [], [], 0
        if tokens:
            yield from _packed(doc_ids, tokens, base, config)

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, _SCHEMA))


def _packed(doc_ids: list, tokens: list[np.ndarray], base: int, config: PackingConfig) -> Iterator[pa.RecordBatch]:
    placed = assign(np.array([len(x) for x in tokens], dtype=np.int64), config)
    for at in range(0, len(placed), 8192):
        rows = placed[at:at + 8192]
        ids = [tokens[doc][start:start + size].tobytes() for doc, start, size, _, _ in rows]
        yield pa.RecordBatch.from_arrays([
            pa.array([doc_ids[r[0]] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
            pa.array([zlib.crc32(x) for x in ids], pa.int64()),
            pa.array([len(tokens[r[0]]) for r in rows], pa.int64()),
            pa.array([base + r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int64()),
            pa.array(ids, pa.binary())], names=[c.split()[0] for c in _SCHEMA.split(", ")])
