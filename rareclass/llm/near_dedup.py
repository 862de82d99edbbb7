"""Near-duplicate texts: MinHash, banding, verification, connected components.

Texts with equal shingle sets are one node, so copies never meet each other. Signatures are
banded; every bucket links its members to its smallest and largest node, the signatures and
then the full sets confirm the links, and components merge what is linked. Buckets that still
hold several components are then compared in blocks, by signatures first and full sets after;
a block returns the links it confirms and never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareclass.llm.components import connected_components
from rareclass.llm.words import RangeHash, Words, mix, pieces, words
from rareclass.llm.workers import bound_batches, release
from rareclass.session import materialize

_STEP = np.uint64(0xA0761D6478BD642F)
_SHORT = np.uint64(0xE7037ED1A0B428DB)
_BLOCK = 4096


@dataclass(frozen=True)
class NearDedupConfig:
    """``similarity`` is a share in percent: a link needs 100 * common >= similarity * union.

    With 32 bands of 5 minima a pair at the limit of 80 % shares no band with probability
    3e-6, and ``slack`` leaves five standard deviations to the signature check.
    A group of the last step compares ``block`` texts, or fewer if they hold ``block_shingles``
    shingles together, with as many others.
    """

    shingle_words: int = 5
    similarity: int = 80
    bands: int = 32
    rows: int = 5
    slack: float = 5.0
    block: int = 512
    block_shingles: int = 1 << 18
    seed: int = 7

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def least_equal(self) -> int:
        """Equal minima that a pair must have to be checked on its full sets."""
        s = self.similarity / 100
        return max(0, math.floor(self.hashes * s - self.slack * math.sqrt(self.hashes * s * (1 - s))))


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of every text, sorted by both."""
    n = len(w.hash) - k + 1
    texts, hashes = [], []
    if n > 0:
        value = w.hash[:n].copy()
        for j in range(1, k):
            value = value * _STEP + w.hash[j:n + j]
        whole = w.doc[:n] == w.doc[k - 1:]
        texts.append(w.doc[:n][whole])
        hashes.append(mix(value[whole]))
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        texts.append(short)
        hashes.append(RangeHash(w.hash)(w.first[short], w.first[short + 1]) ^ _SHORT)
    if not texts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    text, value = np.concatenate(texts), np.concatenate(hashes)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    fresh = np.ones(len(text), dtype=bool)
    fresh[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[fresh], value[fresh]


def _factors(config: NearDedupConfig) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(config.seed)
    draw = rng.integers(0, 1 << 32, size=(2, config.hashes, 1), dtype=np.uint32)
    return draw[0] | np.uint32(1), draw[1]


def signatures(value: np.ndarray, first: np.ndarray, config: NearDedupConfig) -> np.ndarray:
    """Minima of ``a * x + b`` modulo 2**32 over each set, one row per set."""
    a, b = _factors(config)
    x = (value >> np.uint64(32)).astype(np.uint32)
    out = np.full((len(first) - 1, config.hashes), 0xFFFFFFFF, dtype=np.uint32)
    for i, (start, end) in enumerate(zip(first[:-1], first[1:])):
        for at in range(start, end, _BLOCK):
            block = x[None, at:min(at + _BLOCK, end)]
            np.minimum(out[i], (a * block + b).min(axis=1), out=out[i])
    return out


def _fixed_binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.dtype.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [
        None, pa.py_buffer(np.ascontiguousarray(rows))]).cast(pa.binary())


def sign(docs: DataFrame, config: NearDedupConfig) -> DataFrame:
    """``(doc_id, text_key, n_shingles, set_a, set_b, minima)``; an empty set has null minima."""

    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for piece in pieces(batches, "text"):
            text, value = shingle_sets(words(piece.column("text"), lower=True), config.shingle_words)
            first = np.searchsorted(text, np.arange(piece.num_rows + 1))
            size = np.diff(first)
            # A set is told apart by two sums over its members, 128 bits, and its size.
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(v)]) for v in (value, mix(value + _STEP))]
            keys = [mix((s[first[1:]] - s[first[:-1]]) ^ size.astype(np.uint64)).view(np.int64) for s in sums]
            minima = _fixed_binary(signatures(value, first, config))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("text_key"), pa.array(size), pa.array(keys[0]), pa.array(keys[1]),
                 pa.compute.if_else(pa.array(size > 0), minima, pa.scalar(None, pa.binary()))],
                names=["doc_id", "text_key", "n_shingles", "set_a", "set_b", "minima"])

    return docs.select("doc_id", "text_key", "text").mapInArrow(
        run, "doc_id bigint, text_key bigint, n_shingles bigint, set_a bigint, set_b bigint, minima binary")


def band_keys(minima: np.ndarray, config: NearDedupConfig) -> np.ndarray:
    """One 64-bit key per set and band; the band's number is part of it."""
    part = minima.reshape(-1, config.bands, config.rows).astype(np.uint64)
    key = np.zeros(part.shape[:2], dtype=np.uint64) + np.arange(config.bands, dtype=np.uint64)[None, :]
    for j in range(config.rows):
        key = mix(key * _STEP + part[:, :, j])
    return key


def band_rows(nodes: DataFrame, config: NearDedupConfig) -> DataFrame:
    """``(bucket, node, component, n_shingles)``: the band keys of ``(node, component, n_shingles, minima)``."""
    carried = ["node", "component", "n_shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key = band_keys(np.frombuffer(b"".join(batch.column("minima").to_pylist()), dtype=np.uint32), config)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel().view(np.int64)),
                 *[pa.array(np.repeat(batch.column(c).to_numpy(), config.bands)) for c in carried]],
                names=["bucket", *carried])

    return nodes.select(*carried, "minima").mapInArrow(
        run, "bucket bigint, node bigint, component bigint, n_shingles bigint")


def alike(pairs: DataFrame, nodes: DataFrame, config: NearDedupConfig) -> DataFrame:
    """The pairs ``(u, v)`` whose signatures agree often enough."""
    least = config.least_equal

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32)
                    .reshape(batch.num_rows, -1) for c in ("minima_u", "minima_v"))
            keep = pa.array((a == b).sum(axis=1) >= least)
            yield batch.select(["u", "v"]).filter(keep)

    left, right = (nodes.select(F.col("node").alias(c), F.col("minima").alias(f"minima_{c}")) for c in "uv")
    return pairs.join(left, "u").join(right, "v").mapInArrow(run, "u bigint, v bigint")


def confirmed(pairs: DataFrame, docs: DataFrame, config: NearDedupConfig) -> DataFrame:
    """The pairs whose full shingle sets are similar enough. Texts are read from ``docs``."""
    k, share = config.shingle_words, config.similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text_u"):
            n = piece.num_rows
            both = pa.concat_arrays([piece.column("text_u"), piece.column("text_v")])
            text, value = shingle_sets(words(both, lower=True), k)
            size = np.bincount(text, minlength=2 * n)
            pair = text % n
            order = np.lexsort((value, pair))
            pair, value = pair[order], value[order]
            twice = (pair[1:] == pair[:-1]) & (value[1:] == value[:-1])
            common = np.bincount(pair[1:][twice], minlength=n)
            union = size[:n] + size[n:] - common
            keep = pa.array((100 * common >= share * union) & (common > 0))
            yield piece.select(["u", "v"]).filter(keep)

    left, right = (docs.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}")) for c in "uv")
    return pairs.join(left, "u").join(right, "v").mapInArrow(run, "u bigint, v bigint")


def _texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """The texts of the documents in ``ids(doc_id)``, one per id, written once.

    The ids grow with the table, so they are merged and not broadcast at any size.
    """
    return materialize(docs.join(ids.distinct().hint("merge"), "doc_id", "left_semi")
                       .dropDuplicates(["doc_id"]), "texts")


def _dealt(members: DataFrame, config: NearDedupConfig) -> DataFrame:
    """Members of each bucket in pairs ``(i, j)`` of blocks, bounded by their number and their shingles.

    Links are only missing between components, so members of all components but the bucket's
    largest (``asks``) meet all members (``told``). A bucket that is nearly one component gives
    few rows beside its own, and a large one is spread over many groups.
    """
    parts = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    buckets = parts.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("n"), F.sum("size").alias("size"),
        F.max(F.struct("n", "component", "size")).alias("most")).withColumns({
            "told": _blocks("n", "size", config), "asks": _blocks("n - most.n", "size - most.size", config)})
    dealt = members.join(buckets.select("bucket", "main", "told", "asks").hint("merge"), "bucket")
    minor, side = F.col("component") != F.col("main"), F.xxhash64("node")

    def spread(rows: DataFrame, own: str, other: str, names: tuple[str, str], asks: bool) -> DataFrame:
        return rows.select("bucket", "node", "component", F.lit(asks).alias("asks"), minor.alias("minor"),
                           F.pmod(side, F.col(own)).cast("int").alias(names[0]),
                           F.explode(F.sequence(F.lit(0), F.col(other).cast("int") - 1)).alias(names[1]))

    asking, told = spread(dealt.where(minor), "asks", "told", ("i", "j"), True), spread(dealt, "told", "asks", ("j", "i"), False)
    return asking.unionByName(told)


def _blocks(count: str, size: str, config: NearDedupConfig):
    return F.expr(f"cast(greatest(ceil(({count}) / {config.block}), ceil(({size}) / {config.block_shingles})) AS bigint)")


def _across(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that ask, rows that are told, and which pairs of them are this group's to compare."""
    component, node, minor, asks = (group.column(c).to_numpy() for c in ("component", "node", "minor", "asks"))
    a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
    ask = component[a][:, None] != component[b][None, :]
    # Two that both ask meet twice: the smaller one's turn counts.
    return a, b, ask & ~(minor[b][None, :] & (node[a][:, None] > node[b][None, :]))


_DEALT = ["bucket", "i", "j", "asks", "minor", "node", "component"]


def _undecided(dealt: DataFrame, config: NearDedupConfig) -> DataFrame:
    """Rows of ``_dealt`` (with minima) that have a likely partner in another component.

    A pair is looked at in the first of the buckets that it shares.
    """
    least = config.least_equal

    def run(group: pa.Table) -> pa.Table:
        minima = np.frombuffer(b"".join(group.column("minima").to_pylist()), dtype=np.uint32).reshape(len(group), -1)
        a, b, ask = _across(group)
        keys = band_keys(minima, config)
        here = int(np.flatnonzero(keys[0].view(np.int64) == group.column("bucket")[0].as_py())[0])
        for band in range(here):
            ask &= keys[a, band][:, None] != keys[b, band][None, :]
        hit = np.zeros(len(group), dtype=bool)
        u, v = np.nonzero(ask)
        u, v = a[u], b[v]
        for at in range(0, len(u), _BLOCK):
            x, y = u[at:at + _BLOCK], v[at:at + _BLOCK]
            close = (minima[x] == minima[y]).sum(axis=1) >= least
            hit[x[close]] = hit[y[close]] = True
        return group.select(_DEALT).filter(pa.array(hit))

    return dealt.groupBy("bucket", "i", "j").applyInArrow(
        run, "bucket bigint, i int, j int, asks boolean, minor boolean, node bigint, component bigint")


def _group_shingles(column: pa.ChunkedArray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets`` of a group's texts, read in bounded pieces."""
    texts, values, row = [], [], 0
    for piece in pieces(pa.table({"text": column}).to_batches(), "text"):
        text, value = shingle_sets(words(piece.column("text"), lower=True), k)
        texts.append(text + row)
        values.append(value)
        row += piece.num_rows
    return np.concatenate(texts), np.concatenate(values)


def _links_between(dealt: DataFrame, config: NearDedupConfig) -> DataFrame:
    """Confirmed links ``(u, v)`` of rows of ``_dealt`` (with texts), enough to merge components.

    Common shingles of all pairs of a group come from products of 0/1 matrices over the
    shingles that at least two texts have, a few thousand columns at a time.
    """
    k, share = config.shingle_words, config.similarity

    def run(group: pa.Table) -> pa.Table:
        text, value = _group_shingles(group.column("text"), k)
        n = len(group)
        size = np.bincount(text, minlength=n)
        _, code, count = np.unique(value, return_inverse=True, return_counts=True)
        shared = count > 1
        column = np.cumsum(shared) - 1
        text, code = text[shared[code]], column[code[shared[code]]]
        order = np.argsort(code, kind="stable")
        text, code = text[order], code[order]
        a, b, ask = _across(group)
        common = np.zeros((len(a), len(b)), dtype=np.float32)
        for at in range(0, int(shared.sum()), 4096):
            lo, hi = np.searchsorted(code, [at, at + 4096])
            part = np.zeros((n, 4096), dtype=np.float32)
            part[text[lo:hi], code[lo:hi] - at] = 1
            common += part[a] @ part[b].T
        union = size[a][:, None] + size[b][None, :] - common
        u, v = np.nonzero(ask & (100 * common >= share * union) & (common > 0))
        u, v = a[u], b[v]
        component = group.column("component").to_numpy()
        ends = np.sort(np.stack([component[u], component[v]], axis=1), axis=1)
        _, one = np.unique(ends, axis=0, return_index=True)
        node = group.column("node").to_numpy()
        return pa.table({"u": node[u[one]], "v": node[v[one]]})

    return dealt.groupBy("bucket", "i", "j").applyInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, config: NearDedupConfig = NearDedupConfig()) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs(doc_id, text)``.

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; a text with fewer than
    ``shingle_words`` words is one shingle. A null or empty text, and a row without an id, has
    no links; the latter has a null ``component_id`` and is kept. An id that repeats is one
    document: where its texts differ, the one with the least ``xxhash64`` links for all its
    rows. ``component_id`` is the least id reachable by links.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    signed = materialize(sign(docs, config), "signed")
    # Ids with several texts, usually none: only one of the texts speaks for the id.
    several = (signed.groupBy(F.col("doc_id").alias("id")).agg(F.min("text_key").alias("first"), F.max("text_key").alias("last"))
               .where("first < last").select("id", "first"))

    def speaking(rows: DataFrame) -> DataFrame:
        return rows.join(several, (rows.doc_id == several.id) & (rows.text_key != several["first"]), "left_anti")

    full = speaking(signed.where("n_shingles > 0 and doc_id is not null"))
    # One node per distinct set, named by its least id; copies hang on it.
    sets = full.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("node"))
    named = materialize(full.join(sets, ["set_a", "set_b", "n_shingles"]).select(
        "doc_id", "node", "n_shingles", F.when(F.expr("doc_id = node"), F.col("minima")).alias("minima")), "named")
    copies = named.where("doc_id != node").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    nodes = named.where("minima is not null").select("node", F.col("node").alias("component"), "n_shingles", "minima")
    nodes = nodes.dropDuplicates(["node"])

    # Leaders: every bucket links its members to its least and its greatest node.
    bands = band_rows(nodes, config).drop("component", "n_shingles")
    ends = bands.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    # A node has many band keys, of which the planner knows nothing: neither side is broadcast.
    pairs = (bands.join(ends.hint("merge"), "bucket").select("node", F.explode(F.array("a", "b")).alias("leader"))
             .where("node != leader").select(F.greatest("node", "leader").alias("u"), F.least("node", "leader").alias("v"))
             .distinct())
    pairs = materialize(pairs, "pairs")
    likely = materialize(alike(pairs, nodes, config), "likely")
    # Every node of a bucket with several nodes is in a pair; their texts serve both searches.
    texts = _texts_of(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")), speaking(docs).drop("text_key"))
    links = materialize(confirmed(likely, texts, config), "confirmed")
    found = connected_components(links)

    # The rest: buckets that still hold several components, compared block by block.
    labelled = materialize(nodes.drop("component").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node")).select("node", "component", "n_shingles", "minima"), "labelled")
    bands = band_rows(labelled, config)
    mixed = (bands.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"))
             .where("a < b").select("bucket"))
    rest = materialize(_dealt(bands.join(mixed.hint("merge"), "bucket"), config), "rest")
    open_rows = materialize(_undecided(rest.join(labelled.select("node", "minima"), "node"), config), "undecided")
    more = materialize(_links_between(open_rows.join(
        texts.withColumnRenamed("doc_id", "node"), "node"), config), "links")

    # Copies, and rows that repeat an id, join their node's component.
    found = connected_components(
        found.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more).union(copies))
    return (signed.select("doc_id", "n_shingles").join(found, signed.doc_id == found.node, "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.expr("doc_id = component_id"), F.lit(True))))
