"""Prefix trie of rebuilt conversations, by collapsing whole sequences.

Each turn is hashed once; running sums over a conversation then give the key of every prefix,
and the keys of a rebuilt conversation follow from those of its two parts. Identical rebuilt
conversations collapse into one weighted sequence with the list of those that end there. A
sequence that is a proper prefix of another one is no leaf and is found by an anti-join. Only
the sequences are then expanded into prefixes, whose weights are summed per node.

Every node belongs to the sequence of its smallest member, so each sequence owns a run of nodes
down to its end. A subtree is then a part of its owner's run and the whole runs of all other
sequences below, which makes sums over subtrees plain sums over prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareclass.llm.running import running
from rareclass.llm.words import powers
from rareclass.session import materialize

KEY = ["depth", "key_a", "key_b"]


@dataclass(frozen=True)
class TrieConfig:
    """Conversation ``c`` starts with ``crc32(c) % heads`` turns of ``c - c % family``."""

    family: int = 100
    heads: int = 6
    chunk_bits: int = 12


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, a, b, chars, n)``: 128 bits of each turn's role and text, its code points, a row number."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit("second"), text, role).alias("b"),
        F.length(text).cast("bigint").alias("chars"), F.monotonically_increasing_id().alias("n"))


def _conversations(turns: DataFrame, config: TrieConfig) -> DataFrame:
    """One row per conversation: how it is rebuilt, and the sums at the places where it is cut.

    ``h`` turns of its own are replaced by the first ``t`` of its family's first conversation;
    ``base_*`` are the sums of those, ``own_*`` those of the replaced, ``last_*`` of all its own.
    """
    first = config.heads - 1
    head = F.array_sort(F.collect_list(F.when(F.col("place") < first, F.struct("place", "a", "b", "chars", "run_a", "run_b"))))
    convs = turns.groupBy("conv_id").agg(
        (F.max("place") + 1).alias("n"), F.max_by(F.struct("run_a", "run_b"), "place").alias("last"), head.alias("head"))
    convs = materialize(convs, "conversations")
    heads = convs.where(F.col("conv_id") % config.family == 0).select(F.col("conv_id").alias("base_id"), F.col("head").alias("base"))
    joined = convs.withColumn("base_id", F.expr(f"conv_id - conv_id % {config.family}")).join(heads, "base_id", "left")
    joined = (joined.withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % config.heads).cast("int"))
              .withColumn("base", F.slice(F.coalesce("base", F.array().cast(convs.schema["head"].dataType)), F.lit(1), F.col("h")))
              .withColumn("t", F.size("base")).withColumn("goes_on", F.col("n") > F.col("h")))

    def sums(of: str, place: str):
        # ``place`` turns in front; their sum stands at the last of them.
        return [F.when(F.expr(f"{place} > 0 and {place} <= size({of})"), F.expr(f"try_element_at({of}, {place}).run_{k}"))
                .otherwise(F.lit(0).cast("bigint")) for k in "ab"]

    base, own = sums("base", "t"), sums("head", "h")
    return joined.select("conv_id", "n", "h", "t", "goes_on", "base", *[
        x.alias(f"{name}_{k}") for name, two in (("base", base), ("own", own), ("last", [F.col("last.run_a"), F.col("last.run_b")]))
        for k, x in zip("ab", two)])


def _moved(base: np.ndarray, run: np.ndarray, own: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Sum of a rebuilt prefix: that of the borrowed turns, then the own ones moved ``back`` places."""
    return base + (run - own) * powers(int(back.max(initial=0)) + 1, down=True)[back]


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(c).to_numpy().view(np.uint64) for c in names]


def _whole(convs: DataFrame) -> DataFrame:
    """The conversations with the key of their whole rebuilt sequence: its number of turns and 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            goes_on = batch.column("goes_on").to_numpy(zero_copy_only=False)
            n, h, t = (batch.column(c).to_numpy().astype(np.int64) for c in "nht")
            keys = []
            for k in "ab":
                base, own, last = _columns(batch, f"base_{k}", f"own_{k}", f"last_{k}")
                keys.append(np.where(goes_on, _moved(base, last, own, h - t), base).view(np.int64))
            depth = t + np.where(goes_on, n - h, 0)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(depth), *map(pa.array, keys)],
                                             names=["conv_id", *KEY])

    return convs.drop("base").mapInArrow(run, "conv_id bigint, depth bigint, key_a bigint, key_b bigint")


def _prefixes(rows: DataFrame) -> DataFrame:
    """Nodes on the way to each sequence's end: key, parent's key and last turn's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, h, t = (batch.column(c).to_numpy().astype(np.int64) for c in ("place", "h", "t"))
            at, keys, parents = place - h + t, [], []
            for k in "ab":
                base, own, last, term = _columns(batch, f"base_{k}", f"own_{k}", f"run_{k}", k)
                key = _moved(base, last, own, h - t)
                keys.append(pa.array(key.view(np.int64)))
                parents.append(pa.array((key - term * powers(int(at.max(initial=0)) + 1)[at]).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("seq", "weight", "turns", "chars")), pa.array(at + 1), *keys, *parents],
                names=["seq", "weight", "turns", "chars", *KEY, "parent_a", "parent_b"])

    return rows.mapInArrow(run, "seq bigint, weight bigint, turns bigint, chars bigint, depth bigint, key_a bigint, "
                                "key_b bigint, parent_a bigint, parent_b bigint")


def _ends(whole: DataFrame, config: TrieConfig) -> DataFrame:
    """``(depth, key_a, key_b, ends_sha256)``: the hash of the ids of all conversations of a sequence.

    Ids are joined to chunks where they are counted; only chunks of one sequence meet in a
    task, which hashes them as they pass and holds none of them.
    """
    placed = running(whole, KEY, ["conv_id"], name="ends").withColumn("chunk", F.expr(f"shiftright(place, {config.chunk_bits})"))
    chunks = (placed.groupBy(*KEY, "chunk").agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
              .withColumn("ids", F.expr("array_join(transform(ids, x -> cast(x AS string)), ',')")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            for *now, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if now == key:
                    state.update(b"," + ids.encode())
                else:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = now, hashlib.sha256(ids.encode())
            if done:
                yield _end_rows(done)
                done = []
        if key is not None:
            yield _end_rows([(*key, state.hexdigest())])

    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").select(*KEY, "ids").mapInArrow(
        run, "depth bigint, key_a bigint, key_b bigint, ends_sha256 string")


def _end_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=[*KEY, "ends_sha256"])


def prefix_trie(conversations: DataFrame, config: TrieConfig = TrieConfig()) -> DataFrame:
    """One row per node of the trie of ``conversations(conv_id, turn, role, text)``, as rebuilt.

    ``conv_id`` is the smallest member, ``depth`` the number of turns, ``parent_conv_id`` the
    parent's smallest member (null at the root), ``n_convs`` the members, ``n_children`` the
    nodes one turn longer, ``n_leaves`` the childless nodes below or here, ``saved_tokens`` the
    code points that members share with a smaller one, summed over the subtree, and
    ``ends_sha256`` the hash of the ids that end here. Turns ascend by number, null first; turns
    of one number stand in the order of a hash of their role and text, and repeated rows are
    turns of their own. Null roles and texts are empty. Rows without a ``conv_id`` belong to no
    conversation. Without conversations there is no node, not even a root.
    """
    rows = materialize(hashed_turns(conversations), "turns")
    turns = running(rows, ["conv_id"], ["turn", "a", "b", "n"], chained=["a", "b"], name="turns-in-order")
    convs = materialize(_conversations(turns, config), "rebuilt")
    whole = materialize(_whole(convs), "whole")
    # Identical conversations are one sequence, named by the smallest.
    sequences = materialize(whole.groupBy(*KEY).agg(
        F.min("conv_id").alias("seq"), F.count(F.lit(1)).alias("weight")), "sequences")
    ends = _ends(whole, config)

    chosen = sequences.select("seq", "weight", F.col("depth").alias("turns")).join(convs, F.col("seq") == F.col("conv_id")).drop("conv_id")
    zero, nothing = F.lit(0).cast("bigint"), ["base_a", "base_b", "own_a", "own_b"]
    wanted = ["seq", "weight", "turns", "place", "h", "t", "a", "b", "chars", "run_a", "run_b", *nothing]
    own = turns.join(chosen.where("goes_on").hint("merge"), F.col("conv_id") == F.col("seq")).where("place >= h").select(*wanted)
    borrowed = chosen.select("seq", "weight", "turns", F.explode("base").alias("x")).select(
        "seq", "weight", "turns", "x.place", F.lit(0).alias("h"), F.lit(0).alias("t"),
        *[f"x.{c}" for c in ("a", "b", "chars", "run_a", "run_b")], *[zero.alias(c) for c in nothing])
    null = F.lit(None).cast("bigint")
    roots = sequences.select("seq", "weight", F.col("depth").alias("turns"), *[zero.alias(c) for c in ("chars", *KEY)],
                             null.alias("parent_a"), null.alias("parent_b"))
    prefixes = materialize(_prefixes(own.union(borrowed)).union(roots), "prefixes")
    nodes = materialize(prefixes.groupBy(*KEY).agg(
        F.min("seq").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max("turns").alias("deepest"),
        *[F.min(c).alias(c) for c in ("chars", "parent_a", "parent_b")])
        .withColumn("up", -F.col("depth")).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "nodes")

    # Each sequence's run of nodes, counted from its end: sums down to the end, and the whole run.
    nodes = running(nodes, ["conv_id"], ["up"], sums=["saved"], name="node-runs")
    runs = nodes.groupBy(F.col("conv_id").alias("seq")).agg(F.min("depth").alias("from_depth"), F.sum("saved").alias("run"))
    leaves = sequences.join(nodes.where("deepest > depth").select(*KEY), KEY, "left_anti").select("seq", F.lit(1).alias("leaf"))
    told = sequences.select("seq").join(runs, "seq", "left").join(leaves, "seq", "left")
    below = (prefixes.select("seq", *KEY).join(told.hint("merge"), "seq").groupBy(*KEY).agg(
        F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
        F.coalesce(F.sum(F.when(F.col("depth") < F.col("from_depth"), F.col("run"))), F.lit(0)).alias("others")))

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("key_a"),
                                                F.col("parent_b").alias("key_b")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("key_a").alias("parent_a"),
                           F.col("key_b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(below, KEY).join(children, KEY, "left").join(ends, KEY, "left")
    return found.join(parents, ["depth", "parent_a", "parent_b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        F.col("n_leaves").cast("bigint").alias("n_leaves"), (F.col("run_saved") + F.col("others")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
