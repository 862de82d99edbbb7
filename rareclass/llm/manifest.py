"""Merkle manifest of a dataset, with a persistent version for every changed leaf.

Leaves are put in order within their part (a language, say), and every two nodes of a level
become one node above, up to the part's root; the roots of the parts become the dataset's root
in the same way. A tree is stored as aligned blocks of ``2 ** levels`` nodes: one task hashes a
block, block roots are the leaves of the next tier, and so on until one block is left.

A changed leaf makes a new version of the tree by path copying: inside its block only the
ancestors of the leaf are copied, all other nodes are shared with the first version, and the
copied block root continues along the block's path through the tiers above, whose other nodes
are shared as well. No tree is built twice and no version is stored whole.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rareclass.llm.running import running
from rareclass.session import materialize

_LONE, _LEFT, _RIGHT = b"0", b"l", b"r"  # where the sibling stands, in front of its digest
_STEP = 65


@dataclass(frozen=True)
class ManifestConfig:
    """``levels``: a task holds blocks of ``2 ** levels`` nodes."""

    levels: int = 12

    @property
    def block(self) -> int:
        return 1 << self.levels


def digest(data: bytes) -> bytes:
    """Lowercase hex SHA-256."""
    return hashlib.sha256(data).hexdigest().encode()


class Block:
    """An aligned block of a tree. Levels are lists of hex digests, leaves first.

    Block 0 with fewer leaves than fit is a whole tree and ends at one node; any other block
    has the full height, as its level goes on outside of it.
    """

    def __init__(self, leaves: list[bytes], number: int, config: ManifestConfig):
        whole = number == 0 and len(leaves) < config.block
        self.height = (len(leaves) - 1).bit_length() if whole else config.levels
        self.levels = [leaves]
        for _ in range(self.height):
            below = self.levels[-1]
            self.levels.append([digest(b"".join(below[i:i + 2])) for i in range(0, len(below), 2)])

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def path(self, leaf: int) -> bytes:
        """Place and digest of the sibling on every level up to the root, 65 bytes each."""
        steps = []
        for level in self.levels[:self.height]:
            other = leaf ^ 1
            steps.append((_LEFT if leaf & 1 else _RIGHT) + level[other] if other < len(level) else _LONE * _STEP)
            leaf >>= 1
        return b"".join(steps)

    def siblings(self, leaf: int) -> bytes:
        """The digests of ``path``, joined."""
        found = []
        for level in self.levels[:self.height]:
            found += level[leaf ^ 1:(leaf ^ 1) + 1]
            leaf >>= 1
        return b"".join(found)

    def copied(self, leaf: int, changed: bytes) -> list[bytes]:
        """The nodes that a version with another digest of the leaf has of its own, leaf to root."""
        return copied_along(self.path(leaf), changed)


def copied_along(path: bytes, changed: bytes) -> list[bytes]:
    """Copies of a node's ancestors along its path, the changed node itself first."""
    copies = [changed]
    for at in range(0, len(path), _STEP):
        side, other = path[at:at + 1], path[at + 1:at + _STEP]
        low = copies[-1]
        copies.append(digest(low if side == _LONE else other + low if side == _LEFT else low + other))
    return copies


def _siblings(path: bytes) -> bytes:
    return b"".join(path[at + 1:at + _STEP] for at in range(0, len(path), _STEP) if path[at:at + 1] != _LONE)


def field(column: Column) -> Column:
    """``-`` for a null, else the value's UTF-8 length, a colon and the value."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def document_leaves(docs: DataFrame) -> DataFrame:
    """``(doc_id, lang, leaf, changed)``: digests of documents, and of those that are tampered with.

    Where 7 divides the CRC-32 of the decimal id, ``changed`` is the digest with one more in
    ``n_chars``; elsewhere it is null. A null ``n_chars`` stays null, so nothing changes.
    """
    values = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}

    def leaf(n_chars: Column) -> Column:
        return F.sha2(F.concat(*[field(n_chars if c == "n_chars" else v) for c, v in values.items()]), 256)

    more = F.col("n_chars").cast("decimal(20,0)") + 1  # beyond a bigint too
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return docs.select(*values).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        leaf(F.col("n_chars")).alias("leaf"), F.when(tampered, leaf(more)).alias("changed"))


def _blocks(items: DataFrame, config: ManifestConfig) -> DataFrame:
    """``(part, block, root)`` of nodes ``(part, place, leaf)``."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        number = group.column("block")[0].as_py()
        root = Block([x.encode() for x in group.column("leaf").to_pylist()], number, config).root
        return pa.table({"part": group.column("part").slice(0, 1), "block": [number], "root": [root.decode()]})

    kind = items.schema["part"].dataType.simpleString()
    return (items.select("part", "place", "leaf", F.expr(f"shiftright(place, {config.levels})").alias("block"))
            .groupBy("part", "block").applyInArrow(run, f"part {kind}, block bigint, root string"))


def _tiers(leaves: DataFrame, config: ManifestConfig) -> list[DataFrame]:
    """Nodes ``(part, place, leaf)`` of every tier: the leaves, their block roots, and so on to the roots."""
    tiers = [leaves.select("part", "place", "leaf")]
    while True:
        blocks = materialize(_blocks(tiers[-1], config), "tree-blocks")
        tiers.append(blocks.select("part", F.col("block").alias("place"), F.col("root").alias("leaf")))
        if not blocks.agg(F.max("block")).first()[0]:
            return tiers


def _paths(nodes: DataFrame, above: DataFrame, config: ManifestConfig) -> DataFrame:
    """``(part, place, path, subroot, root)`` of a tier's nodes, continued by the paths of their blocks."""

    def run(group: pa.Table, path: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        block = Block([x.encode() for x in group.column("leaf").to_pylist()], path.column("place")[0].as_py(), config)
        rest, n = path.column("path")[0].as_py(), len(group)
        return pa.table({"part": group.column("part"), "place": group.column("place"),
                         "path": pa.array([block.path(i) + rest for i in range(n)], pa.binary()),
                         "subroot": [path.column("subroot")[0].as_py()] * n, "root": [path.column("root")[0].as_py()] * n})

    kind = nodes.schema["part"].dataType.simpleString()
    nodes = nodes.withColumn("block", F.expr(f"shiftright(place, {config.levels})"))
    return (nodes.groupBy("part", "block").cogroup(above.groupBy("part", "place"))
            .applyInArrow(run, f"part {kind}, place bigint, path binary, subroot string, root string"))


def _tops(roots: DataFrame, config: ManifestConfig) -> DataFrame:
    """Paths of the parts' roots ``(part, place, leaf)`` in the tree over the parts."""
    parts = running(roots.select(F.lit(0).alias("all"), F.col("part").alias("name"), "leaf"), ["all"], ["name"],
                    name="tree-parts").select(F.col("all").alias("part"), "name", "place", "leaf")
    tiers = _tiers(parts, config)
    paths = tiers[-1].select("part", "place", F.lit(b"").alias("path"), F.lit("").alias("subroot"), F.col("leaf").alias("root"))
    for nodes in reversed(tiers[:-1]):
        paths = _paths(nodes, paths, config)
    names = parts.select("place", "name", "leaf")
    return materialize(paths.join(names, "place").select(
        F.col("name").alias("part"), F.lit(0).cast("bigint").alias("place"), "path", F.col("leaf").alias("subroot"), "root"),
        "tree-tops")


def ordered_leaves(leaves: DataFrame) -> DataFrame:
    """Leaves ``(doc_id, lang, leaf, changed)`` as ``(part, place, doc_id, leaf, changed)``.

    Within a language they ascend by id (null first), rows of one id by digest. A null language
    comes before all others; a part's name is its language after a ``+``, and empty for null.
    """
    rows = materialize(leaves.select(F.coalesce(F.concat(F.lit("+"), "lang"), F.lit("")).alias("part"), "doc_id",
                                     "leaf", "changed", F.monotonically_increasing_id().alias("n")), "tree-leaves")
    return running(rows, ["part"], ["doc_id", "leaf", "n"], name="tree-order")


def _built(leaves: DataFrame, config: ManifestConfig) -> tuple[DataFrame, DataFrame]:
    """The ordered leaves, and ``(part, place, path, subroot, root)`` of their blocks."""
    ordered = ordered_leaves(leaves)
    tiers = _tiers(ordered, config)
    paths = _tops(tiers[-1], config)
    for nodes in reversed(tiers[1:-1]):
        paths = _paths(nodes, paths, config)
    return ordered.withColumn("block", F.expr(f"shiftright(place, {config.levels})")), paths


def manifest(leaves: DataFrame, config: ManifestConfig = ManifestConfig()) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` for every leaf.

    ``leaves`` are ``(doc_id, lang, leaf, changed)`` with hex digests, as ``document_leaves``
    gives them. ``proof_sha256`` is the digest of the leaf's siblings up to the root, joined.
    ``folded_root`` is the root of the version in which the leaf is ``changed``, or of the first
    version where that is null, and ``verified`` tells whether it equals ``root``. Rows that
    repeat an id are leaves of their own; no rows give no rows.
    """
    ordered, paths = _built(leaves, config)

    def run(group: pa.Table, path: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        block = Block([x.encode() for x in group.column("leaf").to_pylist()], path.column("place")[0].as_py(), config)
        above = path.column("path")[0].as_py()
        joined, n = _siblings(above), len(group)
        shared = copied_along(above, block.root)[-1].decode()
        folded = [shared if x is None else copied_along(above, block.copied(i, x.encode())[-1])[-1].decode()
                  for i, x in enumerate(group.column("changed").to_pylist())]
        proofs = [digest(block.siblings(i) + joined).decode() for i in range(n)]
        return pa.table({"doc_id": group.column("doc_id"), "leaf": group.column("leaf"),
                         "subroot": [path.column("subroot")[0].as_py()] * n, "root": [path.column("root")[0].as_py()] * n,
                         "proof_sha256": proofs, "folded_root": folded})

    found = ordered.select("part", "block", "place", "doc_id", "leaf", "changed").groupBy("part", "block").cogroup(
        paths.groupBy("part", "place")).applyInArrow(
        run, "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def version_nodes(leaves: DataFrame, config: ManifestConfig = ManifestConfig()) -> DataFrame:
    """``(doc_id, part, place, level, digest)``: what each version has of its own, one row per copied node.

    ``level`` counts from the changed leaf up to the dataset's root; ``place`` is the leaf's
    within its part. All other nodes of a version are those of the first.
    """
    ordered, paths = _built(leaves, config)

    def run(group: pa.Table, path: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        number, above = (path.column(c)[0].as_py() for c in ("place", "path"))
        block = Block([x.encode() for x in group.column("leaf").to_pylist()], number, config)
        rows, levels, nodes = [], [], []
        for i, x in enumerate(group.column("changed").to_pylist()):
            if x is not None:
                inside = block.copied(i, x.encode())
                own = inside + copied_along(above, inside[-1])[1:]
                rows += [i] * len(own)
                levels += range(len(own))
                nodes += [node.decode() for node in own]
        out = group.select(["doc_id", "part", "place"]).take(pa.array(rows, pa.int64()))
        return (out.append_column("level", pa.array(levels, pa.int32()))
                .append_column("digest", pa.array(nodes, pa.string())))

    return ordered.groupBy("part", "block").cogroup(paths.groupBy("part", "place")).applyInArrow(
        run, "doc_id bigint, part string, place bigint, level int, digest string")
