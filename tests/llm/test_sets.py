"""Running totals, the Merkle manifest, the conversation trie and source mixing against brute force."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rareclass.llm import manifest as merkle
from rareclass.llm.conversation_trie import TrieConfig, prefix_trie
from rareclass.llm.manifest import ManifestConfig, document_leaves, manifest, version_nodes
from rareclass.llm.mixing import MixConfig, mix, pareto_copies, source_targets
from rareclass.llm.running import running
from rareclass.llm.words import powers
from rareclass.session import materialize

EMPTY = hashlib.sha256(b"").hexdigest()


@pytest.fixture
def ranges(spark):
    """Many small ranges, so that groups go on over several of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_running_totals(spark, ranges):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < .6 else f"g{rng.randrange(9)}", rng.randrange(10**6), rng.randrange(-9, 99),
             rng.getrandbits(64) - (1 << 63)) for _ in range(3000)]
    df = materialize(spark.createDataFrame(rows, "g string, o bigint, x bigint, h bigint"), "test").repartition(3)
    got = running(df, ["g"], ["o", "h"], sums=["x"], chained=["h"]).collect()
    base, want = int(powers(2)[1]), set()
    for g, members in itertools.groupby(sorted(rows, key=lambda r: (r[0], r[1], r[3])), key=lambda r: r[0]):
        x = h = 0
        for place, r in enumerate(members):
            x, h = x + r[2], (h + r[3] * pow(base, place, 1 << 64)) % (1 << 64)
            want.add((*r, place, x, h))
    assert {(r.g, r.o, r.x, r.h, r.place, r.run_x, r.run_h % (1 << 64)) for r in got} == want and len(got) == len(rows)
    assert running(df.where("false"), ["g"], ["o"]).count() == 0


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def up(level):
    return [h(*level[i:i + 2]) for i in range(0, len(level), 2)]


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text), rebuilt whole."""
    def leaf(r, more=0):
        values = [r[0], r[1], r[2], r[3] if r[3] is None else r[3] + more, r[4]]
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    parts = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}

    def root(changed=None):
        def tree(level):
            levels = [level]
            while len(levels[-1]) > 1:
                levels.append(up(levels[-1]))
            return levels
        trees = {x: tree([leaf(r, (x, i) == changed) for i, r in enumerate(p)]) for x, p in parts.items()}
        return trees, tree([trees[x][-1][0] for x in langs])

    trees, top = root()
    out = []
    for x, p in parts.items():
        for i, r in enumerate(p):
            proof = []
            for levels, at in ((trees[x], i), (top, langs.index(x))):
                for level in levels[:-1]:
                    proof += level[at ^ 1:(at ^ 1) + 1]
                    at >>= 1
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = root((x, i))[1][-1][0] if tampered else top[-1][0]
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], h(*proof), folded, folded == top[-1][0]))
    return out


DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, part string, place int, leaf string"


def documents(rng, n):
    rows = []
    for i in range(n):
        lang = rng.choice(["en"] * 20 + ["de", "é", "", None, "zz"])
        rows.append((rng.randrange(10**6), rng.choice(["a", None, "ü"]), lang, rng.choice([None, 5, 2**63 - 1]), rng.choice([None, "", "tëxt " * i])))
    rows += [(7, "s", "only", 3, "x"), (None, "s", "en", 3, "x"), (None, None, None, None, None), rows[0], rows[0],
             (rows[0][0], "s", rows[0][2], 1, "other")]
    return rows


@pytest.mark.parametrize("levels", [1, 2, 12])
def test_manifest_equals_whole_trees(spark, ranges, levels):
    rows = documents(random.Random(levels), 90)
    df = spark.createDataFrame([(*r, "p", 1, "l") for r in rows], DOCS).repartition(5)
    got = manifest(document_leaves(df), ManifestConfig(levels)).collect()
    fields = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=repr) == sorted(brute_manifest(rows), key=repr)
    assert any(not r.verified for r in got)


def test_versions_share_all_but_their_path(spark):
    rows = [(i, "s", "en", 1, f"t{i}") for i in range(40)]
    df = spark.createDataFrame([(*r, "p", 1, "l") for r in rows], DOCS)
    own = version_nodes(document_leaves(df), ManifestConfig(2)).collect()
    told = {r[0]: r for r in brute_manifest(rows)}
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 0]
    assert sorted((r.doc_id, r.level) for r in own) == [(i, level) for i in ids for level in range(7)]
    assert all(r.digest == told[r.doc_id][5] for r in own if r.level == 6)
    assert {r.place for r in own} == set(ids)


def test_manifest_of_little(spark):
    assert manifest(document_leaves(spark.createDataFrame([], DOCS))).count() == 0
    one = manifest(document_leaves(spark.createDataFrame([(1, "s", "en", 1, "t", "p", 1, "l")], DOCS))).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == EMPTY
    assert version_nodes(document_leaves(spark.createDataFrame([], DOCS))).count() == 0


def test_block_heights():
    leaves = [merkle.digest(str(i).encode()) for i in range(5)]
    config = ManifestConfig(3)
    assert merkle.Block(leaves, 0, config).height == 3 and merkle.Block(leaves[:1], 0, config).height == 0
    lone = merkle.Block(leaves[:1], 4, config)  # its level goes on elsewhere
    assert lone.height == 3 and lone.root == merkle.digest(merkle.digest(merkle.digest(leaves[0])))


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, depth bigint, seq string"


def brute_trie(rows):
    told = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            told.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [x[2:] for x in sorted(t, key=lambda x: x[:2])] for c, t in told.items()}
    rebuilt = {}
    for c, own in told.items():
        heads = zlib.crc32(str(c).encode()) % 6
        family = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(told.get(family, [])[:heads] + own[heads:])
    members = {}
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], set()).add(c)
    out = set()
    for node, inside in members.items():
        below = [n for n in members if n[:len(node)] == node]
        parents = {n[:-1] for n in members if n}
        ends = ",".join(map(str, sorted(c for c in inside if rebuilt[c] == node)))
        out.add((min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside),
                 sum(len(n) == len(node) + 1 for n in below), sum(n not in parents for n in below),
                 sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def talks(rng, n):
    rows = []
    for c in range(n):
        conv = rng.choice([0, 100, 1000, 5000, -200]) + rng.randrange(100)
        if any(r[0] == conv for r in rows):
            continue
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "bot", None]), rng.choice([None, "", "a", "bé", "🙂c"])))
    rows += [(c, t, "user", f"same {t}") for c in range(300, 340) for t in range(7)]  # copies and prefixes
    rows += [(c, t, "user", f"same {t}") for c in range(340, 350) for t in range(3)]
    rows += [(7777, None, "user", "first"), (7777, 0, "user", "second"), (None, 1, "user", "x"), (7778, 1, "a", "b"),
             (7778, 1, "a", "b"), (7779, 0, "user", "long " * 50_000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, ranges, seed):
    rows = talks(random.Random(seed), 150)
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], CONVERSATIONS).repartition(4)
    got = prefix_trie(df, TrieConfig(chunk_bits=2)).collect()
    assert {tuple(r) for r in got} == brute_trie(rows) and len(got) == len(brute_trie(rows))


def test_trie_of_little(spark):
    assert prefix_trie(spark.createDataFrame([], CONVERSATIONS)).count() == 0
    gone = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 0)  # its only turn is replaced by none
    got = prefix_trie(spark.createDataFrame([(gone, 0, "a", "b", 1, "s")], CONVERSATIONS)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(gone).encode()).hexdigest())]


MIXED = "doc_id bigint, source string, text string, size int, target string"


def test_targets_share_the_excess(spark):
    sizes = {"a": 100, "b": 5, "c": 1000, "d": 0, "é": 40, "z": 300, None: 900}
    df = spark.createDataFrame([("~" if s is None else f"+{s}", n) for s, n in sizes.items()], "source string, size bigint")
    got = {r.source: r.target for r in source_targets(df).collect()}
    order = ["+a", "+b", "+c", "+d", "+z", "+é", "~"]
    weight = dict(zip(order, [3, 1, 2, 3, 1, 2, 3]))
    limit = {("~" if s is None else f"+{s}"): 2 * n for s, n in sizes.items()}
    whole, want = sum(sizes.values()) * 1.5, {}
    while True:  # as stated: shares by weight, the excess of the capped is shared again
        free = [s for s in order if s not in want]
        left = whole - sum(want.values())
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > limit[s]]
        if not over:
            want |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
            break
        want |= {s: limit[s] for s in over}
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(whole)


def test_mix_meets_targets(spark, ranges):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot"] * 8 + ["b", "c", None]), "w " * rng.choice([1, 3, 10, 200]), 9, "t") for i in range(800)]
    rows += [(900, "lone", "one two", 9, "t"), (901, "b", None, 9, "t"), (902, "none", "", 9, "t"), (None, "c", "x y", 9, "t"),
             (5, "c", "again", 9, "t"), (5, "c", "again", 9, "t"), (903, "long", "v " * 100_000, 9, "t")]
    df = spark.createDataFrame(rows, MIXED)
    got = mix(df.repartition(5)).collect()
    assert len(got) == len(rows) and sorted(map(tuple, got), key=repr) == sorted(map(tuple, mix(df.repartition(2)).collect()), key=repr)
    words = sorted(len((r[2] or "").split()) for r in rows)
    assert sorted(r.size for r in got) == words
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    told = {}
    for r in got:
        size, taken = told.get((r.source_size, r.target), (0, 0))
        told[r.source_size, r.target] = (size + r.size, taken + r.taken)
    for (source_size, target), (size, taken) in told.items():
        assert size % max(1, source_size) == 0
        assert abs(taken - target) <= 1 or source_size in (2, 100_000)
    assert mix(df.where("false")).count() == 0


def test_pareto_inclusion_follows_the_chances(spark):
    """Unequal expected copies: over many draws a row is taken as often as it should be."""
    rng, draws = random.Random(5), 400
    copies = [0.1, 0.25, 0.5, 0.75, 1.3, 1.8] * 10
    rows = [(f"draw{d}", i, 10, rng.random(), c) for d in range(draws) for i, c in enumerate(copies)]
    df = spark.createDataFrame(rows, "source string, doc_id bigint, size bigint, draw double, copies double")
    got = pareto_copies(df.withColumn("n", F.monotonically_increasing_id()))
    totals = {r.t for r in got.groupBy("source").agg(F.sum("copies_taken").alias("t")).collect()}
    assert len(totals) == 1  # the sample has a fixed size
    mean = {r.copies: r.m for r in got.groupBy("copies").agg(F.avg("copies_taken").alias("m")).collect()}
    assert all(abs(mean[c] - c) < .03 for c in mean) and set(mean) == set(copies)


def test_mix_weights_are_a_parameter(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "w " * 4, 9, "t") for i in range(100)], MIXED)
    got = mix(df, MixConfig(weights=(1, 3), percent=50)).groupBy("target").agg(F.sum("taken").alias("n")).collect()
    assert sorted(r.target for r in got) == [50, 150] and all(abs(r.target - r.n) <= 2 for r in got)
