"""Components, near-duplicate texts and near-duplicate vectors against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rareclass.llm.components import connected_components
from rareclass.llm.embedding_dedup import EmbeddingConfig, near_duplicate_vectors
from rareclass.llm.near_dedup import NearDedupConfig, near_duplicates

DOCS = "doc_id bigint, text string, source string"


def least_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for u, v in links:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, first=None):
    """``first`` gives the text that speaks for an id with several."""
    sets = {}
    for doc_id, text in rows:
        if doc_id is not None and (first is None or first[doc_id] == (text or "")):
            sets.setdefault(doc_id, []).append(shingles(text, k))
    flat = [(d, s) for d, many in sets.items() for s in many if s]
    links = [(a, b) for i, (a, s) in enumerate(flat) for b, t in flat[:i] if 100 * len(s & t) >= 80 * len(s | t)]
    return least_reachable(sets, links)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(1, 50)] + [(7, 7)]
    df = spark.createDataFrame([*links, (None, 3)], "u bigint, v bigint")
    want = least_reachable({n for p in links if p[0] != p[1] for n in p}, links)
    assert {r.node: r.component for r in connected_components(df).collect()} == want


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def edited(rng, words, share):
    return " ".join(rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in words)


def hard_rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, doc_id = [], 0
    for size in (1, 2, 4, 5, 60, 200):
        base = [rng.choice(vocabulary) for _ in range(size)]
        for share in (0, 0, .01, .02, .03, .04, .05, .06, .08):
            rows.append((doc_id, edited(rng, base, share)))
            doc_id += 1
    base = [rng.choice(vocabulary) for _ in range(120)]  # a large group of near copies at the limit
    rows += [(1000 + i, edited(rng, base, .02)) for i in range(150)]
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "ONE two"), (2004, "one TWO"), (2005, "É one"),
             (2006, "é one"), (None, "one two"), (None, None), (2007, "x " * 60_000), (2008, "x " * 3), (0, rows[0][1]),
             (4, rows[40][1])]
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    rows = hard_rows()
    df = spark.createDataFrame([(d, t, "s") for d, t in rows], DOCS).repartition(7)
    got = near_duplicates(df, NearDedupConfig(shingle_words=k, block=32)).collect()
    ranked = df.selectExpr("doc_id", "coalesce(text, '') t").orderBy(F.xxhash64("t").desc())
    want = brute(rows, k, {r.doc_id: r.t for r in ranked.collect()})
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id is not None} == set(want.items())
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    sizes = sorted((r.doc_id, r.n_shingles) for r in got if r.doc_id is not None)
    assert sizes == sorted((d, len(shingles(t, k))) for d, t in rows if d is not None)


def test_near_duplicates_of_a_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = near_duplicates(docs, NearDedupConfig(shingle_words=2)).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 2)


def test_long_near_copies_are_compared_in_small_groups(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120_000)]  # about a megabyte each
    rows = [(i, " ".join(base[:300 * i] + [f"own{i}"] + base[300 * i + 1:])) for i in range(12)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), NearDedupConfig(block_shingles=200_000))
    assert {r.component_id for r in got.collect()} == {0}


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def brute_vectors(rows, limit):
    good = {}
    for vec_id, x, label in rows:
        if vec_id is None or label is None or not x or any(v is None for v in x):
            continue
        x = np.array(x, dtype=np.float64)
        if np.isfinite(x).all() and x.any():
            good.setdefault(vec_id, (x, label))
    ids, links = sorted(good), []
    for i, a in enumerate(ids):
        for b in ids[:i]:
            (x, p), (y, q) = good[a], good[b]
            if p == q and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= limit:
                links.append((a, b))
    count = {n: 0 for n in {r[0] for r in rows if r[0] is not None}}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return count, least_reachable(count, links)


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, size = [], 16
    for group in range(12):
        base = rng.normal(size=size)
        for _ in range(15):
            near = base + rng.normal(size=size) * rng.choice([0, .02, .1, .2])
            rows.append((len(rows), near.tolist(), group % 3))
    rows += [(900 + i, rows[0][1], rows[0][2]) for i in range(40)]  # copies
    rows += [(950, (np.array(rows[0][1]) * 3).tolist(), rows[0][2]), (951, rows[0][1], None), (952, [0.0] * size, 1),
             (953, None, 1), (954, [], 1), (955, [float("nan")] * size, 1), (956, [None] + [1.0] * (size - 1), 1),
             (957, [1.0, 2.0], 1), (958, [float("inf")] * size, 1), (None, rows[0][1], rows[0][2]), rows[5]]
    df = spark.createDataFrame([(a, b, c, "x") for a, b, c in rows],
                               "vec_id bigint, embedding array<double>, label int, doc_id string").repartition(5)
    got = near_duplicate_vectors(df, EmbeddingConfig(block=16)).collect()
    count, parts = brute_vectors(rows, .93)
    assert len(got) == len(rows)
    told = {r.vec_id: r for r in got if r.vec_id is not None}
    links, found = sum(count.values()), sum(r.n_links for r in told.values())
    assert found <= links and found >= .99 * links
    assert sum(told[v].component_id == c for v, c in parts.items()) >= .99 * len(parts)
    assert all(told[v].n_links <= n for v, n in count.items())
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]


def test_vectors_of_a_table(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    count, parts = brute_vectors(rows, .93)
    got = near_duplicate_vectors(vectors).collect()
    assert {r.vec_id: r.n_links for r in got} == count
    assert {r.vec_id: r.component_id for r in got} == parts


def unit(x):
    return x / np.linalg.norm(x)


@pytest.mark.parametrize("size", [64, 48])
def test_recall_of_planted_pairs(spark, size):
    """Pairs at cosines from the limit on, in as many dimensions as real vectors have."""
    rng, rows = np.random.default_rng(size), []
    for i in range(350):
        a = unit(rng.normal(size=size))
        b = rng.normal(size=size)
        b = unit(b - (b @ a) * a)
        cosine = rng.uniform(.931, .97)
        rows += [(2 * i, a.tolist(), i % 2), (2 * i + 1, (cosine * a + np.sqrt(1 - cosine ** 2) * b).tolist(), i % 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(5)
    count, _ = brute_vectors(rows, .93)
    found = sum(r.n_links for r in near_duplicate_vectors(df).collect())
    assert .99 * sum(count.values()) <= found <= sum(count.values())


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=64).tolist(), 1) for i in range(200)]
    rows += [(500 + i, [1.0 + j for j in range(32)], 1) for i in range(3)] + [(600, rows[0][1][:32], 1), (601, rows[7][1], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicate_vectors(df).collect()}
    assert [got[i] for i in (500, 501, 502)] == [(2, 500)] * 3
    assert got[7] == (1, 7) and got[601] == (1, 7) and got[600] == (0, 600)


def test_segments_follow_the_number_of_cells():
    small, large = EmbeddingConfig().sized(1000), EmbeddingConfig().sized(10**9)
    assert small.segments > large.segments and small.probed_bits <= large.probed_bits
    assert small.edges[-1] == large.edges[-1] == 128


def test_vectors_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert near_duplicate_vectors(empty).count() == 0
