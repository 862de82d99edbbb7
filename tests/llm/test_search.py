"""Exact top-k, revisits, registered queries and the pipeline."""

import zlib

import pytest
from oracle_check import compare, connect

import corpus_pipeline
from rareclass.llm import near_dedup, revisits, toxicity
from rareclass.llm.queries import ORACLES, QUERIES
from rareclass.llm.topk import TopKConfig, exact_top_k

BASE = "id bigint, code bigint, rank int"


def nearest(base, queries, k):
    out = set()
    for q, code in {x for x in queries if None not in x}:
        near = sorted(((code ^ c) & (1 << 64) - 1).bit_count() * 1_000_000 + i
                      for i, c in {x for x in base if None not in x} if i != q)
        out |= {(q, n + 1, x % 1_000_000, x // 1_000_000) for n, x in enumerate(near[:k])}
    return out


@pytest.mark.parametrize("segments", [4, 7, 8, None])
def test_top_k_equals_brute_force(spark, segments):
    import random

    rng = random.Random(segments or 1)
    centres = [rng.getrandbits(64) - (1 << 63) for _ in range(6)]
    base = [(i, rng.choice(centres) ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(4)))) for i in range(300)]
    base += [(1000 + i, centres[0]) for i in range(60)] + [(None, 5), (5000, None), base[0]]
    queries = base[::9] + [(7777, rng.getrandbits(62)), (None, 3)]
    df, asked = (spark.createDataFrame([(a, b, 0) for a, b in x], BASE) for x in (base, queries))
    got = exact_top_k(df, asked, TopKConfig(k=5, segments=segments, sample=64))
    assert {(r.query_id, r.rank, r.id, r.distance) for r in got.collect()} == nearest(base, queries, 5)


def test_top_k_with_few_rows(spark):
    few = spark.createDataFrame([(1, 0, 0), (2, -1, 0)], BASE)
    assert {(r.query_id, r.id, r.distance) for r in exact_top_k(few, few).collect()} == {(1, 2, 64), (2, 1, 64)}
    none = spark.createDataFrame([], BASE)
    assert exact_top_k(none, few).count() == 0 and exact_top_k(few, none).count() == 0


RECORDS = ("record_id bigint, kind string, url string, captured_at bigint, etag string, last_modified string, "
           "headers map<string,string>, status string")


def test_revisits(spark):
    day = 86400
    rows = [
        (1, "response", "http://www.A.com:80/x/?b=2&a=1&utm_source=q#f", 10, '"e"', "D1", {"ETag": '"e"', "Content-Length": "9", "Date": "1"}),
        (2, "response", "https://a.com/x?a=1&b=2", 10, '"f"', "D2", {"etag": '"f"', "ETAG": None, "Server": "s"}),
        (3, "revisit", "a.com/x?a=1&b=2", 20, 'W/"f"', None, {"Date": "7", "content-length": "0", "Set-Cookie": "c"}),
        (4, "revisit", "a.com/x?a=1&b=2", 10, '"f"', None, {}),  # not later than the responses
        (5, "revisit", "a.com/x?b=2&a=1", 100 * day, '"zz"', None, {}),
        (6, "revisit", "a.com/x?b=2&a=1", 200 * day, None, "D2", None),
        (7, "revisit", "a.com/x?b=2&a=1", 300 * day, None, "D9", None),
        (8, "revisit", "a.com/x?b=2&a=1", 300 * day, None, None, {"Vary": "v"}),
        (9, "revisit", None, 5, None, None, None), (10, "revisit", "a.com/X?a=1&b=2", 50, None, None, None),
        (11, "revisit", "a.com/x?b=2&a=1", None, None, None, None), (12, "other", "a.com/x", 1, None, None, None),
        (8, "revisit", "a.com/x?b=2&a=1", 300 * day, None, None, {"Vary": "v"}),
        (13, "response", None, 5, None, None, None), (14, "revisit", "  ", 5, None, None, None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], RECORDS)
    got = revisits.resolve_revisits(df).collect()
    assert sorted((r.record_id, r.response_id or 0, r.status) for r in got) == sorted([
        (3, 2, "resolved"), (4, 0, "no_response"), (5, 2, "mismatch"), (6, 2, "resolved"), (7, 2, "mismatch"),
        (8, 2, "unchecked"), (8, 2, "unchecked"), (9, 0, "no_response"), (10, 0, "no_response"), (11, 0, "no_response"),
        (14, 0, "no_response")])
    told = {r.record_id: r.headers and {e.key: e.value for e in r.headers} for r in got}
    assert told[3] == {"etag": '"f"', "server": "s", "date": "7"}
    assert told[8] == {"etag": '"f"', "server": "s", "vary": "v"} and told[5] is None
    assert revisits.resolve_revisits(df.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert compare(df, connect(sf), ORACLES[name]) is None
    else:
        rows = df.collect()
        assert len(rows) >= 200 and ("same" not in df.columns or all(r.same for r in rows))


def test_lines_and_passages_of_a_larger_table(spark):
    sf = "/root/testdata/sf0.01"
    for name in ("op4_substring_dedup", "op6_line_dedup"):
        assert compare(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) is None


def test_pipeline_stages(spark, sf):
    from test_near import brute
    from test_texts import lines_removed

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = [(900, None, None, "s", None), (901, "", "en", None, 0), (None, "no id here", "en", "s", 10), (7, "seven again", "en", "s", 11),
           (902, "token = abcdefgh12", "en", "s", 18)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    kept = stages["toxicity"](spark, docs, sf)
    assert kept.columns == corpus_pipeline.COLUMNS
    scores = toxicity.toxicity(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()
    assert kept.count() == sum(r.score < .5 for r in scores)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(d, k) if n else (d, t) for (d, t), (_, lines, n, k) in zip(rows, lines_removed(rows, long_words=50)) if n == 0 or n < lines]
    lined = stages["line_dedup"](spark, docs, sf)
    assert sorted(map(repr, ((d, t or "") for d, t in want))) == sorted(repr((r.doc_id, r.text or "")) for r in lined.collect())
    assert all(r.n_chars == len(r.text) for r in lined.collect() if r.text)
    numbered = list(enumerate(t for _, t in rows))  # every row is judged on its own
    near = stages["minhash_near_dedup"](spark, docs, sf).collect()
    classes, of_text = brute(numbered, 5), {}
    for i, text in numbered:
        of_text.setdefault(text, classes[i])
    with_words = [of_text[r.text] for r in near if (r.text or "").split()]
    assert sorted(with_words) == sorted({classes[i] for i, t in numbered if (t or "").split()})
    assert sorted(repr((r.doc_id, r.text)) for r in near if not (r.text or "").split()) == sorted(
        repr(r) for r in rows if not (r[1] or "").split())
    masked = stages["secret_scan"](spark, docs, sf)
    assert masked.count() == len(rows)
    assert masked.where("doc_id = 902").first().text == "[SECRET]"
    packed = stages["packing"](spark, docs, sf)
    assert packed.where("start = 0").count() == len(rows)


def test_near_duplicates_keep_different_texts_of_an_id(spark, sf):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string"
    rows = [(d, " ".join(f"{v}{d}x{i}" for i in range(12)), "en", "s", 1, "clash") for d in range(30) for v in "ab"]
    copies = [(3, rows[6][1], "en", "s", 1, "clash"), (77, rows[6][1] + " more", "en", "s", 1, "clash")]
    got = corpus_pipeline.remove_near_duplicates(spark, spark.createDataFrame(rows + copies, schema), sf)
    assert got.columns == corpus_pipeline.COLUMNS
    texts = [r.text.removesuffix(" more") for r in got.collect()]
    assert sorted(texts) == sorted(r[1] for r in rows)


def test_pipeline_stages_on_nothing_and_on_long_texts(spark, sf):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string"
    long = [(1, "word " * 200_000, "en", "s", 1, "x"), (2, "line\n" * 100_000, "en", "s", 1, "x"), (3, "z" * 500_000, None, None, None, "x")]
    for rows in ([], long):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == corpus_pipeline.COLUMNS and out.count() <= len(rows)
        packed = corpus_pipeline.pack(spark, docs, sf)
        assert packed.where("start = 0").count() == len(rows)


def test_pipeline_runs(spark, sf):
    out = corpus_pipeline.run(spark, sf).collect()
    assert out and all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in out)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = {r.doc_id for r in out}
    assert left <= {r.doc_id for r in docs.collect()}
    assert near_dedup.near_duplicates(docs.where(docs.doc_id.isin(sorted(left)))).where("kept").count() > .9 * len(left)
