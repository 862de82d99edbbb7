"""Registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rareclass.llm import (
    conversation_trie, embedding_dedup, line_dedup, manifest, mixing, near_dedup, packing, revisits, secrets, sentence_pieces,
    substring_dedup, topk, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_minhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of whole documents on sets of two-word shingles."""
    config = near_dedup.NearDedupConfig(shingle_words=2)
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), config)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token of every document in exactly one piece of a sequence of 4096."""
    config = packing.PackingConfig(tokenizer_path("word_bpe_49k.json"))
    return packing.pack(table(spark, sf_dir, "documents"), config).drop("ids")


# Words of a document are its runs of other characters than space and \\x09-\\x0D.
OP4_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
wins AS (
  SELECT doc_id, unnest(range(1, len(ws) - 11)) AS p, ws FROM w WHERE len(ws) >= 13),
keyed AS (SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS win FROM wins),
judged AS (SELECT doc_id, p, doc_id > min(doc_id) OVER (PARTITION BY win) AS rep FROM keyed),
gone AS (SELECT doc_id, list(DISTINCT q) AS qs FROM (
  SELECT doc_id, unnest(range(p, p + 13)) AS q FROM judged WHERE rep) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(qs), 0)::BIGINT AS n_removed,
  sha256(array_to_string(
    CASE WHEN qs IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(qs, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""


@query("op4_substring_dedup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 13-word windows that a smaller document also has."""
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
n AS (
  SELECT doc_id, ls, list_filter(range(1, len(ls) + 1), lambda i: trim(ls[i], E' \t\r\f') <> '') AS nb FROM d),
wins AS (
  SELECT doc_id, unnest(range(1, len(nb) + 1)) AS s, ls, nb FROM n),
-- Three lines, or one or two with 50 words or 400 characters together.
keyed AS (
  SELECT doc_id, s, k, list_transform(nb[s:s + k - 1], lambda i: ls[i]) AS win
  FROM wins, (VALUES (1), (2), (3)) AS v(k) WHERE s + k - 1 <= len(nb)),
long AS (SELECT * FROM keyed WHERE k = 3 OR list_sum(list_transform(win, lambda x: length(x))) >= 400
  OR list_sum(list_transform(win, lambda x: len(string_split_regex(trim(x, E' \t\r\f'), '\s+')))) >= 50),
judged AS (SELECT doc_id, s, k, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) > 1 AS rep FROM long),
gone AS (SELECT doc_id, list(DISTINCT q) AS qs FROM (
  SELECT doc_id, unnest(range(s, s + k)) AS q FROM judged WHERE rep) GROUP BY doc_id),
-- A blank line goes if the lines before and after it are of one deleted run.
raw AS (
  SELECT n.doc_id, ls, nb, qs, list_filter(range(1, len(ls) + 1), lambda i: NOT (
    qs IS NOT NULL AND (list_contains(qs, list_position(nb, i))
      OR (NOT list_contains(nb, i) AND
          list_contains(qs, len(list_filter(nb, lambda x: x < i)))
          AND list_contains(qs, len(list_filter(nb, lambda x: x < i)) + 1)
          ))) IS NOT FALSE) AS stay
  FROM n LEFT JOIN gone USING (doc_id))
SELECT doc_id, len(nb)::BIGINT AS n_lines, coalesce(len(qs), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_transform(stay, lambda i: ls[i]), chr(10))) AS kept_sha256
FROM raw
"""


@query("op6_line_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without runs of three lines or more, or of 50 words or more, that an earlier place also has."""
    found = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents"), long_words=line_dedup.LONG_WORDS)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of whole documents, learned from the labels that are not held out."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def secret_config() -> secrets.SecretConfig:
    import public_tokenizers

    return secrets.SecretConfig(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op9_secret_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in whole documents: base patterns, and strings of low token efficiency."""
    return secrets.scan(table(spark, sf_dir, "documents"), secret_config()).drop("redacted")


@query("op10_embedding_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of vectors of one label that are near by cosine."""
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH c AS (
  SELECT DISTINCT vec_id AS id, CAST(list_sum(list_transform(range(1, 65), lambda i:
    CASE WHEN embedding[i] > 0 THEN 1::HUGEINT << (i - 1)::INTEGER ELSE 0::HUGEINT END)) AS UBIGINT) AS code
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
d AS (
  SELECT q.id AS query_id, b.id, CAST(bit_count(xor(q.code, b.code)) AS INTEGER) AS distance
  FROM c q JOIN c b ON q.id % 50 = 0 AND b.id <> q.id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS INTEGER) AS rank FROM d)
SELECT query_id, rank, id, distance FROM r WHERE rank <= 10
"""


@query("op5_exact_top_k", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest sign codes of every vector whose id is divisible by 50, among all vectors."""
    codes = topk.sign_codes(table(spark, sf_dir, "embeddings"))
    return topk.exact_top_k(codes, codes.where("id % 50 = 0"))


@query("op2_sentence_pieces")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every whole document, and whether decoding them gives the text again."""
    config = sentence_pieces.PieceConfig(tokenizer_path("piece_bpe_32k.model"))
    documents = table(spark, sf_dir, "documents").withColumn("whole", F.coalesce("text", F.lit("")))
    encoded = sentence_pieces.encode(documents, config, ["doc_id", "whole"])
    back = sentence_pieces.decode(encoded, config, ["doc_id", "whole", "ids"])
    return (sentence_pieces.checksums(back.withColumn("same", F.col("whole") == F.col("text")))
            .select("doc_id", "n_pieces", "ids_crc32", "same"))


def capture_records(pages: DataFrame) -> DataFrame:
    """Captures of each page: one full response, and three revisits around it."""
    return pages.select("page_id", "url", "html", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("j")).selectExpr(
        "page_id * 4 + j AS record_id", "if(j = 0, 'response', 'revisit') AS kind",
        "CASE j WHEN 1 THEN replace(url, 'http://', 'HTTPS://') WHEN 3 THEN concat(url, '#again') ELSE url END AS url",
        """1700000000 + page_id * 60 + CASE j WHEN 1 THEN 86400 * (1 + page_id % 40) WHEN 2 THEN -86400 * (page_id % 3)
           WHEN 3 THEN 86400 * 400 + page_id % 1000 ELSE 0 END AS captured_at""",
        """CASE WHEN j = 0 THEN concat('"', substr(md5(html), 1, 16), '"')
           WHEN j = 1 THEN concat('W/"', substr(md5(html), 1, 16), '"')
           WHEN j = 3 AND page_id % 5 = 0 THEN '"other"'
           WHEN j = 3 AND page_id % 5 > 1 THEN concat('"', substr(md5(html), 1, 16), '"') END AS etag""",
        "CASE WHEN j = 0 THEN concat('D', page_id % 1000) WHEN j = 3 THEN concat('D', page_id % 1000 + if(page_id % 10 = 1, 1, 0)) END AS last_modified",
        "length(html) AS size", "page_id").selectExpr(
        "record_id", "kind", "url", "captured_at", "etag", "last_modified",
        """if(kind = 'response',
             map('Content-Type', 'text/html', 'ETag', etag, 'Content-Length', cast(size AS string), 'Date', cast(captured_at AS string)),
             map('date', cast(captured_at AS string), 'cache-control', concat('max-age=', page_id % 100), 'content-length', '0', 'etag', etag)
           ) AS headers""")


OP8_SQL = r"""
WITH p AS (SELECT page_id, url, html, unnest(range(0, 4)) AS j FROM pages),
r AS (
  SELECT page_id * 4 + j AS record_id, j = 0 AS full_, page_id, length(html) AS size,
    CASE j WHEN 1 THEN replace(url, 'http://', 'HTTPS://') WHEN 3 THEN url || '#again' ELSE url END AS url,
    1700000000 + page_id * 60 + CASE j WHEN 1 THEN 86400 * (1 + page_id % 40) WHEN 2 THEN -86400 * (page_id % 3)
      WHEN 3 THEN 86400 * 400 + page_id % 1000 ELSE 0 END AS at_,
    CASE WHEN j = 0 THEN '"' || substr(md5(html), 1, 16) || '"'
      WHEN j = 1 THEN 'W/"' || substr(md5(html), 1, 16) || '"'
      WHEN j = 3 AND page_id % 5 = 0 THEN '"other"'
      WHEN j = 3 AND page_id % 5 > 1 THEN '"' || substr(md5(html), 1, 16) || '"' END AS etag,
    CASE WHEN j = 0 THEN 'D' || (page_id % 1000)
      WHEN j = 3 THEN 'D' || (page_id % 1000 + CASE WHEN page_id % 10 = 1 THEN 1 ELSE 0 END) END AS last_modified
  FROM p),
b AS (SELECT *, regexp_replace(split_part(trim(url), '#', 1), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM r),
h AS (SELECT *, regexp_extract(bare, '^[^/?]*') AS host, regexp_replace(bare, '^[^/?]*', '') AS rest FROM b),
q AS (SELECT *, regexp_replace(regexp_extract(rest, '^[^?]*'), '/+$', '') AS path, list_sort(list_filter(
    string_split(regexp_replace(rest, '^[^?]*\??', ''), '&'),
    lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS params FROM h),
k AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(lower(host), '^www\.', ''), ':(80|443)$', '')
    || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS url_key FROM q),
resp AS (SELECT url_key, at_, max(record_id) AS response_id FROM k WHERE full_ GROUP BY ALL),
m AS (
  SELECT v.*, resp.response_id FROM (SELECT * FROM k WHERE NOT full_) v
  ASOF LEFT JOIN resp ON v.url_key = resp.url_key AND v.at_ > resp.at_),
s AS (
  SELECT m.record_id, m.url_key, m.response_id, CASE WHEN m.response_id IS NULL THEN 'no_response'
      WHEN m.etag IS NOT NULL THEN CASE WHEN regexp_replace(m.etag, '^W/', '') = o.etag THEN 'resolved' ELSE 'mismatch' END
      WHEN m.last_modified IS NOT NULL THEN CASE WHEN m.last_modified = o.last_modified THEN 'resolved' ELSE 'mismatch' END
      ELSE 'unchecked' END AS status,
    'cache-control: max-age=' || (m.page_id % 100) || chr(10) || 'content-length: ' || o.size || chr(10)
      || 'content-type: text/html' || chr(10) || 'date: ' || m.at_ || chr(10) || 'etag: ' || coalesce(m.etag, o.etag) AS headers
  FROM m LEFT JOIN k o ON o.record_id = m.response_id)
SELECT record_id, url_key, response_id, status,
  CASE WHEN status IN ('resolved', 'unchecked') THEN headers END AS headers FROM s
"""


@query("op8_warc_revisits", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits of the pages' captures, resolved to earlier responses."""
    found = revisits.resolve_revisits(capture_records(table(spark, sf_dir, "pages")))
    lines = F.transform("headers", lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(lines, "\n"))


# CRC-32 of a decimal number: one step per bit of its characters.
CRC32_SQL = """list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(CAST({0} AS VARCHAR), ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END)"""

OP11_SQL = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang, xor(""" + CRC32_SQL.format("doc_id") + r""", 4294967295) % 7 = 0 AS tampered,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS front,
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS n0,
    coalesce(strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1), '-') AS n1,
    coalesce(strlen(text) || ':' || text, '-') AS back
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(front || n0 || back) AS leaf, CASE WHEN tampered THEN sha256(front || n1 || back) END AS changed FROM f),
parts AS (SELECT lang, row_number() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS part, count(*) AS n FROM leaves GROUP BY lang),
placed AS (
  SELECT l.*, p.part, p.n, row_number() OVER (PARTITION BY p.part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM leaves l JOIN parts p ON l.lang IS NOT DISTINCT FROM p.lang),
low AS (
  SELECT part, 0 AS level, place AS node, n, leaf AS h FROM placed
  UNION ALL
  SELECT part, level + 1, node // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY node)) FROM low WHERE n > 1
  GROUP BY part, level, node // 2, n),
high AS (
  SELECT 0 AS level, part AS node, (SELECT count(*) FROM parts) AS n, h FROM low WHERE n = 1
  UNION ALL
  SELECT level + 1, node // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY node)) FROM high WHERE n > 1
  GROUP BY level, node // 2, n),
tree AS (
  SELECT part, level, node, n, h FROM low UNION ALL
  SELECT NULL, level, node, n, h FROM high),
way AS (
  SELECT part AS own, place, part, 0 AS level, place AS node, '' AS proof, coalesce(changed, leaf) AS h, false AS done FROM placed
  UNION ALL
  SELECT w.own, w.place,
    CASE WHEN t.n = 1 THEN NULL ELSE w.part END, CASE WHEN t.n = 1 THEN 0 ELSE w.level + 1 END,
    CASE WHEN t.n = 1 THEN w.own ELSE w.node // 2 END, w.proof || CASE WHEN t.n = 1 THEN '' ELSE coalesce(s.h, '') END,
    CASE WHEN t.n = 1 THEN w.h WHEN s.h IS NULL THEN sha256(w.h) WHEN w.node % 2 = 0 THEN sha256(w.h || s.h) ELSE sha256(s.h || w.h) END,
    t.n = 1 AND w.part IS NULL
  FROM way w JOIN tree t ON t.part IS NOT DISTINCT FROM w.part AND t.level = w.level AND t.node = w.node
  LEFT JOIN tree s ON s.part IS NOT DISTINCT FROM w.part AND s.level = w.level AND s.node = xor(w.node, 1)
  WHERE NOT w.done)
SELECT p.doc_id, p.leaf, l.h AS subroot, r.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = r.h AS verified
FROM placed p JOIN way w ON w.own = p.part AND w.place = p.place AND w.done
JOIN low l ON l.part = p.part AND l.n = 1 JOIN high r ON r.n = 1
"""


@query("op11_merkle_manifest", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document in the manifest of all, and the root of its tampered version."""
    return manifest.manifest(manifest.document_leaves(table(spark, sf_dir, "documents")))


OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, (xor(""" + CRC32_SQL.format("conv_id") + r""", 4294967295) % 6)::BIGINT AS h FROM t),
c AS (
  SELECT h.conv_id, list_concat(coalesce(b.ts[1:h.h], []), h.ts[h.h + 1:]) AS ts
  FROM h LEFT JOIN t b ON b.conv_id = h.conv_id - h.conv_id % 100),
p AS (SELECT conv_id, len(ts)::BIGINT AS total, unnest(range(0, len(ts) + 1)) AS depth, ts FROM c),
k AS (SELECT conv_id, total, depth, ts[1:depth] AS seq, CASE WHEN depth > 0 THEN ts[1:depth - 1] END AS up FROM p),
n AS (
  SELECT depth, seq, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, max(total) = depth AS leaf,
    (count(*) - 1) * CASE WHEN depth > 0 THEN length(seq[depth].t) ELSE 0 END AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (total = depth), '')) AS ends_sha256
  FROM k GROUP BY depth, seq),
s AS (
  SELECT a.depth, a.seq, sum(b.leaf::BIGINT)::BIGINT AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens
  FROM n a JOIN n b ON b.depth >= a.depth AND b.seq[1:a.depth] = a.seq GROUP BY ALL),
ch AS (SELECT up AS seq, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY up)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n_children, 0)::BIGINT AS n_children,
  s.n_leaves, s.saved_tokens, n.ends_sha256
FROM n JOIN s ON s.seq = n.seq LEFT JOIN ch ON ch.seq = n.seq LEFT JOIN n u ON u.seq = n.up AND u.depth = n.depth - 1
"""


@query("op12_conversation_trie", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, rebuilt on their families' first turns."""
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> ''))::BIGINT AS size,
    (('0x' || substr(md5('13:' || coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')), 1, 13))::BIGINT + 0.5::DOUBLE)
      / 4503599627370496 AS draw
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size)::BIGINT * 2 AS lim,
    [3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source),
w AS (
  SELECT *, lim::DOUBLE / weight AS turn, (SELECT sum(source_size) FROM s)::DOUBLE * 150 / 100
      - (sum(lim) OVER o - lim)::DOUBLE AS rest,
    (SELECT sum(weight) FROM s) - (sum(weight) OVER o - weight) AS left_weight
  FROM s WINDOW o AS (ORDER BY lim::DOUBLE / weight, source IS NULL, encode(source))),
l AS (SELECT arg_min(rest / left_weight::DOUBLE, turn) AS level FROM w WHERE turn > rest / left_weight::DOUBLE),
g AS (SELECT source, source_size, least(lim::DOUBLE, coalesce(level * weight, lim::DOUBLE)) AS target FROM w, l),
r AS (
  SELECT d.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS copies
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
c AS (SELECT *, copies - floor(copies) AS chance FROM r),
q AS (
  SELECT *, CASE WHEN chance > 0 THEN draw / (1 - draw) / (chance / (1 - chance)) ELSE 'inf'::DOUBLE END AS rank,
    sum(chance * size) OVER (PARTITION BY source) AS budget FROM c),
o AS (
  SELECT *, row_number() OVER x AS place, sum(size) OVER x AS run FROM q
  WINDOW x AS (PARTITION BY source ORDER BY rank, doc_id NULLS FIRST, size, draw ROWS UNBOUNDED PRECEDING)),
i AS (SELECT *, chance > 0 AND 2 * run - size < 2 * budget AS inside FROM o),
gap AS (SELECT *, budget - sum(CASE WHEN inside THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM i),
e AS (
  SELECT source, arg_min(place, {'a': abs(gap - size), 'b': place}) AS closing FROM gap
  WHERE NOT inside AND chance > 0 AND size > 0 AND abs(gap - size) < abs(gap) GROUP BY source)
SELECT gap.doc_id, gap.size, gap.source_size, gap.target,
  gap.size * (floor(copies)::BIGINT + CASE WHEN inside OR place = e.closing THEN 1 ELSE 0 END) AS taken
FROM gap LEFT JOIN e ON gap.source IS NOT DISTINCT FROM e.source
"""


@query("op13_source_mixing", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of the sources, half as large again as all documents, takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents"))
