"""One query per operator over its whole table, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, balltree, buckets, mixing, pii, setsketch, shards, tokens, topk, toxicity, trie, urlrules, warc
from tidemark.llm.common import table
from tidemark.session import local_frame, work_path

Query = Callable[[SparkSession, str], DataFrame]

# Host, path and verdict of the rules on urls.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

SHARDS = [f"shard-{i:03d}" for i in range(64)]


def op1_shard_placement(spark, sf_dir):
    """The shard of each document, and where it is after the first shard is lost."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    placed = shards.place(docs, SHARDS, "doc_id")
    after = shards.place(placed, SHARDS[1:], "doc_id", slot="slot_after", shard="shard_after")
    moved = F.col("shard") != F.col("shard_after")
    return after.select("doc_id", "slot", "shard", "shard_after", moved.alias("moved"))


def op2_warc_salvage(spark, sf_dir):
    path = work_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records, _ = warc.read_archives(spark, path, payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_setsketch_dedup(spark, sf_dir):
    found = setsketch.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_length_buckets(spark, sf_dir):
    return buckets.pack(table(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels)
    scored = docs.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), toxicity.score("text", model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_adaptive_scan(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_source_mix(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_weak_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    number = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == pii.KINDS.index(kind)))
    return found.select(
        "doc_id",
        *[number(kind).cast("long").alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.written(F.col("base_spans")), 256).alias("base_sha256"),
        pii.written(F.col("all_spans")).alias("spans"),
    )


def op9_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op10_block_topk(spark, sf_dir):
    return topk.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op11_prefix_trie(spark, sf_dir):
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_ball_tree(spark, sf_dir):
    return balltree.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_url_rules(spark, sf_dir):
    rules = local_frame(spark, URL_RULES, "host string, path string, verdict string")
    return urlrules.judge(table(spark, sf_dir, "pages"), rules)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_shard_placement,
        op2_warc_salvage,
        op3_setsketch_dedup,
        op4_length_buckets,
        op5_toxicity,
        op6_adaptive_scan,
        op7_source_mix,
        op8_weak_pii,
        op9_token_counts,
        op10_block_topk,
        op11_prefix_trie,
        op12_ball_tree,
        op13_url_rules,
    )
}

ORACLE: dict[str, str] = {}

ORACLE["op7_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    md5(concat('mix:', coalesce('i' || doc_id, 'null'), ':', coalesce('t' || md5(text), 'null'))) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
    [5.0, 2.0, 1.0][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)]::DOUBLE AS w
  FROM d GROUP BY source),
l AS (
  SELECT source, source_size, w, 2 * source_size AS cap,
    (1.5 * (sum(source_size) OVER ()) - coalesce(sum(2 * source_size) OVER f, 0))
      / ((sum(w) OVER ()) - coalesce(sum(w) OVER f, 0)) AS level
  FROM s
  WINDOW f AS (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
    least(cap, w * (SELECT max(level) FROM l WHERE cap / w >= level)) AS target
  FROM l),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(size * (whole + CASE WHEN 2 * start + size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""

ORACLE["op2_warc_salvage"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS lead,
    row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC) AS place
  FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < 1000 OR place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes < 1000 OR place = 1 THEN NULL ELSE lead END AS refers_to
FROM m
"""

ORACLE["op3_setsketch_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
h AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM h JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.root) AS component_id,
  d.doc_id = min(r.root) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.node = d.doc_id
GROUP BY d.doc_id, n.n
"""

ORACLE["op10_block_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

ORACLE["op13_url_rules"] = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

# CRC-32 has no function in DuckDB: the table of its 256 steps and a fold over the digits.
ORACLE["op11_prefix_trie"] = """
WITH k AS (
  SELECT list(list_reduce(list_prepend(i::UBIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM range(256) r(i)),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
    xor(4294967295::UBIGINT, list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
      lambda a, b: xor(a >> 8, steps[CAST(1 + xor(a, b) % 256 AS BIGINT)]))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), k),
t AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) AS pos FROM t),
r AS (
  SELECT c.conv_id, 0 AS own, o.pos, o.x, o.text FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, o.pos, o.x, o.text FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h),
p AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(x, '') OVER w AS path, length(text) AS size
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
l AS (SELECT conv_id, max(depth) AS length FROM p GROUP BY conv_id),
n AS (
  SELECT p.depth, p.path, min(p.conv_id) AS conv_id, count(*) AS n, any_value(p.size) AS size,
    count_if(p.depth = l.length) AS ended,
    string_agg(CASE WHEN p.depth = l.length THEN p.conv_id::VARCHAR END, ',' ORDER BY p.conv_id) AS ends
  FROM p JOIN l USING (conv_id) GROUP BY p.depth, p.path),
s AS (
  SELECT u.depth, u.path, sum((v.n - 1) * v.size) AS saved, count_if(v.ended = v.n) AS leaves
  FROM (SELECT depth, path, n, size, ended, unnest(generate_series(0, depth)) AS up FROM n) v
  JOIN n u ON u.depth = v.up AND u.path = substr(v.path, 1, 64 * v.up)
  GROUP BY u.depth, u.path),
k2 AS (SELECT depth - 1 AS depth, substr(path, 1, 64 * (depth - 1)) AS path, count(*) AS children FROM n WHERE depth > 0 GROUP BY ALL)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(k2.children, 0) AS n_children,
  CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n JOIN s USING (depth, path) LEFT JOIN k2 USING (depth, path)
LEFT JOIN n m ON m.depth = n.depth - 1 AND m.path = substr(n.path, 1, 64 * (n.depth - 1))
"""

ORACLE["op12_ball_tree"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
a AS (SELECT count_if(len(terms) > 0) AS n, sum(len(terms)) AS l FROM d),
q AS (
  SELECT item_id, row_number() OVER () AS item, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
f AS (
  SELECT doc_id, doc, term, len(terms) AS n, count(*) AS tf
  FROM (SELECT doc_id, doc, terms, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * a.n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM f, a GROUP BY term, a.n),
v AS (
  SELECT doc_id, doc, f.term, w * ((1000000000 * tf) // (1000 * tf + 12 * CAST(75 + (25 * f.n * a.n) // a.l AS BIGINT))) AS v
  FROM f JOIN w ON w.term = f.term, a),
s AS (
  SELECT item, item_id, doc, doc_id, CAST(sum(v) AS BIGINT) AS score
  FROM q JOIN v ON v.term = q.term GROUP BY ALL HAVING sum(v) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) <= 20
"""
