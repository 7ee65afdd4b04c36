"""The registered queries of the training-data operators and, where SQL can express them, their oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontaminate, jaccard, language_id, packing, ranked, secrets, sharding, suffix_dedup, token_counts, topk, url_filter, warc
from .common import left, shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))  # a null doc_id is not held out
    model = language_id.fit(docs.where(~held_out))
    return language_id.predict(docs, model, carry=["doc_id", held_out.alias("held_out")])


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op3_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=16)


def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.round_trip(_table(spark, sf_dir, "pages"), left(f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"), n=4, num=85, den=100)


def op6_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), most=2048)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), min_bytes=400)


def op8_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


#: The listed rules.
URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), rules)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=10)
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        F.size("near").cast("long").alias("n_near"),
    )


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source owns a document; its documents of one language are a repository."""
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"), F.col("source"), F.concat_ws("/", "source", "lang"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(told(F.filter("spans", lambda s: s["rank"] < 3)), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
        count("live").alias("n_live"),
        F.size(F.filter("spans", lambda s: s["copied"])).cast("long").alias("n_copied"),
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_token_counts,
        op3_hash_tree_sharding,
        op4_warc_round_trip,
        op5_ngram_jaccard,
        op6_shortest_pack_first,
        op7_suffix_dedup,
        op8_threshold_topk,
        op9_url_rules,
        op10_decontaminate,
        op11_secret_scan,
        op12_ranked_search,
        op13_token_alignment,
    )
}

_TREE_SQL = """
WITH leaf AS (
  SELECT i AS shard, CASE WHEN i < 16 THEN 'r' || i // 4 ELSE 'r' || i END AS region,
         CASE WHEN i < 16 THEN 'k' || i // 2 ELSE 'k' || i END AS rack, size AS tree
  FROM range(17) r(i), (VALUES (16), (17)) s(size) WHERE i < size
), node AS (
  SELECT tree, 1 AS level, '' AS parent, region AS path, count(*)::DOUBLE AS w FROM leaf GROUP BY tree, region
  UNION ALL SELECT tree, 2, region, region || '/' || rack, count(*)::DOUBLE FROM leaf GROUP BY tree, region, rack
  UNION ALL SELECT tree, 3, region || '/' || rack, region || '/' || rack || '/' || shard, 1.0 FROM leaf
), docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(doc_id::VARCHAR, 'null') AS key FROM documents
), drawn AS (
  SELECT rid, n.tree, n.level, n.parent, n.path,
         ln((('0x' || substr(md5(key || '|' || n.path), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0) / n.w AS d
  FROM docs, node n
), best AS (
  SELECT rid, tree, level, parent, arg_max(path, d) AS path FROM drawn GROUP BY rid, tree, level, parent
), placed AS (
  SELECT a.rid, a.tree, split_part(c.path, '/', 3)::INTEGER AS shard
  FROM best a JOIN best b ON b.rid = a.rid AND b.tree = a.tree AND b.level = 2 AND b.parent = a.path
  JOIN best c ON c.rid = a.rid AND c.tree = a.tree AND c.level = 3 AND c.parent = b.path WHERE a.level = 1
), crc_table AS (
  WITH RECURSIVE s(k, v, n) AS (
    SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) r(i)
    UNION ALL SELECT k, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n + 1 FROM s WHERE n < 8
  ) SELECT list(v ORDER BY k) AS tab FROM s WHERE n = 8
), bytes AS (
  SELECT rid, strlen(t) AS n, list_transform(range(0, strlen(t)), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b
  FROM (SELECT rid, t, hex(encode(t)) AS h FROM docs)
), crc AS (
  SELECT rid, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM bytes, crc_table
)
SELECT doc_id, (n + 1)::BIGINT AS size, text_crc32, 'key' AS law, p.shard,
       row_number() OVER (PARTITION BY p.shard ORDER BY substr(md5(key), 1, 3), doc_id, n, text_crc32) - 1 AS slot,
       g.shard AS grown_shard
FROM docs JOIN placed p ON p.rid = docs.rid AND p.tree = 16 JOIN placed g ON g.rid = docs.rid AND g.tree = 17
JOIN crc ON crc.rid = docs.rid
"""

_WARC_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, lower(sha1(coalesce(html, ''))) AS h FROM pages
), d AS (
  SELECT page_id, payload_bytes, translate(array_to_string(list_transform([1, 11, 21, 31],
           lambda i: lpad(upper(to_base(('0x' || substr(h, i, 10))::BIGINT, 32)), 8, '0')), ''),
         '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
  FROM p
), m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS best FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
FROM m
"""

_JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh
  FROM w
), t AS (SELECT doc_id, unnest(sh) AS g FROM s),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM common JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * c >= 85 * (len(a.sh) + len(b.sh) - c)
), edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(x, y) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.x, e.y FROM reach r JOIN edge e ON e.x = r.y)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, m.component_id
FROM s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) m ON m.x = s.doc_id
"""

_TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_URL_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), p AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM u
), rules(rh, rp, rv) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
hit AS (
  SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS v
  FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id
)
SELECT p.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN hit ON hit.page_id = p.page_id
"""

_LEAK_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) r(i) WHERE len(w) > 0
), pos AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM d, (SELECT DISTINCT n FROM win) s, unnest(range(1, len(w) - n + 2)) r(i) WHERE len(w) >= n
), hit AS (SELECT doc_id, i, pos.n, item_id FROM pos JOIN win ON win.n = pos.n AND win.g = pos.g),
words AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, n)) r(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id),
term AS (SELECT doc_id, w, p, w[p] AS t FROM d, unnest(range(1, len(w) + 1)) r(p)),
often AS (SELECT t, count(*) AS c FROM term GROUP BY t),
span AS (SELECT row_number() OVER () AS id, item_id, w[i:i + least(len(w), 10) - 1] AS words FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) r(i) WHERE len(w) > 0),
seek AS (SELECT id, any_value(item_id) AS item_id, any_value(words) AS words, arg_min(v, coalesce(c, 0)) AS rare FROM (SELECT *, unnest(words) AS v FROM span) x LEFT JOIN often ON often.t = v GROUP BY id),
stretch AS (
  SELECT doc_id, item_id, words, len(words) + 4 AS span, w[greatest(p - len(words) - 3, 1):p + len(words) + 3] AS part
  FROM seek JOIN term ON t = rare
),
close AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_near FROM stretch
  WHERE list_has_all(part, words) AND len(list_filter(range(1, greatest(len(part) - span, 0) + 2), lambda s: list_has_all(part[s:s + span - 1], words))) > 0
  GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id LEFT JOIN close ON close.doc_id = d.doc_id
"""

_SECRET_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner, concat_ws('/', source, lang) AS repository FROM documents),
p(kind, k, p) AS (VALUES
  ('assign', 0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  ('access', 1, 'AKIA[A-Z0-9]+'), ('hex', 2, '[0-9a-f]+'), ('mixed', 3, '[A-Za-z0-9+/_-]+')
), m AS (
  SELECT id, owner, repository, kind, k, p, string_split_regex(t, p) AS gaps, regexp_extract_all(t, p) AS ms FROM d, p
), e AS (
  SELECT id, owner, repository, kind, k, p, i, ms[i] AS x, length(gaps[i]) AS gap FROM m, unnest(range(1, len(ms) + 1)) r(i)
), f AS (
  SELECT *, CASE WHEN k = 0 THEN regexp_extract(x, p, 2) ELSE x END AS v, sum(gap + length(x)) OVER (PARTITION BY id, kind ORDER BY i) AS stop FROM e
), c AS (
  SELECT * FROM f WHERE CASE k WHEN 0 THEN length(v) >= 12 WHEN 1 THEN length(x) >= 18 WHEN 2 THEN length(x) >= 16
    ELSE length(x) >= 20 AND regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Z]') AND regexp_matches(x, '[a-z]') END
), held AS (SELECT v, count(DISTINCT owner) AS owners FROM c GROUP BY v),
s AS (
  SELECT id, k, kind, stop - length(x) AS start, stop, owners FROM c JOIN held USING (v) WHERE k < 3
  UNION SELECT id, 4, 'live', stop - length(v), stop, owners FROM c JOIN held USING (v)
  WHERE owners = 1 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND len(list_distinct(string_split(v, ''))) >= 8
    AND NOT regexp_matches(lower(v), 'example|sample|dummy|placeholder|change_?me|your|xxxx|test|\.\.\.')
), g AS (
  SELECT id, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS b, count(*) FILTER (k = 2) AS h, count(*) FILTER (k = 4) AS l, count(*) FILTER (owners >= 3) AS w,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k, stop) FILTER (k < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k, stop) AS spans
  FROM s GROUP BY id
)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(l, 0)::BIGINT AS n_live, coalesce(w, 0)::BIGINT AS n_copied
FROM d LEFT JOIN g ON g.id = d.id
"""

_RANKED_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), q AS (
  SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark
), corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
size AS (SELECT id, doc_id, 25 + (75 * len(w)::BIGINT * n_docs) // n_terms AS m FROM d, corpus WHERE len(w) > 0),
asked AS (SELECT iid, any_value(item_id) AS item_id, t, count(*)::BIGINT AS qn FROM (SELECT iid, item_id, unnest(w) AS t FROM q) GROUP BY iid, t),
post AS (SELECT id, t, count(*)::BIGINT AS tf FROM (SELECT id, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM asked) GROUP BY id, t),
weight AS (SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM post GROUP BY t), corpus),
score AS (
  SELECT iid, any_value(item_id) AS item_id, id, any_value(doc_id) AS doc_id, sum(qn * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN post USING (t) JOIN weight USING (t) JOIN size USING (id) GROUP BY iid, id
), r AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id)::INTEGER AS rank FROM score WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

ORACLES: dict[str, str] = {
    "op3_hash_tree_sharding": _TREE_SQL,
    "op4_warc_round_trip": _WARC_SQL,
    "op5_ngram_jaccard": _JACCARD_SQL,
    "op8_threshold_topk": _TOPK_SQL,
    "op9_url_rules": _URL_SQL,
    "op10_decontaminate": _LEAK_SQL,
    "op11_secret_scan": _SECRET_SQL,
    "op12_ranked_search": _RANKED_SQL,
}
