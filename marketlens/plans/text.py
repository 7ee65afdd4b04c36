"""News, search and document queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.functions import text as tx
from marketlens.operators import search
from marketlens.plans.registry import register
from marketlens.sources.tables import table

pages = lambda s, d: table(s, d, "pages")
docs = lambda s, d: table(s, d, "documents")
#: Words that begin with, hold and overlap one another.
TOPICS = [("etf", ["tionsh", "ETF", "ersthtion"]), ("macro", ["ing ", "cpi", "tion"]), ("chain", ["le ", "hash", "sh", "ti", "élé"])]


@register(r"""SELECT page_id, lower(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)) || regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') ||
CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url FROM (SELECT page_id, url, list_transform(list_sort(list_transform(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: regexp_matches(p, '^[^=]*=.') AND NOT regexp_matches(p, '(?i)^(utm_[^=]*|fbclid|gclid|mc_cid|mc_eid)=')), lambda p: {'k': split_part(p, '=', 1), 'p': p})), lambda x: x.p) AS q FROM (SELECT page_id, url || CASE page_id % 4 WHEN 0 THEN '?UTM_X=1&b=2&ref=z&a=' WHEN 1 THEN '?utm_1=q&b=1&a=2&a=1#top' ELSE '' END AS url FROM pages))""")
def f7_canonical_url(spark, sf_dir):
    more = F.when(F.col("page_id") % 4 == 0, "?UTM_X=1&b=2&ref=z&a=").when(F.col("page_id") % 4 == 1, "?utm_1=q&b=1&a=2&a=1#top").otherwise("")
    return pages(spark, sf_dir).select("page_id", tx.canonical_url(F.concat("url", more)).alias("url"))


@register(r"SELECT doc_id, trim(regexp_replace(lower(split_part(text, chr(10), 1)), '[^a-z0-9]+', ' ', 'g')) AS title FROM documents")
def f8_title_key(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", tx.title_key(tx.first_line(F.col("text"))).alias("title"))


_STRIP = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g'))"""


@register(f"SELECT page_id, length({_STRIP})::BIGINT AS n, md5({_STRIP}) AS digest FROM pages")
def f9_strip_markup(spark, sf_dir):
    t = tx.strip_markup(F.col("html"))
    return pages(spark, sf_dir).select("page_id", F.length(t).cast("long").alias("n"), F.md5(t).alias("digest"))


def _excerpt_sql() -> str:
    """The four turns, one below the other."""
    flat = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
    q = f"""SELECT doc_id, {flat.format(r"coalesce(regexp_extract(text, '^[^.]*'), '')")} AS title, regexp_replace({flat.format("coalesce(text, '')")}, '^[.\\s-]+', '') AS t FROM (
SELECT doc_id, upper(regexp_extract(text, '^[^.]*')) || '. ' || text AS text FROM documents)"""
    for _ in range(4):
        rest = f"ltrim(substr(ltrim(t, '{tx.BEFORE}'), length(title) + 1), '{tx.BEHIND}')"
        q = f"SELECT doc_id, title, CASE WHEN title <> '' AND starts_with(lower(ltrim(t, '{tx.BEFORE}')), lower(title)) AND {rest} <> '' THEN {rest} ELSE t END AS t FROM ({q})"
    q = f"SELECT doc_id, regexp_replace(t, '^#{{1,4}}\\s+', '') AS t FROM ({q})"
    q = f"SELECT doc_id, t, rtrim(substr(t, 1, 280)) AS head FROM ({q})"
    q = f"SELECT *, regexp_replace(head, ' [^ ]*$', '') AS word FROM ({q})"
    return f"SELECT doc_id, CASE WHEN length(t) <= 280 THEN t ELSE rtrim(CASE WHEN length(word) < length(head) AND length(word) >= 196 THEN word ELSE head END, '{tx.LEFT}') || '…' END AS excerpt FROM ({q})"


@register(_excerpt_sql())
def f10_excerpt(spark, sf_dir):
    title = F.regexp_extract("text", r"^[^.]*", 0)
    return docs(spark, sf_dir).select("doc_id", tx.excerpt(F.upper(title), F.concat(F.upper(title), F.lit(". "), F.col("text"))).alias("excerpt"))


@register("SELECT doc_id, CASE " + " ".join(f"WHEN {' OR '.join(f'contains(lower(text), {chr(39)}{w.lower()}{chr(39)})' for w in words)} THEN '{t}'" for t, words in TOPICS) + " ELSE 'other' END AS topic FROM documents")
def f11_first_topic(spark, sf_dir):
    d = spark.createDataFrame([(w, t, i) for i, (t, words) in enumerate(TOPICS) for w in words], "word string, topic string, priority int")
    return docs(spark, sf_dir).select("doc_id", tx.first_topic(F.col("text"), d).alias("topic"))


#: Phrases within phrases, with accents and in upper case; the longest at a place counts.
PHRASES = [("the", "la"), ("IN The", "en la"), ("of the", "de la"), ("and", "y"), ("él", "he"), ("Und Der", "and the"), ("der", "the"), ("où", "where")]


def _phrases_sql() -> str:
    """Words are marked, and phrases replaced by numbers, longest first, so that none is looked at again."""
    marked = r"regexp_replace(text, '([\p{L}\p{M}\p{N}_]+)', chr(1) || '\1' || chr(2), 'g')"
    ordered = sorted(PHRASES, key=lambda p: -len(p[0]))
    for i, (old, _) in enumerate(ordered):
        whole = "' ' || ".join(f"chr(1) || '{w}' || chr(2) || " for w in old.split(" ")).removesuffix(" || ")
        marked = f"regexp_replace({marked}, '(?i)' || {whole}, chr(3) || '{i}' || chr(4), 'g')"
    for i, (_, new) in enumerate(ordered):
        marked = f"replace({marked}, chr(3) || '{i}' || chr(4), '{new}')"
    return f"SELECT doc_id, md5(replace(replace({marked}, chr(1), ''), chr(2), '')) AS digest FROM documents"


@register(_phrases_sql())
def f12_replace_phrases(spark, sf_dir):
    d = spark.createDataFrame(PHRASES, "phrase string, replacement string")
    return docs(spark, sf_dir).select("doc_id", F.md5(tx.replace_phrases(F.col("text"), d)).alias("digest"))


_TOK = r"list_filter(regexp_extract_all(lower(T), '[\p{L}\p{N}]+(?:_[\p{L}\p{N}]+)*'), lambda w: length(w) > 1)"


@register(f"SELECT item_id, array_to_string({_TOK.replace('T)', 'text)')}[1:10], ' ') AS tokens FROM benchmark")
def f13_tokens(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(tx.tokens(tx.nfkc("text")), " ").alias("tokens"))


@register("""SELECT doc_id, CASE WHEN NOT regexp_matches(url, '^https?://') THEN 'url' WHEN length(trim(title)) < 20 THEN 'title' WHEN length(trim(text)) < 50 THEN 'highlight' ELSE 'ok' END AS reason
FROM (SELECT doc_id, text, split_part(text, chr(10), 1) AS title, CASE WHEN doc_id % 7 = 0 THEN 'ftp://x' ELSE 'https://x' END AS url FROM documents)""")
def p6_news_validity(spark, sf_dir):
    url = F.when(F.col("doc_id") % 7 == 0, "ftp://x").otherwise("https://x")
    r = tx.news_reason(url, tx.first_line(F.col("text")), F.col("text"), F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp"))
    return docs(spark, sf_dir).select("doc_id", F.coalesce(r, F.lit("ok")).alias("reason"))


@register("SELECT doc_id, (39 - doc_id % 40 BETWEEN 0 AND CASE doc_id % 3 WHEN 0 THEN 21 WHEN 1 THEN 14 ELSE 7 END) AS fresh FROM documents")
def p7_news_freshness(spark, sf_dir):
    kind = F.when(F.col("doc_id") % 3 == 0, "research").when(F.col("doc_id") % 3 == 1, "primary").otherwise("discovery")
    age = F.datediff(F.date_add(F.lit("2024-01-01").cast("date"), 39), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 40).cast("int")))
    return docs(spark, sf_dir).select("doc_id", tx.news_fresh(age, kind).alias("fresh"))


@register(r"""WITH t AS (SELECT page_id, url, substr(trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1)), 1, 350) AS title, CASE page_id % 5 WHEN 0 THEN 'BTC' WHEN 1 THEN 'SPY' WHEN 2 THEN 'GOLD' WHEN 3 THEN 'MACRO' ELSE 'DOGE' END AS asset FROM pages)
SELECT page_id, asset, title FROM t WHERE asset <> 'DOGE' AND title <> '' AND starts_with(url, 'https://') AND NOT regexp_matches(url, '^https://[^/?#]*@') AND NOT regexp_matches(url, '^https://([/?#]|$)') AND length(url) <= 2048""")
def p8_archive_predicate(spark, sf_dir):
    asset = F.get(F.array(*[F.lit(a) for a in (*tx.ARCHIVED_ASSETS, "DOGE")]), (F.col("page_id") % 5).cast("int"))
    p = pages(spark, sf_dir).select("page_id", "url", asset.alias("asset"), F.substring(F.trim(F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)), 1, 350).alias("title"))
    return p.where(tx.archivable(F.col("url"), F.col("asset"), F.col("title"))).select("page_id", "asset", "title")


@register(r"WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host FROM pages) SELECT page_id, host FROM h WHERE host IN ('example.com', 'tion.example.org') OR ends_with(host, '.example.com') OR ends_with(host, '.tion.example.org')")
def p9_domain_allow_list(spark, sf_dir):
    p = pages(spark, sf_dir).select("page_id", tx.url_host(F.col("url")).alias("host"))
    return p.where(tx.on_domains(F.col("host"), ["example.com", "tion.example.org"]))


@register(r"""WITH RECURSIVE n AS (SELECT doc_id, lang, source, doc_id // 50 AS day, trim(regexp_replace(lower(split_part(text, chr(10), 1)), '[^a-z0-9]+', ' ', 'g')) AS title, substr(md5(text), 1, 1) AS url FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, day ORDER BY source, doc_id, url, title) AS rn FROM n),
w AS (SELECT lang, day, 0::BIGINT AS rn, []::VARCHAR[] AS urls, []::VARCHAR[] AS titles, NULL::BIGINT AS doc_id FROM (SELECT DISTINCT lang, day FROM n)
  UNION ALL SELECT w.lang, w.day, o.rn, CASE WHEN ok THEN list_append(urls, o.url) ELSE urls END, CASE WHEN ok THEN list_append(titles, o.title) ELSE titles END, CASE WHEN ok THEN o.doc_id END
  FROM w JOIN o ON o.lang IS NOT DISTINCT FROM w.lang AND o.day = w.day AND o.rn = w.rn + 1, LATERAL (SELECT len(urls) < 7 AND NOT list_contains(urls, o.url) AND NOT list_contains(titles, o.title) AS ok))
SELECT lang, day, doc_id FROM w WHERE doc_id IS NOT NULL""")
def u1_news_dedupe(spark, sf_dir):
    n = docs(spark, sf_dir).select("doc_id", "lang", "source", F.expr("doc_id div 50").alias("day"), tx.title_key(tx.first_line(F.col("text"))).alias("title"), F.substring(F.md5("text"), 1, 1).alias("url"))
    return search.dedupe_news(n, ["lang", "day"], "source", "doc_id", "url", "title").select("lang", "day", "doc_id")


@register("SELECT lang AS family, count(*) AS n FROM documents GROUP BY 1")
def a21_corpus_manifest(spark, sf_dir):
    return docs(spark, sf_dir).groupBy(F.col("lang").alias("family")).agg(F.count("*").alias("n"))


#: Weights of the five fields.
FIELDS = {"metric": 14, "title": 4, "keywords": 3, "method": 1.2, "caveat": 0.4}


def _corpus(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select("doc_id", F.concat(F.lit("doc"), F.col("doc_id")).alias("metric"), tx.first_line(F.col("text")).alias("title"), F.col("source").alias("keywords"), F.col("lang").alias("method"), F.col("text").alias("caveat"), F.col("lang").alias("family"))


def _asked(spark, sf_dir):
    """Item texts; every tenth item asks for a record by its ident alone."""
    b = table(spark, sf_dir, "benchmark")
    return b.select("item_id", F.when(F.col("item_id") % 10 == 0, F.concat(F.lit("doc"), F.col("item_id"))).otherwise(F.col("text")).alias("text"))


_CORPUS_SQL = "d AS (SELECT doc_id, 'doc' || doc_id AS metric, split_part(text, chr(10), 1) AS title, source AS keywords, lang AS method, text AS caveat FROM documents)"
_ASKED_SQL = f"q AS (SELECT item_id, unnest(list_distinct(({_TOK.replace('T)', 't)')})[1:10])) AS term FROM (SELECT item_id, CASE WHEN item_id % 10 = 0 THEN 'doc' || item_id ELSE text END AS t FROM benchmark))"


def _bm_sql(k: int, where: str = "true") -> str:
    fields = " UNION ALL ".join(f"SELECT doc_id, {w}::DOUBLE AS w, unnest({_TOK.replace('T)', f'coalesce({f}, {chr(39)}{chr(39)}))')}) AS term FROM c" for f, w in FIELDS.items())
    return f"""WITH {_CORPUS_SQL}, c AS (SELECT * FROM d WHERE {where}), {_ASKED_SQL}, f AS ({fields}),
p AS (SELECT term, doc_id, sum(w) AS tf, count(*) AS hits FROM f GROUP BY 1, 2), l AS (SELECT doc_id, sum(hits) AS len FROM p GROUP BY 1), s AS (SELECT avg(len) AS avglen, (SELECT count(*) FROM c) AS n FROM l),
x AS (SELECT item_id, min(c.doc_id) AS doc_id FROM (SELECT item_id, min(term) AS term FROM q GROUP BY 1 HAVING count(*) = 1) o JOIN c ON c.metric = o.term GROUP BY 1),
df AS (SELECT term, count(*) AS n FROM p GROUP BY 1),
t AS (SELECT item_id, p.doc_id, round(sum(greatest(ln((s.n - df.n + 0.5) / (df.n + 0.5)), 1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avglen))), 6) AS score FROM q JOIN df ON df.term = q.term JOIN p ON p.term = q.term JOIN l ON l.doc_id = p.doc_id, s WHERE item_id NOT IN (SELECT item_id FROM x) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM t),
hits AS (SELECT item_id, doc_id, score, rank FROM r WHERE rank <= {k} UNION ALL SELECT item_id, doc_id, NULL, 1 FROM x)"""


@register(_bm_sql(5) + " SELECT * FROM hits")
def d1_bm25(spark, sf_dir):
    return search.bm25(_corpus(spark, sf_dir), _asked(spark, sf_dir), "doc_id", "item_id", "text", FIELDS, ident="metric")


@register(_bm_sql(2, "method IN ('en', 'de')") + " SELECT * FROM hits")
def t6_top_hits(spark, sf_dir):
    return search.bm25(_corpus(spark, sf_dir), _asked(spark, sf_dir), "doc_id", "item_id", "text", FIELDS, k=2, ident="metric", family="family", families=["en", "de"])


@register(f"""WITH {_CORPUS_SQL}, {_ASKED_SQL}, c AS (SELECT doc_id, strip_accents(lower(metric)) AS metric, strip_accents(lower(title)) AS title, strip_accents(lower(keywords)) AS keywords FROM d),
h AS (SELECT item_id, doc_id, 10 AS w FROM q JOIN c ON metric = term UNION ALL SELECT item_id, doc_id, 3 FROM q JOIN c ON contains(title, term) UNION ALL SELECT item_id, doc_id, 2 FROM q JOIN c ON contains(keywords, term)),
t AS (SELECT item_id, doc_id, sum(w)::BIGINT AS score FROM h GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM t) SELECT item_id, doc_id, score, rank FROM r WHERE rank <= 5""")
def d2_lexical(spark, sf_dir):
    return search.lexical(_corpus(spark, sf_dir), _asked(spark, sf_dir), "doc_id", "item_id", "text", "metric", "title", "keywords")


@register(_bm_sql(2, "method IN ('en', 'de')") + """ SELECT item_id, count(*) AS hits, string_agg(rank || '|' || hits.doc_id || '|' || coalesce(printf('%.6f', score), '-') || '|' || d.metric || '|' || coalesce(d.keywords, ''), ';' ORDER BY rank) AS evidence FROM hits JOIN d ON d.doc_id = hits.doc_id GROUP BY 1""")
def d3_evidence_bundle(spark, sf_dir):
    b = search.evidence_bundle(t6_top_hits(spark, sf_dir), _corpus(spark, sf_dir), "item_id", "doc_id", "metric", "keywords")
    score = lambda e: F.when(e["score"].isNull(), "-").otherwise(F.format_string("%.6f", e["score"]))
    shown = F.transform("evidence", lambda e: F.concat_ws("|", e["rank"], e["doc_id"], score(e), e["metric"], F.coalesce(e["keywords"], F.lit(""))))
    return b.select("item_id", F.size("evidence").cast("long").alias("hits"), F.array_join(shown, ";").alias("evidence"))
