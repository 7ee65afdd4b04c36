"""Decoder queries: payloads are built by Spark from the given tables and decoded again."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.plans.registry import register
from marketlens.sources import decode as dc
from marketlens.sources.tables import table, view


def quote_payloads(spark, sf_dir):
    """A quote envelope for each symbol and year."""
    b = view(spark, sf_dir, "bars_daily").withColumn("t", F.unix_timestamp(F.col("day").cast("timestamp")))
    rows = b.groupBy("symbol", F.year("day").alias("year")).agg(F.array_sort(F.collect_list(F.struct("t", "open", "high", "low", "close", F.col("volume").cast("double").alias("volume")))).alias("b"))
    cols = [F.col(f"b.{c}").alias(n) for c, n in (("t", "timestamp"), ("open", "open"), ("high", "high"), ("low", "low"), ("close", "close"), ("volume", "volume"))]
    return rows.select("symbol", "year", F.to_json(F.struct(*cols)).alias("body"))


@register("SELECT symbol, day, open, high, low, close, volume::DOUBLE AS volume FROM bars_daily")
def s3_quote_envelope(spark, sf_dir):
    return dc.quote_envelope(quote_payloads(spark, sf_dir)).select("symbol", "day", "open", "high", "low", "close", "volume")


@register("SELECT symbol, day, metric, value FROM (UNPIVOT (SELECT symbol, day, open, high, low, close, volume::DOUBLE AS volume FROM bars_daily) ON open, high, low, close, volume INTO NAME metric VALUE value)")
def s4_five_series(spark, sf_dir):
    return dc.five_series(quote_payloads(spark, sf_dir), ["symbol", "year"]).where("reason is null").select("symbol", "day", "metric", "value")


def _positions(spark, sf_dir):
    b = view(spark, sf_dir, "bars_daily").select("symbol", F.datediff("day", F.lit("2009-01-01").cast("date")).alias("p"), "close")
    g = b.groupBy("symbol").agg(F.min("p").alias("start"), F.max("p").alias("end"), F.map_from_entries(F.collect_list(F.struct("p", "close"))).alias("m"))
    data = F.transform(F.sequence("start", "end"), lambda p: F.try_element_at("m", p))
    return g.select("symbol", F.to_json(F.struct(F.lit("day").alias("index"), "start", data.alias("data")), {"ignoreNullFields": "false"}).alias("body"))


@register("SELECT symbol, day, close AS value FROM bars_daily")
def s6_positional_daily(spark, sf_dir):
    return dc.positional_daily(_positions(spark, sf_dir)).select("symbol", "day", "value")


@register("""WITH r AS (SELECT symbol, close AS value, row_number() OVER (PARTITION BY symbol, year(day) ORDER BY day) - 1 AS pos FROM bars_daily)
SELECT symbol, (DATE '2009-01-01' + CASE symbol WHEN '1-URGENT' THEN 10 + pos WHEN '2-HIGH' THEN (10 + pos) * 7 WHEN '3-MEDIUM' THEN (10 + pos) * 30 ELSE (10 + pos) * 600 // 86400 END::INT)::DATE AS day, value FROM r""")
def s7_positional_period(spark, sf_dir):
    """A payload for each symbol and year; periods by symbol, two values nested in a list now and then."""
    b = view(spark, sf_dir, "bars_daily").groupBy("symbol", F.year("day").alias("y")).agg(F.array_sort(F.collect_list(F.struct("day", "close"))).alias("l"))  # a year's days
    index = F.when(F.col("symbol") == "1-URGENT", "day").when(F.col("symbol") == "2-HIGH", "week").when(F.col("symbol") == "3-MEDIUM", "month").otherwise("height")
    data = F.transform("l", lambda x: F.when(F.day(x["day"]) % 5 == 0, F.to_json(F.array(x["close"]))).otherwise(x["close"].cast("string")))
    body = F.to_json(F.struct(index.alias("index"), F.lit(10).alias("start"), data.alias("data")))
    return dc.positional_period(b.select("symbol", body.alias("body"))).select("symbol", "day", "value")


@register("SELECT series_id, obs_date AS observed_date, (obs_date + 40)::DATE AS realtime_start, value FROM macro_monthly WHERE month(obs_date) <> 2")
def s8_macro_observations(spark, sf_dir):
    m = view(spark, sf_dir, "macro_monthly").withColumn("v", F.when(F.month("obs_date") == 2, ".").otherwise(F.col("value").cast("string")))
    o = F.struct(F.col("obs_date").cast("string").alias("date"), F.date_add("obs_date", 40).cast("string").alias("realtime_start"), F.col("v").alias("value"))
    g = m.groupBy("series_id").agg(F.to_json(F.struct(F.collect_list(o).alias("observations"))).alias("body"))
    return dc.macro_observations(g)


@register("SELECT symbol, epoch(slot)::BIGINT AS t, close AS value FROM bars_hourly")
def s9_exchange_pages(spark, sf_dir):
    h = view(spark, sf_dir, "bars_hourly").withColumn("ms", F.unix_timestamp(F.col("slot").cast("timestamp")) * 1000)
    bare = F.to_json(F.collect_list(F.struct("symbol", F.col("close").cast("string").alias("sumOpenInterest"), F.col("ms").alias("timestamp"))))
    inner = F.struct(F.first("symbol").alias("symbol"), F.collect_list(F.struct(F.col("close").cast("string").alias("openInterest"), F.col("ms").cast("string").alias("timestamp"))).alias("list"))
    wrapped = F.to_json(F.struct(F.lit(0).alias("retCode"), inner.alias("result")))
    g = h.groupBy("symbol").agg(bare.alias("a"), wrapped.alias("b"))
    g = g.select("symbol", F.when(F.length("symbol") % 2 == 0, F.col("a")).otherwise(F.col("b")).alias("body"))
    return dc.exchange_pages(g, ["symbol"]).where("reason is null").select("symbol", F.unix_timestamp("observed").alias("t"), "value")


@register("SELECT event_id, CASE WHEN event_id % 5 = 4 THEN 'time key' WHEN event_id % 5 = 3 THEN 'other metric' END AS reason, CASE WHEN event_id % 5 < 3 THEN round(value, 4) END AS value FROM events")
def s10_slug_rows(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.round("value", 4).alias("v"), (F.col("event_id") % 5).alias("k"))
    named = F.when(F.col("k") == 0, F.struct(F.lit("d").alias("date"), F.col("v").alias("nupl")).cast("struct<date:string,nupl:double>"))
    plain = F.to_json(F.struct(F.lit("2024-01-01").alias("date"), F.col("v").alias("value")))
    body = F.when(named.isNotNull(), F.to_json(named)).when(F.col("k") == 3, F.to_json(F.struct(F.lit("2024-01-01").alias("date"), F.col("v").alias("value"), F.lit(1).alias("sopr")))).when(F.col("k") == 4, F.to_json(F.struct(F.col("v").alias("value")))).otherwise(plain)
    d = dc.slug_rows(e.select("event_id", body.alias("body")), "nupl", others=("sopr", "mvrv"))
    return d.select("event_id", "reason", F.when(F.col("reason").isNull(), F.col("value")).alias("value"))


@register("SELECT symbol AS ticker, day::VARCHAR AS date, CASE WHEN volume = 1 THEN NULL WHEN volume = 2 THEN -round(close, 2) ELSE round(close, 2) END AS flow FROM bars_daily")
def s11_html_flows(spark, sf_dir):
    b = view(spark, sf_dir, "bars_daily")
    shown = F.format_number("close", 2)
    cell = F.when(F.col("volume") == 1, "-").when(F.col("volume") == 2, F.concat(F.lit("("), shown, F.lit(")"))).otherwise(shown)
    row = F.concat(F.lit("<tr><td>"), F.col("day").cast("string"), F.lit("</td><td><b>"), cell, F.lit("</b></td></tr>"))
    g = b.groupBy("symbol").agg(F.array_join(F.array_sort(F.collect_list(row)), "").alias("r"))
    html = F.concat(F.lit("<table><tr><th>Date</th><th>"), F.col("symbol"), F.lit("</th></tr>"), F.col("r"), F.lit("</table>"))
    return dc.html_flow_table(g.select(html.alias("html"))).select("ticker", "date", F.round("flow", 2).alias("flow"))


def feed_part():
    """The feed that a row goes to: 4,096 rows of a task make one, so there are more of them as a table grows."""
    return F.shiftright(F.monotonically_increasing_id(), 12)


@register("SELECT id::VARCHAR AS uid, 'Claim of ' || asset AS title, created AS day, CASE WHEN id % 3 = 0 THEN 'date' WHEN id % 3 = 1 THEN 'time' ELSE 'unconfirmed' END AS \"precision\" FROM claims")
def s12_calendar(spark, sf_dir):
    c = view(spark, sf_dir, "claims")
    d = F.date_format("created", "yyyyMMdd")
    start = F.when(F.col("id") % 3 == 0, F.concat(F.lit("DTSTART;VALUE=DATE:"), d)).when(F.col("id") % 3 == 1, F.concat(F.lit("DTSTART:"), d, F.lit("T133000Z"))).otherwise(F.concat(F.lit("DTSTART;TZID=Mars/Base:"), d, F.lit("T080000")))
    event = F.concat(F.lit("BEGIN:VEVENT\r\nUID:"), F.col("id").cast("string"), F.lit("\r\n"), start, F.lit("\r\nSUMMARY:Claim\r\n  of "), F.col("asset"), F.lit("\r\nEND:VEVENT\r\n"))
    g = c.groupBy(feed_part()).agg(F.concat(F.lit("BEGIN:VCALENDAR\r\n"), F.array_join(F.collect_list(event), ""), F.lit("END:VCALENDAR")).alias("body"))
    return dc.ical_events(g.select("body")).select("uid", "title", "day", "precision")


@register("SELECT id || ':' || created AS key, asset AS title, created AS day, 'date' AS \"precision\" FROM claims")
def s13_release_dates(spark, sf_dir):
    r = F.struct(F.col("id").cast("int").alias("release_id"), F.col("asset").alias("release_name"), F.col("created").cast("string").alias("date"))
    g = view(spark, sf_dir, "claims").groupBy(feed_part()).agg(F.to_json(F.struct(F.collect_list(r).alias("release_dates"))).alias("body"))
    return dc.release_dates(g.select("body"))


@register("""WITH d AS (SELECT source, doc_id, TIMESTAMP '2024-01-01' + INTERVAL (doc_id % 40) DAY AS p FROM documents), k AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY p DESC, 'https://news.example.com/' || doc_id) AS r FROM d WHERE p <= TIMESTAMP '2024-02-05' AND p >= TIMESTAMP '2024-02-05' - INTERVAL 7 DAY AND doc_id % 6 <> 0)
SELECT source, 'https://news.example.com/' || doc_id AS url FROM k WHERE r <= 4""")
def s14_feed_items(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    at = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 40).cast("int")).cast("timestamp"), "EEE, d MMM yyyy HH:mm:ss 'GMT'")
    host = F.when(F.col("doc_id") % 6 == 0, "https://spam.example.org/").otherwise("https://news.example.com/")
    item = F.concat(F.lit("<item><title>Title "), F.col("doc_id").cast("string"), F.lit("</title><link>"), host, F.col("doc_id").cast("string"), F.lit("</link><pubDate>"), at, F.lit("</pubDate><description>&lt;p&gt;Body&lt;/p&gt;</description></item>"))
    feeds = d.select("source", feed_part().alias("part"), item.alias("item")).groupBy("source", "part").agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list("item"), ""), F.lit("</channel></rss>")).alias("body"))
    return dc.feed_items(feeds, F.lit("2024-02-05").cast("timestamp"), domains=("news.example.com",), most=4, per=["source"]).select("source", "url")


@register("SELECT item_id, 'Item ' || item_id AS title, 'https://e.com/' || item_id AS url FROM benchmark WHERE item_id % 3 <> 0")
def s15_search_blocks(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark")
    url = F.when(F.col("item_id") % 3 == 0, "").otherwise(F.concat(F.lit("https://e.com/"), F.col("item_id").cast("string")))
    body = F.concat(F.lit("Title: Item "), F.col("item_id").cast("string"), F.lit("\nURL: "), url, F.lit("\nPublished: 2024-01-01\nHighlights:\n"), F.regexp_replace("text", "\n", " "))
    return dc.search_blocks(b.select("item_id", body.alias("body"))).select("item_id", "title", "url")


@register("""SELECT doc_id, unnest(CASE doc_id % 16 WHEN 0 THEN ['id'] WHEN 1 THEN ['required'] WHEN 2 THEN ['family'] WHEN 3 THEN ['source kind'] WHEN 4 THEN ['url'] WHEN 5 THEN ['url'] WHEN 6 THEN ['url'] WHEN 7 THEN ['url'] WHEN 8 THEN ['length'] WHEN 9 THEN ['duplicate id'] WHEN 10 THEN ['duplicate id'] END) AS issue FROM documents""")
def s16_corpus_rules(spark, sf_dir):
    at = lambda n: F.col("doc_id") % 16 == n
    n = F.col("doc_id").cast("string")
    d = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(at(0), F.concat(F.lit("9x"), n)).when(at(9) | at(10), F.concat(F.lit("twice"), F.expr("doc_id div 16"))).otherwise(F.concat(F.lit("m"), n)).alias("metric"),
        F.when(at(2), "other").otherwise("onchain").alias("family"), F.when(at(1), " ").otherwise("A title").alias("title"), F.lit("a b").alias("keywords"),
        F.when(at(8), "short").otherwise("A method that is long enough").alias("method"), F.lit("A caveat that is long enough").alias("caveat"),
        F.when(at(4), "http://x.org/a").when(at(5), "https://evil.org/a").when(at(6), "https://u@x.org/a").when(at(7), "https://x.org:8443/a").otherwise("https://x.org/a").alias("url"),
        F.when(at(3), "rumour").otherwise("primary").alias("source_kind"),
    )
    return dc.corpus_issues(d, "metric", ["onchain", "macro"], ["primary"], ["x.org"]).select("doc_id", "issue")


@register("SELECT 'object' AS kind, 'k' AS keys, count(*) AS n, min(strlen(props)) AS min_bytes, max(strlen(props)) AS max_bytes FROM events")
def s17_payload_shape(spark, sf_dir):
    s = dc.payload_shape(table(spark, sf_dir, "events").withColumnRenamed("props", "body"))
    return s.withColumn("min_bytes", F.col("min_bytes").cast("long")).withColumn("max_bytes", F.col("max_bytes").cast("long"))


#: Bodies with nested objects and arrays of mixed types; every seventh is broken.
_BODY = """b AS (SELECT event_id AS id, event_type, CASE WHEN event_id % 7 = 0 THEN '{"p":' ELSE '{"p":' || props || ',"tags":["' || event_type || '",' || event_id || CASE WHEN event_id % 3 = 0 THEN ',null' ELSE '' END || CASE WHEN event_id % 5 = 0 THEN ',{"deep":[true,1.5]}' ELSE '' END || ']}' END AS body FROM events),
g AS (SELECT *, id % 3 = 0 AS nulls, id % 5 = 0 AS deep, 2 + (id % 3 = 0)::INT + (id % 5 = 0)::INT AS tags FROM b WHERE id % 7 <> 0)"""


@register(f"""WITH {_BODY}, r(path, kind, n, min_length, max_length) AS (
  SELECT '$', 'malformed', count(*), NULL::BIGINT, NULL::BIGINT FROM b WHERE id % 7 = 0 UNION ALL SELECT '$', 'object', count(*), 2, 2 FROM g UNION ALL SELECT '$.p', 'object', count(*), 1, 1 FROM g UNION ALL SELECT '$.p.k', 'number', count(*), NULL, NULL FROM g
  UNION ALL SELECT '$.tags', 'array', count(*), min(tags), max(tags) FROM g UNION ALL SELECT '$.tags[]', 'string', count(*), min(length(event_type)), max(length(event_type)) FROM g UNION ALL SELECT '$.tags[]', 'number', count(*), NULL, NULL FROM g
  UNION ALL SELECT '$.tags[]', 'null', count(*), NULL, NULL FROM g WHERE nulls UNION ALL SELECT '$.tags[]', 'object', count(*), 1, 1 FROM g WHERE deep UNION ALL SELECT '$.tags[].deep', 'array', count(*), 2, 2 FROM g WHERE deep
  UNION ALL SELECT '$.tags[].deep[]', 'boolean', count(*), NULL, NULL FROM g WHERE deep UNION ALL SELECT '$.tags[].deep[]', 'number', count(*), NULL, NULL FROM g WHERE deep) SELECT * FROM r WHERE n > 0""")
def s17_payload_types(spark, sf_dir):
    k = F.col("event_id")
    null, deep = F.when(k % 3 == 0, ",null").otherwise(""), F.when(k % 5 == 0, ',{"deep":[true,1.5]}').otherwise("")
    body = F.concat(F.lit('{"p":'), F.col("props"), F.lit(',"tags":["'), F.col("event_type"), F.lit('",'), k.cast("string"), null, deep, F.lit("]}"))
    return dc.payload_types(table(spark, sf_dir, "events").select(F.when(k % 7 == 0, '{"p":').otherwise(body).alias("body")))


@register("""SELECT symbol, day, close, 'first' AS "only" FROM bars_daily WHERE day(day) IN (7, 9) UNION ALL SELECT symbol, day, close + 1, 'second' FROM bars_daily WHERE day(day) = 7""")
def j20_parsers_agree(spark, sf_dir):
    """The second parser is made to read another value on the 7th of each month and to lose the 9th."""
    p = quote_payloads(spark, sf_dir)
    a = dc.quote_envelope(p).select("symbol", "day", "close")
    b = dc.five_series(p, ["symbol", "year"]).where("metric = 'close'").select("symbol", "day", F.col("value").alias("close"))
    b = b.where(F.day("day") != 9).withColumn("close", F.when(F.day("day") == 7, F.col("close") + 1).otherwise(F.col("close")))
    return dc.both_parsers_agree(a, b)
