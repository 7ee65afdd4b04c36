"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.functions import scalars as sc
from marketlens.plans.registry import register
from marketlens.sources.tables import table, view

orders = lambda s, d: table(s, d, "orders").withColumn("t", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")))
claims = lambda s, d: view(s, d, "claims")


@register("SELECT o_orderkey, make_timestamp(epoch(o_orderdate)::BIGINT * 1000000)::DATE AS day, epoch(o_orderdate)::BIGINT * 1000 AS ms FROM orders")
def f1_epochs(spark, sf_dir):
    o = orders(spark, sf_dir)
    return o.select("o_orderkey", F.to_date(sc.epoch_to_utc(F.col("t"))).alias("day"), F.unix_millis(sc.epoch_to_utc(F.col("t") * 1000, "ms")).alias("ms"))


@register("""SELECT o_orderkey, o_orderkey % 4 IN (0, 1) AS accepted FROM orders""")
def f2_strict_utc(spark, sf_dir):
    end = F.when(F.col("o_orderkey") % 4 == 0, "Z").when(F.col("o_orderkey") % 4 == 1, "+00:00").when(F.col("o_orderkey") % 4 == 2, "-05:00").otherwise("")
    text = F.concat(F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"), end)
    return table(spark, sf_dir, "orders").select("o_orderkey", sc.strict_utc(text).isNotNull().alias("accepted"))


@register("""WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS d, epoch(o_orderdate)::BIGINT + o_orderkey AS t FROM orders) SELECT o_orderkey, d - 1 AS completed, (d - 365)::DATE AS first_52w, (t - 600) - (t - 600) % 300 AS slot FROM o""")
def f3_completed_day(spark, sf_dir):
    o = orders(spark, sf_dir)
    done = sc.previous_completed_day(F.col("o_orderdate"))
    return o.select("o_orderkey", done.alias("completed"), sc.window_52w(done)["first"].alias("first_52w"), sc.closed_slot(F.col("t") + F.col("o_orderkey")).alias("slot"))


@register("SELECT DISTINCT year(obs_date) * 12 + month(obs_date) - 1 AS idx, strftime(obs_date, '%Y-%m') AS month FROM macro_monthly")
def f4_month_index(spark, sf_dir):
    m = view(spark, sf_dir, "macro_monthly").select(sc.month_index(F.col("obs_date")).alias("idx")).distinct()
    return m.select("idx", sc.month_text(F.col("idx")).alias("month"))


@register("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE epoch(o_orderdate)::BIGINT END AS t FROM orders")
def f5_feed_date(spark, sf_dir):
    ts = F.col("o_orderdate").cast("timestamp")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(ts, "EEE, d MMM yyyy HH:mm:ss 'GMT'")).when(F.col("o_orderkey") % 3 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("yesterday")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.unix_timestamp(sc.feed_date(text)).alias("t"))


@register("SELECT id, created AS day FROM claims")
def f6_localized_date(spark, sf_dir):
    names = F.array(*[F.lit(k) for k in list(sc.MONTHS)[:12]])
    english = F.array(*[F.lit(k) for k in list(sc.MONTHS)[12:]])
    d = F.col("created")
    month = lambda a: F.get(a, F.month(d) - 1)
    es = F.concat(F.day(d).cast("string"), F.lit(" de "), month(names), F.lit(" de "), F.year(d).cast("string"))
    en = F.concat(F.initcap(month(english)), F.lit(" "), F.day(d).cast("string"), F.lit(", "), F.year(d).cast("string"))
    return claims(spark, sf_dir).select("id", sc.localized_date(F.when(F.col("id") % 2 == 0, es).otherwise(en)).alias("day"))


@register("""SELECT id, CASE WHEN r < 30 THEN 'oversold' WHEN r > 70 THEN 'overbought' ELSE 'neutral' END AS rsi_zone, CASE WHEN c < -100 THEN 'oversold' WHEN c > 100 THEN 'overbought' ELSE 'neutral' END AS cci_zone, CASE WHEN r < 20 THEN 'oversold' WHEN r > 80 THEN 'overbought' ELSE 'neutral' END AS stochastic_zone, CASE WHEN r - 100 < -80 THEN 'oversold' WHEN r - 100 > -20 THEN 'overbought' ELSE 'neutral' END AS williams_zone,
CASE WHEN c > 0 THEN 'bullish' WHEN c < 0 THEN 'bearish' ELSE 'neutral' END AS sign FROM (SELECT id, id % 101 AS r, id % 401 - 200 AS c FROM claims)""")
def f14_zones(spark, sf_dir):
    r, c = F.col("id") % 101, F.col("id") % 401 - 200
    return claims(spark, sf_dir).select("id", sc.zone("rsi", r).alias("rsi_zone"), sc.zone("cci", c).alias("cci_zone"), sc.zone("stochastic", r).alias("stochastic_zone"), sc.zone("williams", r - 100).alias("williams_zone"), sc.sign_label(c).alias("sign"))


@register("""SELECT id, CASE WHEN v < 0 THEN 'capitulation' WHEN v < 0.25 THEN 'low risk' WHEN v < 0.5 THEN 'optimism' WHEN v < 0.75 THEN 'belief' ELSE 'euphoria' END AS nupl, CASE WHEN n < 10 THEN 'below cost' WHEN n < 15 THEN 'accumulation' WHEN n < 25 THEN 'intermediate' WHEN n < 35 THEN 'elevated' ELSE 'euphoria' END AS mvrv, CASE WHEN n < 100 THEN 'loss' WHEN n < 110 THEN 'moderate profit' WHEN n < 130 THEN 'profit' ELSE 'high profit' END AS asopr, CASE WHEN n > 25 THEN 'fear' WHEN n > 15 THEN 'low premium' ELSE 'calm' END AS vix, CASE WHEN n > 55 THEN 'near highs' WHEN n > 50 THEN 'pressing' ELSE 'normal' END AS us10y FROM (SELECT id, id % 120 / 100.0::DOUBLE - 0.1::DOUBLE AS v, id % 140 AS n FROM claims)""")
def f15_bands(spark, sf_dir):
    v, n = F.col("id") % 120 / F.lit(100.0) - F.lit(0.1), F.col("id") % 140
    return claims(spark, sf_dir).select("id", sc.zone("nupl", v).alias("nupl"), sc.zone("mvrv", n / 10).alias("mvrv"), sc.zone("asopr", n / 100).alias("asopr"), sc.zone("vix", n).alias("vix"), sc.zone("us10y", n / 10).alias("us10y"))


_LV = "l AS (SELECT symbol, day, close AS spot, low AS s1, low * 0.9::DOUBLE AS s2, high AS r1, high * 1.1::DOUBLE AS r2 FROM bars_daily)"


def _levels(spark, sf_dir):
    return view(spark, sf_dir, "bars_daily").select("symbol", "day", F.col("close").alias("spot"), F.col("low").alias("s1"), (F.col("low") * 0.9).alias("s2"), F.col("high").alias("r1"), (F.col("high") * 1.1).alias("r2"))


@register(f"WITH {_LV} SELECT symbol, day, r1 AS bull_trigger, round(r2, 4) AS bull_target, s1 AS bull_invalidation, s1 AS bear_trigger, round(s2, 4) AS bear_target FROM l")
def f16_scenarios(spark, sf_dir):
    args = [F.col(c) for c in ("s1", "s2", "r1", "r2")]
    bull, bear = sc.scenario("bull", *args), sc.scenario("bear", *args)
    return _levels(spark, sf_dir).select("symbol", "day", bull["trigger"].alias("bull_trigger"), F.round(bull["target"], 4).alias("bull_target"), bull["invalidation"].alias("bull_invalidation"), bear["trigger"].alias("bear_trigger"), F.round(bear["target"], 4).alias("bear_target"))


@register(f"WITH {_LV} SELECT symbol, day, spot < r1 AND r1 < r2 AS bull_ok, spot > s1 AND s1 > s2 AS bear_ok, spot BETWEEN s1 AND r1 AS base_ok FROM l")
def f17_coherence(spark, sf_dir):
    ok = lambda k, t, g: sc.scenario_coherent(F.lit(k), F.col("spot"), F.col(t), F.col(g))
    return _levels(spark, sf_dir).select("symbol", "day", ok("bull", "r1", "r2").alias("bull_ok"), ok("bear", "s1", "s2").alias("bear_ok"), ok("base", "s1", "r1").alias("base_ok"))


@register("SELECT id, CASE id % 4 WHEN 3 THEN NULL WHEN 1 THEN -round(points, 2) ELSE round(points, 2) END AS value FROM claims")
def f18_parse_number(spark, sf_dir):
    shown = F.format_number("points", 2)
    text = F.when(F.col("id") % 4 == 0, F.concat(F.lit("$"), shown)).when(F.col("id") % 4 == 1, F.concat(F.lit("("), shown, F.lit(")"))).when(F.col("id") % 4 == 2, shown).otherwise("-")
    return claims(spark, sf_dir).select("id", F.round(sc.parse_number(text), 2).alias("value"))


@register("SELECT id, CASE id % 3 WHEN 0 THEN printf('%.2f%%', points) WHEN 1 THEN format('${:,.2f}', points) ELSE printf('%.4f', points) END AS shown FROM (SELECT id, round(points, 2) AS points FROM claims)")
def f19_display(spark, sf_dir):
    unit = F.when(F.col("id") % 3 == 0, "percent").when(F.col("id") % 3 == 1, "usd").otherwise("raw")
    p = F.round("points", 2)
    return claims(spark, sf_dir).select("id", sc.display(p, unit).alias("shown"))


@register("""SELECT id, sha256('{"f0":"' || asset || '","f1":"' || status || '","f2":"' || created || '","f3":' || CASE WHEN id % 3 = 0 THEN 'null' ELSE '"' || id || '"' END || '}') AS row_sha256 FROM claims""")
def f20_row_hash(spark, sf_dir):
    return claims(spark, sf_dir).select("id", sc.row_hash(F.col("asset"), F.col("status"), F.col("created"), F.when(F.col("id") % 3 != 0, F.col("id"))).alias("row_sha256"))


@register("SELECT id, 'https://api.example.com/v1?asset=' || asset || '&api_key=***&x=1 Authorization: Bearer *** ' || status AS logged FROM claims")
def f21_redaction(spark, sf_dir):
    url = F.concat(F.lit("https://api.example.com/v1?asset="), F.col("asset"), F.lit("&api_key=k"), F.col("id").cast("string"), F.lit("&x=1 Authorization: Bearer t"), F.col("id").cast("string"), F.lit(" "), F.col("status"))
    return claims(spark, sf_dir).select("id", sc.redact(url).alias("logged"))


@register("""SELECT id, sha256('[{"key":"day","value":"' || created || '"},{"key":"symbol","value":"' || asset || '"}]') AS identity FROM claims""")
def f22_request_identity(spark, sf_dir):
    params = F.create_map(F.lit("symbol"), F.col("asset"), F.lit("day"), F.col("created").cast("string"))
    return claims(spark, sf_dir).select("id", sc.request_identity(params).alias("identity"))


@register("""SELECT id, least(300, (2 * power(2, id % 9))::BIGINT + ('0x' || substr(sha256(id::VARCHAR), 1, 8))::BIGINT % 4) AS wait, CASE WHEN s = 429 THEN 'rate_limited' WHEN s >= 500 THEN 'transient' WHEN s >= 400 THEN 'permanent' ELSE 'none' END AS retry FROM (SELECT id, CASE id % 5 WHEN 0 THEN 429 WHEN 1 THEN 503 WHEN 2 THEN 404 ELSE 200 END AS s FROM claims)""")
def f23_backoff(spark, sf_dir):
    s = F.when(F.col("id") % 5 == 0, 429).when(F.col("id") % 5 == 1, 503).when(F.col("id") % 5 == 2, 404).otherwise(200)
    return claims(spark, sf_dir).select("id", sc.backoff_seconds(F.col("id") % 9 + 1, F.col("id").cast("string")).alias("wait"), sc.retry_class(s).alias("retry"))


@register("SELECT o_orderkey, 'https://api.example.com/v1/bars?symbol=' || o_orderpriority || '&start=' || epoch(o_orderdate)::BIGINT || '&end=' || (epoch(o_orderdate)::BIGINT + 86400) || '&limit=500' AS request FROM orders")
def f24_expected_request(spark, sf_dir):
    o = orders(spark, sf_dir)
    return o.select("o_orderkey", sc.expected_request(F.lit("api.example.com"), F.lit("/v1/bars"), F.col("o_orderpriority"), F.col("t"), F.col("t") + 86400, 500).alias("request"))


@register("""SELECT id, '{"asset":"' || asset || '","status":"' || status || '"}' AS document FROM claims""")
def f25_revision_json(spark, sf_dir):
    return claims(spark, sf_dir).select("id", F.to_json(F.struct("asset", "status")).alias("document"))


@register("""SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'URLError_TIMEOUT' WHEN 1 THEN 'URLError_DNS' WHEN 2 THEN 'URLError_TLS' WHEN 3 THEN 'URLError_REFUSED' WHEN 4 THEN 'HTTPError_503' WHEN 5 THEN 'HTTPError_UNKNOWN' WHEN 6 THEN 'URLError_RESET' WHEN 7 THEN 'URLError_UNCLASSIFIED' ELSE 'ValueError' END AS category,
event_id % 4 IN (0, 1, 3) AS error_text FROM events""")
def f26_error_category(spark, sf_dir):
    seen = [("URLError", None, "timeout"), ("URLError", None, "gaierror"), ("URLError", None, "SSLError"), ("URLError", None, "ConnectionRefusedError"), ("HTTPError", 503, None), ("HTTPError", 7, None), ("URLError", None, "BrokenPipeError"), ("URLError", None, "OSError"), ("ValueError", None, None)]
    cases = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).cast("int").alias("code"), F.lit(r).cast("string").alias("reason")) for k, c, r in seen])
    texts = F.array(*[F.lit(t) for t in ("", "HTTP 429: Too many", "Title: Quota news", "Connection refused by peer")])
    e = table(spark, sf_dir, "events").withColumn("c", F.get(cases, (F.col("event_id") % 9).cast("int")))
    said = sc.is_error_text(F.get(texts, (F.col("event_id") % 4).cast("int")))
    return e.select("event_id", sc.error_category(F.col("c.kind"), F.col("c.code"), F.col("c.reason")).alias("category"), said.alias("error_text"))


@register("SELECT id, greatest(created - DATE '1995-01-01', 0)::BIGINT AS days_left FROM claims")
def f27_days_left(spark, sf_dir):
    return claims(spark, sf_dir).select("id", sc.days_left(F.col("created"), F.lit("1995-01-01").cast("date")).alias("days_left"))


@register("SELECT id, CASE WHEN id % 3 = 0 THEN DATE '1996-01-01' - 364 ELSE DATE '1990-01-01' END AS earliest, created < CASE WHEN id % 3 = 0 THEN DATE '1996-01-01' - 364 ELSE DATE '1990-01-01' END AS violation FROM claims")
def f28_earliest_start(spark, sf_dir):
    e = sc.earliest_start(F.col("id") % 3, F.lit("1990-01-01").cast("date"), F.lit("1996-01-01").cast("date"))
    return claims(spark, sf_dir).select("id", e.alias("earliest"), (F.col("created") < e).alias("violation"))
