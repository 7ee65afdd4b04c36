"""Scan, join, aggregate, top-k and set queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import scalars as sc
from marketlens.operators import relational as rel
from marketlens.operators.store import stored
from marketlens.plans.registry import register
from marketlens.sources.tables import table, view

bars = lambda s, d: view(s, d, "bars_daily")
claims = lambda s, d: view(s, d, "claims")


@register("SELECT symbol, day, close FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY day DESC) AS rn FROM bars_daily) WHERE rn <= 30")
def s1_newest_prices(spark, sf_dir):
    return rel.newest_n(bars(spark, sf_dir), ["symbol"], "day", 30).select("symbol", "day", "close")


def _range_sql(provider: str, at: str, value: str, more: str, source: str, order: str, limit: int) -> str:
    return f"""SELECT '{provider}' AS provider, *, count(*) OVER () >= {limit} AS truncated FROM (SELECT ({at})::VARCHAR AS at, ({value})::DOUBLE AS value, ({more})::VARCHAR AS more FROM {source} ORDER BY {order} LIMIT {limit})"""


_IN = "BETWEEN DATE '1997-01-01' AND DATE '2024-12-31'"
_RANGES = [
    ("ohlcv", "2-HIGH", 300, "day", "close", "volume", f"bars_daily WHERE symbol = '2-HIGH' AND day {_IN}", "day"),
    ("series", "5-LOW", 5000, "obs_date", "value", "''", f"macro_monthly WHERE series_id = '5-LOW' AND obs_date {_IN}", "obs_date"),
    ("unit", "3-MEDIUM", 200, "created", "points", "'usd|' || id", f"claims WHERE asset = '3-MEDIUM' AND created {_IN}", "created, id"),
    ("vintage", "3", 100, "observed_date", "value", "realtime_start", f"vintages WHERE series_id = 3 AND observed_date {_IN}", "observed_date, realtime_start"),
    ("daily", "1-URGENT", 400, "day", "volume", "symbol", f"bars_daily JOIN (SELECT DISTINCT o_orderpriority AS name FROM orders) ON name = symbol WHERE name = '1-URGENT' AND day {_IN}", "day"),
    ("news", "en", 90, "report_date", "doc_id", "'https://news.example.com/' || doc_id", f"(SELECT doc_id, lang, DATE '1997-01-01' + (doc_id % 400)::INT AS report_date FROM documents) WHERE lang = 'en' AND report_date {_IN}", "report_date, doc_id"),
    ("distribution", "click", 150, "slot::DATE", "close", "hour(slot)", f"bars_hourly WHERE symbol = 'click' AND slot::DATE {_IN}", "slot"),
]


@register(" UNION ALL ".join(f"SELECT * FROM ({_range_sql(p, a, v, m, s, o, n)})" for p, _, n, a, v, m, s, o in _RANGES))
def s2_range_scan(spark, sf_dir):
    v = lambda name: view(spark, sf_dir, name)
    out = ("at", "value", "more")
    shaped = lambda df, at, value, more: df.withColumn("at", F.expr(at).cast("string")).withColumn("value", F.expr(value).cast("double")).withColumn("more", F.expr(more).cast("string"))
    sources = {
        "ohlcv": rel.Source(shaped(v("bars_daily"), "day", "close", "volume"), "symbol", "day", (), out),
        "series": rel.Source(shaped(v("macro_monthly"), "obs_date", "value", "''"), "series_id", "obs_date", (), out),
        "unit": rel.Source(shaped(v("claims"), "created", "points", "concat('usd|', id)"), "asset", "created", ("id",), out),
        "vintage": rel.Source(shaped(v("vintages"), "observed_date", "value", "realtime_start"), "series_id", "observed_date", ("realtime_start",), out),
        "distribution": rel.Source(shaped(v("bars_hourly"), "to_date(slot)", "close", "hour(slot)"), "symbol", "slot", (), out),
    }
    # daily values are found by the name that a catalog gives their series
    catalog = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("name")).distinct()
    daily = v("bars_daily").join(catalog, F.col("symbol") == F.col("name"))
    sources["daily"] = rel.Source(shaped(daily, "day", "volume", "symbol"), "name", "day", (), out)
    news = table(spark, sf_dir, "documents").select("doc_id", "lang", F.date_add(F.lit("1997-01-01").cast("date"), (F.col("doc_id") % 400).cast("int")).alias("report_date"))
    sources["news"] = rel.Source(shaped(news, "report_date", "doc_id", "concat('https://news.example.com/', doc_id)"), "lang", "report_date", ("doc_id",), out)
    parts = [rel.query_history(sources, p, metric, "1997-01-01", "2024-12-31", n).select(F.lit(p).alias("provider"), *out, "truncated") for p, metric, n, *_ in _RANGES]
    return reduce(DataFrame.unionByName, parts)


@register("SELECT DISTINCT lower(trim(o_orderpriority)) AS instrument FROM orders WHERE o_orderpriority LIKE '%-%'")
def s19_catalog_scan(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where(F.col("o_orderpriority").like("%-%"))
    return o.select(F.lower(F.trim("o_orderpriority")).alias("instrument")).distinct()


@register("SELECT sha256(text) AS digest, count(*) AS receipts, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1")
def s18_content_addressed(spark, sf_dir):
    from marketlens.sources.decode import content_addressed

    return content_addressed(table(spark, sf_dir, "documents"), "text", "doc_id").withColumnRenamed("first_id", "first_doc")


@register("""WITH p AS (SELECT l_orderkey, l_linenumber % 5 AS metric, CAST(l_shipdate AS DATE) AS t FROM lineitem WHERE l_linenumber <= 5),
g AS (SELECT l_orderkey, count(DISTINCT metric) AS m, count(*) AS n, count(DISTINCT month(t)) AS k FROM p GROUP BY 1)
SELECT p.* FROM p JOIN g USING (l_orderkey) WHERE m >= 2 AND k = 1""")
def s5_all_or_nothing_fanout(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").where("l_linenumber <= 5").select("l_orderkey", (F.col("l_linenumber") % 5).alias("metric"), F.to_date("l_shipdate").alias("t"))
    g = p.groupBy("l_orderkey").agg(F.count_distinct("metric").alias("m"), F.count_distinct(F.month("t")).alias("k"))
    return p.join(g.where("m >= 2 and k = 1"), "l_orderkey", "left_semi")


_REG = "(VALUES ('1-URGENT', 0.001, 'k', true), ('2-HIGH', 1e-6, 'M', true), ('3-MEDIUM', 1.0, 'raw', false)) reg(asset, factor, unit, verified)"


def registry(spark):
    return spark.createDataFrame([("1-URGENT", 0.001, "k", True), ("2-HIGH", 1e-6, "M", True), ("3-MEDIUM", 1.0, "raw", False)], "asset string, factor double, unit string, verified boolean")


@register(f"SELECT id, round(points * coalesce(factor, 1)::DOUBLE, 6) AS converted, coalesce(unit, 'unknown') AS unit, coalesce(verified, false) AS verified FROM claims LEFT JOIN {_REG} USING (asset)")
def p1_unit_conversion(spark, sf_dir):
    return rel.convert_units(claims(spark, sf_dir), registry(spark), "asset", "points").select("id", F.round("converted", 6).alias("converted"), "unit", "verified")


@register("SELECT id, round(CASE asset WHEN '1-URGENT' THEN points / 1e12 WHEN '2-HIGH' THEN points / 1e18 WHEN '3-MEDIUM' THEN CASE WHEN points > 100000 THEN points / 1e12 ELSE points END ELSE points END * 1e12, 4) AS scaled FROM claims")
def p2_scale_functions(spark, sf_dir):
    v, a = F.col("points"), F.col("asset")
    scaled = F.when(a == "1-URGENT", v / 1e12).when(a == "2-HIGH", v / 1e18).when(a == "3-MEDIUM", F.when(v > 100000, v / 1e12).otherwise(v)).otherwise(v)
    return claims(spark, sf_dir).select("id", F.round(scaled * 1e12, 4).alias("scaled"))


@register(f"SELECT id, round(points * coalesce(factor, 1)::DOUBLE, 2) AS shown FROM claims JOIN {_REG} USING (asset)")
def p3_rounded_display(spark, sf_dir):
    return rel.convert_units(claims(spark, sf_dir).join(registry(spark).select("asset"), "asset"), registry(spark), "asset", "points").select("id", F.round("converted", 2).alias("shown"))


@register("SELECT max(CASE WHEN series_id = '1-URGENT' THEN round(value, 2) END) AS urgent, max(CASE WHEN series_id = '5-LOW' THEN round(value, 2) END) AS low, obs_date FROM macro_monthly WHERE obs_date = DATE '1995-03-01' GROUP BY obs_date")
def p19_macro_for_date(spark, sf_dir):
    m = view(spark, sf_dir, "macro_monthly").where("obs_date = date'1995-03-01'").withColumn("value", F.round("value", 2))
    return m.groupBy("obs_date").pivot("series_id", ["1-URGENT", "5-LOW"]).agg(F.max("value")).select(F.col("`1-URGENT`").alias("urgent"), F.col("`5-LOW`").alias("low"), "obs_date")


@register("""WITH p AS (SELECT day, max(CASE WHEN symbol = '1-URGENT' THEN close END) AS price, max(CASE WHEN symbol = '2-HIGH' THEN close END) AS basis, max(CASE WHEN symbol = '3-MEDIUM' THEN close END) AS profit, max(CASE WHEN symbol = '5-LOW' THEN close END) AS loss, max(CASE WHEN symbol = '3-MEDIUM' THEN open END) - max(CASE WHEN symbol = '5-LOW' THEN open END) AS net FROM bars_daily GROUP BY day)
SELECT day, round((price / basis - 1) * 100, 4) AS price_vs_basis_pct, abs(profit - loss - net) <= greatest(1, abs(net) * 0.001) AS net_ok FROM p WHERE price IS NOT NULL AND basis IS NOT NULL AND profit IS NOT NULL AND loss IS NOT NULL""")
def p18_cross_metric(spark, sf_dir):
    # the reported net is another series than profit and loss: that of the opening values
    of = lambda s, c: F.max(F.when(F.col("symbol") == s, F.col(c)))
    p = bars(spark, sf_dir).groupBy("day").agg(of("1-URGENT", "close").alias("price"), of("2-HIGH", "close").alias("basis"), of("3-MEDIUM", "close").alias("profit"), of("5-LOW", "close").alias("loss"), (of("3-MEDIUM", "open") - of("5-LOW", "open")).alias("net")).na.drop()
    ok = sc.close_to(F.col("net"), F.col("profit") - F.col("loss"), 1.0, 1e-3)
    return p.select("day", F.round((F.col("price") / F.col("basis") - 1) * 100, 4).alias("price_vs_basis_pct"), ok.alias("net_ok"))


@register("SELECT id FROM claims WHERE asset = '2-HIGH' AND status = 'missed'")
def p20_optional_filter(spark, sf_dir):
    return rel.matching(claims(spark, sf_dir), asset="2-HIGH", status="missed", created=None).select("id")


@register("SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey")
def j1_fact_catalog(spark, sf_dir):
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select("o_orderkey", "c_name", "n_name")


@register("SELECT a.day, a.close AS a_close, b.close AS b_close FROM bars_daily a JOIN bars_daily b ON a.day = b.day AND a.symbol = '1-URGENT' AND b.symbol = '5-LOW'")
def j2_two_series(spark, sf_dir):
    b = bars(spark, sf_dir)
    return b.where("symbol = '1-URGENT'").select("day", F.col("close").alias("a_close")).join(b.where("symbol = '5-LOW'").select("day", F.col("close").alias("b_close")), "day")


@register("SELECT a.series_id, a.obs_date, round((a.value / b.value - 1) * 100, 4) AS yoy FROM macro_monthly a JOIN macro_monthly b ON a.series_id = b.series_id AND a.obs_date = b.obs_date + INTERVAL 12 MONTH")
def j3_year_over_year(spark, sf_dir):
    j = rel.month_offset_join(view(spark, sf_dir, "macro_monthly"), "series_id", "obs_date", "value", 12)
    return j.select("series_id", "obs_date", F.round((F.col("value") / F.col("prev") - 1) * 100, 4).alias("yoy"))


@register("SELECT a.series_id, a.obs_date, round(a.value - b.value, 2) AS change FROM macro_monthly a JOIN macro_monthly b ON a.series_id = b.series_id AND a.obs_date = b.obs_date + INTERVAL 1 MONTH")
def j4_month_change(spark, sf_dir):
    j = rel.month_offset_join(view(spark, sf_dir, "macro_monthly"), "series_id", "obs_date", "value", 1)
    return j.select("series_id", "obs_date", F.round(F.col("value") - F.col("prev"), 2).alias("change"))


@register("SELECT symbol, day, round(avg(close) OVER (PARTITION BY symbol ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 4) AS mean7 FROM bars_daily")
def j5_trailing_week_mean(spark, sf_dir):
    return rel.trailing_days_mean(bars(spark, sf_dir), ["symbol"], "day", "close", 7, "mean7").select("symbol", "day", F.round("mean7", 4).alias("mean7"))


@register("SELECT l_orderkey, l_linenumber FROM raw_values WHERE (l_orderkey, l_linenumber) NOT IN (SELECT l_orderkey, l_linenumber FROM stored_values)")
def j6_left_anti(spark, sf_dir):
    return view(spark, sf_dir, "raw_values").join(view(spark, sf_dir, "stored_values"), ["l_orderkey", "l_linenumber"], "left_anti").select("l_orderkey", "l_linenumber")


@register("SELECT DISTINCT obs_date FROM macro_monthly WHERE obs_date IN (SELECT day FROM bars_daily)")
def j7_left_semi(spark, sf_dir):
    m = view(spark, sf_dir, "macro_monthly").select("obs_date").distinct()
    return m.join(bars(spark, sf_dir).select(F.col("day").alias("obs_date")), "obs_date", "left_semi")


@register("SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def j8_left_outer_scores(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "quality", "toxic")


@register("SELECT l_orderkey, l_linenumber, o_custkey, c_nationkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey")
def j9_three_way(spark, sf_dir):
    li, o, c = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    return li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).select("l_orderkey", "l_linenumber", "o_custkey", "c_nationkey")


#: Beside the receipts' windows of a month at most each series has one of 31 years and one of a day.
@register("""WITH w AS (SELECT series_id, start_day, end_day FROM receipts UNION ALL SELECT DISTINCT series_id, DATE '1990-01-01', DATE '2021-01-01' FROM receipts UNION ALL SELECT series_id, min(start_day) + 9, min(start_day) + 10 FROM receipts GROUP BY 1)
SELECT v.series_id, v.realtime_start, w.start_day, w.end_day, count(*) AS points FROM vintages v JOIN w ON w.series_id = v.series_id AND v.realtime_start >= w.start_day AND v.realtime_start < w.end_day GROUP BY 1, 2, 3, 4""")
def j10_interval_join(spark, sf_dir):
    from marketlens.operators.intervals import point_in_window

    v = view(spark, sf_dir, "vintages").groupBy("series_id", "realtime_start").agg(F.count("*").alias("_n"))
    r = stored(view(spark, sf_dir, "receipts").select("series_id", "start_day", "end_day"), "receipts")  # read three times
    long = r.select("series_id").distinct().select("series_id", F.make_date(F.lit(1990), F.lit(1), F.lit(1)).alias("start_day"), F.make_date(F.lit(2021), F.lit(1), F.lit(1)).alias("end_day"))
    first = r.groupBy("series_id").agg(F.min("start_day").alias("_d"))
    short = first.select("series_id", F.date_add("_d", 9).alias("start_day"), F.date_add("_d", 10).alias("end_day"))
    w = r.unionByName(long).unionByName(short).groupBy("series_id", "start_day", "end_day").agg(F.count("*").alias("_m"))
    j = point_in_window(v, w, "series_id", "realtime_start", "start_day", "end_day")  # a row a point and window, so nothing is left to group
    return j.select("series_id", "realtime_start", "start_day", "end_day", (F.col("_n") * F.col("_m")).alias("points"))


@register("WITH c AS (SELECT unnest(['view', 'click', 'purchase', 'unseen_metric']) AS event_type) SELECT coalesce(c.event_type, e.event_type) AS event_type, coalesce(n, 0) AS n FROM c FULL OUTER JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) e ON e.event_type = c.event_type")
def j18_catalog_zero_rows(spark, sf_dir):
    catalog = spark.createDataFrame([("view",), ("click",), ("purchase",), ("unseen_metric",)], "event_type string")
    return rel.with_catalog(table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n")), catalog, "event_type")


@register("SELECT asset, status, count(*) AS n, round(sum(points), 2) AS points FROM claims GROUP BY asset, status")
def a2_status_rollup(spark, sf_dir):
    return claims(spark, sf_dir).groupBy("asset", "status").agg(F.count("*").alias("n"), F.round(F.sum("points"), 2).alias("points"))


_HIT = "count(*) AS total, count(*) FILTER (status = 'achieved') AS achieved, count(*) FILTER (status = 'missed') AS missed, count(*) FILTER (status = 'partial') AS partial"


@register(f"SELECT asset, {_HIT} FROM claims GROUP BY asset")
def a3_conditional_counts(spark, sf_dir):
    return rel.hit_rates(claims(spark, sf_dir)).drop("hit_rate")


@register(f"SELECT *, round(achieved * 100.0::DOUBLE / total, 1) AS hit_rate FROM (SELECT asset, {_HIT} FROM claims WHERE created >= (SELECT max(created) - 90 FROM claims) GROUP BY asset)")
def a4_hit_rate(spark, sf_dir):
    c = claims(spark, sf_dir)
    c = c.crossJoin(F.broadcast(c.agg(F.date_sub(F.max("created"), 90).alias("since"))))  # one row
    return rel.hit_rates(c, F.col("since"))


@register("SELECT count(DISTINCT (asset, status, created)) AS n FROM claims")
def a5_distinct_composite(spark, sf_dir):
    return claims(spark, sf_dir).agg(F.count_distinct("asset", "status", "created").alias("n"))


@register("SELECT asset, status, count(*) AS n, round(sum(points), 2) AS points FROM claims GROUP BY ROLLUP (asset, status)")
def a2_status_rollup_levels(spark, sf_dir):
    """Rows of each asset and status, of each asset, and of all."""
    return claims(spark, sf_dir).rollup("asset", "status").agg(F.count("*").alias("n"), F.round(F.sum("points"), 2).alias("points"))


#: Days of a range of sketches.
_RANGE = ("1994-03-05", "1997-11-20")


@register(f"""WITH r AS (SELECT * FROM claims WHERE created BETWEEN DATE '{_RANGE[0]}' AND DATE '{_RANGE[1]}') SELECT asset, 'distinct days and amounts' AS measure, count(DISTINCT (created, round(points))) AS exact, true AS inside FROM r GROUP BY 1
UNION ALL SELECT asset, 'p' || (q * 100)::INT, count(points), true FROM r, (VALUES (0.1), (0.5), (0.9)) t(q) GROUP BY asset, q""")
def a5_sketches_of_a_range(spark, sf_dir):
    """Sketches are stored by day; those of a range are merged, and each estimate is held against the exact rows: a count
    by its relative error, a quantile by the rank that it has."""
    from marketlens.operators import sketches as sk
    from marketlens.operators.store import stored

    c = claims(spark, sf_dir).select("asset", "created", "points")
    first, last = (F.lit(d).cast("date") for d in _RANGE)
    value = F.concat_ws("|", "created", F.round("points").cast("decimal(18,0)"))
    days = stored(sk.daily_sketches(c, ["asset"], F.col("created"), value, F.col("points")), "sketches")
    rows = c.where(F.col("created").between(first, last))
    exact = rows.groupBy("asset").agg(F.count_distinct(value).alias("exact"))
    near = F.abs(F.col("estimate") - F.col("exact")) <= sk.COUNT_BOUND * F.col("exact")
    counts = sk.distinct_in(days, ["asset"], first, last).join(exact, "asset").select("asset", F.lit("distinct days and amounts").alias("measure"), "exact", near.alias("inside"))
    q = sk.quantiles_in(days, ["asset"], first, last, [0.1, 0.5, 0.9])
    ranks = rows.join(F.broadcast(q), "asset").groupBy("asset", "q").agg(F.count("*").alias("exact"), (F.count_if(F.col("points") <= F.col("estimate")) / F.count("*")).alias("high"), (F.count_if(F.col("points") < F.col("estimate")) / F.count("*")).alias("low"))  # three rows an asset
    held = (F.col("low") - sk.RANK_BOUND <= F.col("q")) & (F.col("q") <= F.col("high") + sk.RANK_BOUND)
    return counts.unionByName(ranks.select("asset", F.concat(F.lit("p"), F.round(F.col("q") * 100).cast("int")).alias("measure"), "exact", held.alias("inside")))


@register("SELECT asset, created, count(*) AS n FROM claims GROUP BY 1, 2 HAVING count(*) > 1")
def a6_duplicates(spark, sf_dir):
    return rel.duplicates(claims(spark, sf_dir), ["asset", "created"])


@register("SELECT series_id, count(DISTINCT (value > 50000)) AS units, count(DISTINCT (value > 50000)) = 1 AS unique_unit FROM vintages GROUP BY 1")
def a13_unit_uniqueness(spark, sf_dir):
    v = view(spark, sf_dir, "vintages").withColumn("unit", F.col("value") > 50000)
    return v.groupBy("series_id").agg(F.size(F.collect_set("unit")).cast("long").alias("units"), (F.size(F.collect_set("unit")) == 1).alias("unique_unit"))


@register("SELECT 'bars' AS source, max(day) AS latest FROM bars_daily UNION ALL SELECT 'macro', max(obs_date) FROM macro_monthly UNION ALL SELECT 'claims', max(created) FROM claims")
def a14_table_freshness(spark, sf_dir):
    parts = [(bars(spark, sf_dir), "day", "bars"), (view(spark, sf_dir, "macro_monthly"), "obs_date", "macro"), (claims(spark, sf_dir), "created", "claims")]
    dfs = [d.agg(F.max(c).alias("latest")).select(F.lit(n).alias("source"), "latest") for d, c, n in parts]
    return dfs[0].unionByName(dfs[1]).unionByName(dfs[2])


@register("""WITH f AS (SELECT CAST(l_shipdate AS DATE) AS day, CASE WHEN l_linenumber = 7 THEN 'TOTAL' ELSE 'F' || l_linenumber END AS ticker, l_extendedprice AS flow FROM lineitem)
SELECT day, round(coalesce(max(CASE WHEN ticker = 'TOTAL' THEN flow END), sum(CASE WHEN ticker <> 'TOTAL' THEN flow END)), 2) AS total, CASE WHEN max(CASE WHEN ticker = 'TOTAL' THEN flow END) IS NOT NULL THEN 'published' ELSE 'sum of components' END AS label FROM f GROUP BY day""")
def a15_day_total(spark, sf_dir):
    ticker = F.when(F.col("l_linenumber") == 7, "TOTAL").otherwise(F.concat(F.lit("F"), F.col("l_linenumber").cast("string")))
    f = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day"), ticker.alias("ticker"), F.col("l_extendedprice").alias("flow"))
    total, parts = F.max(F.when(F.col("ticker") == "TOTAL", F.col("flow"))), F.sum(F.when(F.col("ticker") != "TOTAL", F.col("flow")))
    return f.groupBy("day").agg(F.round(F.coalesce(total, parts), 2).alias("total"), F.when(total.isNotNull(), "published").otherwise("sum of components").alias("label"))


@register("SELECT source, count(*) AS n, sum(strlen(text))::BIGINT AS bytes, min(doc_id) AS first, max(doc_id) AS last FROM documents GROUP BY source")
def a16_payload_inventory(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


@register("SELECT min(latest) AS oldest FROM (SELECT symbol, max(day) AS latest FROM bars_daily WHERE symbol <> '5-LOW' GROUP BY symbol)")
def a28_oldest_required(spark, sf_dir):
    return bars(spark, sf_dir).where("symbol != '5-LOW'").groupBy("symbol").agg(F.max("day").alias("latest")).agg(F.min("latest").alias("oldest"))


@register("SELECT series_id, obs_date, value FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY obs_date DESC) AS rn FROM macro_monthly) WHERE rn <= 12")
def t1_latest_n(spark, sf_dir):
    return rel.newest_n(view(spark, sf_dir, "macro_monthly"), ["series_id"], "obs_date", 12).orderBy("series_id", "obs_date")


@register("SELECT id, asset, created FROM claims ORDER BY created DESC, asset, id LIMIT 25")
def t2_top_recents(spark, sf_dir):
    return claims(spark, sf_dir).orderBy(F.desc("created"), "asset", "id").limit(25).select("id", "asset", "created")


@register("""WITH m AS (SELECT max(created) - 14 AS today FROM claims), e AS (SELECT created AS day, asset AS title, status AS provider, id FROM claims, m WHERE created >= today AND created <= today + 14),
r AS (SELECT *, row_number() OVER (PARTITION BY day, title ORDER BY provider, id) AS k FROM e) SELECT day, title, provider, id FROM r WHERE k = 1 ORDER BY day, title, id LIMIT 20""")
def t3_upcoming_events(spark, sf_dir):
    c = claims(spark, sf_dir)
    c = c.crossJoin(F.broadcast(c.agg(F.date_sub(F.max("created"), 14).alias("today"))))  # one row
    e = c.where((F.col("created") >= F.col("today")) & (F.col("created") <= F.date_add("today", 14))).select(F.col("created").alias("day"), F.col("asset").alias("title"), F.col("status").alias("provider"), "id")
    k = F.row_number().over(Window.partitionBy("day", "title").orderBy("provider", "id"))
    return e.withColumn("k", k).where("k = 1").drop("k").orderBy("day", "title", "id").limit(20)


@register("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id % 40 DESC, doc_id) AS k FROM documents) WHERE k <= 3")
def t5_newest_per_feed(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", "doc_id")
    k = F.row_number().over(Window.partitionBy("source").orderBy(F.desc(F.col("doc_id") % 40), "doc_id"))
    return d.withColumn("k", k).where("k <= 3").drop("k")


@register("SELECT l_orderkey, l_linenumber, 'missing' AS side FROM (SELECT l_orderkey, l_linenumber FROM raw_values EXCEPT SELECT l_orderkey, l_linenumber FROM stored_values) UNION ALL SELECT l_orderkey, l_linenumber, 'unexpected' FROM (SELECT l_orderkey, l_linenumber FROM stored_values EXCEPT SELECT l_orderkey, l_linenumber FROM raw_values)")
def u2_key_differences(spark, sf_dir):
    return rel.key_differences(view(spark, sf_dir, "raw_values"), view(spark, sf_dir, "stored_values"), ["l_orderkey", "l_linenumber"])


@register("SELECT series_id FROM receipts UNION SELECT series_id FROM vintages UNION SELECT s_suppkey FROM supplier")
def u3_key_union(spark, sf_dir):
    a, b = view(spark, sf_dir, "receipts").select("series_id"), view(spark, sf_dir, "vintages").select("series_id")
    return a.union(b).union(table(spark, sf_dir, "supplier").select("s_suppkey")).distinct()


@register("SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS in_both FROM documents")
def u4_in_both(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("_l", F.lit(True))
    return table(spark, sf_dir, "documents").select("doc_id").join(lab, "doc_id", "left").select("doc_id", F.coalesce("_l", F.lit(False)).alias("in_both"))


@register("SELECT symbol, max(CASE WHEN day = DATE '1995-01-03' THEN close END) AS before, max(CASE WHEN day = DATE '1995-01-04' THEN close END) AS after FROM bars_daily GROUP BY symbol HAVING before IS NOT NULL OR after IS NOT NULL")
def u5_day_pair(spark, sf_dir):
    return rel.day_pair(bars(spark, sf_dir), ["symbol"], "day", "close", F.lit("1995-01-03").cast("date"), F.lit("1995-01-04").cast("date"))


#: Columns of the fingerprinted tables, by the form in which a canonical row has them.
_FORMS = {
    "orders": {"text": "o_orderkey o_custkey o_orderstatus o_orderpriority", "float": "o_totalprice", "time": "o_orderdate"},
    "lineitem": {"text": "l_orderkey l_partkey l_suppkey l_linenumber l_returnflag l_linestatus", "float": "l_quantity l_extendedprice l_discount l_tax", "time": "l_shipdate"},
    "events": {"text": "event_id user_id event_type props", "float": "value", "time": "ts"},
    "documents": {"text": "doc_id text lang source n_chars"},
}


def _canonical_sql(forms: dict[str, str], order: list[str]) -> str:
    kind = {c: k for k, names in forms.items() for c in names.split()}
    text = {"text": "{}::VARCHAR", "float": "printf('%.6f', {})", "time": "epoch_us({})::VARCHAR"}
    shown = [text[kind[c]].format(c) for c in order]
    return " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE length({t}) || ':' || {t} END" for c, t in zip(order, shown))


_ORDER = {"events": "event_id ts user_id event_type value props", "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority", "documents": "doc_id text lang source n_chars", "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"}


@register(" UNION ALL ".join(f"""SELECT '{t}' AS "table", count(*) AS n, sum(('0x' || substr(sha256({_canonical_sql(_FORMS[t], _ORDER[t].split())}), 1, 15))::BIGINT::HUGEINT)::VARCHAR AS fingerprint FROM {t}""" for t in _FORMS))
def a18_table_fingerprint(spark, sf_dir):
    dfs = [rel.table_fingerprint(table(spark, sf_dir, t).select(*_ORDER[t].split())).select(F.lit(t).alias("table"), "n", "fingerprint") for t in _FORMS]
    return reduce(DataFrame.unionByName, dfs)


def _digest_sql(source: str, fields: list[str]) -> str:
    row = _canonical_sql({"text": "day volume", "float": "open high low close"}, fields)
    return f"""WITH p AS (SELECT symbol, year(day) AS y, sha256(string_agg({row}, ';' ORDER BY day)) AS d, count(*) AS n FROM {source} GROUP BY 1, 2)
SELECT symbol, sha256(string_agg(d, ';' ORDER BY y)) AS digest, sum(n)::BIGINT AS n FROM p GROUP BY 1"""


@register(_digest_sql("(SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY day DESC) AS rn FROM bars_daily) WHERE rn <= 100", ["day", "close"]))
def a19_sample_fingerprint(spark, sf_dir):
    b = rel.newest_n(bars(spark, sf_dir), ["symbol"], "day", 100)
    return rel.series_digest(b, ["symbol"], "day", ["day", "close"], F.year("day"))


@register(_digest_sql("bars_daily", ["day", "open", "high", "low", "close", "volume"]))
def a20_series_digest(spark, sf_dir):
    return rel.series_digest(bars(spark, sf_dir), ["symbol"], "day", ["day", "open", "high", "low", "close", "volume"], F.year("day"))


@register("SELECT 'lineitem' AS \"table\"")
def a29_changed_tables(spark, sf_dir):
    before = stored(a18_table_fingerprint(spark, sf_dir), "before")  # both snapshots take it
    after = rel.table_fingerprint(table(spark, sf_dir, "lineitem").withColumn("l_quantity", F.col("l_quantity") + F.when(F.col("l_orderkey") % 97 == 0, 1).otherwise(0))).select(F.lit("lineitem").alias("table"), "n", "fingerprint")
    return rel.changed_tables(before, before.where("table != 'lineitem'").unionByName(after))


@register("""WITH k AS (SELECT 'lineitem' AS "table", l_orderkey AS key, CASE WHEN l_orderkey % 2000 = 7 THEN 'removed' ELSE 'changed' END AS change FROM lineitem WHERE l_orderkey % 1500 = 5 OR l_orderkey % 2000 = 7
  UNION SELECT 'lineitem', 10000000 + l_orderkey, 'added' FROM lineitem WHERE l_orderkey % 3000 = 11 UNION SELECT 'orders', o_orderkey, 'changed' FROM orders WHERE o_orderkey % 900 = 2)
SELECT "table", key // 64 * 64 AS lo, key // 64 * 64 + 63 AS hi, key, change FROM k""")
def a29_changed_ranges(spark, sf_dir):
    """Changed, removed and added keys with their ranges, found by hash trees; orders repeat one row, customers stay."""
    from marketlens.operators.hashtree import changed_keys

    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    k = F.col("l_orderkey")
    after = li.where(k % 2000 != 7).withColumn("l_quantity", F.col("l_quantity") + F.when(k % 1500 == 5, 1).otherwise(0))
    after = after.unionByName(li.where(k % 3000 == 11).withColumn("l_orderkey", k + 10_000_000))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    sides = [("lineitem", li, after, "l_orderkey"), ("orders", o, o.unionByName(o.where("o_orderkey % 900 = 2")), "o_orderkey"), ("customer", c, c.repartition(3), "c_custkey")]
    parts = [changed_keys(a, b, key).select(F.lit(n).alias("table"), "lo", "hi", "key", "change") for n, a, b, key in sides]
    return reduce(DataFrame.unionByName, parts)


@register("""WITH c AS (SELECT day, max(CASE WHEN symbol = '1-URGENT' THEN close END) AS cap, max(CASE WHEN symbol = '2-HIGH' THEN close END) AS realized, max(CASE WHEN symbol = '3-MEDIUM' THEN close END) AS have FROM bars_daily GROUP BY day)
SELECT day, round(cap / realized, 6) AS mvrv FROM c WHERE have IS NULL AND cap IS NOT NULL AND realized IS NOT NULL AND cap / realized > 0 AND cap / realized < 100""")
def w28_ratio_fill(spark, sf_dir):
    from marketlens.functions.scalars import ratio_in

    b = bars(spark, sf_dir)
    one = lambda s, c: b.where(F.col("symbol") == s).select("day", F.col("close").alias(c))
    j = one("1-URGENT", "cap").join(one("2-HIGH", "realized"), "day").join(one("3-MEDIUM", "have"), "day", "left_anti")
    return j.withColumn("mvrv", F.round(ratio_in(F.col("cap"), F.col("realized"), 0, 100), 6)).where("mvrv is not null").select("day", "mvrv")
