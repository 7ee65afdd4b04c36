"""Report rules over monthly reports that Spark renders from the given orders: one report for each month.

Each month whose number modulo 60 is listed below breaks something; the oracles tell what from the number alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators import documents as dm
from marketlens.plans.registry import register
from marketlens.sources.tables import table, view

#: The months, their day and closing prices, in SQL for both sides; years are moved to where reports date from.
_MONTHS = """SELECT CAST(year(day) * 12 + month(day) AS BIGINT) AS report, max_by(close, day) FILTER (WHERE symbol = '1-URGENT') AS btc, max_by(close, day) FILTER (WHERE symbol = '2-HIGH') AS spy,
max_by(close, day) FILTER (WHERE symbol = '3-MEDIUM') AS gold FROM bars_daily GROUP BY 1"""
_M = f"m AS (SELECT report, report % 60 AS m, btc FROM ({_MONTHS}) WHERE btc IS NOT NULL AND spy IS NOT NULL AND gold IS NOT NULL)"


def _expected(cases: list[tuple], columns: str) -> str:
    rows = ", ".join("(" + ", ".join("NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'" for v in case) + ")" for case in cases)
    return f"WITH {_M}, c(n, {columns}) AS (VALUES {rows}) SELECT report, {columns} FROM m JOIN c ON c.n = m.m"


def _usd(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(F.round(c, 2), 2))


def months(spark, sf_dir) -> DataFrame:
    m = spark.sql(_MONTHS.replace("bars_daily", "{bars}"), bars=view(spark, sf_dir, "bars_daily")).na.drop()
    day = F.last_day(F.make_date(F.expr("(report - 1) div 12 + 20").cast("int"), ((F.col("report") - 1) % 12 + 1).cast("int"), F.lit(1)))
    return m.withColumn("m", F.col("report") % 60).withColumn("day", day)


def archived(spark, sf_dir) -> DataFrame:
    """report, asset, metric, value, source of each month."""
    m = months(spark, sf_dir)
    at = lambda n: F.col("m") == n
    price = {"BTC": F.col("btc"), "SPY": F.col("spy"), "GOLD": F.col("gold"), "SILVER": F.col("btc") / 9, "OIL": F.col("spy") / 7}
    close = F.unix_timestamp(F.date_sub("day", 1).cast("timestamp")).cast("double")
    rows = [(a, "price", F.round(p, 2) + F.when(at(25) & F.lit(a == "SPY"), 1).otherwise(0), ~(at(24) & F.lit(a == "BTC"))) for a, p in price.items()]
    rows += [(a, "close_ts", close + F.when(at(27) & F.lit(a == "SILVER"), 86400).otherwise(0), ~at(42) & ~(at(26) & F.lit(a == "GOLD"))) for a in price]
    rows += [("BTC", "rsi_14", F.when(at(28), 56.0).otherwise(55.0), ~at(42)), ("BTC", "macd_hist", F.lit(1.25), ~at(42)), ("MACRO", "cpi_yoy", F.when(at(30), 3.6).when(at(31), 12.0).otherwise(3.1), ~at(42) & ~at(39))]
    rows += [("MACRO", "nfp", F.lit(150.0), ~at(42) & ~at(40)), ("CHAIN", "mvrv", F.when(at(34), 2.6).otherwise(2.1), ~at(42)), ("MACRO", "yield_10y", F.when(at(35), 4.5).otherwise(4.2), ~at(42))]
    source = F.when(~(at(43) & (F.col("metric") == "price")), "bars")
    all_ = F.array(*[F.when(kept, F.struct(F.lit(a).alias("asset"), F.lit(k).alias("metric"), v.cast("double").alias("value"))) for a, k, v, kept in rows])
    return m.select("report", "m", F.inline(F.array_compact(all_))).withColumn("source", source).drop("m")


def reports(spark, sf_dir) -> DataFrame:
    """report, day, html: a board of prices, sections with plans, levels and a table, a card, macro fields, news and links."""
    m = months(spark, sf_dir)
    at = lambda *n: F.col("m").isin(*n)
    when = lambda n, text, other="": F.when(at(n), text).otherwise(other)
    join = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    stamp = lambda days: F.concat(F.date_format(F.date_add("day", days), "yyyy-MM-dd"), F.lit(" 00:00"))
    date = lambda days: F.date_format(F.date_add("day", days), "yyyy-MM-dd")
    field = lambda name, value: join(f'<span data-field="{name}">', value, "</span>")
    seen = F.when(at(18), "").when(at(19), "2021-13-45 00:00").when(at(20), stamp(0)).when(at(21), stamp(1)).when(at(22), stamp(-10)).otherwise(stamp(-1))

    def board(asset: str, price: Column) -> Column:
        return join(f'<li data-asset="{asset}" data-field="price">', _usd(price), "</li>")

    def section(asset: str, p: Column, bull: int = -1, bear: int = -1, no_goal: int = -1, base: int = -1, support: int = -1, resistance: int = -1, no_spot: int = -1, attrs="", more="") -> Column:
        factor = lambda n, wrong, right: p * F.when(at(n), wrong).otherwise(right)
        return join(
            f'<section data-asset="{asset}"', attrs, f"><h2>{asset}</h2>", field("spot", F.when(at(no_spot), "n/a").otherwise(_usd(p))),
            '<div data-part="bull">', field("trigger", _usd(p * 1.1)), F.when(at(no_goal), "").otherwise(field("target", _usd(factor(bull, 1.05, 1.2)))), "</div>",
            '<div data-part="bear">', field("trigger", _usd(p * 0.9)), field("target", _usd(factor(bear, 0.95, 0.8))), "</div>",
            '<div data-part="base">', field("low", _usd(factor(base, 1.01, 0.95))), field("high", _usd(p * 1.05)), "</div>",
            '<ol data-part="support"><li data-field="level">', _usd(p * 0.8), '</li><li data-field="level">', _usd(factor(support, 1.02, 0.9)), "</li></ol>",
            '<ol data-part="resistance"><li data-field="level">', _usd(factor(resistance, 0.98, 1.1)), '</li><li data-field="level">', _usd(p * 1.3), "</li></ol>", more, "</section>\n",
        )

    own = join(
        "<table><tr><th>rsi_14</th><td>55.0</td></tr>", F.when(at(29), "").otherwise("<tr><th>macd_hist</th><td>1.25"), "</table>", field("rsi_zone", when(4, "oversold", "neutral")),
        '<p data-field="high_52w" data-day="', date(F.when(at(15), -800).otherwise(-30)), '">', _usd(F.col("btc") * 1.9), '</p><p data-field="low_52w" data-day="', date(-60), '">', _usd(F.col("btc") * 1.5), "</p>",
        field("ath", _usd(F.col("btc") * 2)), field("fall_pct", when(16, "-30.0%", "-25.0%")),
    )
    sha = F.when(at(48), "0badf00d").otherwise(F.sha2(F.col("report").cast("string"), 256))
    card = join('<figure data-metric="mvrv" data-raw="2.1" data-asof="', date(F.when(at(50), -2).otherwise(-1)), '" data-unit="', when(49, "USD", "ratio"), '" data-sha="', sha, '"><b>2.10</b></figure>')
    chain = join('<section data-asset="CHAIN" data-seen="', F.when(at(23), stamp(-20)).otherwise(stamp(-2)), '">', F.when(at(51), "").otherwise(card), "</section>")
    macro = join('<section data-asset="MACRO">', field("cpi_yoy", when(31, "12.0%", "3.1%")), field("nfp", when(32, "+900 K", "+150 K")), field("yield_10y", "4.20%"), field("usd_index", when(36, "Ratio", "Weighted")), when(33, '<p data-field="note">None</p>'), "</section>")
    html = join(
        "<article", F.when(at(17), "").otherwise(join(' data-made="', date(0), ' 12:00"')), "><h1>Report ", F.date_format("day", "d MMM yyyy"), "</h1><ul>", F.when(at(6), "").otherwise(board("BTC", F.col("btc"))), when(46, join("", board("BTC", F.col("btc")))), board("SPY", F.col("spy")), board("GOLD", F.col("gold")),
        board("SILVER", F.col("btc") / 9), board("OIL", F.col("spy") / 7), when(47, '<li data-asset="TIN" data-field="price">$5.00</li>'), "</ul>\n",
        section("BTC", F.col("btc"), bull=9, bear=10, support=13, resistance=14, attrs=join(' data-seen="', seen, '"'), more=own), section("SPY", F.col("spy"), no_goal=11, no_spot=8), F.when(at(7), "").otherwise(section("GOLD", F.col("gold"), base=12)),
        chain, macro, '<aside><time class="quiet news" datetime="', date(F.when(at(5), 3).otherwise(-1)), '">then<br></time><a href="', when(45, "http://", "https://example.com/a"), '">x</a><p>',
        when(1, "{usd(1)}"), when(2, "5%%"), when(3, "$$ 5"), "</p></aside></article>",
    )
    return m.select("report", "day", html.alias("html"))


@register(f"""WITH p AS (SELECT report, report % 60 AS m, btc, spy, gold FROM ({_MONTHS}) WHERE btc IS NOT NULL AND spy IS NOT NULL AND gold IS NOT NULL)
SELECT report, 'board' AS kind, 'BTC' AS asset, 'price' AS metric, round(btc, 2) AS shown FROM p WHERE m <> 6 UNION ALL SELECT report, 'board', 'BTC', 'price', round(btc, 2) FROM p WHERE m = 46 UNION ALL SELECT report, 'board', 'SPY', 'price', round(spy, 2) FROM p
UNION ALL SELECT report, 'board', 'GOLD', 'price', round(gold, 2) FROM p UNION ALL SELECT report, 'board', 'TIN', 'price', 5 FROM p WHERE m = 47 UNION ALL SELECT report, 'board', 'SILVER', 'price', round(btc / 9, 2) FROM p UNION ALL SELECT report, 'board', 'OIL', 'price', round(spy / 7, 2) FROM p
UNION ALL SELECT report, 'row', 'BTC', 'rsi_14', 55 FROM p UNION ALL SELECT report, 'row', 'BTC', 'macd_hist', 1.25 FROM p WHERE m <> 29 UNION ALL SELECT report, 'card', 'CHAIN', 'mvrv', 2.1 FROM p WHERE m <> 51""")
def d5_displayed_values(spark, sf_dir):
    return dm.displayed_values(reports(spark, sf_dir)).where("kind != 'seen'").select("report", "kind", "asset", "metric", F.round("shown", 2).alias("shown"))


_D6 = [(6, "BTC", "price", "not shown"), (24, "BTC", "price", "not archived"), (25, "SPY", "price", "differs"), (26, "GOLD", "close_ts", "no closed bar"), (27, "SILVER", "close_ts", "bar of the day or later"), (28, "BTC", "rsi_14", "differs"), (29, "BTC", "macd_hist", "not shown"),
       (18, "BTC", "close_ts", "not shown"), (19, "BTC", "close_ts", "not shown"), (20, "BTC", "close_ts", "differs"), (21, "BTC", "close_ts", "differs"), (22, "BTC", "close_ts", "differs"), (42, "BTC", "rsi_14", "not archived"), (42, "BTC", "macd_hist", "not archived"), (42, "BTC", "close_ts", "not archived"), (42, "CHAIN", "mvrv", "not archived"),
       (34, "CHAIN", "mvrv", "differs"), (46, "BTC", "price", "duplicated"), (47, "TIN", "price", "unexpected"), (48, "CHAIN", "mvrv", "malformed card"), (49, "CHAIN", "mvrv", "wrong unit"), (50, "CHAIN", "mvrv", "wrong day"), (51, "CHAIN", "mvrv", "not shown"),
       *[(42, a, "close_ts", "no closed bar") for a in ("BTC", "SPY", "GOLD", "SILVER", "OIL")]]


@register(_expected(_D6, "asset, metric, issue"))
def d6_displayed_vs_archived(spark, sf_dir):
    return dm.compare_with_archive(reports(spark, sf_dir), archived(spark, sf_dir))


_D7 = [(1, None, "template"), (2, None, "doubled unit"), (3, None, "doubled currency"), (4, "BTC", "RSI label"), (5, None, "future news"), (6, None, "no price"), (7, "GOLD", "no section"), (8, "SPY", "no spot"), (9, "BTC", "bull scenario"), (10, "BTC", "bear scenario"),
       (11, "SPY", "bull without target"), (12, "GOLD", "base range"), (13, "BTC", "supports side"), (14, "BTC", "resistances side"), (15, "BTC", "high_52w: outside"), (16, "BTC", "fall from top"), (19, "BTC", "high_52w: bad cut"), (19, "BTC", "low_52w: bad cut")]


@register(_expected(_D7, "asset, issue"))
def d7_document_defects(spark, sf_dir):
    return dm.content_issues(reports(spark, sf_dir))


_D8 = [(17, "no time of generation"), (18, "btc: no observation"), (19, "btc: bad time"), (20, "btc: open day"), (21, "btc: open day"), (21, "btc: future"), (22, "btc: stale"), (23, "chain: stale")]


@register(_expected(_D8, "issue"))
def d8_freshness_attributes(spark, sf_dir):
    return dm.freshness_issues(reports(spark, sf_dir))


_D9 = [(30, "cpi differs", "critical"), (31, "cpi range", "warning"), (32, "nfp level", "critical"), (33, "missing number", "warning"), (34, "mvrv differs", "warning"), (35, "yield differs", "warning"), (36, "index as ratio", "warning"), (37, "price differs", "warning"),
       (38, "top below year", "critical"), (39, "cpi unknown", "warning"), (40, "nfp unknown", "warning"), (41, "cpi age", "warning"), (42, "cpi unknown", "warning"), (42, "nfp unknown", "warning")]


@register(_expected(_D9, "issue, severity") + " UNION ALL SELECT report, 'price range', 'warning' FROM m WHERE floor(round(btc, 2)) < 1000 OR floor(round(btc, 2)) > 500000")
def d9_content_range_checks(spark, sf_dir):
    m = months(spark, sf_dir)
    at = lambda n: F.col("m") == n
    prices = m.select("report", (F.col("btc") * F.when(at(37), 1.05).otherwise(1)).alias("price"), (F.col("btc") * F.when(at(38), 0.9).otherwise(1.2)).alias("ath"), F.col("btc").alias("high_52w"), F.date_sub("day", F.when(at(41), 121).otherwise(40)).alias("cpi_day"))
    return dm.gate_issues(reports(spark, sf_dir), archived(spark, sf_dir), prices)


_D10 = [(24, "few metrics", "warning"), (26, "few metrics", "warning"), (39, "few metrics", "warning"), (40, "few metrics", "warning"), (42, "too few metrics", "critical"), (43, "no source", "warning"), (44, "unverified macro", "warning"), (45, "empty link", "critical")]


@register(_expected(_D10, "issue, severity"))
def d10_traceability(spark, sf_dir):
    macro = months(spark, sf_dir).select("report", F.when(F.col("m") == 44, "PENDING").otherwise("VERIFIED").alias("status"))
    return dm.traceability_issues(reports(spark, sf_dir), archived(spark, sf_dir), macro, few=10, enough=16)


@register("""WITH b AS (SELECT symbol, day, high, low, close, avg(close) OVER (PARTITION BY symbol ORDER BY day ROWS 199 PRECEDING) AS s, count(*) OVER (PARTITION BY symbol ORDER BY day ROWS 199 PRECEDING) AS k, max(high) OVER (PARTITION BY symbol ORDER BY day) AS ath,
  max(high) OVER (PARTITION BY symbol ORDER BY day ROWS 363 PRECEDING) AS h, min(low) OVER (PARTITION BY symbol ORDER BY day ROWS 363 PRECEDING) AS l, row_number() OVER (PARTITION BY symbol ORDER BY day) AS n FROM bars_daily),
o AS (SELECT symbol || '/' || n AS bar, n % 60 / 10.0 AS cpi, n % 40 * 50 - 100 AS nfp, 70 + n % 90 AS usd, n % 3 AS ev, n % 5 AS oil, CASE WHEN n % 7 > 0 THEN close END AS share, close AS price, CASE WHEN k = 200 THEN s END AS sma, low AS sup, CASE WHEN n % 11 > 0 THEN high END AS res, n % 4 AS un, n % 6 AS bad, CASE WHEN n % 13 > 0 THEN 90 + n % 10 END AS gate, ath, h, l FROM b)
SELECT bar, 'cpi' AS "check", CASE WHEN cpi > 2.5 AND cpi < 5 THEN 'PASS' WHEN cpi > 5 THEN 'CHECK' ELSE 'FAIL' END AS outcome FROM o
UNION ALL SELECT bar, 'nfp', CASE WHEN abs(nfp) < 1500 AND nfp <> 0 THEN 'PASS' ELSE 'FAIL' END FROM o UNION ALL SELECT bar, 'usd', CASE WHEN usd > 80 AND usd < 150 THEN 'PASS' ELSE 'FAIL' END FROM o
UNION ALL SELECT bar, 'events', CASE WHEN ev = 0 THEN 'PASS' ELSE 'FAIL' END FROM o UNION ALL SELECT bar, 'oil', CASE WHEN oil > 0 THEN 'PASS' ELSE 'FAIL' END FROM o
UNION ALL SELECT bar, 'share', CASE WHEN share IS NOT NULL THEN 'PASS' ELSE 'CHECK' END FROM o UNION ALL SELECT bar, 'sma200', CASE WHEN sma IS NOT NULL THEN 'PASS' ELSE 'FAIL' END FROM o
UNION ALL SELECT bar, 'levels', CASE WHEN sup < price AND price < res THEN 'PASS' ELSE 'CHECK' END FROM o UNION ALL SELECT bar, 'units', CASE WHEN un = 0 THEN 'PASS' ELSE 'FAIL' END FROM o
UNION ALL SELECT bar, 'news', CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END FROM o UNION ALL SELECT bar, 'gate', CASE WHEN gate IS NULL THEN 'CHECK' WHEN gate >= 95 THEN 'PASS' ELSE 'FAIL' END FROM o
UNION ALL SELECT bar, 'extremes', CASE WHEN h > l AND ath > h THEN 'PASS' ELSE 'FAIL' END FROM o""")
def a27_incident_checks(spark, sf_dir):
    """A row of facts for each bar; what the bars do not tell goes by the bar's number."""
    from pyspark.sql import Window

    from marketlens.operators.indicators import full

    w = Window.partitionBy("symbol").orderBy("day")
    n, last, year = F.row_number().over(w), w.rowsBetween(-199, 0), w.rowsBetween(-363, 0)
    b = view(spark, sf_dir, "bars_daily").withColumn("n", n).withColumn("sma200", full(F.col("close"), 200, last, F.avg))
    b = b.withColumn("ath", F.max("high").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("high_52w", F.max("high").over(year)).withColumn("low_52w", F.min("low").over(year))
    k = F.col("n")
    facts = b.select(
        F.concat_ws("/", "symbol", "n").alias("bar"), (k % 60 / 10).alias("cpi"), (k % 40 * 50 - 100).alias("nfp"), (70 + k % 90).alias("usd"), (k % 3).alias("future_events"), (k % 5).alias("oil_rows"),
        F.when(k % 7 > 0, F.col("close")).alias("share_price"), F.col("close").alias("price"), "sma200", F.col("low").alias("support"), F.when(k % 11 > 0, F.col("high")).alias("resistance"),
        (k % 4).alias("units_missing"), (k % 6).alias("bad_titles"), F.when(k % 13 > 0, 90 + k % 10).alias("gate_score"), "ath", "high_52w", "low_52w",
    )
    return dm.incident_checks(facts, "bar")


@register("""WITH x AS (SELECT id, CASE id % 4 WHEN 0 THEN 'mvrv' WHEN 1 THEN 'asopr' WHEN 2 THEN 'nupl' ELSE 'price' END AS metric, CASE WHEN id % 9 = 0 THEN NULL ELSE id % 5 / 2.0::DOUBLE - CASE WHEN id % 4 = 2 THEN 1 ELSE 0 END END AS value, created FROM claims),
k(metric, center, above, below, same) AS (VALUES ('mvrv', 1, 'cap above realized', 'cap below realized', 'cap as realized'), ('asopr', 1, 'spent above cost', 'spent below cost', 'spent at cost'), ('nupl', 0, 'unrealized profit', 'unrealized loss', 'balanced'))
SELECT id, x.metric, value, CASE WHEN value > center THEN above WHEN value < center THEN below ELSE same END AS reading, CASE WHEN id % 3 = 0 THEN created::VARCHAR END AS as_of, 'method of ' || x.metric AS method FROM x JOIN k ON k.metric = x.metric WHERE value IS NOT NULL""")
def d4_snapshot_facts(spark, sf_dir):
    c = view(spark, sf_dir, "claims")
    metric = F.get(F.array(*[F.lit(m) for m in ("mvrv", "asopr", "nupl", "price")]), (F.col("id") % 4).cast("int"))
    value = F.when(F.col("id") % 9 != 0, F.col("id") % 5 / 2 - F.when(F.col("id") % 4 == 2, 1).otherwise(0))
    day = F.col("created").cast("string")
    snapshot = c.select("id", metric.alias("metric"), value.alias("value"), F.when(F.col("id") % 3 == 0, day).otherwise(F.concat(day, F.lit("T00"))).alias("as_of"))
    corpus = table(spark, sf_dir, "labels").select(F.get(F.array(*[F.lit(m) for m in ("mvrv", "asopr", "nupl", "price")]), (F.col("doc_id") % 4).cast("int")).alias("metric")).distinct()
    corpus = corpus.select("metric", F.concat(F.lit("method of "), "metric").alias("method"), F.lit("no signal").alias("caveat"), F.lit("https://example.com").alias("url"))
    return dm.snapshot_facts(snapshot, corpus).select("id", "metric", "value", "reading", "as_of", "method")
