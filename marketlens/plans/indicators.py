"""Indicator queries over the daily bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.operators import indicators as ind
from marketlens.plans.registry import register
from marketlens.sources.tables import view

R = lambda c, n=4: F.round(F.col(c), n).alias(c)


def bars(spark, sf_dir):
    return view(spark, sf_dir, "bars_daily")


@register("""
SELECT symbol, day, close, round(sma20, 4) AS sma20, round(pct, 4) AS pct FROM (
  SELECT symbol, day, close, CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w END AS sma20,
         (close - lag(close) OVER o) * 100 / lag(close) OVER o AS pct, row_number() OVER (PARTITION BY symbol ORDER BY day DESC) AS rn
  FROM bars_daily WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS 19 PRECEDING), o AS (PARTITION BY symbol ORDER BY day)
) WHERE rn = 1""")
def flagship_latest_bar(spark, sf_dir):
    b = ind.pct_change(ind.sma(ind.placed(bars(spark, sf_dir)), 20))
    return ind.latest(b).select("symbol", "day", "close", R("sma20"), R("pct"))


@register("""SELECT symbol, day, round(CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w END, 4) AS sma20
FROM bars_daily WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS 19 PRECEDING)""")
def w1_sma(spark, sf_dir):
    return ind.sma(bars(spark, sf_dir), 20).select("symbol", "day", R("sma20"))


_EMA = """WITH RECURSIVE b AS (SELECT symbol, day, close, row_number() OVER (PARTITION BY symbol ORDER BY day) AS rn FROM bars_daily),
e AS (SELECT symbol, 12::BIGINT AS rn, avg(close) AS y FROM b WHERE rn <= 12 GROUP BY symbol HAVING count(*) = 12
  UNION ALL SELECT e.symbol, b.rn, e.y * (11.0::DOUBLE / 13) + b.close * (2.0::DOUBLE / 13) FROM e JOIN b ON b.symbol = e.symbol AND b.rn = e.rn + 1)
SELECT b.symbol, b.day, round(e.y, 4) AS ema12 FROM b LEFT JOIN e ON e.symbol = b.symbol AND e.rn = b.rn"""


@register(_EMA)
def w2_ema(spark, sf_dir):
    return ind.ema(bars(spark, sf_dir), 12).select("symbol", "day", R("ema12"))


_RSI = """WITH RECURSIVE d AS (
  SELECT symbol, day, close - lag(close) OVER (PARTITION BY symbol ORDER BY day) AS d, row_number() OVER (PARTITION BY symbol ORDER BY day) - 1 AS i FROM bars_daily
), e AS (
  SELECT symbol, 14::BIGINT AS i, avg(greatest(d, 0)) AS g, avg(greatest(-d, 0)) AS l FROM d WHERE i BETWEEN 1 AND 14 GROUP BY symbol HAVING count(*) = 14
  UNION ALL SELECT e.symbol, d.i, (e.g * 13 + greatest(d.d, 0)) / 14, (e.l * 13 + greatest(-d.d, 0)) / 14 FROM e JOIN d ON d.symbol = e.symbol AND d.i = e.i + 1
)"""

#: Bars of three series lack a close, have NaN or are infinite for eleven days, 300 days before the end.
_BROKEN_RSI = """WITH RECURSIVE t AS (SELECT max(day) AS t FROM bars_daily),
p AS (SELECT symbol, day, high, low, CASE WHEN NOT day BETWEEN t - 300 AND t - 290 THEN close WHEN symbol = '2-HIGH' THEN NULL WHEN symbol = '3-MEDIUM' THEN 'nan'::DOUBLE WHEN symbol = '5-LOW' THEN 'inf'::DOUBLE ELSE close END AS close FROM bars_daily, t),
fb AS (SELECT symbol, min(day) AS fb FROM p WHERE close IS NULL OR NOT isfinite(close) GROUP BY 1),
d AS (SELECT p.symbol, day, close - lag(close) OVER (PARTITION BY p.symbol ORDER BY day) AS d, row_number() OVER (PARTITION BY p.symbol ORDER BY day) - 1 AS i FROM p LEFT JOIN fb ON fb.symbol = p.symbol WHERE fb IS NULL OR day < fb),
e AS (
  SELECT symbol, 14::BIGINT AS i, avg(greatest(d, 0)) AS g, avg(greatest(-d, 0)) AS l FROM d WHERE i BETWEEN 1 AND 14 GROUP BY symbol HAVING count(*) = 14
  UNION ALL SELECT e.symbol, d.i, (e.g * 13 + greatest(d.d, 0)) / 14, (e.l * 13 + greatest(-d.d, 0)) / 14 FROM e JOIN d ON d.symbol = e.symbol AND d.i = e.i + 1
),
r AS (SELECT p.symbol, p.day, p.high, p.low, p.close, CASE WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END AS rsi FROM p LEFT JOIN d ON d.symbol = p.symbol AND d.day = p.day LEFT JOIN e ON e.symbol = d.symbol AND e.i = d.i)"""


def broken_bars(spark, sf_dir):
    b = bars(spark, sf_dir)
    b = b.crossJoin(F.broadcast(b.agg(F.max("day").alias("_t"))))  # one row
    out = F.col("day").between(F.date_sub("_t", 300), F.date_sub("_t", 290))
    bad = F.when(F.col("symbol") == "3-MEDIUM", float("nan")).when(F.col("symbol") == "5-LOW", float("inf")).when(F.col("symbol") != "2-HIGH", F.col("close"))
    return b.withColumn("close", F.when(out, bad).otherwise(F.col("close"))).drop("_t")


@register(_BROKEN_RSI + " SELECT symbol, day, round(rsi, 4) AS rsi14 FROM r")
def w26_rsi_trace(spark, sf_dir):
    return ind.rsi(broken_bars(spark, sf_dir), 14).select("symbol", "day", R("rsi14"))


@register(_BROKEN_RSI + " SELECT symbol, round(rsi, 4) AS rsi14 FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY day DESC) AS k FROM r) WHERE k = 1")
def w3_rsi_latest(spark, sf_dir):
    return ind.latest(ind.rsi(broken_bars(spark, sf_dir), 14).select("symbol", "day", "rsi14")).select("symbol", R("rsi14"))


@register("""WITH RECURSIVE b AS (SELECT symbol, day, close, row_number() OVER (PARTITION BY symbol ORDER BY day) AS rn FROM bars_daily),
f AS (SELECT symbol, 12::BIGINT AS rn, avg(close) AS y FROM b WHERE rn <= 12 GROUP BY symbol
  UNION ALL SELECT f.symbol, b.rn, f.y * (11.0::DOUBLE / 13) + b.close * (2.0::DOUBLE / 13) FROM f JOIN b ON b.symbol = f.symbol AND b.rn = f.rn + 1),
s AS (SELECT symbol, 26::BIGINT AS rn, avg(close) AS y FROM b WHERE rn <= 26 GROUP BY symbol
  UNION ALL SELECT s.symbol, b.rn, s.y * (25.0::DOUBLE / 27) + b.close * (2.0::DOUBLE / 27) FROM s JOIN b ON b.symbol = s.symbol AND b.rn = s.rn + 1),
l AS (SELECT f.symbol, f.rn, f.y - s.y AS macd FROM f JOIN s ON s.symbol = f.symbol AND s.rn = f.rn),
m AS (SELECT * FROM l WHERE rn > 26),
g AS (SELECT symbol, 35::BIGINT AS rn, avg(macd) AS y FROM m WHERE rn <= 35 GROUP BY symbol HAVING count(*) = 9
  UNION ALL SELECT g.symbol, m.rn, g.y * 0.8 + m.macd * 0.2 FROM g JOIN m ON m.symbol = g.symbol AND m.rn = g.rn + 1)
SELECT b.symbol, b.day, round(macd, 3) AS macd, round(g.y, 3) AS macd_signal, round(macd - g.y, 3) AS macd_hist
FROM b LEFT JOIN m ON m.symbol = b.symbol AND m.rn = b.rn LEFT JOIN g ON g.symbol = b.symbol AND g.rn = b.rn""")
def w4_macd(spark, sf_dir):
    return ind.macd(bars(spark, sf_dir)).select("symbol", "day", R("macd", 3), R("macd_signal", 3), R("macd_hist", 3))


@register("""WITH r AS (
  SELECT symbol, day, CASE WHEN count(*) OVER w = 14 AND max(high) OVER w > min(low) OVER w
    THEN (close - min(low) OVER w) / (max(high) OVER w - min(low) OVER w) * 100 END AS raw
  FROM bars_daily WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS 13 PRECEDING)
), n AS (SELECT *, count(raw) OVER (PARTITION BY symbol ORDER BY day) AS k FROM r),
v AS (SELECT symbol, k, CASE WHEN count(*) OVER w = 3 THEN avg(raw) OVER w END AS pct_k FROM n WHERE raw IS NOT NULL WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS 2 PRECEDING))
SELECT n.symbol, n.day, round(pct_k, 4) AS pct_k, round(pct_k, 4) AS pct_d FROM n LEFT JOIN v ON v.symbol = n.symbol AND v.k = n.k""")
def w5_stochastic(spark, sf_dir):
    return ind.stochastic(bars(spark, sf_dir)).select("symbol", "day", R("pct_k"), R("pct_d"))


@register("""SELECT symbol, day, round(CASE WHEN count(*) OVER w = 14 AND max(high) OVER w > min(low) OVER w
  THEN (close - max(high) OVER w) / (max(high) OVER w - min(low) OVER w) * 100 END, 4) AS williams_r
FROM bars_daily WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS 13 PRECEDING)""")
def w6_williams_r(spark, sf_dir):
    return ind.williams_r(bars(spark, sf_dir)).select("symbol", "day", R("williams_r"))


@register("""WITH t AS (SELECT symbol, day, (high + low + close) / 3 AS tp FROM bars_daily),
w AS (SELECT symbol, day, tp, avg(tp) OVER w AS m, list(tp) OVER w AS l FROM t WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS 19 PRECEDING)),
d AS (SELECT *, list_sum(list_transform(l, lambda x: abs(x - m))) / 20 AS dev FROM w)
SELECT symbol, day, round(CASE WHEN len(l) = 20 AND dev > 0 THEN (tp - m) / (0.015 * dev) END, 4) AS cci FROM d""")
def w7_cci(spark, sf_dir):
    return ind.cci(bars(spark, sf_dir)).select("symbol", "day", R("cci"))


@register("""WITH t AS (SELECT symbol, day, high, low, lag(close) OVER (PARTITION BY symbol ORDER BY day) AS p FROM bars_daily),
r AS (SELECT symbol, day, CASE WHEN p IS NOT NULL THEN greatest(high - low, abs(high - p), abs(low - p)) END AS tr FROM t)
SELECT symbol, day, round(CASE WHEN count(tr) OVER w = 14 THEN avg(tr) OVER w END, 4) AS atr_sma FROM r WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS 13 PRECEDING)""")
def w8_atr(spark, sf_dir):
    return ind.atr_sma(bars(spark, sf_dir)).select("symbol", "day", R("atr_sma"))


_PIVOT = """p AS (SELECT symbol, close, high, low, count(*) OVER w AS n, min(close) OVER w AS lo, max(close) OVER w AS hi
  FROM bars_daily WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)),
levels AS (SELECT DISTINCT symbol, 'support' AS kind, close AS level FROM p WHERE n = 21 AND high IS NOT NULL AND low IS NOT NULL AND lo >= close - 0.001
  UNION SELECT DISTINCT symbol, 'resistance', close FROM p WHERE n = 21 AND high IS NOT NULL AND low IS NOT NULL AND hi <= close + 0.001)"""


@register(f"WITH {_PIVOT} SELECT symbol, kind, level FROM levels")
def w9_pivots(spark, sf_dir):
    return ind.pivots(bars(spark, sf_dir), 10)


@register(f"""WITH {_PIVOT}, last AS (SELECT symbol, max_by(close, day) AS price FROM bars_daily GROUP BY symbol),
r AS (SELECT symbol, kind, level, price, row_number() OVER (PARTITION BY symbol, kind ORDER BY abs(level - price), level) AS rank
  FROM levels JOIN last USING (symbol) WHERE (kind = 'support' AND level < price) OR (kind = 'resistance' AND level > price))
SELECT * FROM r""")
def w10_price_levels(spark, sf_dir):
    b = bars(spark, sf_dir)
    return ind.price_levels(ind.pivots(b, 10), ind.latest(b).select("symbol", F.col("close").alias("price")))


@register("""SELECT symbol, day, round((close - lag(close) OVER o) * 100 / lag(close) OVER o, 4) AS pct FROM bars_daily WINDOW o AS (PARTITION BY symbol ORDER BY day)""")
def w11_pct_change(spark, sf_dir):
    return ind.pct_change(bars(spark, sf_dir)).select("symbol", "day", R("pct"))


@register("""WITH s AS (SELECT symbol, day, close, CASE WHEN count(*) OVER a = 20 THEN avg(close) OVER a END AS sma20, CASE WHEN count(*) OVER b = 50 THEN avg(close) OVER b END AS sma50,
  row_number() OVER (PARTITION BY symbol ORDER BY day DESC) AS rn FROM bars_daily
  WINDOW a AS (PARTITION BY symbol ORDER BY day ROWS 19 PRECEDING), b AS (PARTITION BY symbol ORDER BY day ROWS 49 PRECEDING))
SELECT symbol, day, close, round(sma20, 4) AS sma20, round(sma50, 4) AS sma50 FROM s WHERE rn <= 90""")
def w25_overlays(spark, sf_dir):
    from marketlens.operators.relational import newest_n

    b = ind.sma(ind.sma(ind.placed(bars(spark, sf_dir)), 20), 50)
    return newest_n(b, ["symbol"], "day", 90).select("symbol", "day", "close", R("sma20"), R("sma50"))


@register("""SELECT symbol, day, round(CASE WHEN count(*) OVER w = 20 THEN avg(volume) OVER w END, 4) AS avg_volume20 FROM bars_daily WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS 19 PRECEDING)""")
def w27_avg_volume(spark, sf_dir):
    return ind.sma(bars(spark, sf_dir), 20, "volume", "avg_volume20").select("symbol", "day", R("avg_volume20"))


@register(_BROKEN_RSI + """, t2 AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY day) AS prev FROM r),
a AS (SELECT symbol, day, rsi, CASE WHEN count(*) OVER s = 20 THEN avg(close) OVER s END AS sma20,
  CASE WHEN count(prev) OVER w = 14 THEN avg(CASE WHEN prev IS NOT NULL THEN greatest(high - low, abs(high - prev), abs(low - prev)) END) OVER w END AS atr
  FROM t2 WINDOW s AS (PARTITION BY symbol ORDER BY day ROWS 19 PRECEDING), w AS (PARTITION BY symbol ORDER BY day ROWS 13 PRECEDING)),
x AS (SELECT * FROM a WHERE rsi IS NOT NULL)
SELECT symbol, day, 'sma20' AS metric, round(sma20, 4) AS value FROM x WHERE sma20 IS NOT NULL
UNION ALL SELECT symbol, day, 'rsi14', round(rsi, 4) FROM x UNION ALL SELECT symbol, day, 'atr_sma', round(atr, 4) FROM x WHERE atr IS NOT NULL""")
def w29_indicator_backfill(spark, sf_dir):
    b = ind.placed(broken_bars(spark, sf_dir))
    b = ind.rsi(ind.atr_sma(ind.sma(b, 20)), 14).where("rsi14 is not null")
    long = b.unpivot(["symbol", "day"], ["sma20", "rsi14", "atr_sma"], "metric", "value")
    return long.where("value is not null").select("symbol", "day", "metric", R("value"))


_EXT = """WITH m AS (SELECT max(day) AS d FROM bars_daily),
a AS (SELECT symbol, max(close) AS ath, max_by(close, day) AS last FROM bars_daily GROUP BY symbol),
y AS (SELECT symbol, max(close) AS hi, min(close) AS lo FROM bars_daily, m WHERE day >= d - 364 GROUP BY symbol),
x AS (SELECT a.symbol, ath, last, hi, lo FROM a LEFT JOIN y ON y.symbol = a.symbol)
SELECT x.symbol, ath, (SELECT max(day) FROM bars_daily b WHERE b.symbol = x.symbol AND b.close = ath) AS ath_day, hi AS high_52w,
  (SELECT max(day) FROM bars_daily b, m WHERE b.symbol = x.symbol AND b.close = hi AND day >= d - 364) AS high_day, lo AS low_52w,
  (SELECT max(day) FROM bars_daily b, m WHERE b.symbol = x.symbol AND b.close = lo AND day >= d - 364) AS low_day,
  round((last / ath - 1) * 100, 4) AS drawdown_pct, round((lo / ath - 1) * 100, 4) AS ath_to_low_pct FROM x"""


def _extremes(spark, sf_dir):
    b = bars(spark, sf_dir)
    b = b.crossJoin(F.broadcast(b.agg(F.max("day").alias("_last"))))  # one row
    return ind.extremes(b, F.col("day") >= F.date_sub("_last", 364))


@register(_EXT)
def a7_extremes(spark, sf_dir):
    return _extremes(spark, sf_dir)


@register(f"SELECT symbol, drawdown_pct, ath_to_low_pct FROM ({_EXT})".replace("(WITH", "(WITH"))
def a8_drawdown(spark, sf_dir):
    return _extremes(spark, sf_dir).select("symbol", "drawdown_pct", "ath_to_low_pct")


@register("""WITH s AS (SELECT symbol, day, close, CASE WHEN count(*) OVER a = 20 THEN avg(close) OVER a END AS s1, CASE WHEN count(*) OVER b = 50 THEN avg(close) OVER b END AS s2,
  CASE WHEN count(*) OVER c = 100 THEN avg(close) OVER c END AS s3, CASE WHEN count(*) OVER d = 200 THEN avg(close) OVER d END AS s4 FROM bars_daily
  WINDOW a AS (PARTITION BY symbol ORDER BY day ROWS 19 PRECEDING), b AS (PARTITION BY symbol ORDER BY day ROWS 49 PRECEDING), c AS (PARTITION BY symbol ORDER BY day ROWS 99 PRECEDING), d AS (PARTITION BY symbol ORDER BY day ROWS 199 PRECEDING))
SELECT symbol, day, (coalesce((close > s1)::INT, 0) + coalesce((close > s2)::INT, 0) + coalesce((close > s3)::INT, 0) + coalesce((close > s4)::INT, 0))::BIGINT AS above,
  (coalesce((close < s1)::INT, 0) + coalesce((close < s2)::INT, 0) + coalesce((close < s3)::INT, 0) + coalesce((close < s4)::INT, 0))::BIGINT AS below FROM s""")
def a25_ma_votes(spark, sf_dir):
    return ind.ma_votes(bars(spark, sf_dir)).select("symbol", "day", "above", "below")


@register("""WITH m AS (SELECT max(day) AS d FROM bars_daily) SELECT symbol, day, open, high, low, close FROM bars_daily, m
WHERE day <= d - 1 AND open > 0 AND high > 0 AND low > 0 AND close > 0""")
def p4_closed_bars(spark, sf_dir):
    from marketlens.functions.scalars import closed_valid_bars

    b = bars(spark, sf_dir)
    return closed_valid_bars(b.crossJoin(F.broadcast(b.agg(F.max("day").alias("today")))), "today").select("symbol", "day", "open", "high", "low", "close")


@register("""SELECT symbol, bool_and(volume >= 0 AND low > 0 AND low <= open AND open <= high AND low <= close AND close <= high) AS valid, count(*) AS n FROM bars_daily GROUP BY symbol""")
def p5_ohlcv_valid(spark, sf_dir):
    from marketlens.functions.scalars import ohlcv_valid

    return bars(spark, sf_dir).groupBy("symbol").agg(F.bool_and(ohlcv_valid()).alias("valid"), F.count("*").alias("n"))


_ARCHIVE = _RSI + """, b AS (SELECT symbol, day, close, row_number() OVER (PARTITION BY symbol ORDER BY day) AS rn FROM bars_daily),
mean(name, n) AS (VALUES ('ema_20', 20), ('ema_50', 50), ('f', 12), ('s', 26)),
em AS (SELECT symbol, name, n, n::BIGINT AS rn, avg(close) AS y FROM b, mean WHERE rn <= n GROUP BY symbol, name, n HAVING count(*) = n
  UNION ALL SELECT em.symbol, name, n, b.rn, em.y * (1 - 2.0::DOUBLE / (n + 1)) + b.close * (2.0::DOUBLE / (n + 1)) FROM em JOIN b ON b.symbol = em.symbol AND b.rn = em.rn + 1),
ln AS (SELECT x.symbol, x.rn, x.y - z.y AS v FROM em x JOIN em z ON z.symbol = x.symbol AND z.rn = x.rn AND x.name = 'f' AND z.name = 's' WHERE x.rn > 26),
sg AS (SELECT symbol, 35::BIGINT AS rn, avg(v) AS y FROM ln WHERE rn <= 35 GROUP BY symbol HAVING count(*) = 9 UNION ALL SELECT sg.symbol, ln.rn, sg.y * 0.8 + ln.v * 0.2 FROM sg JOIN ln ON ln.symbol = sg.symbol AND ln.rn = sg.rn + 1),
t AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY day) AS p, (high + low + close) / 3 AS tp, row_number() OVER (PARTITION BY symbol ORDER BY day) AS rn, count(*) OVER (PARTITION BY symbol) AS total FROM bars_daily),
raw AS (SELECT symbol, day, CASE WHEN count(*) OVER w = 14 AND max(high) OVER w > min(low) OVER w THEN (close - min(low) OVER w) / (max(high) OVER w - min(low) OVER w) * 100 END AS r FROM t WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS 13 PRECEDING)),
st AS (SELECT symbol, max_by(k, day) AS v FROM (SELECT symbol, day, CASE WHEN count(*) OVER w = 3 THEN avg(r) OVER w END AS k FROM raw WHERE r IS NOT NULL WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS 2 PRECEDING)) GROUP BY 1),
w AS (SELECT symbol, day, rn, total, close, p, CASE WHEN count(*) OVER a = 20 THEN avg(close) OVER a END AS s20, CASE WHEN count(*) OVER c = 50 THEN avg(close) OVER c END AS s50, CASE WHEN count(*) OVER f = 100 THEN avg(close) OVER f END AS s100, CASE WHEN count(*) OVER g = 200 THEN avg(close) OVER g END AS s200,
  CASE WHEN count(p) OVER h = 14 THEN avg(CASE WHEN p IS NOT NULL THEN greatest(high - low, abs(high - p), abs(low - p)) END) OVER h END AS atr, CASE WHEN count(*) OVER h = 14 AND max(high) OVER h > min(low) OVER h THEN (close - max(high) OVER h) / (max(high) OVER h - min(low) OVER h) * 100 END AS wr,
  tp, avg(tp) OVER a AS m, list(tp) OVER a AS l FROM t WINDOW a AS (PARTITION BY symbol ORDER BY day ROWS 19 PRECEDING), c AS (PARTITION BY symbol ORDER BY day ROWS 49 PRECEDING), f AS (PARTITION BY symbol ORDER BY day ROWS 99 PRECEDING), g AS (PARTITION BY symbol ORDER BY day ROWS 199 PRECEDING), h AS (PARTITION BY symbol ORDER BY day ROWS 13 PRECEDING)),
z AS (SELECT *, list_sum(list_transform(l, lambda x: abs(x - m))) / 20 AS dev FROM w WHERE rn = total),
p AS (SELECT symbol, close, high, low, count(*) OVER w AS n, min(close) OVER w AS lo, max(close) OVER w AS hi FROM bars_daily WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING)),
lv AS (SELECT DISTINCT symbol, 'sup_' AS kind, close AS level FROM p WHERE n = 41 AND lo >= close - 0.001 UNION SELECT DISTINCT symbol, 'res_', close FROM p WHERE n = 41 AND hi <= close + 0.001),
lr AS (SELECT symbol, kind || row_number() OVER (PARTITION BY symbol, kind ORDER BY level DESC) AS metric, level AS value, row_number() OVER (PARTITION BY symbol, kind ORDER BY level DESC) AS k FROM lv),
ex AS (SELECT b.symbol, max(close) AS ath, max(CASE WHEN day >= x.top - 364 THEN close END) AS hi, min(CASE WHEN day >= x.top - 364 THEN close END) AS lo, max_by(close, day) AS last FROM bars_daily b JOIN (SELECT symbol, max(day) AS top FROM bars_daily GROUP BY 1) x ON x.symbol = b.symbol GROUP BY b.symbol),
v AS (SELECT symbol, 'price' AS metric, close AS value FROM z UNION ALL SELECT symbol, 'close_ts', epoch(day) FROM z UNION ALL SELECT symbol, 'chg_24h', (close - p) * 100 / p FROM z UNION ALL SELECT symbol, 'atr_14', atr FROM z UNION ALL SELECT symbol, 'williams_r', wr FROM z
  UNION ALL SELECT symbol, 'cci_20', CASE WHEN len(l) = 20 AND dev > 0 THEN (tp - m) / (0.015 * dev) END FROM z UNION ALL SELECT symbol, 'sma_20', s20 FROM z UNION ALL SELECT symbol, 'sma_50', s50 FROM z UNION ALL SELECT symbol, 'sma_100', s100 FROM z UNION ALL SELECT symbol, 'sma_200', s200 FROM z
  UNION ALL SELECT em.symbol, name, y FROM em JOIN z ON z.symbol = em.symbol AND z.rn = em.rn WHERE name LIKE 'ema%' UNION ALL SELECT sg.symbol, 'macd_hist', ln.v - sg.y FROM sg JOIN ln ON ln.symbol = sg.symbol AND ln.rn = sg.rn JOIN z ON z.symbol = sg.symbol AND z.rn = sg.rn
  UNION ALL SELECT e.symbol, 'rsi_14', CASE WHEN e.l = 0 THEN 100 ELSE 100 - 100 / (1 + e.g / e.l) END FROM e JOIN z ON z.symbol = e.symbol AND e.i = z.rn - 1 UNION ALL SELECT symbol, 'stoch_k', v FROM st UNION ALL SELECT symbol, metric, value FROM lr WHERE k <= 2
  UNION ALL SELECT symbol, 'ath', ath FROM ex UNION ALL SELECT symbol, 'high_52w', hi FROM ex UNION ALL SELECT symbol, 'low_52w', lo FROM ex UNION ALL SELECT symbol, 'from_ath', round((last / ath - 1) * 100, 4) FROM ex)
SELECT v.symbol, z.day AS report_date, metric, round(value, 3) AS value, CASE WHEN metric = 'close_ts' THEN 'unix_s' WHEN metric IN ('chg_24h', 'from_ath') THEN '%' WHEN metric IN ('rsi_14', 'stoch_k', 'williams_r', 'cci_20') THEN 'ratio' ELSE 'USD' END AS unit,
  CASE WHEN metric LIKE 'sup%' OR metric LIKE 'res%' THEN 'computed' ELSE 'bars' END AS source FROM v JOIN z ON z.symbol = v.symbol WHERE value IS NOT NULL"""


#: Macro and on-chain rows: series, asset, metric, kind, scale, unit, source.
_OBSERVED = [
    ("1-URGENT", "MACRO", "cpi_yoy", "yoy", 1.0, "%", "macro"), ("2-HIGH", "MACRO", "nfp", "change", 0.001, "K", "macro"), ("2-HIGH", "MACRO", "nfp_level", "level", 0.001, "K", "macro"), ("3-MEDIUM", "MACRO", "yield_10y", "level", 1.0, "%", "macro"),
    ("4-NOT SPECIFIED", "BTC", "mvrv", "level", 1.0, "ratio", "onchain"), ("5-LOW", "BTC", "realized_cap", "level", 1e-6, "USD_T", "onchain"), ("none such", "BTC", "nupl", "level", 1.0, "ratio", "onchain"),
]


@register(_ARCHIVE + f""" UNION ALL SELECT asset, obs_date, metric, round(CASE kind WHEN 'level' THEN v WHEN 'change' THEN v - v1 ELSE v / v12 * 100 - 100 END * scale, 3), unit, source
FROM (SELECT series_id, max(obs_date) AS obs_date, arg_max(value, obs_date) AS v FROM macro_monthly GROUP BY 1) l JOIN (VALUES {", ".join(map(str, _OBSERVED))}) c(series, asset, metric, kind, scale, unit, source) ON series = series_id
LEFT JOIN (SELECT series_id AS s1, obs_date + INTERVAL 1 MONTH AS d1, value AS v1 FROM macro_monthly) ON s1 = series_id AND d1 = obs_date LEFT JOIN (SELECT series_id AS s12, obs_date + INTERVAL 12 MONTH AS d12, value AS v12 FROM macro_monthly) ON s12 = series_id AND d12 = obs_date
WHERE kind = 'level' OR (kind = 'change' AND v1 IS NOT NULL) OR (kind = 'yoy' AND v12 IS NOT NULL)""")
def k9_metric_archive(spark, sf_dir):
    own = ind.metric_archive(bars(spark, sf_dir)).select("symbol", "report_date", "metric", "value", "unit", "source")
    catalog = spark.createDataFrame(_OBSERVED, "series string, asset string, metric string, kind string, scale double, unit string, source string")
    more = ind.observed_metrics(view(spark, sf_dir, "macro_monthly"), catalog, "series_id", "obs_date", "value")
    return own.unionByName(more.withColumnRenamed("asset", "symbol")).select("symbol", "report_date", "metric", R("value", 3), "unit", "source")
