"""Upsert, revision, as-of, reconciliation, lineage and quality queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import scalars as sc
from marketlens.operators import reconcile as rec
from marketlens.operators.store import dealt
from marketlens.plans.registry import register
from marketlens.sources.tables import table, view

K = ["l_orderkey", "l_linenumber"]
raw = lambda s, d: view(s, d, "raw_values")
stored = lambda s, d: view(s, d, "stored_values")


@register("SELECT * FROM stored_values UNION ALL SELECT l_orderkey, l_linenumber, min(value) FROM raw_values WHERE (l_orderkey, l_linenumber) NOT IN (SELECT l_orderkey, l_linenumber FROM stored_values) GROUP BY 1, 2")
def k1_insert_ignore(spark, sf_dir):
    return rec.insert_ignore(stored(spark, sf_dir), raw(spark, sf_dir), K)


@register("""WITH n AS (SELECT l_orderkey, l_linenumber, value, 1 AS arrival FROM raw_values UNION ALL SELECT l_orderkey, l_linenumber, value - 1, 2 FROM raw_values WHERE l_linenumber = 2)
SELECT l_orderkey, l_linenumber, value FROM stored_values s WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.l_orderkey = s.l_orderkey AND n.l_linenumber = s.l_linenumber)
UNION ALL SELECT l_orderkey, l_linenumber, arg_max(value, arrival * 1000000000 + value) FROM n GROUP BY 1, 2""")
def k2_upsert(spark, sf_dir):
    first = raw(spark, sf_dir).withColumn("arrival", F.lit(1))
    again = first.where("l_linenumber = 2").select(*K, (F.col("value") - 1).alias("value"), F.lit(2).alias("arrival"))
    old = stored(spark, sf_dir).withColumn("arrival", F.lit(0))
    return rec.upsert(old, first.unionByName(again), K, "arrival").drop("arrival")


@register("""SELECT coalesce(s.l_orderkey, r.l_orderkey) AS l_orderkey, coalesce(s.l_linenumber, r.l_linenumber) AS l_linenumber, coalesce(r.value, s.value) AS value
FROM stored_values s FULL OUTER JOIN (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN value END AS value FROM raw_values) r ON r.l_orderkey = s.l_orderkey AND r.l_linenumber = s.l_linenumber""")
def k3_coalesce_merge(spark, sf_dir):
    new = raw(spark, sf_dir).withColumn("value", F.when(F.col("l_linenumber") % 2 == 0, F.col("value")))
    return rec.merge_coalesce(stored(spark, sf_dir), new, K)


@register("SELECT s.l_orderkey, s.l_linenumber, round(s.value, 2) AS old_value, round(r.value, 2) AS new_value FROM stored_values s JOIN raw_values r USING (l_orderkey, l_linenumber) WHERE s.value <> r.value")
def k4_revisions(spark, sf_dir):
    r = rec.revisions(stored(spark, sf_dir), raw(spark, sf_dir), K, ["value"])
    get = lambda c: F.round(F.get_json_object(c, "$.value").cast("double"), 2)
    return r.select(*K, get("old_json").alias("old_value"), get("new_json").alias("new_value"))


@register("""WITH r AS (SELECT l_orderkey, l_linenumber, min(value) AS value, l_orderkey // 8 AS page FROM raw_values GROUP BY 1, 2), s AS (SELECT l_orderkey, l_linenumber, min(value) AS value FROM stored_values GROUP BY 1, 2),
j AS (SELECT r.*, s.value AS old FROM r LEFT JOIN s ON s.l_orderkey = r.l_orderkey AND s.l_linenumber = r.l_linenumber), bad AS (SELECT DISTINCT page FROM j WHERE old <> value)
SELECT l_orderkey, l_linenumber, j.page FROM j LEFT JOIN bad ON bad.page = j.page WHERE old IS NULL AND bad.page IS NULL""")
def k5_append_only(spark, sf_dir):
    """Pages are eight orders; of a key's several values the least is taken on both sides."""
    rows = 2 * raw(spark, sf_dir).count()  # both sides meet in a task and are dealt alike
    least = lambda df: dealt(df, *K, rows=rows).groupBy(*K).agg(F.min("value").alias("value")).withColumn("digest", F.sha2(F.col("value").cast("string"), 256))
    page = least(raw(spark, sf_dir)).withColumn("page", F.expr("l_orderkey div 8"))
    rows = rec.append_only(least(stored(spark, sf_dir)), page, K, "digest")
    return rec.accept_pages(rows, "page").select(*K, "page")


@register("WITH m AS (SELECT max(day) AS today FROM bars_daily) SELECT symbol, day, close FROM bars_daily, m WHERE day < today")
def k6_purge_open_day(spark, sf_dir):
    b = view(spark, sf_dir, "bars_daily")
    return b.crossJoin(F.broadcast(b.agg(F.max("day").alias("today")))).where("day < today").select("symbol", "day", "close")


@register("""WITH o AS (SELECT asset, status, count(*) AS top FROM claims WHERE created < DATE '1998-01-01' GROUP BY 1, 2)
SELECT c.id, c.asset, c.status, coalesce(top, 0) + row_number() OVER (PARTITION BY c.asset, c.status ORDER BY c.id) AS version FROM claims c LEFT JOIN o ON o.asset = c.asset AND o.status = c.status WHERE c.created >= DATE '1998-01-01'""")
def k7_versions(spark, sf_dir):
    c = view(spark, sf_dir, "claims")
    old = c.where("created < date'1998-01-01'")
    old = rec.next_versions(old.withColumn("version", F.lit(0)).limit(0), old, ["asset", "status"], "id")
    return rec.next_versions(old, c.where("created >= date'1998-01-01'").select("id", "asset", "status"), ["asset", "status"], "id")


@register("""WITH g AS (SELECT asset, status, count(*) AS n, sum(points::DECIMAL(18,2)) AS points FROM claims GROUP BY 1, 2), t AS (SELECT asset, count(*) AS n, max(created) AS latest FROM claims GROUP BY 1)
SELECT t.asset, '{"n":' || t.n || ',"latest":"' || t.latest || '","by_status":[' || (SELECT string_agg('{"status":"' || status || '","n":' || n || ',"points":' || points || '}', ',' ORDER BY status) FROM g WHERE g.asset = t.asset) || ']}' AS document FROM t""")
def k8_dashboard_export(spark, sf_dir):
    """A nested document for each asset: its totals and those of each status."""
    c = view(spark, sf_dir, "claims")
    g = c.groupBy("asset", "status").agg(F.count("*").alias("n"), F.sum(F.col("points").cast("decimal(18,2)")).alias("points"), F.max("created").alias("latest"))
    d = g.groupBy("asset").agg(F.sum("n").alias("n"), F.max("latest").alias("latest"), F.array_sort(F.collect_list(F.struct("status", "n", "points"))).alias("by_status"))  # a few statuses
    return d.select("asset", F.to_json(F.struct("n", "latest", "by_status")).alias("document"))


@register("SELECT series_id, observed_date, arg_max(value, realtime_start) AS value, max(realtime_start) AS realtime_start FROM vintages WHERE realtime_start <= DATE '1996-01-01' GROUP BY 1, 2")
def j11_as_of(spark, sf_dir):
    return rec.as_of(view(spark, sf_dir, "vintages"), ["series_id", "observed_date"], "realtime_start", "value", F.lit("1996-01-01").cast("date"))


@register("""WITH v AS (SELECT series_id, realtime_start, max(value) AS value FROM vintages GROUP BY 1, 2), p AS (SELECT DISTINCT series_id, start_day AS probe_day FROM receipts)
SELECT p.series_id, probe_day, (SELECT arg_max(value, realtime_start) FROM v WHERE v.series_id = p.series_id AND v.realtime_start <= p.probe_day) AS value FROM p""")
def j11_as_of_many(spark, sf_dir):
    v = view(spark, sf_dir, "vintages").groupBy("series_id", "realtime_start").agg(F.max("value").alias("value"))
    p = view(spark, sf_dir, "receipts").select("series_id", F.col("start_day").alias("probe_day")).distinct()
    return rec.as_of_probes(v, p, ["series_id"], "realtime_start", "probe_day", "value")


@register("""SELECT symbol, day, close FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY day DESC) AS k FROM bars_daily WHERE day <= DATE '1995-06-15' AND DATE '1995-06-15' - day <= 10 AND volume > 1) WHERE k = 1""")
def j12_as_of_max_age(spark, sf_dir):
    b = rec.as_of_max_age(view(spark, sf_dir, "bars_daily"), ["symbol"], "day", F.lit("1995-06-15").cast("date"), 10, F.col("volume") > 1)
    return b.select("symbol", "day", "close")


_EVID = """b AS (SELECT l_orderkey AS k, l_shipdate::DATE AS captured, CASE WHEN l_orderkey % 11 = 0 AND l_linenumber % 2 = 0 THEN 'btc' ELSE 'usd' END AS unit, l_linenumber AS n, CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE 1 END AS p FROM lineitem)"""


@register(f"""WITH {_EVID}, r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p, captured DESC, n) AS r FROM b), u AS (SELECT k, count(DISTINCT unit) AS u FROM b GROUP BY k)
SELECT r.k, CASE WHEN u > 1 THEN 'BLOCKED' ELSE 'OK' END AS state, CASE p WHEN 0 THEN 'newer' ELSE 'legacy' END AS origin FROM r JOIN u ON u.k = r.k WHERE r = 1""")
def j13_evidence_merge(spark, sf_dir):
    unit = F.when((F.col("l_orderkey") % 11 == 0) & (F.col("l_linenumber") % 2 == 0), "btc").otherwise("usd")
    b = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.to_date("l_shipdate").alias("captured"), unit.alias("unit"), F.col("l_linenumber").alias("n"))
    return rec.merge_evidence(b.where("n % 3 = 0"), b.where("n % 3 != 0"), ["k"], "captured", "unit").select("k", "state", "origin")


#: Payload rows with a unit, a quote (of every other line) and an endpoint; the store has them wrong for some orders.
_TWO = """r AS (SELECT l_orderkey, l_linenumber, value, 'btc' AS unit, CASE WHEN l_linenumber % 2 = 0 THEN value * 3 END AS quote, '/v5/open-interest' AS endpoint FROM raw_values),
s AS (SELECT l_orderkey, l_linenumber, value, CASE WHEN l_orderkey % 83 = 0 THEN NULL WHEN l_orderkey % 79 = 0 THEN 'usd' ELSE 'btc' END AS unit, CASE WHEN l_orderkey % 71 = 0 THEN NULL ELSE value * 3 END AS quote, CASE WHEN l_orderkey % 73 = 0 THEN '/v5/funding' ELSE '/v5/open-interest' END AS endpoint FROM stored_values
  UNION ALL SELECT -l_orderkey - 1, l_linenumber, value, 'btc', NULL, '/v5/open-interest' FROM stored_values WHERE l_orderkey % 101 = 0)"""


@register(f"""WITH {_TWO}, j AS (SELECT coalesce(r.l_orderkey, s.l_orderkey) AS l_orderkey, coalesce(r.l_linenumber, s.l_linenumber) AS l_linenumber, r.value AS raw_value, s.value AS stored_value,
  CASE WHEN s.value IS NULL THEN 'MISSING' WHEN r.value IS NULL THEN 'EXTRA' WHEN abs(r.value - s.value) > greatest(1e-12, abs(r.value) * 1e-10) THEN 'VALUE' WHEN r.unit IS DISTINCT FROM s.unit THEN 'UNIT' WHEN r.endpoint IS DISTINCT FROM s.endpoint THEN 'ENDPOINT'
    WHEN r.quote IS NOT NULL AND (s.quote IS NULL OR abs(r.quote - s.quote) > greatest(1e-12, abs(r.quote) * 1e-10)) THEN 'QUOTE' END AS issue
  FROM r FULL OUTER JOIN s ON r.l_orderkey = s.l_orderkey AND r.l_linenumber = s.l_linenumber)
SELECT * FROM j WHERE issue IS NOT NULL""")
def j14_two_way_reconcile(spark, sf_dir):
    k, path = F.col("l_orderkey"), "/v5/open-interest"
    quote = F.col("value") * 3
    a = raw(spark, sf_dir).select(*K, "value", F.lit("btc").alias("unit"), F.when(F.col("l_linenumber") % 2 == 0, quote).alias("quote"), F.lit(path).alias("endpoint"))
    unit = F.when(k % 83 == 0, F.lit(None)).when(k % 79 == 0, "usd").otherwise("btc")
    kept = stored(spark, sf_dir)
    b = kept.select(*K, "value", unit.alias("unit"), F.when(k % 71 != 0, quote).alias("quote"), F.when(k % 73 == 0, "/v5/funding").otherwise(path).alias("endpoint"))
    more = kept.where("l_orderkey % 101 = 0").select((-k - 1).alias("l_orderkey"), "l_linenumber", "value", F.lit("btc").alias("unit"), F.lit(None).cast("double").alias("quote"), F.lit(path).alias("endpoint"))  # rows that no payload has
    return rec.two_way(a, b.unionByName(more), K, "value", same={"unit": "UNIT", "endpoint": "ENDPOINT"}, near={"quote": "QUOTE"})


#: A receipt's payload is eight orders; the store names the next receipt as the owner of some, and has rows of its own.
_RECEIPTS = """d AS (SELECT l_orderkey, l_linenumber, min(value) AS value, l_orderkey // 8 AS receipt FROM raw_values GROUP BY 1, 2),
s AS (SELECT l_orderkey, l_linenumber, min(value) AS value, l_orderkey // 8 + CASE WHEN l_orderkey % 103 = 0 THEN 1 ELSE 0 END AS receipt FROM stored_values GROUP BY 1, 2
  UNION ALL SELECT l_orderkey, l_linenumber + 100, min(value), l_orderkey // 8 FROM stored_values WHERE l_orderkey % 107 = 0 GROUP BY 1, 2)"""


@register(f"""WITH {_RECEIPTS}, a AS (SELECT d.receipt, count(*) AS n, count(*) FILTER (s.value IS DISTINCT FROM d.value) AS missing FROM d LEFT JOIN s ON s.l_orderkey = d.l_orderkey AND s.l_linenumber = d.l_linenumber GROUP BY 1),
b AS (SELECT s.receipt, count(*) FILTER (d.value IS NULL) AS extra, count(*) FILTER (d.receipt IS DISTINCT FROM s.receipt OR d.value IS DISTINCT FROM s.value) AS origin FROM s LEFT JOIN d ON s.l_orderkey = d.l_orderkey AND s.l_linenumber = d.l_linenumber GROUP BY 1)
SELECT coalesce(a.receipt, b.receipt) AS receipt, coalesce(n, 0) AS n, coalesce(missing, 0) AS missing, coalesce(extra, 0) AS extra, coalesce(origin, 0) AS origin FROM a FULL OUTER JOIN b ON a.receipt = b.receipt WHERE coalesce(missing, 0) + coalesce(extra, 0) + coalesce(origin, 0) > 0""")
def j15_receipt_reconstruction(spark, sf_dir):
    rows = 2 * raw(spark, sf_dir).count()  # both sides meet in a task and are dealt alike
    least = lambda df: dealt(df, *K, rows=rows).groupBy(*K).agg(F.min("value").alias("value")).withColumn("digest", F.sha2(F.col("value").cast("string"), 256))
    receipt = F.expr("l_orderkey div 8")
    s = least(stored(spark, sf_dir))
    more = s.where("l_orderkey % 107 = 0").withColumn("l_linenumber", F.col("l_linenumber") + 100).withColumn("receipt", receipt)
    s = s.withColumn("receipt", receipt + F.when(F.col("l_orderkey") % 103 == 0, 1).otherwise(0)).unionByName(more)
    return rec.receipt_reconstruction(least(raw(spark, sf_dir)).withColumn("receipt", receipt), s, K, "receipt", "digest")


@register("""WITH m AS (SELECT l_orderkey, count(*) AS n, round(sum(value), 2) AS s FROM raw_values GROUP BY 1), g AS (SELECT l_orderkey, count(*) AS n, round(sum(value), 2) AS s FROM stored_values GROUP BY 1)
SELECT coalesce(m.l_orderkey, g.l_orderkey) AS l_orderkey, CASE WHEN g.n IS NULL THEN 'NO_REPORT' WHEN m.n IS NULL THEN 'NO_MANIFEST' WHEN m.n <> g.n THEN 'COUNT_DRIFT' WHEN m.s <> g.s THEN 'VALUE_DRIFT' ELSE 'MATCH' END AS state FROM m FULL OUTER JOIN g ON m.l_orderkey = g.l_orderkey""")
def j16_manifest_drift(spark, sf_dir):
    agg = lambda df, p: df.groupBy("l_orderkey").agg(F.count("*").alias(f"{p}n"), F.round(F.sum("value"), 2).alias(f"{p}s"))
    j = agg(raw(spark, sf_dir), "a").join(agg(stored(spark, sf_dir), "b"), "l_orderkey", "full_outer")
    state = F.when(F.col("bn").isNull(), "NO_REPORT").when(F.col("an").isNull(), "NO_MANIFEST").when(F.col("an") != F.col("bn"), "COUNT_DRIFT").when(F.col("as") != F.col("bs"), "VALUE_DRIFT").otherwise("MATCH")
    return j.select("l_orderkey", state.alias("state"))


@register("""SELECT 'prices' AS source, symbol AS series, count(*) AS n, max(day) AS last FROM bars_daily GROUP BY 1, 2 UNION ALL SELECT 'macro', series_id, count(*), max(obs_date) FROM macro_monthly GROUP BY 1, 2
UNION ALL SELECT 'vintage', series_id::VARCHAR, count(*), max(observed_date) FROM vintages GROUP BY 1, 2""")
def j19_multi_source(spark, sf_dir):
    shape = lambda df, name, s, d: df.select(F.lit(name).alias("source"), F.col(s).cast("string").alias("series"), F.col(d).alias("_d"))
    a = shape(view(spark, sf_dir, "bars_daily"), "prices", "symbol", "day")
    a = a.unionByName(shape(view(spark, sf_dir, "macro_monthly"), "macro", "series_id", "obs_date")).unionByName(shape(view(spark, sf_dir, "vintages"), "vintage", "series_id", "observed_date"))
    return a.groupBy("source", "series").agg(F.count("*").alias("n"), F.max("_d").alias("last"))


@register("SELECT count(*) FILTER (abs(r.value - s.value) <= greatest(1e-12, abs(r.value) * 1e-10)) AS equal, count(*) AS n FROM raw_values r JOIN stored_values s USING (l_orderkey, l_linenumber)")
def p16_tolerance(spark, sf_dir):
    j = raw(spark, sf_dir).join(stored(spark, sf_dir).withColumnRenamed("value", "b"), K)
    return j.agg(F.count_if(sc.close_to(F.col("value"), F.col("b"))).alias("equal"), F.count("*").alias("n"))


@register("""WITH x AS (SELECT id, CASE asset WHEN '1-URGENT' THEN 'open_interest' WHEN '2-HIGH' THEN 'funding_rate' ELSE 'other' END AS metric, CASE status WHEN 'achieved' THEN 'usd' ELSE 'fraction' END AS unit, points / 1e6 - 0.1 AS v FROM claims)
SELECT id, CASE WHEN metric = 'other' THEN 'metric' WHEN NOT ((metric = 'open_interest' AND unit = 'usd') OR (metric = 'funding_rate' AND unit = 'fraction')) THEN 'unit' WHEN NOT (CASE WHEN metric = 'open_interest' THEN v >= 0 ELSE abs(v) <= 0.2 END) THEN 'range' ELSE 'ok' END AS verdict FROM x""")
def p10_derivative_rules(spark, sf_dir):
    metric = F.when(F.col("asset") == "1-URGENT", "open_interest").when(F.col("asset") == "2-HIGH", "funding_rate").otherwise("other")
    x = view(spark, sf_dir, "claims").select("id", metric.alias("metric"), F.when(F.col("status") == "achieved", "usd").otherwise("fraction").alias("unit"), (F.col("points") / 1e6 - 0.1).alias("v"))
    return x.select("id", sc.first_failing(sc.derivative_rules(F.col("metric"), F.col("unit"), F.col("v")), "ok").alias("verdict"))


@register("""SELECT event_id, CASE WHEN p NOT IN ('date', 'time') THEN 'precision' WHEN (p = 'time') <> (t IS NOT NULL) THEN 'timestamp' WHEN t IS NOT NULL AND t::DATE <> ts::DATE THEN 'day' ELSE 'ok' END AS verdict
FROM (SELECT event_id, ts, CASE event_id % 3 WHEN 0 THEN 'date' WHEN 1 THEN 'time' ELSE 'later' END AS p, CASE WHEN event_id % 4 = 1 THEN ts WHEN event_id % 12 = 7 THEN ts + INTERVAL 1 DAY END AS t FROM events)""")
def p11_event_rules(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    p = F.when(F.col("event_id") % 3 == 0, "date").when(F.col("event_id") % 3 == 1, "time").otherwise("later")
    t = F.when(F.col("event_id") % 4 == 1, F.col("ts")).when(F.col("event_id") % 12 == 7, F.col("ts") + F.expr("interval 1 day"))
    return e.select("event_id", sc.first_failing(sc.event_rules(p, F.to_date("ts"), t, F.col("event_type")), "ok").alias("verdict"))


#: Each rule is broken by some series, the first one that fails is told.
_P12 = """x AS (SELECT series_id, start_day, CASE WHEN series_id % 20 = 1 THEN 'done' WHEN status = 'ok' THEN 'success' ELSE 'failed' END AS status, CASE WHEN series_id % 20 = 2 THEN 2 ELSE 1 END AS attempts,
  CASE WHEN (status = 'ok') <> (series_id % 20 = 3) THEN md5(series_id::VARCHAR) END AS sha, CASE WHEN series_id % 20 = 4 THEN 1001 ELSE points END AS returned_rows, CASE WHEN status <> 'ok' AND series_id % 20 <> 5 THEN 0 ELSE points END AS persisted_rows,
  CASE series_id % 20 WHEN 6 THEN 'sideways' WHEN 7 THEN 'forward' ELSE 'backward' END AS direction, CASE series_id % 20 WHEN 8 THEN 'v5/oi' WHEN 9 THEN '/v5/oi?key=1' ELSE '/v5/oi' END AS path FROM receipts)"""


@register(f"""WITH {_P12} SELECT series_id, start_day, CASE WHEN status NOT IN ('success', 'empty', 'failed') THEN 'status' WHEN attempts NOT BETWEEN 0 AND 1 THEN 'attempts' WHEN returned_rows NOT BETWEEN 0 AND 1000 OR persisted_rows NOT BETWEEN 0 AND 1000 THEN 'rows'
  WHEN direction NOT IN ('backward', 'forward') THEN 'direction' WHEN NOT starts_with(path, '/') OR strpos(path, '?') > 0 THEN 'path' WHEN status <> 'failed' AND (attempts <> 1 OR sha IS NULL) THEN 'evidence' WHEN status = 'failed' AND (sha IS NOT NULL OR persisted_rows > 0) THEN 'failure' ELSE 'ok' END AS verdict FROM x""")
def p12_lineage_rules(spark, sf_dir):
    k = F.col("series_id") % 20
    good = F.col("status") == "ok"
    x = view(spark, sf_dir, "receipts").select(
        "series_id", "start_day", F.when(k == 1, "done").when(good, "success").otherwise("failed").alias("status"), F.when(k == 2, 2).otherwise(1).alias("attempts"),
        F.when(good != (k == 3), F.md5(F.col("series_id").cast("string"))).alias("sha"), F.when(k == 4, 1001).otherwise(F.col("points")).alias("returned_rows"), F.when(~good & (k != 5), 0).otherwise(F.col("points")).alias("persisted_rows"),
        F.when(k == 6, "sideways").when(k == 7, "forward").otherwise("backward").alias("direction"), F.when(k == 8, "v5/oi").when(k == 9, "/v5/oi?key=1").otherwise("/v5/oi").alias("path"),
    )
    return x.select("series_id", "start_day", sc.first_failing(sc.request_rules(), "ok").alias("verdict"))


#: Which metrics, frequencies and units the contracts of the providers allow.
_CONTRACTS = [("urgent", "achieved", "5m", "btc"), ("urgent", "missed", "event", "fraction"), ("high", "achieved", "d1", "usd"), ("high", "partial", "d1", "usd"), ("high", "partial", "d1", "btc"), ("low", "missed", "monthly", "fraction"), ("low", "missed", "event", "usd")]
_P13 = """x AS (SELECT id, lower(split_part(asset, '-', 2)) AS provider, status AS metric, CASE id % 4 WHEN 0 THEN 'd1' WHEN 1 THEN '5m' WHEN 2 THEN 'event' ELSE 'monthly' END AS frequency, CASE id % 3 WHEN 0 THEN 'btc' WHEN 1 THEN 'fraction' ELSE 'usd' END AS unit FROM claims)"""


@register(f"""WITH {_P13}, c(provider, metric, frequency, unit) AS (VALUES {", ".join(map(str, _CONTRACTS))})
SELECT id, provider, metric, frequency, unit, CASE WHEN provider NOT IN (SELECT provider FROM c) THEN 'provider' WHEN (provider, metric) NOT IN (SELECT (provider, metric) FROM c) THEN 'metric'
  WHEN (provider, metric, frequency) NOT IN (SELECT (provider, metric, frequency) FROM c) THEN 'frequency' ELSE 'unit' END AS issue FROM x WHERE (provider, metric, frequency, unit) NOT IN (SELECT (provider, metric, frequency, unit) FROM c)""")
def p13_series_contract(spark, sf_dir):
    pick = lambda *names: F.get(F.array(*[F.lit(n) for n in names]), (F.col("id") % len(names)).cast("int"))
    x = view(spark, sf_dir, "claims").select("id", F.lower(F.split_part("asset", F.lit("-"), F.lit(2))).alias("provider"), F.col("status").alias("metric"), pick("d1", "5m", "event", "monthly").alias("frequency"), pick("btc", "fraction", "usd").alias("unit"))
    allowed = spark.createDataFrame(_CONTRACTS, "provider string, metric string, frequency string, unit string")
    return rec.contract_issues(x, allowed, ["provider", "metric", "frequency", "unit"])


#: An order is a page, of daily rows or of 5-minute ones by its number, from its lines' numbers; some are moved.
_P14 = """x AS (SELECT l_orderkey AS page, CASE WHEN l_orderkey % 2 = 0 THEN 'd1' ELSE '5m' END AS frequency, CASE WHEN l_orderkey % 2 = 0 THEN 86400 ELSE 300 END AS step, l_orderkey % 1000 * 86400 AS begin, l_linenumber AS k FROM lineitem),
y AS (SELECT page, frequency, step, begin, k, begin + (k - 1) * step + CASE WHEN page % 11 = 0 AND k = 2 THEN 7 ELSE 0 END AS t FROM x),
b AS (SELECT page, begin + max(k) * any_value(step) - CASE WHEN page % 17 = 0 THEN 100 ELSE 0 END - CASE WHEN page % 19 = 0 THEN any_value(step) ELSE 0 END AS stop FROM x GROUP BY page, begin)"""


@register(f"""WITH {_P14}, r AS (SELECT y.*, stop, t - lag(t) OVER (PARTITION BY y.page ORDER BY t) AS d, first_value(t) OVER (PARTITION BY y.page ORDER BY t) AS lo, last_value(t) OVER (PARTITION BY y.page ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS hi FROM y JOIN b ON b.page = y.page)
SELECT DISTINCT page, unnest(list_filter([CASE WHEN t < begin OR t >= stop THEN 'outside' END, CASE WHEN d = 0 THEN 'twice' END, CASE WHEN frequency = 'd1' AND t % 86400 <> 0 THEN 'not midnight' END, CASE WHEN frequency = '5m' AND t % 300 <> 0 THEN 'not aligned' END,
  CASE WHEN frequency = '5m' AND lo <> begin THEN 'begins late' END, CASE WHEN frequency = '5m' AND ((stop - begin) % 300 <> 0 OR hi <> stop - 300) THEN 'ends early' END, CASE WHEN frequency = '5m' AND d > 0 AND d <> 300 THEN 'gap' END], lambda i: i IS NOT NULL)) AS issue FROM r""")
def p14_page_bounds(spark, sf_dir):
    page, k = F.col("page"), F.col("l_linenumber")
    x = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), "l_linenumber")
    step = F.when(page % 2 == 0, 86400).otherwise(300)
    begin = page % 1000 * 86400
    rows = x.select("page", (begin + (k - 1) * step + F.when((page % 11 == 0) & (k == 2), 7).otherwise(0)).alias("t"))
    pages = x.groupBy("page").agg(F.max("l_linenumber").alias("m"))
    stop = begin + F.col("m") * step - F.when(page % 17 == 0, 100).otherwise(0) - F.when(page % 19 == 0, step).otherwise(0)
    pages = pages.select("page", F.when(page % 2 == 0, "d1").otherwise("5m").alias("frequency"), begin.alias("begin"), stop.alias("stop"))
    return rec.page_issues(rows, pages, "page", "t")


@register("SELECT page, count(*) AS n FROM (SELECT l_orderkey AS page, count(*) OVER (PARTITION BY l_orderkey) AS c FROM lineitem) WHERE c >= 6 GROUP BY page")
def p15_saturated_pages(spark, sf_dir):
    n = F.count("*").over(Window.partitionBy("page"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page")).withColumn("c", n)
    return rows.where("c >= 6").groupBy("page").agg(F.count("*").alias("n"))


_ISSUES = """i AS (SELECT doc_id % 50 AS report, CASE doc_id % 5 WHEN 0 THEN 'numeric' WHEN 1 THEN 'content' WHEN 2 THEN 'traceability' WHEN 3 THEN 'news' ELSE 'format' END AS category, CASE WHEN toxic = 1 THEN 'critical' ELSE 'warning' END AS severity FROM labels WHERE quality = 0)"""


def _issues(spark, sf_dir):
    cats = F.array(*[F.lit(c) for c in ("numeric", "content", "traceability", "news", "format")])
    la = table(spark, sf_dir, "labels").where("quality = 0")
    return la.select((F.col("doc_id") % 50).alias("report"), F.get(cats, (F.col("doc_id") % 5).cast("int")).alias("category"), F.when(F.col("toxic") == 1, "critical").otherwise("warning").alias("severity"))


@register(f"""WITH {_ISSUES}, g AS (SELECT report, count(*) FILTER (category = 'numeric' AND severity = 'warning') AS a, count(*) FILTER (category = 'content' AND severity = 'warning') AS b, count(*) FILTER (category = 'traceability' AND severity = 'warning') AS c,
  count(*) FILTER (category = 'news' AND severity = 'warning') AS d, count(*) FILTER (category = 'format' AND severity = 'warning') AS e, count(*) FILTER (severity = 'critical') AS critical FROM i GROUP BY 1),
r AS (SELECT DISTINCT doc_id % 50 AS report FROM documents), j AS (SELECT r.report, coalesce(a, 0) AS a, coalesce(b, 0) AS b, coalesce(c, 0) AS c, coalesce(d, 0) AS d, coalesce(e, 0) AS e, coalesce(critical, 0) AS critical FROM r LEFT JOIN g ON g.report = r.report),
s AS (SELECT report, critical, round(greatest(100 - 5 * a, 0) * 0.35::DOUBLE + greatest(100 - 5 * b, 0) * 0.25::DOUBLE + greatest(100 - 5 * c, 0) * 0.2::DOUBLE + greatest(100 - 5 * d, 0) * 0.15::DOUBLE + greatest(100 - 5 * e, 0) * 0.05::DOUBLE, 4) AS score FROM j)
SELECT report, score, critical, score >= 95 AND critical = 0 AS passed FROM s""")
def a22_quality_score(spark, sf_dir):
    return rec.quality_score(_issues(spark, sf_dir), table(spark, sf_dir, "documents").select((F.col("doc_id") % 50).alias("report")))


@register("""WITH a AS (SELECT symbol, bool_and(low > 0) AS valid FROM bars_daily GROUP BY 1), q AS (SELECT unnest(['1-URGENT', '2-HIGH', 'ABSENT']) AS symbol)
SELECT (SELECT bool_and(valid) FROM a) AND count(*) FILTER (symbol NOT IN (SELECT symbol FROM a)) = 0 AS passed, count(*) FILTER (symbol NOT IN (SELECT symbol FROM a)) AS missing FROM q""")
def a23_evidence_gate(spark, sf_dir):
    audits = view(spark, sf_dir, "bars_daily").groupBy("symbol").agg(F.bool_and(F.col("low") > 0).alias("valid"))
    required = spark.createDataFrame([("1-URGENT",), ("2-HIGH",), ("ABSENT",)], "symbol string")
    return rec.evidence_gate(audits, required, "symbol")


@register("""WITH r AS (SELECT l_orderkey AS run, l_linenumber - 1 AS o, CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'ok' END AS st FROM lineitem),
g AS (SELECT run, count(*) AS n, max(o) AS m, count(DISTINCT o) AS d, min(CASE WHEN st <> 'ok' THEN o END) AS bad, max(CASE WHEN st = 'ok' THEN o END) AS good FROM r GROUP BY 1)
SELECT run, n, m + 1 = n AND d = n AS contiguous, bad IS NULL OR good IS NULL OR good < bad AS prefix_ok, CASE WHEN bad IS NULL THEN 'ok' WHEN good IS NULL THEN 'failed' ELSE 'partial' END AS derived_status FROM g""")
def a24_run_lineage(spark, sf_dir):
    r = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run"), (F.col("l_linenumber") - 1).alias("o"), F.when(F.col("l_returnflag") == "R", "error").otherwise("ok").alias("st"))
    return rec.lineage_audit(r, "run", "o", "st")


@register("""WITH b AS (SELECT s_suppkey AS series_id, 60 + s_suppkey % 40 AS budget FROM supplier), u AS (SELECT series_id, count(*) AS used FROM receipts GROUP BY 1)
SELECT b.series_id, budget, coalesce(used, 0) AS used, greatest(budget - coalesce(used, 0), 0)::BIGINT AS "left", coalesce(used, 0) > budget AS exceeded FROM b LEFT JOIN u ON u.series_id = b.series_id""")
def a26_budget(spark, sf_dir):
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("series_id"), (60 + F.col("s_suppkey") % 40).alias("budget"))
    return rec.budget_use(view(spark, sf_dir, "receipts"), b, ["series_id"])


@register("SELECT asset AS source, count(*) AS n FROM (SELECT o_orderpriority AS asset, l_orderkey FROM stored_values s JOIN raw_values r USING (l_orderkey, l_linenumber) JOIN orders ON o_orderkey = l_orderkey WHERE s.value <> r.value) GROUP BY 1")
def a17_revision_counts(spark, sf_dir):
    r = rec.revisions(stored(spark, sf_dir), raw(spark, sf_dir), K, ["value"])
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("source"))
    return r.join(o, "l_orderkey").groupBy("source").agg(F.count("*").alias("n"))


@register("""SELECT o_orderkey, sha256('[{"key":"day","value":"' || o_orderdate::DATE || '"},{"key":"order","value":"' || o_orderkey || '"}]') AS digest, true AS redacted FROM orders""")
def l2_request_digest_audit(spark, sf_dir):
    params = F.create_map(F.lit("order"), F.col("o_orderkey").cast("string"), F.lit("api_key"), F.lit("secret-value"), F.lit("day"), F.to_date("o_orderdate").cast("string"))
    clean = F.map_filter(params, lambda k, v: ~k.rlike("(?i)key|token|secret"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", sc.request_identity(clean).alias("digest"), sc.redact(F.to_json(params)).alias("logged"))
    return o.select("o_orderkey", "digest", (~F.col("logged").contains("secret-value")).alias("redacted"))


@register("""SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN 'limit' WHEN o_orderkey % 19 = 0 THEN 'path' ELSE 'ok' END AS verdict FROM orders""")
def l3_expected_request(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("t", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")))
    want = sc.expected_request(F.lit("api.example.com"), F.lit("/v1/bars"), F.col("o_orderpriority"), F.col("t"), F.col("t") + 86400, 500)
    path = F.when(F.col("o_orderkey") % 19 == 0, "/v2/bars").otherwise("/v1/bars")
    got = F.regexp_replace(sc.expected_request(F.lit("api.example.com"), path, F.col("o_orderpriority"), F.col("t"), F.col("t") + 86400, 500), "500$", F.when(F.col("o_orderkey") % 17 == 0, "100").otherwise("500"))
    same = lambda p: F.regexp_extract(want, p, 1).eqNullSafe(F.regexp_extract(got, p, 1))
    return o.select("o_orderkey", sc.first_failing([("limit", same(r"limit=(\d+)")), ("path", same(r"com(/[^?]*)"))], "ok").alias("verdict"))


@register("""SELECT 'missing' AS kind, count(*) AS n FROM raw_values WHERE (l_orderkey, l_linenumber) NOT IN (SELECT l_orderkey, l_linenumber FROM stored_values)
UNION ALL SELECT 'row hash', count(*) FROM raw_values r JOIN stored_values s USING (l_orderkey, l_linenumber) WHERE r.value <> s.value
UNION ALL SELECT 'broken link', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 71 <> 0)
UNION ALL SELECT 'raw hash', count(*) FROM orders WHERE o_orderkey % 101 = 0
UNION ALL SELECT 'cursor', count(*) FROM (SELECT l_suppkey FROM lineitem GROUP BY 1) WHERE l_suppkey % 7 = 0
UNION ALL SELECT 'coverage', count(*) FROM receipts WHERE series_id % 13 = 0""")
def l4_integrity_summary(spark, sf_dir):
    """Counts of what is broken in a store: payload and row digests, links, cursors, told against counted rows."""
    issues = rec.two_way(raw(spark, sf_dir), stored(spark, sf_dir), K, "value")
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    kept = o.where("o_orderkey % 71 != 0")  # receipts that the store has lost
    links = li.join(kept, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    body = F.concat_ws("|", "o_orderkey", "o_totalprice")
    told = F.sha2(F.when(F.col("o_orderkey") % 101 == 0, F.concat(body, F.lit("x"))).otherwise(body), 256)
    bad_raw = o.where(told != F.sha2(body, 256))
    newest = li.groupBy("l_suppkey").agg(F.max("l_shipdate").alias("newest"))
    cursors = newest.withColumn("cursor", F.when(F.col("l_suppkey") % 7 == 0, F.date_add("newest", 1)).otherwise(F.to_date("newest")))
    receipts = view(spark, sf_dir, "receipts").withColumn("told", F.col("points") + F.when(F.col("series_id") % 13 == 0, 1).otherwise(0))
    counted = li.groupBy(F.col("l_suppkey").alias("series_id"), F.to_date(F.date_trunc("month", "l_shipdate")).alias("start_day")).agg(F.count("*").alias("counted"))
    coverage = receipts.join(counted, ["series_id", "start_day"], "left").where(~F.col("told").eqNullSafe(F.col("counted")))
    parts = [("missing", issues.where("issue = 'MISSING'")), ("row hash", issues.where("issue = 'VALUE'")), ("broken link", links), ("raw hash", bad_raw), ("cursor", cursors.where(F.to_date("newest") != F.col("cursor"))), ("coverage", coverage)]
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n") for kind, df in parts]
    return reduce(DataFrame.unionByName, counts)


@register("""SELECT count(*) FILTER (s_suppkey NOT IN (SELECT series_id FROM receipts)) AS streams_missing, count(*) FILTER (s_suppkey NOT IN (SELECT series_id FROM vintages)) AS cursors_missing, count(*) AS expected FROM supplier""")
def l5_acceptance(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("series_id"))
    seen = lambda v, n: view(spark, sf_dir, v).select("series_id").distinct().withColumn(n, F.lit(True))
    j = s.join(seen("receipts", "_r"), "series_id", "left").join(seen("vintages", "_v"), "series_id", "left")
    return j.agg(F.count_if(F.col("_r").isNull()).alias("streams_missing"), F.count_if(F.col("_v").isNull()).alias("cursors_missing"), F.count("*").alias("expected"))


@register("""WITH e AS (SELECT s_suppkey AS series_id FROM supplier UNION ALL SELECT -s_suppkey - 1 FROM supplier WHERE s_suppkey % 3 = 0), r AS (SELECT series_id, count(*) AS runs, arg_max(status, start_day) AS latest_status, max(end_day) AS latest FROM receipts GROUP BY 1)
SELECT e.series_id, coalesce(runs, 0) AS runs, coalesce(latest_status, 'MISSING') AS latest_status, latest FROM e LEFT JOIN r ON r.series_id = e.series_id""")
def l6_operational_evidence(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("series_id"))
    expected = s.union(s.where("series_id % 3 = 0").select(-F.col("series_id") - 1))  # some that never ran
    return rec.operational_evidence(view(spark, sf_dir, "receipts"), expected, "series_id", "start_day", "end_day")


@register("SELECT s.l_orderkey, s.l_linenumber, s.value AS old_value, r.value AS new_value FROM stored_values s JOIN raw_values r USING (l_orderkey, l_linenumber) WHERE s.value IS DISTINCT FROM r.value")
def l7_revision_capture(spark, sf_dir):
    j = stored(spark, sf_dir).withColumnRenamed("value", "old_value").join(raw(spark, sf_dir).withColumnRenamed("value", "new_value"), K)
    return j.where(~F.col("old_value").eqNullSafe(F.col("new_value")))


@register("""WITH m AS (SELECT max(obs_date) AS top FROM macro_monthly), n AS (SELECT series_id, obs_date, CASE WHEN month(obs_date) % 2 = 0 THEN value + 1 ELSE value END AS value FROM macro_monthly, m WHERE obs_date > top - 60),
o AS (SELECT * FROM macro_monthly, m WHERE obs_date < top)
SELECT n.series_id, n.obs_date, CASE WHEN o.value IS NULL THEN 'INSERT' WHEN abs(n.value - o.value) > 1e-4 THEN 'RECONCILED' ELSE 'UNCHANGED' END AS action FROM n LEFT JOIN o ON o.series_id = n.series_id AND o.obs_date = n.obs_date""")
def l8_retroactive_reconcile(spark, sf_dir):
    m = view(spark, sf_dir, "macro_monthly")
    m = m.crossJoin(F.broadcast(m.agg(F.max("obs_date").alias("top"))))  # one row
    new = m.where(F.col("obs_date") > F.date_sub("top", 60)).withColumn("value", F.when(F.month("obs_date") % 2 == 0, F.col("value") + 1).otherwise(F.col("value")))
    return rec.reconcile_window(m.where("obs_date < top"), new, ["series_id", "obs_date"], "value").select("series_id", "obs_date", "action")


@register("SELECT l_orderkey, count(DISTINCT (l_returnflag, l_linestatus)) = 1 AS identical, count(*) AS n FROM lineitem GROUP BY 1")
def l9_identical_receipts(spark, sf_dir):
    return rec.identical_groups(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_returnflag", "l_linestatus"])


@register("SELECT r.l_orderkey, count(*) = count(s.l_linenumber) AS equal FROM raw_values r LEFT JOIN stored_values s USING (l_orderkey, l_linenumber) GROUP BY 1")
def u6_equal_key_sets(spark, sf_dir):
    return rec.equal_key_sets(raw(spark, sf_dir), stored(spark, sf_dir), "l_orderkey", ["l_linenumber"])
