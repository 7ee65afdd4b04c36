"""Coverage, gap, window and cadence queries over hourly bars, events and receipts."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.operators import coverage as cov
from marketlens.plans.registry import register
from marketlens.sources.tables import table, view

HOUR = 3600


def hourly(spark, sf_dir):
    return view(spark, sf_dir, "bars_hourly").withColumn("slot", F.unix_timestamp(F.col("slot").cast("timestamp")))


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", "event_id", "value", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"))


_H = "h AS (SELECT symbol, epoch(slot)::BIGINT AS slot, close, volume FROM bars_hourly)"
_B = "b AS (SELECT symbol, min(slot) AS lo, max(slot) AS hi FROM h GROUP BY symbol)"
_MISS = f"{_H}, {_B}, m AS (SELECT symbol, slot FROM (SELECT symbol, unnest(range(lo, hi + 1, 3600)) AS slot FROM b) WHERE (symbol, slot) NOT IN (SELECT symbol, slot FROM h))"
_EV = "e AS (SELECT event_type, event_id, value, floor(epoch(ts))::BIGINT AS t FROM events)"


@register(f"WITH {_MISS} SELECT symbol, slot FROM m")
def j17_expected_grid(spark, sf_dir):
    h = hourly(spark, sf_dir)
    b = h.groupBy("symbol").agg(F.min("slot").alias("first"), F.max("slot").alias("last"))
    return cov.missing_slots(h, b, ["symbol"], HOUR)


@register(f"""WITH {_MISS}, r AS (SELECT symbol, slot, slot - row_number() OVER (PARTITION BY symbol ORDER BY slot) * 3600 AS g FROM m)
SELECT b.symbol, 'OK' AS state, start, "end", slots FROM b LEFT JOIN (SELECT symbol, g, min(slot) AS start, max(slot) + 3600 AS "end", count(*) AS slots FROM r GROUP BY symbol, g) x ON x.symbol = b.symbol""")
def w12_gap_candidates(spark, sf_dir):
    return cov.gap_candidates(hourly(spark, sf_dir), ["symbol"], HOUR)


@register("""WITH b AS (SELECT symbol, min(day) AS lo, max(day) AS hi, count(DISTINCT day) AS n FROM bars_daily GROUP BY symbol),
m AS (SELECT symbol, day::DATE AS day FROM (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS day FROM b) WHERE (symbol, day::DATE) NOT IN (SELECT symbol, day FROM bars_daily)),
r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY day) AS k FROM m)
SELECT b.symbol, (hi - lo + 1 - n)::BIGINT AS gap_count, coalesce((SELECT string_agg(day::VARCHAR, ',' ORDER BY day) FROM r WHERE r.symbol = b.symbol AND k <= 40), '') AS sample FROM b""")
def w13_internal_gaps_daily(spark, sf_dir):
    return cov.internal_gaps_daily(view(spark, sf_dir, "bars_daily"), ["symbol"], "day")


#: Weekdays are sessions, but for the 24th to 26th of each month; a series of the second calendar has all days but Sundays;
#: 4 needs a calendar that nobody has, 5 needs none.
_CAL = """span AS (SELECT min(day) AS lo, max(day) AS hi FROM bars_daily), days AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS day FROM span),
cal AS (SELECT 'week' AS calendar, day FROM days WHERE isodow(day) < 6 AND day(day) NOT IN (24, 25, 26) UNION ALL SELECT 'six', day FROM days WHERE isodow(day) < 7),
ser AS (SELECT DISTINCT symbol, CASE symbol[1:1] WHEN '1' THEN 'week' WHEN '2' THEN 'six' WHEN '3' THEN 'week' WHEN '4' THEN 'lunar' END AS calendar FROM bars_daily)"""


@register(f"""WITH {_CAL}, b AS (SELECT b.symbol, calendar, day FROM bars_daily b JOIN ser ON ser.symbol = b.symbol WHERE calendar IS NULL OR (calendar, day) IN (SELECT calendar, day FROM cal)),
e AS (SELECT symbol, calendar, min(day) AS lo, max(day) AS hi FROM b GROUP BY 1, 2),
want AS (SELECT symbol, cal.day FROM e JOIN cal ON cal.calendar = e.calendar AND cal.day BETWEEN lo AND hi UNION ALL SELECT symbol, days.day FROM e JOIN days ON e.calendar IS NULL AND days.day BETWEEN lo AND hi),
miss AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY day) AS k FROM want ANTI JOIN b USING (symbol, day)),
t AS (SELECT symbol, count(*) AS n, string_agg(day::VARCHAR, ',' ORDER BY day) FILTER (k <= 40) AS s FROM miss GROUP BY 1)
SELECT ser.symbol, CASE WHEN calendar IS DISTINCT FROM 'lunar' THEN coalesce(n, 0) END AS gap_count, CASE WHEN calendar IS DISTINCT FROM 'lunar' THEN coalesce(s, '') END AS sample FROM ser LEFT JOIN t ON t.symbol = ser.symbol""")
def w13_calendar_gaps(spark, sf_dir):
    b = view(spark, sf_dir, "bars_daily")
    days = b.agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    week = days.select(F.lit("week").alias("calendar"), "day", ((F.weekday("day") < 5) & ~F.dayofmonth("day").isin(24, 25, 26)).alias("open"))
    six = days.select(F.lit("six").alias("calendar"), "day", (F.weekday("day") < 6).alias("open"))
    calendars = cov.session_calendar(week.unionByName(six), "calendar", "day")
    name = F.substring("symbol", 1, 1)
    calendar = F.when(name.isin("1", "3"), "week").when(name == "2", "six").when(name == "4", "lunar")
    series = b.select("symbol").distinct().select("symbol", calendar.alias("calendar"), (name != "5").alias("required"))
    return cov.session_gaps(b, series, calendars, ["symbol"], "day")


@register("""SELECT series_id, (max(year(obs_date) * 12 + month(obs_date)) - min(year(obs_date) * 12 + month(obs_date)) + 1 - count(DISTINCT obs_date))::BIGINT AS gap_count FROM macro_monthly GROUP BY 1""")
def w13_internal_gaps_monthly(spark, sf_dir):
    return cov.internal_gaps_monthly(view(spark, sf_dir, "macro_monthly"), ["series_id"], "obs_date")


@register("""WITH r AS (SELECT series_id, start_day, end_day, max(end_day) OVER (PARTITION BY series_id ORDER BY start_day, end_day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM receipts),
g AS (SELECT *, sum(CASE WHEN p IS NULL OR start_day > p THEN 1 ELSE 0 END) OVER (PARTITION BY series_id ORDER BY start_day, end_day) AS k FROM r)
SELECT series_id, min(start_day) AS start, max(end_day) AS "end", count(*) AS windows FROM g GROUP BY series_id, k""")
def w14_interval_union(spark, sf_dir):
    return cov.interval_union(view(spark, sf_dir, "receipts"), ["series_id"], "start_day", "end_day")


@register(f"""WITH {_MISS}, r AS (SELECT symbol, slot, slot - row_number() OVER (PARTITION BY symbol ORDER BY slot) * 3600 AS g FROM m),
p AS (SELECT *, (row_number() OVER (PARTITION BY symbol, g ORDER BY slot) - 1) // 2 AS part FROM r)
SELECT symbol, min(slot) AS start, max(slot) + 3600 AS "end", count(*) AS slots FROM p GROUP BY symbol, g, part""")
def w15_missing_runs(spark, sf_dir):
    return cov.split_runs(cov.missing_windows(hourly(spark, sf_dir), ["symbol"], HOUR), HOUR, most=2)


_TILE = f"""WITH {_H}, {_B}, t AS (SELECT symbol, unnest(range(lo, hi, 50400)) AS start, hi FROM b),
w AS (SELECT symbol, start, least(start + 50400, hi) AS "end" FROM t)"""


@register(_TILE + ' SELECT symbol, start, "end" FROM w')
def w16_tiling(spark, sf_dir):
    b = hourly(spark, sf_dir).groupBy("symbol").agg(F.min("slot").alias("first"), F.max("slot").alias("last"))
    return cov.tile(b, 14 * HOUR).select("symbol", "start", "end")


#: Of five tiles in a row: the first is done but for its last hours (twice, by windows that touch), the second in its
#: middle, the third and the start of the fourth by one window, the fifth not at all.
_DONE = """x AS (SELECT symbol, start, (row_number() OVER (PARTITION BY symbol ORDER BY start) - 1) % 5 AS k FROM w),
done AS (SELECT symbol, start AS a, start + 18000 AS b FROM x WHERE k = 0 UNION ALL SELECT symbol, start + 18000, start + 36000 FROM x WHERE k = 0 UNION ALL SELECT symbol, start - 3600, start + 28800 FROM x WHERE k = 0
  UNION ALL SELECT symbol, start + 10800, start + 21600 FROM x WHERE k = 1 UNION ALL SELECT symbol, start, start + 61200 FROM x WHERE k = 2)"""


@register(_TILE + f""", {_DONE}, hours AS (SELECT symbol, w.start AS tile, h FROM w, unnest(range(w.start, w."end", 3600)) r(h)),
left_ AS (SELECT symbol, tile, h FROM hours WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.symbol = hours.symbol AND d.a <= h AND h < d.b)),
g AS (SELECT *, h - row_number() OVER (PARTITION BY symbol, tile ORDER BY h) * 3600 AS g FROM left_)
SELECT symbol, min(h) AS start, max(h) + 3600 AS "end" FROM g GROUP BY symbol, tile, g""")
def w16_tiling_minus_done(spark, sf_dir):
    tiles = w16_tiling(spark, sf_dir)
    first = tiles.groupBy("symbol").agg(F.min("start").alias("_first"))
    k = F.expr("(start - _first) div 50400 % 5")
    a = F.col("start")
    spans = [(0, 0, 18000), (0, 18000, 36000), (0, -3600, 28800), (1, 10800, 21600), (2, 0, 61200)]
    done = F.array_compact(F.array(*[F.when(k == n, F.struct((a + lo).alias("a"), (a + hi).alias("b"))) for n, lo, hi in spans]))
    done = tiles.join(first, "symbol").select("symbol", F.inline(done)).withColumnsRenamed({"a": "start", "b": "end"})
    return cov.subtract_windows(tiles, done, ["symbol"])


@register(_TILE + ' SELECT symbol, start, "end", row_number() OVER (PARTITION BY symbol ORDER BY start) AS turn FROM w')
def w17_round_robin(spark, sf_dir):
    return cov.round_robin(w16_tiling(spark, sf_dir), ["symbol"], "start")


def _backlog(spark, sf_dir):
    e = _events(spark, sf_dir)
    e = e.crossJoin(F.broadcast(e.agg((F.max("t") + 86400).alias("now"))))  # one row
    top = e.groupBy("event_type").agg(F.max("t").alias("t"), F.max("now").alias("now"))
    top = top.withColumn("t", F.col("t") - F.pmod("t", F.lit(300)))
    return cov.backlog(top.withColumn("k", F.col("now")), ["event_type", "k"], "t", F.col("k"), 300, 100).select("event_type", "next_start", "waiting", "pages", "status")


_BACK = f"""WITH {_EV}, n AS (SELECT max(t) + 86400 AS now FROM e), b AS (SELECT event_type, max(t) - max(t) % 300 + 300 AS next_start FROM e GROUP BY 1),
q AS (SELECT event_type, next_start, greatest(((now - 600) - (now - 600) % 300 - next_start) // 300, 0)::BIGINT AS waiting FROM b, n),
z AS (SELECT *, ceil(waiting / 100.0)::BIGINT AS pages FROM q),
res AS (SELECT *, CASE WHEN waiting = 0 THEN 'CURRENT' WHEN pages <= 1 THEN 'ONE_PAGE' ELSE 'BACKLOG' END AS status FROM z)"""


@register(_BACK + " SELECT * FROM res")
def w18_backlog(spark, sf_dir):
    return _backlog(spark, sf_dir)


@register(f"""WITH {_EV}, b AS (SELECT event_type, min(t) AS oldest FROM e GROUP BY 1), f AS (SELECT (SELECT min(t) FROM e) - 30 * 86400 AS fl)
SELECT event_type, oldest, ((oldest - fl) // 300)::BIGINT AS missing_before, greatest(oldest - 60000, fl) AS page_start, oldest AS page_end FROM b, f WHERE (oldest - fl) // 300 > 0""")
def w19_backward_candidate(spark, sf_dir):
    e = _events(spark, sf_dir)
    e = e.crossJoin(F.broadcast(e.agg((F.min("t") - 30 * 86400).alias("floor"))))  # one row
    return cov.backward_candidate(e, ["event_type", "floor"], "t", F.col("floor"), 300, 200).drop("floor")


@register(_BACK + " SELECT * FROM res ORDER BY waiting DESC, event_type LIMIT 1")
def w20_largest_backlog(spark, sf_dir):
    return cov.largest(_backlog(spark, sf_dir), "waiting", "event_type")


@register(f"""WITH {_EV}, d AS (SELECT event_type, t - lag(t) OVER (PARTITION BY event_type ORDER BY t, event_id) AS d, t - lag(t) OVER (PARTITION BY event_type ORDER BY event_id) AS a FROM e)
SELECT event_type, count(*) FILTER (d = 0) AS duplicates, count(*) FILTER (d > 0 AND d < 300) AS sub_interval, count(*) FILTER (d > 300) AS gaps, count(*) FILTER (a <= 0) AS non_increasing FROM d GROUP BY 1""")
def w21_chronology(spark, sf_dir):
    return cov.chronology(_events(spark, sf_dir), ["event_type"], "t", "event_id", 300)


@register(f"""WITH {_EV}, s AS (SELECT event_type, max(t) * 1000 AS f, min(t) * 1000 - 1 AS b FROM e GROUP BY 1)
SELECT event_type, f AS forward_cursor, b AS backward_cursor_ms, length(event_type) % 2 <> 0 AS forward_ok, length(event_type) % 3 <> 0 AS backward_ok FROM s""")
def w22_cursors(spark, sf_dir):
    """Cursors from the rows, and whether the stored ones (some made wrong) are the same."""
    from marketlens.operators.lineage import audit_cursors

    s = _events(spark, sf_dir).groupBy("event_type").agg((F.max("t") * 1000).alias("newest"), (F.min("t") * 1000).alias("oldest"))
    n = F.length("event_type")
    stored = s.select("event_type", (F.col("newest") + F.when(n % 2 == 0, 60_000).otherwise(0)).alias("forward"), (F.col("oldest") - F.when(n % 3 == 0, 2).otherwise(1)).alias("backward"))
    wrong = audit_cursors(s, stored, ["event_type"]).groupBy("event_type").agg(F.collect_set("cursor").alias("_w"))  # two at most
    ok = lambda c: ~F.coalesce(F.array_contains("_w", c), F.lit(False))
    j = s.join(wrong, "event_type", "left")
    return j.select("event_type", F.col("newest").alias("forward_cursor"), (F.col("oldest") - 1).alias("backward_cursor_ms"), ok("forward").alias("forward_ok"), ok("backward").alias("backward_ok"))


@register("""WITH p AS (SELECT series_id, start_day, end_day, lag(end_day) OVER (PARTITION BY series_id ORDER BY start_day) AS previous_end FROM receipts)
SELECT * FROM p WHERE previous_end IS NOT NULL AND previous_end <> start_day""")
def w23_cursor_continuity(spark, sf_dir):
    return cov.continuity(view(spark, sf_dir, "receipts").select("series_id", "start_day", "end_day"), ["series_id"], "start_day", "end_day")


@register(f"WITH {_EV} SELECT event_type, max(t) AS t, arg_max(value, (t, event_id)) AS value FROM e GROUP BY 1")
def w24_latest_per_key(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.groupBy("event_type").agg(F.max("t").alias("t"), F.max_by("value", F.struct("t", "event_id")).alias("value"))


@register("""WITH r AS (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY start_day) - 1 AS ordinal, status FROM receipts)
SELECT series_id, coalesce(min(CASE WHEN status <> 'ok' THEN ordinal END), max(ordinal) + 1) AS resume FROM r GROUP BY 1""")
def w30_resume_index(spark, sf_dir):
    return cov.contiguous_prefix(_ordinals(spark, sf_dir), ["series_id"], "ordinal", F.col("status") == "ok")


def _ordinals(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("series_id").orderBy("start_day")
    return view(spark, sf_dir, "receipts").withColumn("ordinal", (F.row_number().over(w) - 1).cast("long"))


@register("""WITH c AS (SELECT max(day) - 1 AS closed FROM bars_daily), s AS (SELECT DISTINCT symbol FROM bars_daily UNION ALL SELECT 'NEW'),
l AS (SELECT symbol, max(day) AS last FROM bars_daily WHERE symbol <> '1-URGENT' AND day < (SELECT closed - 5 FROM c) GROUP BY symbol)
SELECT s.symbol, coalesce(last + 1, closed - 89)::DATE AS start, closed AS "end" FROM s CROSS JOIN c LEFT JOIN l ON l.symbol = s.symbol WHERE coalesce(last + 1, closed - 89) <= closed""")
def w31_next_window(spark, sf_dir):
    b = view(spark, sf_dir, "bars_daily")
    closed = F.broadcast(b.agg(F.date_sub(F.max("day"), 1).alias("closed")))  # one row
    series = b.select("symbol").distinct().union(spark.range(1).select(F.lit("NEW").alias("symbol"))).crossJoin(closed)
    stored = b.crossJoin(closed).where((F.col("symbol") != "1-URGENT") & (F.col("day") < F.date_sub("closed", 5)))
    return cov.next_window(stored, series, ["symbol", "closed"], "day", F.col("closed"), 90).drop("closed")


@register("SELECT event_type, count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM events GROUP BY 1 UNION ALL SELECT o_orderpriority, count(*), min(o_orderkey), max(o_orderkey) FROM orders GROUP BY 1")
def a1_coverage(spark, sf_dir):
    from marketlens.operators.relational import coverage

    e = coverage(table(spark, sf_dir, "events"), ["event_type"], "event_id")
    return e.unionByName(coverage(table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "event_type"), ["event_type"], "o_orderkey"))


@register(f"""WITH {_EV}, d AS (SELECT event_type, floor((t - lag(t) OVER (PARTITION BY event_type ORDER BY t)) / 60.0)::BIGINT AS delta_min FROM e),
g AS (SELECT event_type, delta_min, count(*) AS n FROM d WHERE delta_min IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, delta_min) AS rank FROM g)
SELECT * FROM r WHERE rank <= 10""")
def a9_cadence(spark, sf_dir):
    return cov.cadence(_events(spark, sf_dir), ["event_type"], "t")


@register(f"""WITH {_EV}, n AS (SELECT max(t) AS now FROM e), d AS (SELECT event_type, t, t - lag(t) OVER (PARTITION BY event_type ORDER BY t) AS d FROM e),
g AS (SELECT event_type, count(*) AS n, min(t) AS first, max(t) AS last, count(*) FILTER (d = 0) AS duplicates, count(*) FILTER (d > 0 AND d < 300) AS sub_interval,
  count(*) FILTER (t % 300 <> 0) AS misaligned, count(*) FILTER (t > now - 3600) AS future, count(DISTINCT CASE WHEN t % 300 = 0 THEN t END) AS onn, count(DISTINCT CASE WHEN t % 7 = 0 AND length(event_type) % 2 = 0 THEN 'usd' ELSE 'base' END) AS units, any_value(now) AS now FROM d, n GROUP BY 1)
SELECT event_type, units, n, first, last, duplicates, sub_interval, misaligned, future, round((last - first) / 3600, 4) AS span_hours, now - 3600 - last AS age_seconds,
  greatest(floor(last / 300) - ceil(first / 300) + 1 - onn, 0)::BIGINT AS missing_slots FROM g""")
def a10_temporal_quality(spark, sf_dir):
    e = _events(spark, sf_dir)
    e = e.crossJoin(F.broadcast(e.agg((F.max("t") - 3600).alias("now"))))  # one row
    unit = F.when((F.col("t") % 7 == 0) & (F.length("event_type") % 2 == 0), "usd").otherwise("base")  # some streams with two
    return cov.temporal_quality(e, ["event_type", "now"], "t", 300, F.col("now"), unit).drop("now")


_ATT = """a AS (SELECT series_id, count(*) AS attempts, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'error') AS errors, min(start_day) AS requested_from, max(end_day) AS requested_to,
  sum(CASE WHEN status = 'ok' THEN points ELSE 0 END)::BIGINT AS points FROM receipts GROUP BY 1)"""


def _attempts(spark, sf_dir):
    r = view(spark, sf_dir, "receipts")
    return r.groupBy("series_id").agg(
        F.count("*").alias("attempts"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "error").alias("errors"),
        F.min("start_day").alias("requested_from"), F.max("end_day").alias("requested_to"), F.sum(F.when(F.col("status") == "ok", F.col("points")).otherwise(0)).alias("points"),
    )


@register(f"WITH {_ATT} SELECT *, CASE WHEN ok = 0 THEN 'NO_EVIDENCE' WHEN errors > 0 THEN 'PARTIAL' ELSE 'COMPLETE' END AS state FROM a")
def a11_attempt_evidence(spark, sf_dir):
    state = F.when(F.col("ok") == 0, "NO_EVIDENCE").when(F.col("errors") > 0, "PARTIAL").otherwise("COMPLETE")
    return _attempts(spark, sf_dir).withColumn("state", state)


@register(f"""WITH {_ATT}, r AS (SELECT series_id, start_day, end_day, max(end_day) OVER (PARTITION BY series_id ORDER BY start_day, end_day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM receipts WHERE status = 'ok'),
g AS (SELECT *, sum(CASE WHEN p IS NULL OR start_day > p THEN 1 ELSE 0 END) OVER (PARTITION BY series_id ORDER BY start_day, end_day) AS k FROM r),
w AS (SELECT series_id, count(DISTINCT k) AS merged_windows FROM g GROUP BY 1),
v AS (SELECT series_id, count(*) AS observations, count(DISTINCT CASE WHEN series_id % 10 = 0 AND month(observed_date) = 6 THEN 'usd' ELSE 'base' END) AS units FROM vintages GROUP BY 1),
k AS (SELECT series_id, CASE WHEN month(start_day) % 2 = 0 THEN 'timeout' ELSE 'HTTPError_503' END AS kind, count(*) AS n FROM receipts WHERE status = 'error' GROUP BY 1, 2),
x AS (SELECT series_id, string_agg(kind || ':' || n, ';' ORDER BY kind) AS error_kinds FROM k GROUP BY 1)
SELECT a.series_id, attempts, ok, errors, coalesce(merged_windows, 0) AS merged_windows, coalesce(observations, 0) AS observations, coalesce(units, 0) AS units, coalesce(error_kinds, '') AS error_kinds,
  CASE WHEN units > 1 THEN 'MIXED_UNITS' WHEN errors > 0 THEN 'ERRORS' WHEN coalesce(merged_windows, 0) <= 1 THEN 'CONTIGUOUS' ELSE 'GAPS' END AS grid_state
FROM a LEFT JOIN w USING (series_id) LEFT JOIN v USING (series_id) LEFT JOIN x USING (series_id)""")
def a12_manifest(spark, sf_dir):
    ok = view(spark, sf_dir, "receipts").where("status = 'ok'")
    merged = cov.interval_union(ok, ["series_id"], "start_day", "end_day").groupBy("series_id").agg(F.count("*").alias("merged_windows"))
    unit = F.when((F.col("series_id") % 10 == 0) & (F.month("observed_date") == 6), "usd").otherwise("base")  # some series with two
    seen = view(spark, sf_dir, "vintages").groupBy("series_id").agg(F.count("*").alias("observations"), F.count_distinct(unit).alias("units"))
    kind = F.when(F.month("start_day") % 2 == 0, "timeout").otherwise("HTTPError_503")
    kinds = view(spark, sf_dir, "receipts").where("status = 'error'").groupBy("series_id", kind.alias("kind")).agg(F.count("*").alias("n"))
    kinds = kinds.groupBy("series_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "kind", "n"))), ";").alias("error_kinds"))  # a few categories
    m = _attempts(spark, sf_dir).join(merged, "series_id", "left").join(seen, "series_id", "left").join(kinds, "series_id", "left")
    m = m.withColumn("merged_windows", F.coalesce("merged_windows", F.lit(0))).withColumn("observations", F.coalesce("observations", F.lit(0)))
    m = m.withColumn("units", F.coalesce("units", F.lit(0))).withColumn("error_kinds", F.coalesce("error_kinds", F.lit("")))
    state = F.when(F.col("units") > 1, "MIXED_UNITS").when(F.col("errors") > 0, "ERRORS").when(F.col("merged_windows") <= 1, "CONTIGUOUS").otherwise("GAPS")
    return m.select("series_id", "attempts", "ok", "errors", "merged_windows", "observations", "units", "error_kinds", state.alias("grid_state"))


@register(f"""WITH {_MISS} SELECT symbol, count(*) AS gaps FROM m GROUP BY 1 ORDER BY gaps DESC, symbol LIMIT 3""")
def t4_review_queue(spark, sf_dir):
    return j17_expected_grid(spark, sf_dir).groupBy("symbol").agg(F.count("*").alias("gaps")).orderBy(F.desc("gaps"), "symbol").limit(3)


@register(f"""WITH {_H}, r AS (SELECT symbol, slot, slot - row_number() OVER (PARTITION BY symbol ORDER BY slot) * 3600 AS g FROM h)
SELECT symbol, min(slot) AS start, max(slot) + 3600 AS "end", count(*) AS slots FROM r GROUP BY symbol, g""")
def g6_coverage_runs(spark, sf_dir):
    return cov.slot_runs(hourly(spark, sf_dir), ["symbol"], "slot", HOUR)


@register("""WITH t AS (SELECT *, max(l_shipdate) OVER () AS now FROM lineitem), w AS (SELECT l_orderkey, l_linenumber, (epoch(now) - epoch(l_shipdate))::BIGINT - 86400 AS age, CASE WHEN l_linenumber % 2 = 0 THEN 86400 * 3 ELSE 86400 * 40 END AS budget FROM t)
SELECT CASE WHEN age < 0 THEN 'FUTURE' WHEN age <= budget THEN 'WITHIN' ELSE 'STALE' END AS state, count(*) AS n FROM w GROUP BY 1""")
def p17_freshness(spark, sf_dir):
    from marketlens.functions.scalars import freshness

    li = table(spark, sf_dir, "lineitem").select("l_linenumber", F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).alias("t"))
    li = li.crossJoin(F.broadcast(li.agg(F.max("t").alias("now"))))  # one row
    budget = F.when(F.col("l_linenumber") % 2 == 0, 86400 * 3).otherwise(86400 * 40)
    return li.groupBy(freshness(F.col("now") - F.col("t") - 86400, budget).alias("state")).agg(F.count("*").alias("n"))
