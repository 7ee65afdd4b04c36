"""Streaming queries: the given tables' folders as file streams, run to the end of what is there (availableNow).

A trigger takes all files that are there; a deployment bounds that by maxFilesPerTrigger. Views over a stream are the
same SQL as over the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.store import folder, stored
from marketlens.plans.registry import register
from marketlens.sources.tables import table, view
from marketlens.streaming import operators as st


def table_stream(spark, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream of its files."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")


def run_append(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to the end into Parquet files and read them."""
    spark, path = stream.sparkSession, folder(stream.sparkSession, name)
    q = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", folder(spark, "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def events(spark, sf_dir):
    e = table_stream(spark, sf_dir, "events")
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")


def hourly(spark, sf_dir):
    """Hourly bars as they come in: the table of bars, written to a folder that the stream reads."""
    path = folder(spark, "hourly")
    bars = view(spark, sf_dir, "bars_hourly").select("symbol", F.col("slot").cast("timestamp").alias("slot"), "close")
    bars.write.parquet(path)
    return spark.readStream.schema(bars.schema).parquet(path)


@register("""WITH e AS (SELECT event_id, ts::TIMESTAMP AS ts, event_type, value, time_bucket(INTERVAL 5 MINUTE, ts::TIMESTAMP, TIMESTAMP '1970-01-01') AS start FROM events), m AS (SELECT max(ts) AS top FROM e)
SELECT event_type, start, max(value) AS high, min(value) AS low, count(*) AS n FROM e, m WHERE start + INTERVAL 5 MINUTE <= date_trunc('millisecond', top) - INTERVAL 10 MINUTE GROUP BY 1, 2""")
def g1_closed_bars(spark, sf_dir):
    return run_append(st.closed_bars(events(spark, sf_dir), "ts", ["event_type"], "value"), "bars").select("event_type", "start", "high", "low", "n")


@register("""WITH m AS (SELECT max(ts::TIMESTAMP) AS top FROM events) SELECT event_type, date_trunc('day', ts::TIMESTAMP)::DATE AS day, count(*) AS n FROM events, m
WHERE date_trunc('day', ts::TIMESTAMP) + INTERVAL 1 DAY <= date_trunc('millisecond', top) - INTERVAL 10 MINUTE GROUP BY 1, 2""")
def g2_daily_grid(spark, sf_dir):
    return run_append(st.daily_grid(events(spark, sf_dir), "ts", ["event_type"]), "days")


#: Micro-batches of the queries with replays.
BATCHES = 5


def in_batches(rows: DataFrame, at: str, again: str, name: str) -> DataFrame:
    """rows as a stream of BATCHES files, one a trigger, cut in time; each but the first repeats, behind its own rows, those
    of the one before for which `again` holds."""
    spark, path = rows.sparkSession, folder(rows.sparkSession, name)
    rows = stored(rows, name)
    bounds = rows.agg(F.min(F.unix_micros(at)).alias("_lo"), F.max(F.unix_micros(at)).alias("_hi"))
    part = F.floor((F.unix_micros(at) - F.col("_lo")) * BATCHES / (F.col("_hi") - F.col("_lo") + 1))
    cut = stored(rows.crossJoin(F.broadcast(bounds)).withColumn("_part", part).drop("_lo", "_hi"), name)  # one row
    for i in range(BATCHES):
        batch = cut.where(F.col("_part") == i).unionByName(cut.where((F.col("_part") == i - 1) & F.expr(again)))
        batch.drop("_part").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


@register("SELECT event_id, event_type FROM events")
def g3_exactly_once(spark, sf_dir):
    """Every fifth event comes again in the next trigger; the margin reaches back over two triggers' time."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return run_append(st.once_per_key(in_batches(e, "ts", "event_id % 5 = 0", "replayed"), "ts", ["event_id"], "90 days"), "once").select("event_id", "event_type")


@register("SELECT event_id, round(CASE WHEN event_id % 7 = 0 THEN value - 1 ELSE value END, 4) AS value FROM events")
def g4_late_revisions(spark, sf_dir):
    """A first stream fills the table; a second one brings corrections, each of them twice, the last one counts."""
    path, log = folder(spark, "table"), folder(spark, "revisions")
    fresh = events(spark, sf_dir).select("event_id", "value", F.lit(0).alias("arrival"))
    wrong = events(spark, sf_dir).where("event_id % 7 = 0").select("event_id", (F.col("value") + 1).alias("value"), F.lit(1).alias("arrival"))
    right = events(spark, sf_dir).where("event_id % 7 = 0").select("event_id", (F.col("value") - 1).alias("value"), F.lit(2).alias("arrival"))
    for first, feed in enumerate((fresh, wrong.unionByName(right))):
        sink = st.revise_batch(path, log, ["event_id"], ["value"], "arrival", first)
        feed.writeStream.foreachBatch(sink).option("checkpointLocation", folder(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return st.latest_parts(spark, path).select("event_id", F.round("value", 4).alias("value"))


#: Bars that the margin has not passed at the end still wait.
_CLOSED = "(SELECT max(epoch(slot))::BIGINT - 601 FROM bars_hourly)"


@register(f"""WITH h AS (SELECT symbol, epoch(slot)::BIGINT AS slot FROM bars_hourly), d AS (SELECT symbol, slot, slot - lag(slot) OVER (PARTITION BY symbol ORDER BY slot) AS d FROM h)
SELECT symbol, slot, CASE WHEN d IS NULL THEN 'first' WHEN d = 3600 THEN 'next' ELSE 'gap' END AS kind FROM d WHERE slot <= {_CLOSED}""")
def g5_contiguity(spark, sf_dir):
    """Every third bar comes again in the next trigger."""
    bars = view(spark, sf_dir, "bars_hourly").select("symbol", F.col("slot").cast("timestamp").alias("slot"))
    s = in_batches(bars, "slot", "hour(slot) % 3 = 0", "bars")
    return run_append(st.contiguity(s, "symbol", "slot", 3600), "kinds").select("symbol", F.unix_timestamp("slot").alias("slot"), "kind")


_RUN = """WITH RECURSIVE b AS (SELECT symbol, epoch(slot)::BIGINT AS slot, close, close - lag(close) OVER (PARTITION BY symbol ORDER BY slot) AS d, row_number() OVER (PARTITION BY symbol ORDER BY slot) AS rn FROM bars_hourly),
e AS (SELECT symbol, 12::BIGINT AS rn, avg(close) AS y FROM b WHERE rn <= 12 GROUP BY symbol UNION ALL SELECT e.symbol, b.rn, e.y * (11.0::DOUBLE / 13) + b.close * (2.0::DOUBLE / 13) FROM e JOIN b ON b.symbol = e.symbol AND b.rn = e.rn + 1),
r AS (SELECT symbol, 15::BIGINT AS rn, avg(greatest(d, 0)) AS g, avg(greatest(-d, 0)) AS l FROM b WHERE rn BETWEEN 2 AND 15 GROUP BY symbol UNION ALL SELECT r.symbol, b.rn, (r.g * 13 + greatest(b.d, 0)) / 14, (r.l * 13 + greatest(-b.d, 0)) / 14 FROM r JOIN b ON b.symbol = r.symbol AND b.rn = r.rn + 1)
SELECT b.symbol, b.slot, round(e.y, 4) AS ema, round(CASE WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END, 4) AS rsi FROM b LEFT JOIN e ON e.symbol = b.symbol AND e.rn = b.rn LEFT JOIN r ON r.symbol = b.symbol AND r.rn = b.rn WHERE b.slot <= """ + _CLOSED


@register(_RUN)
def g7_running_indicators(spark, sf_dir):
    bars = view(spark, sf_dir, "bars_hourly").select("symbol", F.col("slot").cast("timestamp").alias("slot"), "close")
    s = in_batches(bars, "slot", "hour(slot) % 3 = 0", "bars")
    out = run_append(st.running_indicators(s, "symbol", "slot", "close"), "running")
    return out.select("symbol", F.unix_timestamp("slot").alias("slot"), F.round("ema", 4).alias("ema"), F.round("rsi", 4).alias("rsi"))


@register("""WITH l AS (SELECT event_type, max(epoch(ts))::BIGINT AS t FROM events GROUP BY 1), n AS (SELECT max(t) AS now FROM l) SELECT event_type, CASE WHEN now - t <= 600 THEN 'WITHIN' ELSE 'STALE' END AS state FROM l, n""")
def g8_staleness(spark, sf_dir):
    latest = table(spark, sf_dir, "events").groupBy("event_type").agg(F.unix_timestamp(F.max(F.col("ts").cast("timestamp"))).alias("t"))
    latest = latest.crossJoin(F.broadcast(latest.agg(F.max("t").alias("now"))))  # one row
    return st.staleness(latest, "t", F.col("now"), F.lit(600)).select("event_type", "state")


@register("""WITH h AS (SELECT symbol, slot::TIMESTAMP AS slot FROM bars_hourly), m AS (SELECT date_trunc('millisecond', max(slot)) - INTERVAL 10 MINUTE AS mark FROM h),
g AS (SELECT symbol, slot, CASE WHEN slot - lag(slot) OVER (PARTITION BY symbol ORDER BY slot) < INTERVAL 3601 SECOND THEN 0 ELSE 1 END AS new FROM h),
r AS (SELECT symbol, slot, sum(new) OVER (PARTITION BY symbol ORDER BY slot) AS run FROM g)
SELECT symbol, min(slot) AS start, max(slot) + INTERVAL 3601 SECOND AS "end", count(*) AS slots FROM r, m GROUP BY symbol, run, mark HAVING max(slot) + INTERVAL 3601 SECOND <= mark""")
def g6_coverage_sessions(spark, sf_dir):
    return run_append(st.coverage_sessions(hourly(spark, sf_dir), "slot", ["symbol"], "3601 seconds"), "sessions")
