"""Request lineage over the given orders and lines: each order is a request, its lines are a page of five-minute slots.

Every 64th order breaks one rule (some break several); the oracle says which from the number of the order alone.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.operators import lineage
from marketlens.operators.store import stored
from marketlens.plans.registry import register
from marketlens.sources.tables import table

STEP = 300_000
FORWARD = (6, 14, 15, 16, 17, 30, 31, 32)

#: What breaks: order number modulo 64, rule, and the condition on the page's rows.
BROKEN = [
    (1, "direction", ""), (2, "stream", ""), (3, "path or interval", ""), (4, "limit", ""), (5, "instrument", ""), (6, "start missing", ""), (7, "end missing", ""), (8, "attempts", ""),
    (9, "state", ""), (10, "time order", ""), (11, "timestamps", ""), (12, "run missing", ""), (13, "run disagrees", ""), (14, "acquisition missing", ""), (15, "acquisition digest", ""),
    (16, "acquisition provider", ""), (17, "acquisition path", ""), (18, "failed with rows", ""), (19, "failed without error", ""), (20, "error on success", ""), (21, "payload missing", ""),
    (21, "returned count", "n > 0"), (21, "keys differ", "n > 0"), (22, "payload digest", ""), (23, "payload source", ""), (24, "payload unreadable", ""), (24, "returned count", "n > 0"),
    (24, "keys differ", "n > 0"), (25, "other stream", ""), (26, "returned count", ""), (26, "not persisted", ""), (26, "empty with rows", "n = 0"), (27, "persisted count", ""),
    (27, "not persisted", ""), (27, "empty with rows", "n = 0"), (28, "keys differ", "n > 0"), (29, "first or last", "n > 0"), (30, "forward start", "n > 0"), (31, "forward gap", "n > 1"),
    (31, "forward start", "n = 1"), (32, "forward end", "n > 0"), (33, "backward boundary", "n > 0"), (34, "backward gap", "n > 1"), (35, "page boundary", "n > 0"), (36, "empty with rows", "n > 0"),
    (37, "success without rows", ""), (38, "range without rows", ""),
]
_SQL = f"""WITH q AS (SELECT o_orderkey AS request_id, o_orderkey % 64 AS m, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM orders)
{" UNION ALL ".join(f"SELECT request_id, '{rule}' AS rule FROM q WHERE m = {m}{' AND ' + when if when else ''}" for m, rule, when in BROKEN)}"""


def receipts(spark, sf_dir):
    """(requests, runs, acquisitions, payloads, source, rows, config) with the planted faults."""
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).join(n, "k", "left")
    m = F.col("m")
    at = lambda x: m == x
    o = o.withColumn("m", F.col("k") % 64).withColumn("n", F.when(at(37) | at(38), 0).otherwise(F.coalesce("n", F.lit(0))))
    o = o.withColumn("base", F.lit(1_700_000_000_000) + F.col("k") * 86_400_000)
    o = o.withColumn("provider", F.when(at(2), "gamma").when(F.col("k") % 2 == 0, "alpha").otherwise("beta")).withColumn("metric", F.when(F.col("k") % 3 == 0, "funding").otherwise("interest"))
    o = o.withColumn("symbol", F.concat(F.lit("S"), F.col("k"))).withColumn("path", F.concat(F.lit("/v1/"), F.col("metric")))
    o = o.withColumn("body", F.concat(F.lit("page "), F.col("k")).cast("binary")).withColumn("sha", F.sha2("body", 256))
    # the last slot of 31 and 34 lies a step late
    late = F.when(at(31) | at(34), STEP).otherwise(0)
    o = o.withColumn("first", F.when(F.col("n") == 1, F.col("base") + STEP + late).when(F.col("n") > 1, F.col("base") + STEP)).withColumn("last", F.when(F.col("n") > 0, F.col("base") + F.col("n") * STEP + late))
    o = o.withColumn("direction", F.when(at(1), "sideways").when(m.isin(*FORWARD) | ((m >= 40) & (m % 2 == 0)), "forward").otherwise("backward"))
    o = o.withColumn("status", F.when(at(9), "done").when(at(18) | at(19), "failed").when(at(36) | at(38), "empty").when(at(37), "success").when(F.col("n") > 0, "success").otherwise("empty"))
    o = o.withColumn("error", F.when(at(18) | at(20), "timeout")).withColumn("returned", F.when(at(19), 0).otherwise(F.col("n") + F.when(at(26), 1).otherwise(0)))
    o = o.withColumn("persisted", F.when(at(19), 0).otherwise(F.col("n") + F.when(at(27), 1).otherwise(0)))
    told_first = F.when(at(19), None).when(at(38), F.col("base")).otherwise(F.col("first") + F.when(at(29), 1).otherwise(0))
    start = F.when(at(6), None).when(at(30), F.coalesce("first", "base") + STEP).when(at(31), F.col("base") + STEP).otherwise(F.coalesce("first", "base"))
    end = F.when(at(7), None).when(F.col("direction") == "forward", F.col("last") - F.when(at(32), 1).otherwise(0)).otherwise(F.coalesce("last", "base") + STEP - 1 + F.when(at(33), STEP).otherwise(0))
    o = stored(o.select("*", told_first.cast("long").alias("_first"), start.cast("long").alias("_start"), end.cast("long").alias("_end")), "requests")  # seven tables come of it
    attempts, begun = F.when(at(8), 2).otherwise(1), F.col("base") / 1000
    requests = o.select(
        F.col("k").alias("request_id"), F.col("k").alias("run_id"), "provider", "metric", F.when(at(5), "Z").otherwise(F.col("symbol")).alias("symbol"),
        F.when(at(3), "15m").otherwise("5m").alias("interval_label"), F.col("path").alias("endpoint_path"), F.col("_start").alias("requested_start_ms"), F.col("_end").alias("requested_end_ms"),
        F.when(at(4), 100).otherwise(500).alias("requested_limit"), F.timestamp_seconds(F.when(~at(11), begun + F.when(at(10), 60).otherwise(0))).alias("attempted"),
        F.timestamp_seconds(begun + 5).alias("ended"), attempts.alias("http_attempts"), "status", F.col("error").alias("error_class"),
        F.when(~at(19), F.col("sha")).alias("raw_sha256"), F.col("returned").alias("returned_rows"), F.col("persisted").alias("persisted_rows"),
        F.col("_first").alias("first_observed"), F.when(~at(19), F.col("last")).alias("last_observed"), "direction",
    )
    runs = o.where(~at(12)).select(F.col("k").alias("run_id"), "provider", "status", attempts.alias("requests"), (F.col("persisted") + F.when(at(13), 1).otherwise(0)).alias("points"), "error")
    acquisitions = o.where(~at(14)).select(F.col("k").alias("request_id"), F.when(at(15), "0").otherwise(F.col("sha")).alias("raw_sha256"), F.when(at(16), "delta").otherwise(F.col("provider")).alias("provider"), F.when(at(17), "/v2/x").otherwise(F.concat(F.lit("https://api.example.com"), "path")).alias("endpoint_path"))
    payloads = o.where(~at(21)).select(F.col("sha").alias("raw_sha256"), F.when(at(23), "delta").otherwise(F.col("provider")).alias("provider"), F.col("path").alias("endpoint"), F.when(at(22), F.lit(b"other")).otherwise(F.col("body")).alias("body"), (~at(24)).alias("readable"))
    slots = o.where("n > 0").select("provider", "metric", "symbol", "sha", "m", "n", "base", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")).withColumn("at", F.col("base") + F.col("i") * STEP + F.when(F.col("i") == F.col("n"), late).otherwise(0))
    slots = slots.drop("n", "base")
    rows = slots.where(~at(19)).select("provider", "metric", "symbol", F.col("sha").alias("raw_sha256"), "at", F.lit("5m").alias("interval"))
    extra = o.where(at(35) & (F.col("n") > 0)).select("provider", "metric", "symbol", F.lit("later").alias("raw_sha256"), (F.col("last") + 3 * STEP).alias("at"), F.lit("5m").alias("interval"))
    source = slots.where(~at(19) & ~at(21) & ~at(24)).select(F.col("sha").alias("raw_sha256"), "metric", "at", F.when(at(28) & (F.col("i") == 1), "15m").otherwise("5m").alias("interval"))
    other = o.where(at(25)).select(F.col("sha").alias("raw_sha256"), F.lit("volume").alias("metric"), F.col("base").alias("at"), F.lit("5m").alias("interval"))
    config = spark.createDataFrame([(p, m, f"/v1/{m}", 500, "5m") for p in ("alpha", "beta") for m in ("funding", "interest")], "provider string, metric string, endpoint string, limit int, interval string")
    return requests, runs, acquisitions, payloads, source.unionByName(other), rows.unionByName(extra), config


@register(_SQL)
def l1_request_lineage(spark, sf_dir):
    return lineage.audit_requests(*receipts(spark, sf_dir), F.col("symbol").startswith("S"), STEP)
