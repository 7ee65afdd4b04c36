"""Audit of request receipts against runs, acquisitions, raw payloads, decoded and stored rows, and cursors.

All times are milliseconds of UTC. Every rule is a column over one row a request; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.store import checked, stored

#: What a receipt may say.
DIRECTIONS, STATES = ("backward", "forward"), ("success", "empty", "failed")


#: A row's stream, and what a page of stored rows is.
STREAM = ["provider", "metric", "symbol"]


def stored_pages(rows: DataFrame, step: int) -> DataFrame:
    """(provider, metric, symbol, raw_sha256, s): the (at, interval) of a page's stored rows, up to its limit; rows without
    a payload, which are no page, and long pages by stretches of 4,096 steps."""
    stretch = F.floor(F.col("at") / (4096 * step)).alias("_x")
    return rows.groupBy(*STREAM, "raw_sha256", stretch).agg(F.collect_list(F.struct("at", "interval")).alias("s")).drop("_x")


def page_facts(requests: DataFrame, source: DataFrame, pages: DataFrame) -> DataFrame:
    """Per request: rows decoded from its payload (its own stream and all), rows stored for it, their first and last
    time, whether neighbours are a step apart, and whether both sides have the same keys. Both sides are gathered by page
    first, so that a row travels once."""
    own = requests.select("request_id", "provider", "metric", "raw_sha256")
    kept = pages.where("raw_sha256 is not null").groupBy("provider", "metric", "raw_sha256").agg(F.flatten(F.collect_list("s")).alias("s"))  # whatever the symbol
    native = source.where("raw_sha256 is not null").groupBy("raw_sha256", "metric").agg(F.collect_list(F.struct("at", "interval")).alias("w"))
    native = native.groupBy("raw_sha256").agg(F.sum(F.size("w")).alias("decoded"), F.collect_list(F.struct("metric", "w")).alias("_by"))
    j = own.join(native, "raw_sha256", "left").join(kept, ["provider", "metric", "raw_sha256"], "left")
    none = F.array().cast(kept.schema["s"].dataType)
    mine = F.get(F.filter("_by", lambda x: x["metric"] == F.col("metric")), 0)["w"]
    j = j.select("request_id", "decoded", F.coalesce(mine, none).alias("w"), F.coalesce("s", none).alias("s"))
    keys = lambda c: F.array_sort(F.array_distinct(c))
    times = F.array_sort(F.array_distinct(F.array_compact(F.col("s.at"))))
    return j.select(
        "request_id", F.size("w").alias("native"), F.size("s").alias("stored"), (~keys("w").eqNullSafe(keys("s"))).alias("keys_differ"),
        F.array_min("s.at").alias("first"), F.array_max("s.at").alias("last"), times.alias("times"), "decoded",
    )


def next_newer(requests: DataFrame, facts: DataFrame, pages: DataFrame, step: int) -> DataFrame:
    """(request_id, newest, next) of requests whose stream has a time behind the page's last: the newest time and the first
    one within a step. Only pages of such streams are read for it; times meet in buckets of a step, as an equi-join."""
    newest = pages.groupBy(*STREAM).agg(F.max(F.array_max("s.at")).alias("newest"))
    ends = requests.select("request_id", *STREAM).join(facts.select("request_id", "last").where("last is not null"), "request_id")
    ends = stored(ends.join(newest, STREAM).where("newest > last"), "ends")  # read three times
    bucket = F.floor(F.col("last") / step)
    near = ends.withColumn("_b", F.explode(F.array(bucket, bucket + 1)))
    later = pages.join(checked(ends.select(*STREAM).distinct()), STREAM, "left_semi").select(*STREAM, F.explode("s.at").alias("at"))
    behind = near.join(later.withColumn("_b", F.floor(F.col("at") / step)), [*STREAM, "_b"]).where((F.col("at") > F.col("last")) & (F.col("at") <= F.col("last") + step))
    behind = behind.groupBy("request_id").agg(F.min("at").alias("next"))
    return ends.join(behind, "request_id", "left").select("request_id", "newest", "next")


def request_rules(instrument: Column, step: int) -> list[tuple[str, Column]]:
    """(rule, is broken) over the joined row of a request; a NULL is not broken."""
    c = F.col
    forward, failed = c("direction") == "forward", c("status") == "failed"
    done, stored = ~failed, F.coalesce("stored", F.lit(0))
    told = lambda a, b: ~a.eqNullSafe(b)
    gap = F.exists(F.sequence(F.lit(1), F.size("times") - 1), lambda i: F.get("times", i) - F.get("times", i - 1) != step)
    page = stored > 0
    return [
        ("direction", ~c("direction").isin(*DIRECTIONS) | c("direction").isNull()),
        ("stream", c("endpoint").isNull()),
        ("path or interval", c("endpoint").isNotNull() & (told(c("endpoint_path"), c("endpoint")) | told(c("interval_label"), c("config_interval")))),
        ("limit", c("endpoint").isNotNull() & told(c("requested_limit"), c("limit"))),
        ("instrument", ~F.coalesce(instrument, F.lit(False))),
        ("start missing", forward & c("requested_start_ms").isNull()),
        ("end missing", ~forward & c("requested_end_ms").isNull()),
        ("attempts", told(c("http_attempts"), F.lit(1))),
        ("state", ~c("status").isin(*STATES) | c("status").isNull()),
        ("timestamps", c("attempted").isNull() | c("ended").isNull()),
        ("time order", c("attempted") > c("ended")),
        ("run missing", c("run_provider").isNull()),
        ("run disagrees", c("run_provider").isNotNull() & (told(c("run_provider"), c("provider")) | told(c("run_status"), c("status")) | told(c("run_requests"), c("http_attempts")) | told(c("run_points"), c("persisted_rows")))),
        ("acquisition missing", forward & c("status").isin("success", "empty") & c("acq_provider").isNull()),
        ("acquisition digest", forward & c("status").isin("success", "empty") & c("acq_provider").isNotNull() & told(c("acq_sha256"), c("raw_sha256"))),
        ("acquisition provider", forward & c("status").isin("success", "empty") & (c("acq_provider") != c("provider"))),
        ("acquisition path", forward & c("status").isin("success", "empty") & ~c("acq_path").endswith(c("endpoint_path"))),
        ("failed with rows", failed & (c("raw_sha256").isNotNull() | (c("returned_rows") != 0) | (c("persisted_rows") != 0) | c("first_observed").isNotNull() | c("last_observed").isNotNull())),
        ("failed without error", failed & (c("error_class").isNull() | (c("error_class") == "") | (c("run_provider").isNotNull() & told(c("error_class"), c("run_error"))))),
        ("error on success", done & ((F.coalesce("error_class", F.lit("")) != "") | (F.coalesce("run_error", F.lit("")) != ""))),
        ("payload missing", done & c("body_sha256").isNull()),
        ("payload digest", done & (c("body_sha256") != c("raw_sha256"))),
        ("payload source", done & ~forward & c("body_sha256").isNotNull() & (told(c("raw_provider"), c("provider")) | ~F.coalesce(c("raw_path").endswith(c("endpoint_path")), F.lit(False)))),
        ("payload unreadable", done & ~c("readable")),
        ("other stream", done & (F.coalesce("decoded", F.lit(0)) != F.coalesce("native", F.lit(0)))),
        ("returned count", done & told(F.coalesce("native", F.lit(0)), c("returned_rows"))),
        ("persisted count", done & told(stored, c("persisted_rows"))),
        ("not persisted", done & told(c("returned_rows"), c("persisted_rows"))),
        ("keys differ", done & c("keys_differ")),
        ("first or last", done & page & (told(c("first"), c("first_observed")) | told(c("last"), c("last_observed")))),
        ("forward start", done & page & forward & (c("first") != c("requested_start_ms"))),
        ("forward gap", done & forward & (F.size("times") > 1) & gap),
        ("forward end", done & page & forward & (c("last") > c("requested_end_ms"))),
        ("backward boundary", done & page & ~forward & (c("last") != c("requested_end_ms") + 1 - step)),
        ("backward gap", done & ~forward & (F.size("times") > 1) & gap),
        ("page boundary", done & page & ~forward & (c("newest") > c("last")) & told(c("next"), c("last") + step)),
        ("range without rows", done & ~page & (c("first_observed").isNotNull() | c("last_observed").isNotNull())),
        ("empty with rows", (c("status") == "empty") & ((c("returned_rows") != 0) | (c("persisted_rows") != 0))),
        ("success without rows", (c("status") == "success") & (c("persisted_rows") <= 0)),
    ]


def audit_requests(requests: DataFrame, runs: DataFrame, acquisitions: DataFrame, payloads: DataFrame, source: DataFrame, rows: DataFrame, config: DataFrame, instrument: Column, step: int = 300_000) -> DataFrame:
    """(request_id, rule) for every rule that a request breaks.

    requests: request_id, run_id, provider, metric, symbol, interval_label, endpoint_path, requested_start_ms,
    requested_end_ms, requested_limit, attempted, ended, http_attempts, status, error_class, raw_sha256, returned_rows,
    persisted_rows, first_observed, last_observed, direction. runs: run_id, provider, status, requests, points, error.
    acquisitions: request_id, raw_sha256, provider, endpoint_path. payloads: raw_sha256, provider, endpoint, body,
    readable. source (decoded payloads): raw_sha256, metric, at, interval. rows (stored): provider, metric, symbol,
    raw_sha256, at, interval. config: provider, metric, endpoint, limit, interval. Ids and digests are unique there.
    A digest is taken over the payload's own bytes. Payloads travel as digests only.
    """
    runs = runs.select("run_id", F.col("provider").alias("run_provider"), F.col("status").alias("run_status"), F.col("requests").alias("run_requests"), F.col("points").alias("run_points"), F.col("error").alias("run_error"))
    acquired = acquisitions.select("request_id", F.col("raw_sha256").alias("acq_sha256"), F.col("provider").alias("acq_provider"), F.col("endpoint_path").alias("acq_path"))
    raw = payloads.select("raw_sha256", F.sha2("body", 256).alias("body_sha256"), F.col("provider").alias("raw_provider"), F.col("endpoint").alias("raw_path"), "readable")
    config = config.select("provider", "metric", "endpoint", "limit", F.col("interval").alias("config_interval"))
    pages = stored(stored_pages(rows, step), "pages")  # read three times
    facts = stored(page_facts(requests, source, pages), "facts")  # read twice
    j = requests.join(F.broadcast(config), ["provider", "metric"], "left")  # one row for each kind of stream
    j = j.join(runs, "run_id", "left").join(raw, "raw_sha256", "left")
    j = j.join(acquired, "request_id", "left").join(facts, "request_id", "left").join(next_newer(requests, facts, pages, step), "request_id", "left")  # dealt once
    found = [F.when(F.coalesce(broken, F.lit(False)), name) for name, broken in request_rules(instrument, step)]
    return j.select("request_id", F.explode(F.array_compact(F.array(*found))).alias("rule"))


def audit_cursors(streams: DataFrame, cursors: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, cursor, stored, expected) of stored cursors that are not what the rows give: the newest time forward, the
    oldest less a millisecond backward. streams: keys, oldest, newest; cursors: keys, forward, backward (may be NULL)."""
    j = cursors.join(streams, keys)
    both = F.array(
        F.struct(F.lit("forward").alias("cursor"), F.col("forward").alias("stored"), F.col("newest").alias("expected")),
        F.struct(F.lit("backward").alias("cursor"), F.col("backward").alias("stored"), (F.col("oldest") - 1).alias("expected")),
    )
    return j.select(*keys, F.inline(both)).where("stored != expected")
