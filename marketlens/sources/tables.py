"""Readers of the given tables, and the market-shaped views over them (one SQL text for Spark and the oracle)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS = {
    "bars_daily": """
SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS day, min_by(o_totalprice, o_orderkey) AS open,
       max(o_totalprice) AS high, min(o_totalprice) AS low, max_by(o_totalprice, o_orderkey) AS close,
       CAST(count(*) AS BIGINT) AS volume
FROM {orders} GROUP BY 1, 2""",
    "bars_hourly": """
SELECT event_type AS symbol, date_trunc('hour', ts) AS slot, min_by(value, event_id) AS open, max(value) AS high,
       min(value) AS low, max_by(value, event_id) AS close, CAST(count(*) AS BIGINT) AS volume
FROM {events} GROUP BY 1, 2""",
    "macro_monthly": """
SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_date,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS value
FROM {orders} GROUP BY 1, 2""",
    "vintages": """
SELECT l.l_suppkey AS series_id, CAST(o.o_orderdate AS DATE) AS observed_date, CAST(l.l_shipdate AS DATE) AS realtime_start,
       max(l.l_extendedprice) AS value
FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2, 3""",
    "claims": """
SELECT o_orderkey AS id, o_orderpriority AS asset,
       CASE o_orderstatus WHEN 'F' THEN 'achieved' WHEN 'O' THEN 'missed' ELSE 'partial' END AS status,
       CAST(o_orderdate AS DATE) AS created, o_totalprice AS points
FROM {orders}""",
    "raw_values": "SELECT l_orderkey, l_linenumber, l_extendedprice AS value FROM {lineitem}",
    "stored_values": """
SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 89 = 0 THEN l_extendedprice + 1 ELSE l_extendedprice END AS value
FROM {lineitem} WHERE l_orderkey % 97 <> 0""",
    # requested windows of a series: one for each supplier and month, as a receipt log
    "receipts": """
SELECT l_suppkey AS series_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS start_day,
       CAST(max(l_shipdate) AS DATE) AS end_day, CASE WHEN sum(l_orderkey) % 7 = 0 THEN 'error' ELSE 'ok' END AS status,
       CAST(count(*) AS BIGINT) AS points
FROM {lineitem} GROUP BY 1, 2""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view by name, as a DataFrame."""
    text = VIEWS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", text))})


def oracle(sql: str) -> str:
    """The SQL with the views that it names put in front."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    ctes = ",\n".join(f"{v} AS ({re.sub(r'[{}]', '', VIEWS[v])})" for v in used)
    sql = sql.strip()
    if sql.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes}, {sql[14:]}" if used else sql
    if sql.upper().startswith("WITH "):
        return f"WITH {ctes}, {sql[5:]}" if used else sql
    return f"WITH {ctes} {sql}" if used else sql
