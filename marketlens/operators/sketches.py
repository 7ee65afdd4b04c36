"""Mergeable sketches stored by day and merged for any range of days: distinct counts and quantiles without the rows.

Distinct counts use HyperLogLog with 2^LG_K registers, whose relative standard error is 1.04 / sqrt(2^LG_K); quantiles use
KLL, whose rank error at K = 200 is below 1.65 percent with 99 percent confidence. Both merge in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K, K = 12, 200
#: Bounds that estimates are held to: three standard errors of a count; a quantile's rank.
COUNT_BOUND = 3 * 1.04 / 2 ** (LG_K / 2)
RANK_BOUND = 0.0165


def daily_sketches(df: DataFrame, keys: list[str], day: Column, counted: Column | None = None, measured: Column | None = None) -> DataFrame:
    """(keys, day, n, distinct, quantiles): sketches of a day's rows. NULLs are in neither."""
    aggs = [F.count("*").alias("n")]
    if counted is not None:
        aggs.append(F.hll_sketch_agg(counted, LG_K).alias("distinct"))
    if measured is not None:
        aggs.append(F.kll_sketch_agg_double(measured.cast("double"), K).alias("quantiles"))
    return df.groupBy(*keys, day.alias("day")).agg(*aggs)


def distinct_in(sketches: DataFrame, keys: list[str], first: Column, last: Column) -> DataFrame:
    """(keys, estimate): distinct values over days first to last, from the stored sketches alone."""
    rows = sketches.where(F.col("day").between(first, last))
    return rows.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("estimate"))


def quantiles_in(sketches: DataFrame, keys: list[str], first: Column, last: Column, at: list[float]) -> DataFrame:
    """(keys, q, estimate): quantiles over days first to last, from the stored sketches alone."""
    rows = sketches.where(F.col("day").between(first, last))
    merged = rows.groupBy(*keys).agg(F.kll_merge_agg_double("quantiles").alias("_s"))
    each = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias("estimate")) for q in at])
    return merged.select(*keys, F.inline(each))
