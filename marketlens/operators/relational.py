"""Basic relational operators over series: scans, as-of picks, calendar joins, conditional aggregates, set operations."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.operators.store import dealt


def newest_n(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """The newest n rows of each key; sort by (keys, order) to read them in time order."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def range_scan(df: DataFrame, day: str, first: str, last: str, limit: int, *tie: str) -> DataFrame:
    """Rows of inclusive UTC days, oldest first, at most limit (1 to 5000), with a flag whether more may follow."""
    if not 1 <= limit <= 5000:
        raise ValueError("limit must be 1 to 5000")
    if first > last:
        raise ValueError("the range ends before it begins")
    rows = df.where(F.to_date(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    got = rows.orderBy(day, *tie).limit(limit)
    n = got.agg((F.count("*") >= limit).alias("truncated"))
    return got.crossJoin(F.broadcast(n))  # one row


class Source(NamedTuple):
    """Where a provider's rows are: the table, its metric, day and tie columns, and the columns that it returns."""

    table: DataFrame
    metric: str
    day: str
    tie: tuple[str, ...]
    fields: tuple[str, ...]


def query_history(sources: dict[str, Source], provider: str, metric: str, first: str, last: str, limit: int = 1000) -> DataFrame:
    """The provider's fields of one metric over inclusive UTC days, oldest first, at most limit, with the flag
    `truncated`. Filters reach the provider's own table."""
    if provider not in sources:
        raise ValueError(f"no such provider: {provider}")
    if not metric or len(metric) > 150:
        raise ValueError("a metric of at most 150 characters is needed")
    s = sources[provider]
    return range_scan(s.table.where(F.col(s.metric) == metric), s.day, first, last, limit, *s.tie).select(*s.fields, "truncated")


def convert_units(df: DataFrame, registry: DataFrame, key: str, value: str) -> DataFrame:
    """Registry factor, display unit and verified flag; unknown keys keep the raw value with unit `unknown`."""
    j = df.join(F.broadcast(registry), key, "left")  # a registry of metrics
    return (
        j.withColumn("converted", F.col(value) * F.coalesce("factor", F.lit(1.0)))
        .withColumn("unit", F.coalesce("unit", F.lit("unknown")))
        .withColumn("verified", F.coalesce("verified", F.lit(False)))
    )


def month_offset_join(df: DataFrame, key: str, date: str, value: str, months: int) -> DataFrame:
    """Each value with the one `months` calendar months earlier (prev); rows without one are left out."""
    prev = df.select(key, F.add_months(date, months).alias(date), F.col(value).alias("prev"))
    return df.join(prev, [key, date])


def trailing_days_mean(df: DataFrame, keys: list[str], day: str, value: str, days: int, out: str) -> DataFrame:
    """Mean over the last `days` calendar days, the row's own included."""
    at = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy(*keys).orderBy(at).rangeBetween(-(days - 1), 0)
    return df.withColumn(out, F.avg(value).over(w))


def coverage(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(at).alias("first"), F.max(at).alias("last"))


def hit_rates(claims: DataFrame, since: Column | None = None) -> DataFrame:
    """Claims of each asset since a day: counts by status, and achieved in percent with one decimal."""
    rows = claims if since is None else claims.where(F.col("created") >= since)
    g = rows.groupBy("asset").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "achieved").alias("achieved"),
        F.count_if(F.col("status") == "missed").alias("missed"),
        F.count_if(F.col("status") == "partial").alias("partial"),
    )
    return g.withColumn("hit_rate", F.round(F.col("achieved") * 100.0 / F.col("total"), 1))


def matching(df: DataFrame, **wanted) -> DataFrame:
    """Conjunctive filter on the fields that are given."""
    for c, v in wanted.items():
        if v is not None:
            df = df.where(F.col(c) == v)
    return df


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def with_catalog(observed: DataFrame, catalog: DataFrame, key: str, count: str = "n") -> DataFrame:
    """Catalog and observed keys together; keys without observations count 0."""
    return catalog.join(observed, key, "full_outer").withColumn(count, F.coalesce(count, F.lit(0)).cast("long"))


def key_differences(expected: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """Keys in one of two sets only, with the side that has them; NULL is a key like others. Both sides are grouped at once."""
    side = lambda df, x: df.select(*keys, F.lit(x).alias("side"))
    both = dealt(side(expected, "missing").unionByName(side(observed, "unexpected")), *keys)
    one = both.groupBy(*keys).agg(F.min("side").alias("side"), F.max("side").alias("_s"))
    return one.where("side = _s").drop("_s")


def day_pair(df: DataFrame, keys: list[str], day: str, value: str, first: Column, second: Column) -> DataFrame:
    """Two days side by side."""
    return df.groupBy(*keys).agg(
        F.max(F.when(F.col(day) == first, F.col(value))).alias("before"), F.max(F.when(F.col(day) == second, F.col(value))).alias("after")
    ).where("before is not null or after is not null")


def six_digits(c: Column) -> Column:
    """A double as `%.6f` has it, with 0 for -0. Numbers below 10^11 go by way of a decimal, which rounds the same digits
    in a tenth of the time; what has no decimal (NaN, infinities) or loses its sign there (-0.000000) is formatted."""
    plain = (F.abs(c) < 1e11) & ((c >= 0) | (c <= -1e-6))
    return F.when(plain, c.cast("decimal(18,6)").cast("string")).when(c.isNotNull(), F.format_string("%.6f", c))


def canonical(df: DataFrame, fields: list[str] | None = None) -> Column:
    """A row as text: each field with its length in front, `-` for NULL; floats with six digits, times as microseconds."""
    parts = []
    for f in fields or df.columns:
        c, kind = F.col(f"`{f}`"), df.schema[f].dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            c = six_digits(c.cast("double"))
        elif isinstance(kind, T.TimestampType):
            c = F.unix_micros(c).cast("string")
        elif isinstance(kind, T.TimestampNTZType):
            c = F.unix_micros(c.cast("timestamp")).cast("string")
        elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            c = F.when(c.isNotNull(), F.to_json(F.struct(c.alias("v"))))
        else:
            c = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(c), F.lit(":"), c), F.lit("-")))  # no branch of its own, so c is made once
    return F.concat(*parts)


def row_hash(df: DataFrame) -> Column:
    """The first 60 bits of the SHA-256 of canonical rows."""
    return F.conv(F.substring(F.sha2(canonical(df), 256), 1, 15), 16, 10).cast("long").cast("decimal(38,0)")


def table_fingerprint(df: DataFrame) -> DataFrame:
    """(n, fingerprint) of a table whatever its order: hashes of canonical rows are added in 38 digits, so copies count."""
    return df.select(row_hash(df).alias("h")).agg(F.count("*").alias("n"), F.coalesce(F.sum("h"), F.lit(0)).cast("string").alias("fingerprint"))


def changed_tables(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tables whose (n, fingerprint) differ between two snapshots, or that only one of them has."""
    a = before.select("table", F.struct("n", "fingerprint").alias("_a"))
    b = after.select("table", F.struct("n", "fingerprint").alias("_b"))
    return a.join(b, "table", "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b"))).select("table")


def series_digest(df: DataFrame, keys: list[str], order: str, fields: list[str], part: Column) -> DataFrame:
    """SHA-256 over the digests of a series' parts, in order; a part's digest is over its canonical rows in order. Parts
    (such as years) bound what is gathered in one place."""
    rows = df.select(*keys, part.alias("_p"), F.struct(order, canonical(df, fields).alias("row")).alias("_r"))
    parts = rows.groupBy(*keys, "_p").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("_r"))["row"], ";"), 256).alias("d"), F.count("*").alias("n"))
    whole = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_p", "d"))).alias("_d"), F.sum("n").alias("n"))
    return whole.select(*keys, F.sha2(F.array_join("_d.d", ";"), 256).alias("digest"), "n")
