"""Technical indicators over many series at once.

Every function takes bars with key columns, an order column and values, and adds a column. NULL stands for an indicator
without enough data. No series is sorted in one task: rows get positions by stretches of the order column, moving windows
run over blocks of positions with the rows before (and behind) copied in, and recurrences are linear and run in stretches.
A frame that has positions already (see `placed`) keeps them for the next indicator.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.operators.store import stored
from marketlens.operators.stretches import BLOCK, cut, moving, own, positions, running_last, with_side

KEYS, ORDER = ["symbol"], "day"
#: Days (of a date), minutes (of a timestamp) or units (of a number) that a stretch of a recurrence covers.
CHUNK = 4096


def trailing(n: int, keys=KEYS, order=ORDER, ahead: int = 0):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), ahead)


def full(value: Column, n: int, w, agg) -> Column:
    """agg over the window if it holds n values, else NULL."""
    return F.when(F.count(value).over(w) == n, agg(value).over(w))


def _width(df: DataFrame, order: str, chunk: int) -> int:
    return chunk * 60 if isinstance(df.schema[order].dataType, (T.TimestampType, T.TimestampNTZType)) else chunk


def placed(df: DataFrame, keys=KEYS, order=ORDER, chunk: int = CHUNK) -> DataFrame:
    """Add each bar's position in its series, _pos."""
    return positions(cut(df, list(keys), order, _width(df, order, chunk)), list(keys), [order]).drop("_c")


def windowed(df: DataFrame, before: int, add: Callable, keys=KEYS, order=ORDER, after: int = 0, chunk: int = CHUNK, block: int | None = None) -> DataFrame:
    """add(rows, spec) with moving windows of up to `before` rows before and `after` rows behind each row; spec(lo, hi) is
    a window's spec. Blocks of positions are worked on apart."""
    known = "_pos" in df.columns
    rows, spec = moving(df if known else placed(df, keys, order, chunk), list(keys), before, after, block)
    out = own(add(rows, spec))
    return out if known else out.drop("_pos")


def sma(df: DataFrame, n: int, value: str = "close", out: str | None = None, keys=KEYS, order=ORDER, **cuts) -> DataFrame:
    """Mean of the last n values; NULL unless all n are there and not NULL."""
    return windowed(df, n - 1, lambda r, w: r.withColumn(out or f"sma{n}", full(F.col(value), n, w(1 - n), F.avg)), keys, order, **cuts)


def pct_change(df: DataFrame, value: str = "close", out: str = "pct", keys=KEYS, order=ORDER, **cuts) -> DataFrame:
    prev = lambda w: F.first(value).over(w(-1, -1))
    return windowed(df, 1, lambda r, w: r.withColumn(out, F.try_divide((F.col(value) - prev(w)) * 100, prev(w))), keys, order, **cuts)


def williams_r(df: DataFrame, n: int = 14, out: str = "williams_r", keys=KEYS, order=ORDER, **cuts) -> DataFrame:
    def add(r: DataFrame, w) -> DataFrame:
        hi, lo = full(F.col("high"), n, w(1 - n), F.max), full(F.col("low"), n, w(1 - n), F.min)
        return r.withColumn(out, F.when(hi > lo, (F.col("close") - hi) / (hi - lo) * 100))

    return windowed(df, n - 1, add, keys, order, **cuts)


def stochastic(df: DataFrame, n: int = 14, smooth: int = 3, true_d: bool = False, keys=KEYS, order=ORDER, chunk: int = CHUNK, block: int | None = None) -> DataFrame:
    """Slow stochastic: %K is the mean of the last `smooth` raw values of windows that are not flat; %D equals %K, or
    with true_d is the mean of the last `smooth` %K. Rows without a raw value have those of the last one."""
    keys, known = list(keys), "_pos" in df.columns

    def raw(r: DataFrame, w) -> DataFrame:
        hi, lo = full(F.col("high"), n, w(1 - n), F.max), full(F.col("low"), n, w(1 - n), F.min)
        return r.withColumn("_raw", F.when(hi > lo, (F.col("close") - lo) / (hi - lo) * 100))

    rows = windowed(df if known else placed(df, keys, order, chunk), n - 1, raw, keys, order, block=block)
    valid = rows.where("_raw is not null").select(*keys, F.col("_pos").alias("_at"), "_raw")
    mean = lambda value, out: lambda r, w: r.withColumn(out, full(F.col(value), smooth, w(1 - smooth), F.avg))
    valid = windowed(placed(valid, keys, "_at", block or BLOCK), smooth - 1, mean("_raw", "_k"), keys, "_at", block=block)
    valid = windowed(valid, smooth - 1, mean("_k", "_d"), keys, "_at", block=block) if true_d else valid.withColumn("_d", F.col("_k"))
    valid = valid.select(*keys, F.col("_at").alias("_pos"), F.struct(F.col("_k").alias("k"), F.col("_d").alias("d")).alias("_s"))
    rows = cut(with_side(rows, valid, [*keys, "_pos"]), keys, "_pos", block or BLOCK)
    rows = running_last(rows, keys, ["_pos"], F.col("_s"), "_v").withColumn("pct_k", F.col("_v.k")).withColumn("pct_d", F.col("_v.d"))
    return rows.drop("_raw", "_s", "_v", "_c", *([] if known else ["_pos"]))


def cci(df: DataFrame, n: int = 20, out: str = "cci", keys=KEYS, order=ORDER, **cuts) -> DataFrame:
    """(tp - mean) / (0.015 mean absolute deviation) over n bars; NULL for no deviation."""
    def add(r: DataFrame, w) -> DataFrame:
        r = r.withColumn("_tp", (F.col("high") + F.col("low") + F.col("close")) / 3)
        r = r.withColumn("_m", full(F.col("_tp"), n, w(1 - n), F.avg)).withColumn("_l", F.collect_list("_tp").over(w(1 - n)))
        dev = F.aggregate("_l", F.lit(0.0), lambda a, x: a + F.abs(x - F.col("_m"))) / n
        return r.withColumn(out, F.when(F.col("_m").isNotNull() & (dev > 0), (F.col("_tp") - F.col("_m")) / (0.015 * dev))).drop("_tp", "_m", "_l")

    return windowed(df, n - 1, add, keys, order, **cuts)


def atr_sma(df: DataFrame, n: int = 14, out: str = "atr_sma", keys=KEYS, order=ORDER, **cuts) -> DataFrame:
    """Simple mean of the last n true ranges (n + 1 bars)."""
    def add(r: DataFrame, w) -> DataFrame:
        prev = F.first("close").over(w(-1, -1))
        r = r.withColumn("_tr", F.when(prev.isNotNull(), F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - prev), F.abs(F.col("low") - prev))))
        return r.withColumn(out, full(F.col("_tr"), n, w(1 - n), F.avg)).drop("_tr")

    return windowed(df, n, add, keys, order, **cuts)


def pivots(df: DataFrame, lookback: int = 10, slack: float = 0.001, keys=KEYS, order=ORDER, **cuts) -> DataFrame:
    """Distinct closes that no close within lookback bars on both sides is below (above) by more than `slack`, an
    absolute amount: (keys, kind, level). Bars without a close are no levels and no hindrance to others."""
    def add(r: DataFrame, w) -> DataFrame:
        both = w(-lookback, lookback)
        return r.withColumn("_n", F.count("*").over(both)).withColumn("_lo", F.min("close").over(both)).withColumn("_hi", F.max("close").over(both))

    df = windowed(df, lookback, add, keys, order, after=lookback, **cuts)
    df = df.where(F.col("_n") == 2 * lookback + 1).where("close is not null and high is not null and low is not null")
    kinds = F.array(
        F.when(F.col("_lo") >= F.col("close") - slack, F.lit("support")),
        F.when(F.col("_hi") <= F.col("close") + slack, F.lit("resistance")),
    )
    return df.select(*keys, F.explode(F.array_compact(kinds)).alias("kind"), F.col("close").alias("level")).distinct()


def price_levels(levels: DataFrame, price: DataFrame, keys=KEYS) -> DataFrame:
    """All distinct supports below and resistances above a price, ranked from the price outwards. Only positive, finite
    levels and prices count."""
    usable = lambda c: F.col(c).isNotNull() & (F.col(c) > 0) & (F.col(c) < float("inf"))
    near = levels.where(usable("level")).distinct().join(price.where(usable("price")), keys).where(
        ((F.col("kind") == "support") & (F.col("level") < F.col("price"))) | ((F.col("kind") == "resistance") & (F.col("level") > F.col("price")))
    )
    rank = F.row_number().over(Window.partitionBy(*keys, "kind").orderBy(F.abs(F.col("level") - F.col("price"))))
    return near.withColumn("rank", rank.cast("long"))


def latest(df: DataFrame, keys=KEYS, order=ORDER) -> DataFrame:
    """The row of each key with the largest order value (ties: the largest row)."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in rest if c != order])).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in rest])


class Mean(NamedTuple):
    """A smoothed mean: the plain mean of the first n inputs, then decay * before + gain * input.

    The input is the value ("x"), its rise or fall ("up", "down"), or the difference of two earlier means (i, j); the
    first input is that of bar `skip` (from 0).
    """

    n: int
    decay: float
    gain: float
    source: str | tuple[int, int] = "x"
    skip: int = 0


def _run(means: list[Mean], value: str, order: str):
    """One stretch: each row's means if all had been 0 before it (_y), and what they owe to those before it (_m)."""
    d = len(means)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        xs, i, last = table[value].to_pylist(), table["_before"][0].as_py(), table["_last"][0].as_py()
        y, m, ys, ms = [0.0] * d, [[float(j == k) for k in range(d)] for j in range(d)], [], []
        for x in xs:
            if x is not None:
                for j, mean in enumerate(means):
                    r = i - mean.skip + 1
                    if r < 1:
                        continue
                    a, g = (1.0, 1 / mean.n) if r <= mean.n else (mean.decay, mean.gain)
                    if isinstance(mean.source, tuple):
                        p, q = mean.source
                        y[j] = a * y[j] + g * (y[p] - y[q])
                        m[j] = [a * own + g * (one - two) for own, one, two in zip(m[j], m[p], m[q])]
                    else:
                        u = x if mean.source == "x" else max(x - last, 0.0) if mean.source == "up" else max(last - x, 0.0)
                        y[j] = a * y[j] + g * u
                        m[j] = [a * own for own in m[j]]
                last = x
                i += 1
            ys.append(list(y))
            ms.append([v for row in m for v in row])
        doubles = pa.list_(pa.float64())
        index = pa.array(range(len(xs)), pa.int64())
        return table.append_column("_y", pa.array(ys, doubles)).append_column("_m", pa.array(ms, doubles)).append_column("_at", index)

    return run


def _fold(keys: list[str], d: int):
    """What comes into each stretch of a series, from the ends of those before it."""

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by("_c")
        y, came = [0.0] * d, []
        for end in table["_e"].to_pylist():
            came.append(y)
            y = [end["_y"][j] + sum(end["_m"][j * d + k] * y[k] for k in range(d)) for j in range(d)]
        return table.select([*keys, "_c"]).append_column("_in", pa.array(came, pa.list_(pa.float64())))

    return fold


def smoothed(df: DataFrame, means: list[Mean], outs: list[str], value: str = "close", keys=KEYS, order=ORDER, chunk: int = CHUNK) -> DataFrame:
    """Add linear recurrences over the rows that have a value: one column for each mean, NULL before its n inputs are
    there and where the value is NULL.

    Stretches are worked on by themselves, in one pass for all means; the ends of a series' stretches are folded, and
    each stretch's rows then take what comes into it. Equal to one pass up to rounding. How many values, and which
    last one, stand before a stretch is told by counts.
    """
    keys, d = list(keys), len(means)
    rows = cut(df, keys, order, _width(df, order, chunk)).withColumn("_x", F.col(value).cast("double"))
    sizes = rows.groupBy(*keys, "_c").agg(F.count("_x").alias("_n"), F.max_by("_x", F.when(F.col("_x").isNotNull(), F.col(order))).alias("_v"))
    earlier = Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, "_c", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.last("_v", ignorenulls=True).over(earlier).alias("_last"))
    rows = rows.join(sizes, [*keys, "_c"])
    out = T.StructType([*rows.schema.fields, *T._parse_datatype_string("_y array<double>, _m array<double>, _at long").fields])
    local = rows.groupBy(*keys, "_c").applyInArrow(_run(means, "_x", order), out)
    ends = local.groupBy(*keys, "_c").agg(F.max_by(F.struct("_y", "_m"), "_at").alias("_e"))
    into = T.StructType([*[df.schema[k] for k in keys], T.StructField("_c", T.LongType()), T.StructField("_in", T.ArrayType(T.DoubleType()))])
    carry = ends.groupBy(*keys).applyInArrow(_fold(keys, d), into)
    done = local.join(carry, [*keys, "_c"])
    upto = F.col("_before") + F.count("_x").over(Window.partitionBy(*keys, "_c").orderBy("_at"))
    done = done.withColumn("_i", upto)
    for j, (mean, name) in enumerate(zip(means, outs)):
        whole = F.col("_y")[j] + sum(F.col("_m")[j * d + k] * F.col("_in")[k] for k in range(d))
        done = done.withColumn(name, F.when(F.col("_x").isNotNull() & (F.col("_i") >= mean.n + mean.skip), whole))
    return done.select(*[c for c in df.columns if c not in outs], *outs)


def ema(df: DataFrame, n: int, value: str = "close", out: str | None = None, keys=KEYS, order=ORDER, chunk: int = CHUNK) -> DataFrame:
    """Exponential mean, seeded by the mean of the first n values; rows with a NULL value get NULL and are skipped."""
    return smoothed(df, [Mean(n, 1 - 2 / (n + 1), 2 / (n + 1))], [out or f"ema{n}"], value, keys, order, chunk)


def unusable(value: str) -> Column:
    """NULL, NaN or infinite."""
    v = F.col(value).cast("double")
    return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))


def rsi(df: DataFrame, p: int = 14, value: str = "close", out: str | None = None, keys=KEYS, order=ORDER, chunk: int = CHUNK) -> DataFrame:
    """Wilder RSI of every bar, seeded by the first p changes; no loss gives 100; NULL for p bars or fewer, and from the
    first bar on whose value is missing, NaN or infinite, as every later index would rest on it."""
    keys = list(keys)
    broken = df.groupBy(*keys).agg(F.min(F.when(unusable(value), F.col(order))).alias("_broken"))
    df = df.withColumn("_fine", F.when(~unusable(value), F.col(value).cast("double")))
    means = [Mean(p, (p - 1) / p, 1 / p, side, skip=1) for side in ("up", "down")]
    df = with_side(smoothed(df, means, ["_ag", "_al"], "_fine", keys, order, chunk), broken, keys)
    index = F.when(F.col("_al") == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + F.col("_ag") / F.col("_al")))
    fine = F.col("_ag").isNotNull() & (F.col("_broken").isNull() | (F.col(order) < F.col("_broken")))
    return df.withColumn(out or f"rsi{p}", F.when(fine, index)).drop("_ag", "_al", "_fine", "_broken")


def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, value: str = "close", keys=KEYS, order=ORDER, chunk: int = CHUNK) -> DataFrame:
    """MACD line from the bar behind the first `slow` on, its signal (an EMA seeded by the first `signal` values of the
    line, so from slow + signal bars on) and histogram."""
    plain = [Mean(n, 1 - 2 / (n + 1), 2 / (n + 1)) for n in (fast, slow)]
    over = Mean(signal, 1 - 2 / (signal + 1), 2 / (signal + 1), (0, 1), skip=slow)
    df = smoothed(df, [*plain, over, Mean(1, 0.0, 1.0, (0, 1), skip=slow)], ["_f", "_s", "macd_signal", "macd"], value, keys, order, chunk).drop("_f", "_s")
    return df.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))


def extremes(df: DataFrame, since: Column | None = None, value: str = "close", keys=KEYS, order=ORDER) -> DataFrame:
    """All-time high, and high and low since a day, each with its latest day, and the drawdowns."""
    since = F.lit(True) if since is None else since
    pick = F.struct(F.col(value).alias("v"), F.col(order).alias("d"))
    low = F.struct((-F.col(value)).alias("v"), F.col(order).alias("d"))
    g = df.groupBy(*keys).agg(
        F.max(pick).alias("ath"), F.max(F.when(since, pick)).alias("hi"), F.max(F.when(since, low)).alias("lo"), F.max_by(value, order).alias("last")
    )
    return g.select(
        *keys,
        F.col("ath.v").alias("ath"), F.col("ath.d").alias("ath_day"), F.col("hi.v").alias("high_52w"), F.col("hi.d").alias("high_day"),
        (-F.col("lo.v")).alias("low_52w"), F.col("lo.d").alias("low_day"),
        F.round((F.col("last") / F.col("ath.v") - 1) * 100, 4).alias("drawdown_pct"),
        F.round((-F.col("lo.v") / F.col("ath.v") - 1) * 100, 4).alias("ath_to_low_pct"),
    )


def ma_votes(df: DataFrame, periods=(20, 50, 100, 200), keys=KEYS, order=ORDER, **cuts) -> DataFrame:
    """How many of the moving averages the close is above and below."""
    def add(r: DataFrame, w) -> DataFrame:
        means = [full(F.col("close"), n, w(1 - n), F.avg).alias(f"_s{n}") for n in periods]
        r = r.select("*", *means)
        above = sum(F.when(F.col("close") > F.col(f"_s{n}"), 1).otherwise(0) for n in periods)
        below = sum(F.when(F.col("close") < F.col(f"_s{n}"), 1).otherwise(0) for n in periods)
        return r.withColumn("above", above.cast("long")).withColumn("below", below.cast("long")).drop(*[f"_s{n}" for n in periods])

    return windowed(df, max(periods) - 1, add, keys, order, **cuts)


#: The daily archive's metrics from a price series: name, unit.
ARCHIVED = {
    "price": "USD", "close_ts": "unix_s", "chg_24h": "%", "rsi_14": "ratio", "macd_hist": "USD", "atr_14": "USD", "stoch_k": "ratio", "williams_r": "ratio", "cci_20": "ratio",
    "sma_20": "USD", "sma_50": "USD", "sma_100": "USD", "sma_200": "USD", "ema_20": "USD", "ema_50": "USD", "sup_1": "USD", "sup_2": "USD", "res_1": "USD", "res_2": "USD",
    "ath": "USD", "high_52w": "USD", "low_52w": "USD", "from_ath": "%",
}


#: Bars that the moving windows of the archive look back at most; a block that holds any position.
TAIL, WHOLE = 256, 1 << 40


def metric_archive(bars: DataFrame, lookback: int = 20, keys=KEYS, order=ORDER) -> DataFrame:
    """Tidy rows (keys, report day, metric, value, unit, source) of the last bar of each series: its price, change and
    indicators, the two nearest pivots on both sides of the list's ends, and its extremes. Missing values have no row.

    Bars are read once and stored with their positions; moving windows see the last TAIL bars of each series only."""
    keys = list(keys)
    bars = stored(placed(bars.select(*keys, order, "high", "low", "close"), keys, order), "bars")
    tops = bars.groupBy(*keys).agg(F.max("_pos").alias("_top"), F.max(unusable("close")).alias("_broken"))
    b = with_side(bars, tops, keys).where(F.col("_pos") > F.col("_top") - TAIL)
    at = {"keys": keys, "order": order, "block": WHOLE}
    b = pct_change(b, out="chg_24h", **at)
    for n in (20, 50, 100, 200):
        b = sma(b, n, out=f"sma_{n}", **at)
    b = cci(williams_r(atr_sma(b, out="atr_14", **at), **at), out="cci_20", **at).where("_pos = _top")
    means = [Mean(20, 1 - 2 / 21, 2 / 21), Mean(50, 1 - 2 / 51, 2 / 51), Mean(12, 1 - 2 / 13, 2 / 13), Mean(26, 1 - 2 / 27, 2 / 27), Mean(9, 0.8, 0.2, (2, 3), skip=26), Mean(1, 0.0, 1.0, (2, 3), skip=26), Mean(14, 13 / 14, 1 / 14, "up", 1), Mean(14, 13 / 14, 1 / 14, "down", 1)]
    names = ["ema_20", "ema_50", "_f", "_s", "_signal", "_line", "_up", "_down"]
    run = smoothed(bars, means, names, keys=keys, order=order)
    run = latest(run.select(*keys, order, *names), keys, order).drop(order)
    slow = latest(stochastic(bars, keys=keys, order=order).select(*keys, order, "pct_k"), keys, order).drop(order)
    b = with_side(with_side(b, run, keys), slow, keys).withColumn("macd_hist", F.col("_line") - F.col("_signal"))
    b = b.withColumn("rsi_14", F.when(F.col("_down") == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + F.col("_up") / F.col("_down"))))
    b = b.withColumn("rsi_14", F.when(~F.col("_broken"), F.col("rsi_14")))
    last = b.withColumn("price", F.col("close")).withColumn("stoch_k", F.col("pct_k")).withColumn("close_ts", F.unix_timestamp(F.col(order).cast("timestamp")).cast("double"))
    levels = pivots(bars, lookback, keys=keys, order=order)
    rank = F.row_number().over(Window.partitionBy(*keys, "kind").orderBy(F.desc("level")))
    ends = levels.withColumn("_r", rank).where("_r <= 2")
    at = lambda kind, r: F.max(F.when((F.col("kind") == kind) & (F.col("_r") == r), F.col("level")))
    ends = ends.groupBy(*keys).agg(at("support", 1).alias("sup_1"), at("support", 2).alias("sup_2"), at("resistance", 1).alias("res_1"), at("resistance", 2).alias("res_2"))
    top = bars.groupBy(*keys).agg(F.max(order).alias("_last"))
    year = bars.join(top, keys)
    year = extremes(year, F.col(order) >= F.date_sub("_last", 364), keys=keys, order=order).select(*keys, "ath", "high_52w", "low_52w", F.col("drawdown_pct").alias("from_ath"))
    wide = last.join(ends, keys, "left").join(year, keys, "left")
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"), F.lit(u).alias("unit")) for n, u in ARCHIVED.items()])
    computed = F.col("metric").isin("sup_1", "sup_2", "res_1", "res_2")
    long = wide.select(*keys, F.col(order).alias("report_date"), F.inline(rows)).where("value is not null")
    return long.withColumn("source", F.when(computed, "computed").otherwise("bars"))


def observed_metrics(values: DataFrame, catalog: DataFrame, series: str, day: str, value: str) -> DataFrame:
    """The same tidy rows (asset, report_date, metric, value, unit, source) of monthly series, macro or on-chain ones.

    catalog: series, asset, metric, kind, scale, unit, source (a small table of rules). Kinds: `level` is the last value,
    `change` the last less that of the month before, `yoy` the change in percent against the same month a year before; each
    times scale. A value that cannot be told has no row.
    """
    rows = values.select(F.col(series).alias("series"), F.col(day).alias("report_date"), F.col(value).alias("v"), (F.year(day) * 12 + F.month(day)).alias("_m"))
    last = rows.groupBy("series").agg(F.max_by(F.struct("report_date", "v", "_m"), "report_date").alias("_l")).select("series", "_l.*")
    wanted = last.join(F.broadcast(catalog), "series")
    before = rows.select("series", F.col("_m").alias("_then"), F.col("v").alias("_before"))
    back = F.when(F.col("kind") == "change", 1).when(F.col("kind") == "yoy", 12)
    j = wanted.withColumn("_then", F.col("_m") - back).join(before, ["series", "_then"], "left")
    told = F.when(F.col("kind") == "level", F.col("v")).when(F.col("kind") == "change", F.col("v") - F.col("_before")).when(F.col("kind") == "yoy", F.try_divide(F.col("v"), F.col("_before")) * 100 - 100)
    j = j.withColumn("value", told * F.col("scale")).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return j.select("asset", "report_date", "metric", "value", "unit", "source")
