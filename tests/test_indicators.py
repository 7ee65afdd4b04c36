"""Indicators on golden vectors and against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketlens.operators import indicators as ind

# fixed values: closes with known RSI(14)
CLOSES = [44.34, 44.09, 44.15, 43.61, 44.33, 44.83, 45.10, 45.42, 45.84, 46.08, 45.89, 46.03, 45.61, 46.28, 46.28, 46.00, 46.03, 46.41, 46.22, 45.64]


def bars(spark, closes, symbol="x"):
    rows = [(symbol, dt.date(2024, 1, 1) + dt.timedelta(i), c, c + 1, c - 1, c, 10) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, day date, open double, high double, low double, close double, volume long")


def values(df, col):
    return [r[0] for r in df.orderBy("symbol", "day").select(col).collect()]


def test_rsi_golden(spark):
    got = values(ind.rsi(bars(spark, CLOSES)), "rsi14")
    assert got[:14] == [None] * 14
    assert got[14] == pytest.approx(70.4641350211, abs=1e-6) and got[15] == pytest.approx(66.2496185536, abs=1e-6)


def test_flat_prices_give_100_and_short_series_null(spark):
    assert values(ind.rsi(bars(spark, [5.0] * 20)), "rsi14")[-1] == 100.0
    assert values(ind.rsi(bars(spark, [1.0, 2.0, 3.0])), "rsi14") == [None] * 3


def test_sma(spark):
    b = bars(spark, [float(i) for i in range(1, 11)])
    assert values(ind.sma(b, 5), "sma5")[-1] == 8.0 and values(ind.sma(b, 10), "sma10")[-1] == 5.5
    assert values(ind.sma(b, 20), "sma20") == [None] * 10


def test_ema_in_chunks_equals_one_pass(spark):
    rng = random.Random(1)
    closes = [100 + rng.random() * 10 for _ in range(60)]
    one = values(ind.ema(bars(spark, closes), 12), "ema12")
    many = values(ind.ema(bars(spark, closes), 12, chunk=7), "ema12")
    y, k, want = sum(closes[:12]) / 12, 2 / 13, [None] * 11
    want.append(y)
    for c in closes[12:]:
        y = y * (1 - k) + c * k
        want.append(y)
    assert one[:11] == many[:11] == [None] * 11
    assert one[11:] == pytest.approx(want[11:]) and many[11:] == pytest.approx(want[11:])


def plain_macd(closes):
    """The rule bar by bar, in plain Python: means seeded by plain means; the line begins behind the first 26 bars."""

    def means(xs, n):
        out, k = [None] * len(xs), 2 / (n + 1)
        for i in range(n - 1, len(xs)):
            out[i] = sum(xs[:n]) / n if i == n - 1 else out[i - 1] * (1 - k) + xs[i] * k
        return out

    fast, slow = means(closes, 12), means(closes, 26)
    line = [fast[i] - slow[i] for i in range(26, len(closes))]
    return [None] * 26 + line, [None] * 26 + means(line, 9)


@pytest.mark.parametrize("chunk", [4096, 7])
def test_macd(spark, chunk):
    rng = random.Random(7)
    closes = [50 + rng.random() * 9 for _ in range(70)]
    line, signal = plain_macd(closes)
    got = ind.macd(bars(spark, closes), chunk=chunk).orderBy("day").collect()
    assert [r["macd"] for r in got] == pytest.approx(line) and [r["macd_signal"] for r in got] == pytest.approx(signal)
    assert [r["macd_signal"] is None for r in got] == [True] * 34 + [False] * 36
    assert got[-1]["macd_hist"] == pytest.approx(line[-1] - signal[-1])
    plan = ind.macd(bars(spark, closes))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 4  # bars and counts, for the rows and for the ends of stretches


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf"), float("-inf")])
def test_rsi_ends_at_the_first_unusable_close(spark, bad):
    b = bars(spark, CLOSES)
    late = b.withColumn("close", F.when(F.col("day") == dt.date(2024, 1, 17), F.lit(bad).cast("double")).otherwise(F.col("close")))
    got = values(ind.rsi(late, chunk=5), "rsi14")
    assert got[14:16] == pytest.approx([70.4641350211, 66.2496185536], abs=1e-6) and got[16:] == [None] * 4
    early = b.withColumn("close", F.when(F.col("day") == dt.date(2024, 1, 3), F.lit(bad).cast("double")).otherwise(F.col("close")))
    assert values(ind.rsi(early, chunk=5), "rsi14") == [None] * 20


def test_missing_values_are_skipped_by_means(spark):
    closes = CLOSES[:9] + [None] + CLOSES[9:]
    got, whole = values(ind.ema(bars_with_gaps(spark, closes), 12, chunk=5), "ema12"), values(ind.ema(bars(spark, CLOSES), 12), "ema12")
    assert got[9] is None and got[10:] == pytest.approx(whole[9:])


def bars_with_gaps(spark, closes):
    b = bars(spark, [c or 1.0 for c in closes])
    gaps = [dt.date(2024, 1, 1) + dt.timedelta(i) for i, c in enumerate(closes) if c is None]
    return b.withColumn("close", F.when(~F.col("day").isin(gaps), F.col("close")))


def test_extremes_ties_go_to_the_latest_day(spark):
    b = bars(spark, [10.0, 20.0, 5.0, 20.0, 8.0])
    r = ind.extremes(b, F.col("day") >= F.lit("2024-01-03").cast("date")).first()
    assert r["ath"] == 20 and r["ath_day"] == dt.date(2024, 1, 4) and r["low_52w"] == 5 and r["drawdown_pct"] == -60


def test_levels(spark):
    rows = [("support", 12.5), ("support", 9.25), ("support", 7.0), ("support", 3.0), ("support", 1.5), ("support", 12.5), ("support", 21.0), ("support", -1.0), ("resistance", 17.0), ("resistance", 30.5), ("resistance", 11.0), ("resistance", float("nan"))]
    levels = spark.createDataFrame([("x", *r) for r in rows], "symbol string, kind string, level double")
    price = spark.createDataFrame([("x", 15.0), ("y", None)], "symbol string, price double")
    got = ind.price_levels(levels, price).orderBy("kind", "rank").select("kind", "level").collect()
    assert [tuple(r) for r in got] == [("resistance", 17.0), ("resistance", 30.5), *[("support", v) for v in (12.5, 9.25, 7.0, 3.0, 1.5)]]


def test_pivots_allow_an_absolute_slack(spark):
    base = [80_000.0 + 100 * abs(i - 5) for i in range(11)]
    level = {r["level"] for r in ind.pivots(bars(spark, base), 5).where("kind = 'support'").collect()}
    assert level == {80_000.0}
    near = [*base[:4], 80_000.0005, *base[5:]]
    assert {r["level"] for r in ind.pivots(bars(spark, near), 5).where("kind = 'support'").collect()} == {80_000.0}
    lower = [*base[:4], 79_990.0, *base[5:]]  # a tenth of a thousandth below is no support any more
    assert ind.pivots(bars(spark, lower), 5).where("kind = 'support'").count() == 0


def test_votes_use_long_means(spark):
    b = ind.ma_votes(bars(spark, [float(i) for i in range(1, 221)])).orderBy("day").collect()
    assert [b[i]["above"] for i in (18, 19, 49, 99, 199)] == [0, 1, 2, 3, 4]


def test_row_order_and_partitions_do_not_matter(spark):
    b = bars(spark, CLOSES * 3)
    a = values(ind.stochastic(ind.cci(b)), "pct_k")
    assert values(ind.stochastic(ind.cci(b.orderBy(F.rand(3)).repartition(5))), "pct_k") == a


@pytest.mark.parametrize("block", [3, 7, 1000])
def test_moving_windows_in_tiny_blocks(spark, block):
    """The same in stretches of 7 days and blocks of a few rows as in one window over a series."""
    from pyspark.sql import Window

    rng = random.Random(block)
    b = bars(spark, [round(50 + rng.random() * 9, 2) for _ in range(90)]).unionByName(bars(spark, [7.0] * 40, None))
    cuts = {"chunk": 7, "block": block}
    w = lambda lo, hi=0: Window.partitionBy("symbol").orderBy("day").rowsBetween(lo, hi)
    same = lambda got, want: got.select("symbol", "day", F.round("x", 9)).exceptAll(want.select("symbol", "day", F.round("x", 9))).isEmpty() and got.count() == want.count() == 130
    assert same(ind.sma(b, 20, out="x", **cuts), b.withColumn("x", ind.full(F.col("close"), 20, w(-19), F.avg)))
    prev = F.lag("close").over(Window.partitionBy("symbol").orderBy("day"))
    assert same(ind.pct_change(b, out="x", **cuts), b.withColumn("x", (F.col("close") - prev) * 100 / prev))
    hi, lo = ind.full(F.col("high"), 14, w(-13), F.max), ind.full(F.col("low"), 14, w(-13), F.min)
    assert same(ind.williams_r(b, out="x", **cuts), b.withColumn("x", F.when(hi > lo, (F.col("close") - hi) / (hi - lo) * 100)))
    tr = b.withColumn("tr", F.when(prev.isNotNull(), F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - prev), F.abs(F.col("low") - prev))))
    assert same(ind.atr_sma(b, out="x", **cuts), tr.withColumn("x", ind.full(F.col("tr"), 14, w(-13), F.avg)))
    for out in ("pct_k", "pct_d"):
        assert same(ind.stochastic(b, true_d=True, **cuts).withColumnRenamed(out, "x"), ind.stochastic(b, true_d=True).withColumnRenamed(out, "x"))
    assert ind.stochastic(b, **cuts).where("pct_k is not null").count() == 75 + 25
    lows = b.withColumn("n", F.count("*").over(w(-10, 10))).withColumn("m", F.min("close").over(w(-10, 10))).where("n = 21 and m >= close - 0.001")
    got = ind.pivots(b, 10, **cuts).where("kind = 'support'").select("symbol", "level")
    assert sorted(got.collect(), key=repr) == sorted(lows.select("symbol", F.col("close").alias("level")).distinct().collect(), key=repr)


def test_stochastic_goes_back_over_flat_windows(spark):
    closes = [float(i % 9) for i in range(30)] + [5.0] * 40
    b = bars(spark, closes).withColumn("high", F.col("close")).withColumn("low", F.col("close"))
    got = ind.stochastic(b, chunk=5, block=4).orderBy("day").collect()
    assert got[-1]["pct_k"] == got[45]["pct_k"] is not None


def test_no_window_holds_a_whole_series(spark):
    b = bars(spark, CLOSES)
    for df in (ind.sma(b, 5), ind.stochastic(b), ind.cci(b), ind.pivots(b, 3)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        specs = [line for line in plan.splitlines() if " Window [" in line or line.strip().startswith("Window [")]
        assert specs and all("_c#" in s or "_b#" in s for s in specs)
