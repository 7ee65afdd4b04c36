"""Incremental forms: closed-bar windows, exactly-once keys, late revisions, contiguity and running indicators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from marketlens.operators.reconcile import last_writes, revisions, upsert

MARGIN = "10 minutes"


def closed_bars(stream: DataFrame, at: str, keys: list[str], value: str, width: str = "5 minutes", margin: str = MARGIN) -> DataFrame:
    """Bars of a fixed grid; in append mode a bar comes out once it is closed for the margin."""
    w = stream.withWatermark(at, margin).groupBy(F.window(at, width).alias("w"), *keys)
    g = w.agg(F.min_by(value, at).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"), F.max_by(value, at).alias("close"), F.count("*").alias("n"))
    return g.select(*keys, F.col("w.start").alias("start"), "open", "high", "low", "close", "n")


def daily_grid(stream: DataFrame, at: str, keys: list[str], margin: str = MARGIN) -> DataFrame:
    return stream.withWatermark(at, margin).groupBy(F.window(at, "1 day").alias("w"), *keys).agg(F.count("*").alias("n")).select(*keys, F.to_date("w.start").alias("day"), "n")


def once_per_key(stream: DataFrame, at: str, keys: list[str], margin: str = MARGIN) -> DataFrame:
    """Each natural key once; replays within the margin are dropped."""
    return stream.withWatermark(at, margin).dropDuplicatesWithinWatermark(keys)


def coverage_sessions(stream: DataFrame, at: str, keys: list[str], step: str, margin: str = MARGIN) -> DataFrame:
    """Contiguous runs: a session ends when no row follows within the step."""
    g = stream.withWatermark(at, margin).groupBy(F.session_window(at, step).alias("w"), *keys).agg(F.count("*").alias("slots"))
    return g.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "slots")


#: Parts of a revised table; a batch rewrites the parts that it touches.
BUCKETS = 64


def latest_parts(spark, path: str, before: int | None = None) -> DataFrame:
    """The table that revise_batch keeps: of each part its last version (below `before`), with the columns _b and _v."""
    rows = spark.read.option("basePath", path).parquet(path)
    rows = rows if before is None else rows.where(F.col("_v") < before)
    last = rows.groupBy("_b").agg(F.max("_v").alias("_v"))  # at most BUCKETS rows
    return rows.join(F.broadcast(last), ["_b", "_v"])


def revise_batch(path: str, log: str, keys: list[str], fields: list[str], order: str, first: int = 0) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: late or corrected rows are written over, and what they replace goes to a revision log.

    Of several rows of a key the one with the largest `order` (arrival) is written, of equal ones the largest row. The
    table is kept in parts by the keys' hash; a batch writes a new version of each part that it touches
    (path/_b=<part>/_v=<first + batch>), so that a batch that is run again gives the same tables. `first` is the
    number of versions written by earlier streams into the table.
    """
    columns = [*keys, *fields]

    def write(batch: DataFrame, number: int) -> None:
        spark, version = batch.sparkSession, first + number
        new = last_writes(batch.select(*columns, F.col(order).alias("_order")), keys, "_order").select(*columns)
        new = new.withColumn("_b", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))
        if version > 0:
            touched = new.select("_b").distinct()  # at most BUCKETS rows
            old = latest_parts(spark, path, version).join(F.broadcast(touched), "_b", "left_semi").select(*columns, "_b")
            revisions(old, new, keys, fields).write.mode("overwrite").parquet(f"{log}/v={version}")
            new = upsert(old, new, keys)
        parts = new.withColumn("_v", F.lit(version)).repartition("_b").write.partitionBy("_b", "_v")
        parts.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)

    return write


class InOrder(StatefulProcessor):
    """A key's rows in event-time order, each once, whatever triggers they come in.

    Rows wait in state until the watermark has passed them, each with a timer of its own; timers fire in order of time, so
    a key's rows are never gathered in one frame. What waits is bounded by the margin. A time that comes again overwrites
    what waits, or is dropped once it was passed. A key without rows for `idle` milliseconds loses its state.
    """

    #: Schema and start of the running state, and the columns that `follow` gives behind the key and the time.
    STATE, START = "", ()

    def __init__(self, columns: list[str], at: str, value: str | None, idle: int):
        self.columns, self.at, self.value, self.idle = columns, at, value, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at long", "value double")
        self.running = handle.getValueState("running", f"last_at long, {self.STATE}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            times = (pdf[self.at].astype("int64") // {"ns": 10**6, "us": 10**3, "ms": 1, "s": 1}[pdf[self.at].dt.unit]).tolist()
            values = pdf[self.value].astype(float).tolist() if self.value else [0.0] * len(times)
            for t, v in zip(times, values):
                if t > passed:
                    self.waiting.updateValue((t,), (v,))
                    self.handle.registerTimer(t)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        t = expiredTimerInfo.getExpiryTimeInMs()
        before = self.running.get() if self.running.exists() else None
        if self.waiting.containsKey((t,)):
            (value,) = self.waiting.getValue((t,))
            self.waiting.removeKey((t,))
            last, state = (before[0], tuple(before[1:])) if before else (None, self.START)
            out, state = self.follow(t, value, last, state)
            self.running.update((t, *state))
            self.handle.registerTimer(t + self.idle)
            yield pd.DataFrame([(*key, pd.Timestamp(t, unit="ms"), *out)], columns=self.columns)
        elif before and before[0] + self.idle <= t:
            self.running.clear()

    def follow(self, t: int, value: float, last: int | None, state: tuple) -> tuple[tuple, tuple]:
        raise NotImplementedError

    def close(self) -> None:
        pass


class Contiguity(InOrder):
    STATE, START = "n long", (0,)

    def __init__(self, step: int, *args):
        super().__init__(*args)
        self.step = step

    def follow(self, t, value, last, state):
        kind = "first" if last is None else "next" if t == last + self.step else "gap" if t > last + self.step else "overlap"
        return (kind,), (state[0] + 1,)


class Running(InOrder):
    STATE, START = "n long, last double, ema double, gain double, loss double", (0, 0.0, 0.0, 0.0, 0.0)

    def __init__(self, n: int, p: int, *args):
        super().__init__(*args)
        self.n, self.p = n, p

    def follow(self, t, value, last, state):
        i, before, ema, gain, loss = state
        n, p, f = self.n, self.p, 2 / (self.n + 1)
        i += 1
        ema = ema + value / n if i <= n else ema * (1 - f) + value * f
        if i > 1:
            up, down = max(value - before, 0.0), max(before - value, 0.0)
            gain = gain + up / p if i <= p + 1 else (gain * (p - 1) + up) / p
            loss = loss + down / p if i <= p + 1 else (loss * (p - 1) + down) / p
        rsi = None if i <= p else 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss)
        return (ema if i >= n else None, rsi), (i, value, ema, gain, loss)


def _in_order(stream: DataFrame, key: str, at: str, processor: InOrder, more: str, margin: str) -> DataFrame:
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # the store that timers need
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.withWatermark(at, margin).groupBy(key)
    return rows.transformWithStateInPandas(processor, f"{key} {kind}, {at} timestamp, {more}", "append", "eventTime")


#: State of a key goes after so many days without rows.
IDLE_DAYS = 400


def contiguity(stream: DataFrame, key: str, at: str, step: int, margin: str = MARGIN, idle_days: int = IDLE_DAYS) -> DataFrame:
    """For each time of a key, once the margin has passed, whether it follows the last one by `step` seconds: `first`,
    `next`, `gap` or `overlap` (nearer than a step)."""
    columns = [key, at, "kind"]
    return _in_order(stream.select(key, at), key, at, Contiguity(step * 1000, columns, at, None, idle_days * 86_400_000), "kind string", margin)


def running_indicators(stream: DataFrame, key: str, at: str, close: str, n: int = 12, p: int = 14, margin: str = MARGIN, idle_days: int = IDLE_DAYS) -> DataFrame:
    """EMA(n) and Wilder RSI(p) of each bar, once the margin has passed (state: counts, sums, averages, the last close)."""
    columns = [key, at, "ema", "rsi"]
    return _in_order(stream.select(key, at, close), key, at, Running(n, p, columns, at, close, idle_days * 86_400_000), "ema double, rsi double", margin)


def staleness(latest: DataFrame, at: str, now, budget) -> DataFrame:
    """Freshness state of each row of a state table."""
    from marketlens.functions.scalars import freshness

    return latest.withColumn("state", freshness(now - F.col(at), budget))
