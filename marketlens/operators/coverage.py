"""Coverage of series in time: grids, gaps, windows, backlogs, chronology."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.operators.stretches import cut, lagged, positions, running_before, segments, with_side


def grid(bounds: DataFrame, step: int, first: str = "first", last: str = "last", out: str = "slot") -> DataFrame:
    """Each key's slots from first to last (epoch seconds, inclusive)."""
    return bounds.withColumn(out, F.explode(F.sequence(F.col(first), F.col(last), F.lit(step).cast("long"))))


def missing_slots(observed: DataFrame, bounds: DataFrame, keys: list[str], step: int, slot: str = "slot") -> DataFrame:
    return grid(bounds, step, out=slot).select(*keys, slot).join(observed.select(*keys, slot), [*keys, slot], "left_anti")


def merge_runs(slots: DataFrame, keys: list[str], step: int, slot: str = "slot", most: int | None = None, width: float | None = None) -> DataFrame:
    """Consecutive slots (distinct in a series) as half-open windows [start, end), of at most `most` slots each."""
    rows = lagged(cut(slots.select(*keys, slot), keys, slot, width), keys, [slot], F.col(slot), "_before")
    opens = F.col("_before").isNull() | (F.col(slot) - F.col("_before") != step)
    runs = segments(rows, keys, [slot], opens, F.col(slot), F.col(slot) + step).withColumnRenamed("n", "slots")
    return split_runs(runs, step, most) if most else runs


def split_runs(runs: DataFrame, step: int, most: int) -> DataFrame:
    """Windows of `step` units a slot cut into ones of at most `most` slots."""
    size = most * step
    parts = runs.withColumn("start", F.explode(F.sequence(F.col("start"), F.col("end") - step, F.lit(size).cast("long"))))
    parts = parts.withColumn("end", F.least(F.col("start") + size, F.col("end")))
    return parts.withColumn("slots", ((F.col("end") - F.col("start")) / step).cast("long"))


def missing_windows(observed: DataFrame, keys: list[str], step: int, slot: str = "slot", width: float | None = None) -> DataFrame:
    """Windows [start, end) without a slot between two neighbours of a series, from the neighbours alone: no grid is made.
    Slots are on the grid of `step`; repeated ones do not matter."""
    rows = lagged(cut(observed.select(*keys, slot), keys, slot, width), keys, [slot], F.col(slot), "_before")
    gaps = rows.where(F.col(slot) - F.col("_before") > step)
    return gaps.select(*keys, (F.col("_before") + step).alias("start"), F.col(slot).alias("end"), ((F.col(slot) - F.col("_before")) / step - 1).cast("long").alias("slots"))


def gap_candidates(observed: DataFrame, keys: list[str], step: int, budget: int = 10_000, slot: str = "slot", width: float | None = None) -> DataFrame:
    """Missing windows between a key's first and last slot; a key off its grid, or over the budget, is BLOCKED."""
    b = observed.groupBy(*keys).agg(
        F.min(slot).alias("first"), F.max(slot).alias("last"), F.count_if(F.pmod(F.col(slot), F.lit(step)) != 0).alias("drift")
    )
    b = b.withColumn("expected", ((F.col("last") - F.col("first")) / step + 1).cast("long"))
    state = F.when(F.col("drift") > 0, "BLOCKED_DRIFT").when(F.col("expected") > budget, "BLOCKED_BUDGET").otherwise("OK")
    b = b.select(*keys, state.alias("state"))
    fine = with_side(observed, b, keys).where("state = 'OK'")
    windows = missing_windows(fine, keys, step, slot, width)
    return with_side(b, windows.select(*keys, F.struct("start", "end", "slots").alias("_w")), keys).select(*keys, "state", "_w.*")


def interval_union(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", width: float | None = None) -> DataFrame:
    """Overlapping or touching windows as one, with how many there were."""
    order = [start, end]
    rows = running_before(cut(df.select(*keys, start, end), keys, start, width), keys, order, F.col(end), "_before")
    opens = F.col("_before").isNull() | (F.col(start) > F.col("_before"))
    return segments(rows, keys, order, opens, F.col(start), F.col(end)).withColumnRenamed("n", "windows")


def subtract_windows(windows: DataFrame, done: DataFrame, keys: list[str], start: str = "start", end: str = "end", width: float | None = None) -> DataFrame:
    """What windows [start, end) cover and done ones do not, cut where a window begins or ends.

    A sweep over boundary events: each window is +1 at its start and -1 at its end, on its own side. Events of one place
    are added up, and between two neighbours the running depths tell what is covered. Both sides are multisets; windows
    may overlap, touch, hold or split one another. Empty windows (end <= start, or a null bound) are ignored.
    """
    def events(df: DataFrame, a: int, b: int) -> DataFrame:
        df = df.where(F.col(start) < F.col(end))
        both = F.array(F.struct(F.col(start).alias("at"), F.lit(a).alias("a"), F.lit(b).alias("b")), F.struct(F.col(end).alias("at"), F.lit(-a).alias("a"), F.lit(-b).alias("b")))
        return df.select(*keys, F.inline(both))

    e = events(windows, 1, 0).unionByName(events(done, 0, 1)).groupBy(*keys, "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    e = cut(e, keys, "at", width)
    e = lagged(e, keys, ["at"], F.col("at"), "from")
    e = running_before(e, keys, ["at"], F.col("a"), "_wanted", F.sum)
    e = running_before(e, keys, ["at"], F.col("b"), "_done", F.sum)
    return e.where("_wanted > 0 and _done = 0").select(*keys, F.col("from").alias("start"), F.col("at").alias("end"))


def session_calendar(days: DataFrame, calendar: str, day: str, width: float | None = 4096) -> DataFrame:
    """(calendar, day, rank): how many sessions a calendar has had up to each of its sessions. Where a row says `open` is
    false the day is closed. Expected sessions between two days are then a subtraction of ranks."""
    open_days = days.where("open").select(F.col(calendar).alias("calendar"), F.col(day).alias("day")).distinct()
    return positions(cut(open_days, ["calendar"], "day", width), ["calendar"], ["day"], "rank").select("calendar", "day", (F.col("rank") + 1).alias("rank"))


def session_gaps(df: DataFrame, series: DataFrame, calendars: DataFrame, keys: list[str], day: str, sample: int = 40, width: float | None = 4096) -> DataFrame:
    """(keys, gap_count, sample): sessions inside each series without an observation, and the first of them.

    series: keys, calendar (NULL: every day is a session), required. Where a calendar is required and unknown, the gaps
    are NULL: nobody can tell them. Observations on closed days do not count. calendars: see session_calendar.
    """
    known = calendars.groupBy("calendar").agg(F.lit(True).alias("_known"))
    s = with_side(series.select(*keys, "calendar", "required"), known, ["calendar"])
    seen = with_side(df.select(*keys, F.col(day).alias("day")).distinct(), s, keys)
    every = seen.where("calendar is null and not required").withColumn("rank", F.unix_date("day").cast("long"))
    ranked = seen.where("_known").join(calendars, ["calendar", "day"]).select(*every.columns)
    rows = lagged(cut(every.unionByName(ranked), keys, "day", width), keys, ["day"], F.col("rank"), "_r")
    # each gap with the number of missing sessions before it in its series
    gaps = rows.withColumn("missing", F.coalesce(F.col("rank") - F.col("_r") - 1, F.lit(0)))
    total = gaps.groupBy(*keys).agg(F.sum("missing").alias("gap_count"))
    holes = running_before(gaps.where("missing > 0"), keys, ["day"], F.col("missing"), "_before", F.sum).where(F.col("_before") < sample)
    holes = holes.withColumn("_to", F.least(F.col("rank") - 1, F.col("_r") + sample - F.col("_before")))
    holes = holes.select(*keys, "calendar", F.explode(F.sequence(F.col("_r") + 1, "_to")).alias("rank"))  # `sample` a series at most
    named = holes.where("calendar is null").select(*keys, F.date_from_unix_date(F.col("rank").cast("int")).alias("day"))
    named = named.unionByName(holes.join(calendars, ["calendar", "rank"]).select(*keys, "day"))
    told = named.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(F.col("day").cast("string"))), ",").alias("sample"))
    out = with_side(with_side(s, total, keys), told, keys)
    unknown = F.col("required") & F.col("_known").isNull()
    return out.select(*keys, F.when(~unknown, F.coalesce("gap_count", F.lit(0))).alias("gap_count"), F.when(~unknown, F.coalesce("sample", F.lit(""))).alias("sample"))


def internal_gaps_daily(df: DataFrame, keys: list[str], day: str, sample: int = 40, width: float | None = 4096) -> DataFrame:
    """Missing days inside each series and the first `sample` of them."""
    series = df.select(*keys).distinct().select(*keys, F.lit(None).cast("string").alias("calendar"), F.lit(False).alias("required"))
    none = df.sparkSession.createDataFrame([], "calendar string, day date, rank long")
    return session_gaps(df, series, none, keys, day, sample, width)


def internal_gaps_monthly(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    m = F.year(day) * 12 + F.month(day)
    b = df.groupBy(*keys).agg((F.max(m) - F.min(m) + 1 - F.count_distinct(m)).cast("long").alias("gap_count"))
    return b


def tile(bounds: DataFrame, width: int, first: str = "first", last: str = "last") -> DataFrame:
    """[start, end) windows of `width` units over [first, last), the last one short."""
    starts = F.sequence(F.col(first), F.greatest(F.col(last) - 1, F.col(first)), F.lit(width).cast("long"))
    t = bounds.where(F.col(last) > F.col(first)).withColumn("start", F.explode(starts))
    return t.withColumn("end", F.least(F.col("start") + width, F.col(last)))


def round_robin(df: DataFrame, series: list[str], order: str) -> DataFrame:
    """Position in a fair order: first windows of all series, then second ones."""
    turn = F.row_number().over(Window.partitionBy(*series).orderBy(order))
    return df.withColumn("turn", turn.cast("long"))


def backlog(df: DataFrame, keys: list[str], at: str, now: Column, step: int, page: int, margin: int = 600) -> DataFrame:
    """Next start, closed intervals that wait, pages needed and status of each stream."""
    b = df.groupBy(*keys).agg((F.max(at) + step).alias("next_start"))
    closed = (now - margin) - F.pmod(now - margin, F.lit(step))
    b = b.withColumn("waiting", F.greatest(((closed - F.col("next_start")) / step).cast("long"), F.lit(0).cast("long")))
    b = b.withColumn("pages", F.ceil(F.col("waiting") / page).cast("long"))
    return b.withColumn("status", F.when(F.col("waiting") == 0, "CURRENT").when(F.col("pages") <= 1, "ONE_PAGE").otherwise("BACKLOG"))


def backward_candidate(df: DataFrame, keys: list[str], at: str, floor: Column, step: int, page: int) -> DataFrame:
    """Missing slots before the oldest one, and the bounds of the next page backwards."""
    b = df.groupBy(*keys).agg(F.min(at).alias("oldest"))
    b = b.withColumn("missing_before", F.greatest(((F.col("oldest") - floor) / step).cast("long"), F.lit(0).cast("long")))
    b = b.withColumn("page_start", F.greatest(F.col("oldest") - page * step, floor)).withColumn("page_end", F.col("oldest"))
    return b.where("missing_before > 0")


def largest(df: DataFrame, amount: str, tie: str) -> DataFrame:
    return df.orderBy(F.desc(amount), tie).limit(1)


def chronology(df: DataFrame, keys: list[str], at: str, tie: str, step: int, width: float | None = None, tie_width: float | None = None) -> DataFrame:
    """Duplicates, spacings below the step, spacings above it, and rows that run backwards in arrival order."""
    rows = df.select(*keys, at, tie)
    d = lagged(cut(rows, keys, at, width), keys, [at, tie], F.col(at), "_b").select(*keys, (F.col(at) - F.col("_b")).alias("_d"), F.lit(None).cast("long").alias("_a"))
    a = lagged(cut(rows, keys, tie, tie_width), keys, [tie], F.col(at), "_b").select(*keys, F.lit(None).cast("long").alias("_d"), (F.col(at) - F.col("_b")).alias("_a"))
    return d.unionByName(a).groupBy(*keys).agg(
        F.count_if(F.col("_d") == 0).alias("duplicates"),
        F.count_if((F.col("_d") > 0) & (F.col("_d") < step)).alias("sub_interval"),
        F.count_if(F.col("_d") > step).alias("gaps"),
        F.count_if(F.col("_a") <= 0).alias("non_increasing"),
    )


def cadence(df: DataFrame, keys: list[str], at: str, top: int = 10, width: float | None = None) -> DataFrame:
    """The most frequent distances in minutes between neighbours."""
    rows = lagged(cut(df.select(*keys, at), keys, at, width), keys, [at], F.col(at), "_b")
    rows = rows.withColumn("delta_min", F.floor((F.col(at) - F.col("_b")) / 60)).where("delta_min is not null")
    g = rows.groupBy(*keys, "delta_min").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "delta_min"))
    return g.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)


def temporal_quality(df: DataFrame, keys: list[str], at: str, step: int, now: Column, unit: Column | None = None, width: float | None = None) -> DataFrame:
    """Rows, first, last, span, age, duplicates, missing slots, misaligned, future and sub-interval rows of streams; with a
    unit also how many units a stream has."""
    df = df.withColumn("_unit", F.lit("") if unit is None else unit)
    rows = lagged(cut(df, keys, at, width), keys, [at], F.col(at), "_b").withColumn("_d", F.col(at) - F.col("_b"))
    g = rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.min(at).alias("first"),
        F.max(at).alias("last"),
        F.count_if(F.col("_d") == 0).alias("duplicates"),
        F.count_if((F.col("_d") > 0) & (F.col("_d") < step)).alias("sub_interval"),
        F.count_if(F.pmod(F.col(at), F.lit(step)) != 0).alias("misaligned"),
        F.count_if(F.col(at) > now).alias("future"),
        F.count_distinct(F.when(F.pmod(F.col(at), F.lit(step)) == 0, F.col(at))).alias("_on"),
        F.count_distinct("_unit").alias("units"),
    )
    g = g.withColumn("span_hours", F.round((F.col("last") - F.col("first")) / 3600, 4)).withColumn("age_seconds", now - F.col("last"))
    lo, hi = F.ceil(F.col("first") / step) * step, F.floor(F.col("last") / step) * step
    g = g.withColumn("missing_slots", F.greatest((hi - lo) / step + 1 - F.col("_on"), F.lit(0)).cast("long")).drop("_on")
    return g if unit is not None else g.drop("units")


def next_window(df: DataFrame, series: DataFrame, keys: list[str], day: str, closed: Column, lookback: int) -> DataFrame:
    """The next days to fetch: after the last stored one to the last closed one; a look-back where none is stored."""
    last = df.groupBy(*keys).agg(F.max(day).alias("last"))
    j = series.join(last, keys, "left")
    j = j.withColumn("start", F.coalesce(F.date_add("last", 1), F.date_sub(closed, lookback - 1))).withColumn("end", closed)
    return j.where(F.col("start") <= F.col("end")).select(*keys, "start", "end")


def contiguous_prefix(df: DataFrame, keys: list[str], ordinal: str, ok: Column) -> DataFrame:
    """First ordinal that did not succeed: where to resume."""
    g = df.groupBy(*keys).agg(F.min(F.when(~ok, F.col(ordinal))).alias("_bad"), (F.max(ordinal) + 1).alias("_next"))
    return g.select(*keys, F.coalesce("_bad", "_next").alias("resume"))


def continuity(df: DataFrame, keys: list[str], start: str, end: str, width: float | None = None) -> DataFrame:
    """Windows that do not start where the one before ended."""
    rows = lagged(cut(df, keys, start, width), keys, [start, end], F.col(end), "previous_end").drop("_c")
    return rows.where(F.col("previous_end").isNotNull() & (F.col("previous_end") != F.col(start)))


def slot_runs(df: DataFrame, keys: list[str], slot: str, step: int, width: float | None = None) -> DataFrame:
    """Contiguous runs of observed slots."""
    return merge_runs(df.select(*keys, slot).distinct(), keys, step, slot, width=width)
