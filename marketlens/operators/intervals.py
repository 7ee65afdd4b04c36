"""Interval joins by a sweep over sorted rows, and dyadic cells of windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.operators import store
from marketlens.operators.store import checked, stored
from marketlens.operators.stretches import units

#: Points of a stretch of a key and windows of a part of it, about.
ROWS = 100_000
#: Pairs that leave a task at a time, about.
PAIRS = 1 << 17


def dyadic_cells(first: Column, end: Column) -> Column:
    """The array of (level, cell) that cover the whole units [first, end) exactly: cell c of level k is [c 2^k, (c + 1) 2^k).

    At each level at most one cell on the left and one on the right, so at most two for each doubling of the length. No
    level beyond the length's highest bit has a cell. NULL for an empty window.
    """
    highest = F.length(F.bin(end - first)) - 1

    right_by = lambda x, k: F.call_function("shiftright", x, k)

    def at(k: Column) -> Column:
        lo = -right_by(-first, k)  # rounded up
        hi = right_by(end, k)
        odd = lambda x: F.pmod(x, F.lit(2)) == 1
        left = F.when((lo < hi) & odd(lo), F.struct(k.alias("level"), lo.alias("cell")))
        right = F.when((lo + F.when(odd(lo), 1).otherwise(0) < hi) & odd(hi), F.struct(k.alias("level"), (hi - 1).alias("cell")))
        return F.array(left, right)

    return F.array_compact(F.flatten(F.transform(F.when(first < end, F.sequence(F.lit(0), highest)), at)))


def _sweep(names: list[str]):
    """Pairs from rows (key, _s, _c, _at, _end, _p, _w) in order of (key, _s, _c, _at), windows (with _end) before points of
    the same _at. What is held between batches are the windows that are still open at the last row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, ends = None, None, np.zeros(0, np.int64)  # the last row's group, its open windows and their ends
        for b in batches:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            for c in b.columns[:3]:
                new[1:] |= pc.not_equal(c.slice(1), c.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
            group = np.cumsum(new)
            is_window = pc.is_valid(b.column(4)).to_numpy(zero_copy_only=False)
            at = b.column(3).to_numpy(zero_copy_only=False)
            w, p = np.flatnonzero(is_window), np.flatnonzero(~is_window)
            mine = pc.take(b.column(6), pa.array(w))
            end = pc.take(b.column(4), pa.array(w)).to_numpy(zero_copy_only=False).astype(np.int64)
            first, of = np.searchsorted(p, w), group[w]
            if held is not None and last == tuple(c[0].as_py() for c in b.columns[:3]):
                mine = pa.concat_arrays([held, mine])
                end, first, of = np.concatenate([ends, end]), np.concatenate([np.zeros(len(ends), np.int64), first]), np.concatenate([np.zeros(len(ends), np.int64), of])
            ranks = np.unique(np.concatenate([at[p], end]), return_inverse=True)[1]
            many = len(ranks) + 1
            stop = np.searchsorted(group[p] * many + ranks[: len(p)], of * many + ranks[len(p) :])
            sizes = np.maximum(stop - first, 0)
            some = np.flatnonzero(sizes)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes[some]) // PAIRS)) + 1
            for part in np.split(some, cuts) if len(some) else []:
                n = sizes[part]
                point = p[np.repeat(first[part] - np.cumsum(n) + n, n) + np.arange(n.sum())]
                left, right = pc.take(b.column(5), pa.array(point)), pc.take(mine, pa.array(np.repeat(part, n)))
                yield pa.RecordBatch.from_arrays([pc.take(b.column(0), pa.array(point)), *left.flatten(), *right.flatten()], names=names)
            last = tuple(c[-1].as_py() for c in b.columns[:3])
            still = np.flatnonzero((of == group[-1]) & (end > at[-1]))
            held, ends = pc.take(mine, pa.array(still)), end[still]

    return run


def point_in_window(points: DataFrame, windows: DataFrame, key: str, at: str, start: str, end: str) -> DataFrame:
    """Points with the windows [start, end) of their key that hold them; days, seconds of timestamps, or whole numbers.

    Windows and points of a key are sorted together by time, and one sweep pairs each point with the windows that are open:
    a row travels once, whatever the windows' lengths are. A key of many points is cut into stretches of time, to each of
    which the windows go that reach into it; a key of many windows has them dealt over parts, which all see its points.
    So the windows open at one time in one part are what a task holds. Null keys and bounds join nothing; empty windows
    hold nothing.
    """
    t, lo, hi = units(points, at).cast("long"), units(windows, start).cast("long"), units(windows, end).cast("long")
    mine, theirs = [c for c in points.columns if c != key], [c for c in windows.columns if c != key]
    p = points.where(F.col(key).isNotNull() & t.isNotNull()).select(F.col(key).alias("_k"), t.alias("_at"), F.struct(*mine).alias("_p"))
    w = windows.where(F.col(key).isNotNull() & (lo < hi)).select(F.col(key).alias("_k"), lo.alias("_at"), hi.alias("_end"), F.struct(*theirs).alias("_w"))
    p, w = stored(p, "points"), stored(w, "windows")
    n_p = p.groupBy("_k").agg(F.count("*").alias("n"), F.min("_at").alias("_lo"), F.max("_at").alias("_hi")).where(F.col("n") > ROWS)
    n_w = w.groupBy("_k").agg((F.floor(F.count("*") / ROWS) + 1).alias("_parts")).where("_parts > 1")
    large = n_p.select("_k", "_lo", "_hi", F.greatest(F.floor((F.col("_hi") - F.col("_lo") + 1) / F.col("n") * ROWS), F.lit(1)).alias("_width"))
    large = checked(stored(large.join(n_w, "_k", "full"), "large"))  # few keys
    stretch = lambda c: F.coalesce(F.floor((c - F.col("_lo")) / F.col("_width")), F.lit(0))
    parts = F.coalesce("_parts", F.lit(1))
    p = p.join(large, "_k", "left").select("_k", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("_s"), stretch(F.col("_at")).alias("_c"), "_at", F.lit(None).cast("long").alias("_end"), "_p", F.lit(None).cast(w.schema["_w"].dataType).alias("_w"))
    w = w.join(large, "_k", "left").where("_lo is null or (_at <= _hi and _end > _lo)")
    reach = F.sequence(stretch(F.greatest("_at", "_lo")), stretch(F.least(F.col("_end") - 1, F.col("_hi"))))
    w = w.select("_k", F.pmod(F.monotonically_increasing_id(), parts).alias("_s"), F.explode(reach).alias("_c"), "_at", "_end", F.lit(None).cast(p.schema["_p"].dataType).alias("_p"), "_w")
    rows = p.union(w)
    tasks = -(-rows.count() // store.TASK_ROWS)
    rows = rows.repartition(*([tasks] if tasks > 1 else []), "_k", "_s", "_c").sortWithinPartitions("_k", "_s", "_c", "_at", F.col("_end").isNull())
    kinds = T.StructType([points.schema[key], *[points.schema[c] for c in mine], *[windows.schema[c] for c in theirs]])
    return rows.mapInArrow(_sweep(kinds.names), kinds)
