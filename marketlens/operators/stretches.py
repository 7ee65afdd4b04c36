"""Long series in stretches: neighbours, running values, positions, islands and moving windows without sorting a series in
one task.

A series is cut by its order column into stretches, which are sorted by themselves. What crosses a border is one row a
stretch: its last row, its running end or its count go to the stretches behind it. Moving windows run over blocks of
positions, into which the rows just before (and behind) are copied. Keys may be null; a null order value comes first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a stretch of the densest series should have, where its width is measured.
ROWS = 100_000
#: Rows of a block of a moving window, at least; eight windows if that is more.
BLOCK = 4096


def units(df: DataFrame, order: str) -> Column:
    """The order column as a number: days of a date, seconds of a timestamp, a number as it is."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(order)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_seconds(F.col(order).cast("timestamp"))
    return F.col(order)


def measured_width(df: DataFrame, keys: list[str], order: str, rows: int = ROWS) -> float:
    """A width of stretches that gives about `rows` rows to each of the densest series."""
    at = units(df, order)
    spans = df.groupBy(*keys).agg((F.max(at) - F.min(at) + 1).alias("span"), F.count(at).alias("n")).where("n > 0")
    width = spans.agg(F.min(F.col("span") / F.col("n")) * rows).first()[0]
    return max(float(width), 1.0) if width is not None else 1.0


def cut(df: DataFrame, keys: list[str], order: str, width: float | None = None) -> DataFrame:
    """Add the stretch of each row, _c. Without a width it is measured, at the cost of one aggregation."""
    width = width or measured_width(df, keys, order)
    return df.withColumn("_c", F.floor(units(df, order) / F.lit(width)))


def with_side(rows: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """rows with the columns of side (one row for each `on`), nulls being equal."""
    named = {c: f"_side{i}" for i, c in enumerate(on)}
    side = side.withColumnsRenamed(named)
    same = [F.col(c).eqNullSafe(F.col(s)) for c, s in named.items()]
    joined = rows.join(side, same, "left")
    return joined.drop(*named.values())


def _earlier(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)


def lagged(rows: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """Add the value of the row before; rows are cut. The last row of each stretch goes to the next one that has rows."""
    wrapped = F.struct(value.alias("v"))
    local = F.lag(wrapped).over(Window.partitionBy(*keys, "_c").orderBy(*order))
    ends = rows.groupBy(*keys, "_c").agg(F.max_by(wrapped, F.struct(*order)).alias("_end"))
    came = ends.select(*keys, "_c", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_c")).alias("_in"))
    joined = with_side(rows.withColumn("_local", local), came, [*keys, "_c"])
    return joined.withColumn(out, F.coalesce("_local", "_in")["v"]).drop("_local", "_in")


def running_before(rows: DataFrame, keys: list[str], order: list[str], value: Column, out: str, agg: Callable = F.max) -> DataFrame:
    """Add the maximum (agg=F.max) or sum (F.sum) of all rows before; rows are cut."""
    w = Window.partitionBy(*keys, "_c").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy(*keys, "_c").agg(agg(value).alias("_end"))
    came = ends.select(*keys, "_c", agg("_end").over(_earlier(keys)).alias("_in"))
    joined = with_side(rows.withColumn("_local", agg(value).over(w)), came, [*keys, "_c"])
    zero = F.lit(0)
    both = F.greatest("_local", "_in") if agg is F.max else F.coalesce("_local", zero) + F.coalesce("_in", zero)
    return joined.withColumn(out, both).drop("_local", "_in")


def running_last(rows: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """Add the latest value that is not NULL, the row's own included; rows are cut."""
    w = Window.partitionBy(*keys, "_c").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.groupBy(*keys, "_c").agg(F.max_by(value, F.when(value.isNotNull(), F.struct(*order))).alias("_end"))
    came = ends.select(*keys, "_c", F.last("_end", ignorenulls=True).over(_earlier(keys)).alias("_in"))
    joined = with_side(rows.withColumn("_local", F.last(value, ignorenulls=True).over(w)), came, [*keys, "_c"])
    return joined.withColumn(out, F.coalesce("_local", "_in")).drop("_local", "_in")


def positions(rows: DataFrame, keys: list[str], order: list[str], out: str = "_pos") -> DataFrame:
    """Add gapless positions from 0; rows are cut."""
    sizes = rows.groupBy(*keys, "_c").agg(F.count("*").alias("_n"))
    shift = sizes.select(*keys, "_c", F.coalesce(F.sum("_n").over(_earlier(keys)), F.lit(0)).alias("_in"))
    local = F.row_number().over(Window.partitionBy(*keys, "_c").orderBy(*order))
    joined = with_side(rows.withColumn("_local", local), shift, [*keys, "_c"])
    return joined.withColumn(out, (F.col("_local") - 1 + F.col("_in")).cast("long")).drop("_local", "_in")


def segments(rows: DataFrame, keys: list[str], order: list[str], opens: Column, start: Column, end: Column) -> DataFrame:
    """(keys, start, end, n): groups of rows that stand together, each beginning where `opens` holds; rows are cut.

    A stretch's groups are made by themselves. Only its first one, if another stretch began it, and its last one may go on
    over a border; these two are stitched, all others are done.
    """
    inside = Window.partitionBy(*keys, "_c")
    rows = rows.withColumn("_open", F.coalesce(opens, F.lit(False)).cast("int"))
    rows = rows.withColumn("_g", F.sum("_open").over(inside.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    parts = rows.groupBy(*keys, "_c", "_g").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("n"), F.max("_open").alias("_open"))
    parts = parts.withColumn("_last", F.col("_g") == F.max("_g").over(inside))
    whole = (F.col("_open") == 1) & ~F.col("_last")
    border = parts.where(~whole).withColumn("_id", F.sum("_open").over(Window.partitionBy(*keys).orderBy("_c", "_g").rowsBetween(Window.unboundedPreceding, 0)))
    stitched = border.groupBy(*keys, "_id").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")).drop("_id")
    return parts.where(whole).select(*keys, "start", "end", "n").unionByName(stitched)


def moving(rows: DataFrame, keys: list[str], before: int, after: int = 0, block: int | None = None, pos: str = "_pos") -> tuple[DataFrame, Callable]:
    """Blocks of positions for moving windows of up to `before` rows before and `after` rows behind a row.

    Returns the rows with their block _b, copies included, and a function that gives a window's spec from its bounds.
    What is computed is right for the rows of a block itself; `own` takes those.
    """
    size = block or max(BLOCK, 8 * (before + after + 1))
    first, last = F.expr(f"greatest(({pos} - {after}) div {size}, 0)"), F.expr(f"({pos} + {before}) div {size}")
    spread = rows.withColumn("_b", F.explode(F.sequence(F.when(F.col(pos) < after, F.lit(0).cast("long")).otherwise(first), last)))
    spread = spread.withColumn("_own", F.expr(f"_b = {pos} div {size}"))
    spec = Window.partitionBy(*keys, "_b").orderBy(pos)
    return spread, lambda lo, hi=0: spec.rowsBetween(lo, hi)


def own(df: DataFrame) -> DataFrame:
    """The rows of each block without the copies."""
    return df.where("_own").drop("_b", "_own")
