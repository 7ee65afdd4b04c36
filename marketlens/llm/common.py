"""Shared helpers of the training-data operators: durable intermediate tables, gapless ranks, batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: A side is broadcast only up to these rows and bytes, both measured; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 48 << 20
#: Lets a query's shuffle files go when it is done: what comes after reads the table that it wrote.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a local master gets a folder of our
    own (its driver and executor are one process); on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return _SPACE.get() or base.rstrip("/")


#: The folder that a stage's tables go to, where one is open.
_SPACE: ContextVar[str | None] = ContextVar("space", default=None)


@contextmanager
def space(spark: SparkSession, name: str) -> Iterator[None]:
    """Tables stored inside go to a folder of their own, which is removed at the end."""
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = _SPACE.set(folder)
    try:
        yield
    finally:
        _SPACE.reset(before)
        remove(spark, folder)


def stored(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage and survives lost executors.

    files: at most so many files, for tables that are small whatever the documents (of a benchmark or a model).
    Zstandard is used since Snappy's direct buffers add up over many small files until the next full collection.
    """
    return written(df, f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}", files)


@contextmanager
def cleaned_up(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN_UP, before)


#: Folders that results may still read, until `close`.
_LEFT: set[str] = set()


def close(spark: SparkSession) -> None:
    """Delete all tables and archives that operators have left for their results to read. Results that were not read yet
    can't be read any more."""
    for path in sorted(_LEFT):
        remove(spark, path)


def written(df: DataFrame, path: str, files: int | None = None) -> DataFrame:
    with cleaned_up(df.sparkSession):
        (df.coalesce(files) if files else df).write.option("compression", "zstd").parquet(left(path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _LEFT.discard(path)


def left(path: str) -> str:
    """Remember a folder for `close`."""
    _LEFT.add(path)
    return path


class Scratch:
    """The stored tables of one call of an operator, each of which can go once nothing reads it any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.tables = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", []

    def stored(self, df: DataFrame, name: str, files: int | None = None) -> DataFrame:
        path = f"{self.base}/{len(self.tables)}-{name}"
        out = written(df, path, files)
        self.tables.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df, path in self.tables:
            if any(df is t for t in tables):
                remove(self.spark, path)

    def keep(self, *tables: DataFrame) -> None:
        """Drop all but these, which the result reads."""
        self.drop(*[df for df, _ in self.tables if not any(df is t for t in tables)])


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows an Arrow batch holds, since texts can be long; a smaller setting of the session stays. Spark itself
    ends a batch at spark.sql.execution.arrow.maxBytesPerBatch (64 MB), or behind one longer text.

    The bound stays in the session: results are lazy, and their batches are cut when they are read.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def _width(name: str, kind: T.DataType) -> Column:
    """Bytes of a value, about."""
    col = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(col)
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType)):
            size = F.aggregate(col, F.lit(0), lambda a, x: a + 8 + F.octet_length(x))
        elif isinstance(kind.elementType, T.StructType):
            wide = [f.name for f in kind.elementType if isinstance(f.dataType, (T.StringType, T.BinaryType))]
            each = lambda x: F.lit(8 * len(kind.elementType)) + sum((F.coalesce(F.octet_length(x[n]), F.lit(0)) for n in wide), F.lit(0))
            size = F.aggregate(col, F.lit(0), lambda a, x: a + each(x))
        else:
            size = F.size(col) * 8
    else:
        return F.lit(8)
    return F.coalesce(size, F.lit(0)) + 16


def fits(small: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> bool:
    """Whether a (stored) side has at most so many rows and bytes."""
    width = sum((_width(f.name, f.dataType) for f in small.schema.fields), F.lit(0))
    n, size = small.limit(rows + 1).agg(F.count("*"), F.sum(width.cast("long"))).first()
    return n <= rows and (size or 0) <= most


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a broadcast of `small` if its rows and bytes, measured, are few, else by a shuffle. `small` should be stored."""
    if fits(small, limit):
        small = F.broadcast(small)
    return big.join(small, on, how)


#: A key with more than this part of all rows is hot.
HEAT = 256


def join_by_heat(big: DataFrame, small: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of big (cheap to read twice) with small, one row a key, whose column `weight` counts the key's rows in big.

    A small side is broadcast. Else only the hot keys are (each has more than 1/HEAT of all rows, so there are fewer than
    HEAT of them), and the other keys are shuffled.
    """
    if fits(small):
        return big.join(F.broadcast(small.drop(weight)), key)
    total = small.agg(F.sum(weight)).first()[0]
    hot = F.broadcast(small.where(F.col(weight) * HEAT > total).drop(weight))
    cold = small.where(F.col(weight) * HEAT <= total).drop(weight)
    return big.join(hot, key).unionByName(big.join(hot.select(key), key, "left_anti").join(cold, key))


def gapless_rank(df: DataFrame, key: str, bucket: Column, order: list, out: str, start: int = 0) -> DataFrame:
    """Number the rows of each key without gaps, without sorting a key in one task.

    Rows are ranked inside (key, bucket) and shifted by the rows of the key's earlier buckets, so that a
    key that holds most rows is still dealt over all buckets. df should be cheap to compute twice (or stored).
    """
    df = df.withColumn("_bucket", bucket)
    sizes = df.groupBy(F.col(key).alias("_key"), F.col("_bucket").alias("_b")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_key").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_key", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    rank = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(*order))
    ranked = df.withColumn("_rank", rank)
    joined = ranked.join(shift, ranked[key].eqNullSafe(shift["_key"]) & (ranked["_bucket"] == shift["_b"]))
    return joined.withColumn(out, (F.col("_rank") - 1 + F.col("_shift") + start).cast("long")).drop(
        "_bucket", "_rank", "_shift", "_key", "_b"
    )


#: Bits of a bitmap of hashes seen twice (32 MB), and its parts; a fuller bitmap lets more rows pass, never fewer.
FILTER_BITS = 1 << 28
FILTER_PARTS = 1 << 10


def _bitmap_part(pdf: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(FILTER_BITS // FILTER_PARTS, bool)
    bits[pdf["bit"].to_numpy() % len(bits)] = True
    return pd.DataFrame({"part": pdf["part"].iloc[:1], "bits": [np.packbits(bits).tobytes()]})


def seen_twice(hashes: DataFrame) -> np.ndarray:
    """A bitmap of fixed size of the hashes (h long, n long) whose n add up to two or more, to be broadcast: what it
    doesn't hold occurs once."""
    often = hashes.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    bits = often.select(F.pmod("h", F.lit(FILTER_BITS)).alias("bit")).distinct()
    parts = bits.withColumn("part", F.expr(f"bit div {FILTER_BITS // FILTER_PARTS}"))
    parts = parts.groupBy("part").applyInPandas(_bitmap_part, "part long, bits binary")
    out = np.zeros((FILTER_PARTS, FILTER_BITS // FILTER_PARTS // 8), np.uint8)
    with cleaned_up(hashes.sparkSession):
        for row in parts.collect():  # at most FILTER_BITS bits
            out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = np.mod(hashes, FILTER_BITS)
    return bitmap[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1 == 1


def by_chars(texts, most: int = 4_000_000):
    """Slices (start, end) of a list of texts of about `most` characters each; a longer text is alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def extended(batch: pa.RecordBatch, without: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch without some columns and with new ones behind; the others pass untouched (nulls, large integers)."""
    kept = [(n, batch.column(n)) for n in batch.schema.names if n not in without]
    cols = kept + list(new.items())
    return pa.RecordBatch.from_arrays([c for _, c in cols], names=[n for n, _ in cols])


def letters(col: Column) -> Column:
    """Lower-case A-Z alone."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
