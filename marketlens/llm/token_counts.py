"""Token counts: the exact histogram of encoded lengths, and its suffix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import by_chars, small_batches, stored
from .tokens import default_path, encoder

#: Lengths in a block of the suffix sums.
STEP = 1024


def _count(path: str, space_splits: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, space_splits)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [enc.lengths(texts[a:b]) for a, b in by_chars(texts)]
            if found:
                length, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(length.astype(np.int64)), pa.array(n.astype(np.int64))], names=["length", "n_docs"])

    return count


def length_histogram(docs: DataFrame, path: str | None = None, space_splits: bool = True) -> DataFrame:
    """(length, n_docs) over all documents; batches are counted before the shuffle. A null text has length 0."""
    small_batches(docs.sparkSession)
    counted = docs.select("text").mapInArrow(_count(path or default_path(), space_splits), "length long, n_docs long")
    return stored(counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs")), "lengths")


def length_sums(histogram: DataFrame) -> DataFrame:
    """For each length L that occurs, as a context limit: the documents and tokens of at least L, the total when each
    document is cut to L tokens, and the documents of at most L with their share (the quantile that L answers).

    Sums run inside blocks of STEP lengths and then over the blocks, so that no task gets the whole histogram.
    """
    h = histogram.withColumn("_b", F.floor(F.col("length") / STEP)).withColumn("n_tokens", F.col("length") * F.col("n_docs"))
    blocks = h.groupBy(F.col("_b").alias("_block")).agg(F.sum("n_docs").alias("_d"), F.sum("n_tokens").alias("_t"))
    after = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)  # one row for each STEP lengths
    blocks = blocks.select("_block", F.coalesce(F.sum("_d").over(after), F.lit(0)).alias("_d"), F.coalesce(F.sum("_t").over(after), F.lit(0)).alias("_t"))
    inside = Window.partitionBy("_b").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    s = h.withColumn("_di", F.sum("n_docs").over(inside)).withColumn("_ti", F.sum("n_tokens").over(inside)).join(blocks, F.col("_b") == F.col("_block"))
    s = s.withColumn("docs_at_least", F.col("_di") + F.col("_d")).withColumn("tokens_at_least", F.col("_ti") + F.col("_t"))
    total = histogram.agg(F.sum("n_docs").alias("_docs"), F.sum(F.col("length") * F.col("n_docs")).alias("_tokens"))
    s = s.crossJoin(F.broadcast(total))  # one row
    return s.select(
        "length",
        "n_docs",
        "n_tokens",
        "docs_at_least",
        "tokens_at_least",
        (F.col("_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_total"),
        (F.col("_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_at_most"),
        ((F.col("_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("_docs")).alias("quantile"),
    )


def quantile_length(sums: DataFrame, q: float) -> DataFrame:
    """The least length that a share q of the documents (a decimal text keeps it exact) does not exceed: counts are
    compared as whole numbers."""
    share = F.lit(str(q)).cast("decimal(20,18)")
    total = sums.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("_n"))  # one row
    enough = F.col("docs_at_most") >= F.ceil(share * F.col("_n").cast("decimal(18,0)"))
    return sums.crossJoin(F.broadcast(total)).where(enough).agg(F.min("length").alias("length"))


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """Tokens left when each document is cut to `limit` tokens: from the first length not below the limit on."""
    at = sums.where(F.col("length") >= limit).agg(F.min(F.struct("length", "docs_at_least", "tokens_at_least")).alias("x"))
    whole = sums.agg(F.sum("n_tokens").alias("t"))
    longer = F.coalesce(F.col("x.docs_at_least"), F.lit(0))
    return at.crossJoin(whole).select((F.coalesce("t", F.lit(0)) - F.coalesce("x.tokens_at_least", F.lit(0)) + longer * limit).alias("truncated_total"))


def token_counts(docs: DataFrame, path: str | None = None, space_splits: bool = True) -> DataFrame:
    """Histogram and sums of the encoded lengths of all whole texts.

    Nulls: a null or empty text has length 0. Repeated rows each count. Other columns, nulls in them included, are
    ignored. An empty table gives an empty result.
    """
    return length_sums(length_histogram(docs, path, space_splits))
