"""Exact top-k inner-product search: the threshold algorithm over sorted per-dimension lists, block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

BLOCK_ROWS = 8192
QUERY_ROWS = 1024


def threshold_search(rows: np.ndarray, ids: np.ndarray, order: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, floor: np.ndarray) -> list[tuple[int, int, int]]:
    """(query, id, score) of the k best rows of a block for each query, but its own id; ties to the smaller id.

    order holds each dimension's list: the rows from its least to its largest component. A list is read from the end that gives the query most, a few places at a time in all lists. Rows
    met are scored in full. A query stops when its kth score, or the floor known from other blocks, beats the sum of
    what each list can still give. floor is raised in place.
    """
    n = len(rows)
    ranked = np.take_along_axis(rows, order, axis=0)
    depths = []
    step = max(4, k)
    while not depths or depths[-1] < n:
        depths.append(min(n, step))
        step *= 2
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    # what the lists can give beyond each depth
    bounds = np.array([up @ ranked[n - 1 - d] + down @ ranked[d] if d < n else np.full(len(queries), np.iinfo(np.int64).min) for d in depths])
    best = up @ ranked[-1] + down @ ranked[0]
    out = []
    for q in range(len(queries)):
        if best[q] < floor[q]:
            continue
        high, low = np.flatnonzero(queries[q] > 0), np.flatnonzero(queries[q] < 0)
        seen = np.zeros(n, bool)
        seen[ids == query_ids[q]] = True
        got_i, got_s = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = 0
        for d, bound in zip(depths, bounds[:, q]):
            met = np.concatenate([order[n - d : n - at][:, high].ravel(), order[at:d][:, low].ravel()])
            fresh = np.zeros(n, bool)
            fresh[met] = True
            if not len(high) and not len(low) or d == n:
                fresh[:] = True
            fresh &= ~seen
            new = np.flatnonzero(fresh)
            seen |= fresh
            got_i = np.concatenate([got_i, ids[new]])
            got_s = np.concatenate([got_s, rows[new] @ queries[q]])
            top = np.lexsort((got_i, -got_s))[:k]
            got_i, got_s = got_i[top], got_s[top]
            if len(got_s) == k:
                floor[q] = max(floor[q], got_s[-1])
            if floor[q] > bound:
                break
            at = d
        keep = got_s >= floor[q]
        out += [(int(query_ids[q]), int(i), int(s)) for i, s in zip(got_i[keep], got_s[keep])]
    return out


def _pack(width: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = np.array(pdf["v"].tolist(), np.int64).reshape(len(pdf), width)
        lists = np.argsort(rows, axis=0, kind="stable").astype(np.int32)
        return pd.DataFrame({"ids": [pdf["id"].to_numpy(np.int64).tobytes()], "rows": [rows.tobytes()], "lists": [lists.tobytes()]})

    return pack


def _blocks(df: DataFrame, size: int, width: int) -> DataFrame:
    """Rows (id, v) packed into blocks of about `size` rows with their sorted lists, stored: one row each."""
    n = max(1, -(-df.count() // size))
    df = df.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(n)))
    return stored(df.groupBy("_b").applyInPandas(_pack(width), "ids binary, rows binary, lists binary"), "blocks")


def _search(k: int, width: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        floors: dict[bytes, np.ndarray] = {}  # the kth score so far of this task's query batches
        for pdf in batches:
            for ids, rows, lists, qids, qrows in zip(pdf["ids"], pdf["rows"], pdf["lists"], pdf["qids"], pdf["qrows"]):
                i, q = np.frombuffer(ids, np.int64), np.frombuffer(qids, np.int64)
                floor = floors.setdefault(qids, np.full(len(q), np.iinfo(np.int64).min))
                order = np.frombuffer(lists, np.int32).reshape(len(i), width)
                found = threshold_search(np.frombuffer(rows, np.int64).reshape(len(i), width), i, order, np.frombuffer(qrows, np.int64).reshape(len(q), width), q, k, floor)
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return search


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each query row by the integer inner product of
    floor(scale * x), ties to the smaller vec_id.

    Of equal vectors only the k + 1 smallest ids can be results, so the others leave before the search. Blocks of
    rows meet batches of queries, each pair in a task of its own; only k rows of each pair go on.
    Nulls: vectors that are null, empty or hold a null or non-finite component, and rows with a null vec_id, take no
    part. Integer scores must fit: components beyond sqrt(2^62 / length) after scaling raise an error. Repeated rows
    count once. Vectors of another length than a query's are no candidates for it. Other columns
    are ignored; an empty table gives an empty result.
    """
    v = F.col("embedding")
    fine = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.col("vec_id").isNotNull()
    rows = vectors.where(fine).select(
        F.col("vec_id").alias("id"), F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"), is_query.alias("q")
    )
    rows = rows.withColumn("width", F.size("v"))
    scaled = vectors.where(fine).select(F.array_max(F.transform(v, lambda x: F.abs(F.lit(scale) * x.cast("double")))).alias("m"), F.size(v).alias("w"))
    if not scaled.where("m * m * w >= 4.6e18").isEmpty():
        raise ValueError("components are too large for integer scores")
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    rows = stored(rows.distinct(), "vectors")
    candidates = stored(rows.withColumn("_p", place).where(F.col("_p") <= k + 1).select("id", "v", "width"), "candidates")
    queries = rows.where("q").select("id", "v", "width")
    found = None
    for (width,) in queries.select("width").distinct().collect():  # the lengths of vectors, usually one
        own = _blocks(candidates.where(F.col("width") == width).select("id", "v"), BLOCK_ROWS, width)
        asked = _blocks(queries.where(F.col("width") == width).select("id", "v"), QUERY_ROWS, width)
        pairs = own.crossJoin(asked.select(F.col("ids").alias("qids"), F.col("rows").alias("qrows")))  # blocks with batches
        part = pairs.mapInPandas(_search(k, width), "query_id long, vec_id long, score long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.limit(0).select(F.col("id").alias("query_id"), F.col("id").alias("vec_id"), F.col("id").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
