"""Ranked lexical search for many queries at once: shared term sets are mined among the items, and a document's partial
sums over them are made once and combined along a graph that all items share.

The graph grows by rounds: an item is its terms from the most shared to the least, and two neighbours that stand together
in several items become one node, until no two do. Each node is the sum of two others, each item the sum of few nodes.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, schema, small_batches

#: Terms of items that one block holds about; items are dealt over blocks, and each block meets all documents.
BLOCK_TERMS = 1 << 18
#: Numbers that a task holds at a time for the sums of documents and nodes.
CELLS = 4 << 20
#: What parts terms becomes a space, A-Z lower case.
_TABLE = bytes(32 if b < 48 or 57 < b < 65 or 90 < b < 97 or 122 < b < 128 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and what is not ASCII, A-Z in lower case, in UTF-8."""
    return (text or "").encode().translate(_TABLE).split()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for iid, text in zip(b.column("iid").to_pylist(), b.column("text").to_pylist()):
            found = Counter(terms_of(text))
            yield pa.RecordBatch.from_arrays([pa.array([iid] * len(found), pa.int64()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["iid", "term", "times"])


@dataclass
class Graph:
    """Leaves are (term, times) and come first; node i is left[i] + right[i], at most of the level before. Item i is the sum of
    refs[starts[i]:starts[i + 1]]."""

    terms: list[bytes]
    leaf_term: np.ndarray
    leaf_times: np.ndarray
    left: np.ndarray
    right: np.ndarray
    levels: list[int]
    iids: np.ndarray
    refs: np.ndarray
    starts: np.ndarray

    @property
    def additions(self) -> int:
        """Additions for one document."""
        return len(self.left) + len(self.refs) - len(self.iids)


def mine(items: pd.DataFrame) -> Graph:
    """The graph of a block's (iid, term, times), one row for each term of an item."""
    terms, term = np.unique(items["term"].to_numpy(object).astype(object), return_inverse=True)
    leaf_key = term.astype(np.int64) << 32 | items["times"].to_numpy(np.int64)
    keys, leaf, shared = np.unique(leaf_key, return_inverse=True, return_counts=True)
    iids, item = np.unique(items["iid"].to_numpy(np.int64), return_inverse=True)
    order = np.lexsort((leaf, -shared[leaf], item))  # of equal ones the smaller leaf first
    seq, item = leaf[order].astype(np.int64), item[order]
    n = len(keys)
    left, right = [], []
    while len(seq) > 1:
        pair = np.where(item[1:] == item[:-1], seq[:-1] << 32 | seq[1:], -1)
        found, which, count = np.unique(pair, return_inverse=True, return_counts=True)
        count[found < 0] = 0
        rank = np.empty(len(found), np.int64)
        rank[np.lexsort((found, -count))] = np.arange(len(found))
        mine_ = np.where(count[which] > 1, rank[which], len(found))
        padded = np.r_[len(found) + 1, mine_, len(found) + 1]
        take = (mine_ < len(found)) & (mine_ < padded[:-2]) & (mine_ < padded[2:])  # better than both neighbours, no overlap
        kept = np.bincount(which[take], minlength=len(found))
        take &= kept[which] > 1
        if not take.any():
            break
        new, at = np.unique(pair[take], return_inverse=True)
        seq = seq.copy()
        spots = np.flatnonzero(take)
        seq[spots] = n + at
        left.append(new >> 32)
        right.append(new & 0xFFFFFFFF)
        n += len(new)
        keep = np.ones(len(seq), bool)
        keep[spots + 1] = False
        seq, item = seq[keep], item[keep]
    starts = np.searchsorted(item, np.arange(len(iids)))
    none = [np.zeros(0, np.int64)]
    return Graph(terms.tolist(), keys >> 32, keys & 0xFFFFFFFF, np.concatenate(left or none), np.concatenate(right or none), [len(x) for x in left], iids, seq, starts)


def sums(graph: Graph, of_terms: np.ndarray) -> np.ndarray:
    """Scores (items, documents) from what each term brings a document (terms, documents)."""
    n = len(graph.leaf_term)
    acc = np.empty((n + len(graph.left), of_terms.shape[1]), np.int64)
    np.multiply(of_terms[graph.leaf_term], graph.leaf_times[:, None], out=acc[:n])
    at = 0
    for size in graph.levels:
        here = slice(at, at + size)
        np.add(acc[graph.left[here]], acc[graph.right[here]], out=acc[n + at : n + at + size])
        at += size
    return np.add.reduceat(acc[graph.refs], graph.starts, axis=0)


def _postings(known: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, terms, times = [], [], []
            for text in b.column("text").to_pylist():
                words = terms_of(text)
                found = Counter(map(known.get, words))
                found.pop(None, None)
                sizes.append(len(words))
                terms.append(list(found))
                times.append(list(found.values()))
            new = [pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))]
            out = pa.RecordBatch.from_arrays([b.column("doc_id"), *new], names=["doc_id", "n", "terms", "times"])
            yield out.filter(pa.array(np.array(sizes, np.int64) > 0))

    return run


def _best(graph: Graph, weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    """Per task the k best documents of each item: (iid, doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = max(1, min(512, CELLS // (len(graph.leaf_term) + len(graph.left) + len(graph.refs) + len(graph.terms))))
        ends = len(graph.iids)
        top = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * ends
        least = np.zeros(ends, np.int64)  # a score must reach it
        for b in batches:
            ids, n = b.column("doc_id"), b.column("n").to_pylist()
            no_id = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            m = np.array([25 + 75 * x * n_docs // n_terms for x in n], np.int64)
            terms, times = b.column("terms"), b.column("times")
            cuts = terms.offsets.to_numpy()
            flat, tf = terms.values.to_numpy(), times.values.to_numpy().astype(np.int64)
            for a in range(0, len(n), wide):
                z = min(a + wide, len(n))
                here = slice(cuts[a], cuts[z])
                doc = np.repeat(np.arange(z - a), np.diff(cuts[a : z + 1]))
                of_terms = np.zeros((len(graph.terms), z - a), np.int64)
                of_terms[flat[here], doc] = weights[flat[here]] * (1_000_000_000 * tf[here] // (1000 * tf[here] + 8 * m[a:z][doc]))
                score = sums(graph, of_terms)
                for i in np.flatnonzero(score.max(axis=1) >= np.maximum(least, 1)):
                    new = np.flatnonzero(score[i] >= max(least[i], 1))
                    s = np.r_[top[i][0], score[i][new]]
                    d = np.r_[top[i][1], ids[a + new]]
                    u = np.r_[top[i][2], no_id[a + new]]
                    order = np.lexsort((d, u, -s))[:k]
                    top[i] = (s[order], d[order], u[order])
                    if len(order) == k:
                        least[i] = s[order[-1]]
        iid = np.repeat(graph.iids, [len(t[0]) for t in top])
        if len(iid):
            s, d, u = (np.concatenate(x) for x in zip(*top))
            yield pa.RecordBatch.from_arrays([pa.array(iid), pa.array(d, pa.int64(), mask=u), pa.array(s)], names=["iid", "doc_id", "score"])

    return run


def rank(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the k documents of the highest scores above 0, equal scores by doc_id.

    A score is the sum, over the item's terms with repeats, of weight by rarity times saturated frequency, in whole
    numbers. Items are dealt over blocks of about block_terms terms; a block's graph and weights go to all tasks, each of
    which keeps k documents an item. Counts (documents, terms, documents of a term) are over all documents.

    Nulls: a null or empty text has no terms, is in no result and counts nowhere; a null doc_id comes last among equals.
    Every row is a document of its own, repeated or not, and every row of items an item, whatever its item_id. An empty
    table on either side gives an empty result. doc_id must be an integer; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "ranked")
    asked = scratch.stored(items.select(F.monotonically_increasing_id().alias("iid"), "item_id", "text"), "items", files=8)
    terms = asked.select("iid", "text").mapInArrow(_item_terms, schema("iid long, term binary, times long"))
    n_blocks = scratch.stored(terms, "terms", files=8).count() // block_terms + 1
    terms = scratch.tables[-1][0].withColumn("block", F.pmod(F.xxhash64("iid"), F.lit(n_blocks)).cast("int"))
    results = []
    for block in range(n_blocks):
        part = terms.where(F.col("block") == block).select("iid", "term", "times").toPandas()  # about block_terms rows
        if len(part):
            results.append(_rank_block(docs, mine(part), k, scratch))
    if not results:
        scratch.drop(*[t for t, _ in scratch.tables])
        kind = items.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    found = results[0]
    for r in results[1:]:
        found = found.unionByName(r)
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = scratch.stored(found, "found")
    scratch.keep(asked, found)
    # tasks' results meet in parts first
    part = Window.partitionBy("iid", "part").orderBy(*best)
    found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64))).withColumn("r", F.row_number().over(part)).where(F.col("r") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("iid").orderBy(*best))).where(F.col("rank") <= k)
    return found.join(asked.select("iid", "item_id"), "iid").select("item_id", "rank", "doc_id", "score")


def _rank_block(docs: DataFrame, graph: Graph, k: int, scratch: Scratch) -> DataFrame:
    known = {t: i for i, t in enumerate(graph.terms)}
    post = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    post = post.mapInArrow(_postings(known), schema("doc_id long, n long, terms array<int>, times array<int>"))
    post = scratch.stored(post, "postings")
    n_docs, n_terms = post.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(len(known), np.int64)
    for i, n in post.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # the block's terms
        held[i] = n
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in held], np.int64)
    best = post.where(F.size("terms") > 0).mapInArrow(_best(graph, weights, n_docs, n_terms, k), schema("iid long, doc_id long, score long"))
    best = scratch.stored(best, "best")
    scratch.drop(post)
    return best
