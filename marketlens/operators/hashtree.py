"""Hash trees over key ranges: two tables compare few digests, and only rows of ranges that differ are compared.

A leaf is a range of `width` keys with the number of its rows and the sum of their hashes; a node adds up FANOUT of the
level below. Sums do not depend on order, and equal rows count as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.relational import row_hash
from marketlens.operators.store import checked, stored

#: Children of a node, as bits.
FANOUT_BITS = 6
#: Keys of a leaf.
WIDTH = 64


def leaves(df: DataFrame, key: str, width: int = WIDTH) -> DataFrame:
    """(node, n, sum) of each range of `width` keys that has rows; partial sums are made before the shuffle. Rows with a
    null key are a leaf of their own."""
    rows = df.select(F.floor(F.col(key) / width).alias("node"), row_hash(df).alias("h"))
    return rows.groupBy("node").agg(F.count("*").alias("n"), F.sum("h").alias("sum"))


def level(leaf: DataFrame, up: int) -> DataFrame:
    """The nodes `up` levels above the leaves."""
    return leaf.groupBy(F.shiftright("node", FANOUT_BITS * up).alias("node")).agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))


def differing_leaves(before: DataFrame, after: DataFrame) -> DataFrame:
    """(node) of leaves that differ, from stored leaves of both sides, top down: a level compares only the children of
    nodes that differ in the level above. Equal roots end it at once."""
    spark = before.sparkSession
    most = before.unionByName(after).agg(F.max(F.abs("node"))).first()[0] or 0
    top = -(-int(most).bit_length() // FANOUT_BITS)
    open_ = None
    for up in range(top, -1, -1):
        a, b = level(before, up), level(after, up)
        if open_ is not None:  # the children of open nodes
            mine = lambda x: x.withColumn("_up", F.shiftright("node", FANOUT_BITS)).join(open_, F.col("_up").eqNullSafe(F.col("_open"))).drop("_up", "_open")
            a, b = mine(a), mine(b)
        same = a.withColumnsRenamed({"node": "_a", "n": "_n", "sum": "_s"})
        differ = b.join(same, F.col("node").eqNullSafe(F.col("_a")), "full").where(~F.struct("n", "sum").eqNullSafe(F.struct(F.col("_n").alias("n"), F.col("_s").alias("sum"))))
        # a node that only one side has
        differ = differ.select(F.when(F.col("n").isNotNull(), F.col("node")).otherwise(F.col("_a")).alias("_open"))
        open_ = F.broadcast(kept) if (kept := stored(differ, "differing")).limit(100_001).count() <= 100_000 else kept
        if kept.isEmpty():
            break
    return kept.withColumnRenamed("_open", "node") if top >= 0 else spark.createDataFrame([], "node long")


def changed_keys(before: DataFrame, after: DataFrame, key: str, width: int = WIDTH) -> DataFrame:
    """(lo, hi, key, change) of keys whose rows are not the same on both sides: added, removed or changed, with the range of
    their leaf. Rows of equal ranges leave before anything is shuffled but digests."""
    a, b = stored(leaves(before, key, width), "leaves"), stored(leaves(after, key, width), "leaves")
    nodes = differing_leaves(a, b)
    nodes = checked(nodes.withColumnRenamed("node", "_node"))
    in_open = lambda df: df.join(nodes, F.floor(F.col(key) / width).eqNullSafe(F.col("_node")), "left_semi")
    digest = lambda df, n: df.select(F.col(key).alias(f"{n}_key"), row_hash(df).alias("h")).groupBy(f"{n}_key").agg(F.struct(F.count("*").alias("n"), F.sum("h").alias("s")).alias(n))
    j = digest(in_open(before), "a").join(digest(in_open(after), "b"), F.col("a_key").eqNullSafe(F.col("b_key")), "full")
    j = j.where(~F.col("a").eqNullSafe(F.col("b")))
    found = F.when(F.col("a").isNull(), F.col("b_key")).otherwise(F.col("a_key"))
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("changed")
    lo = F.floor(found / width) * width
    return j.select(lo.alias("lo"), (lo + width - 1).alias("hi"), found.alias("key"), change.alias("change"))
