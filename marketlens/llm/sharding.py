"""Sharding: a hierarchical weighted hash tree (native DataFrame expressions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import gapless_rank

#: (region, rack, shard, weight)
Leaf = tuple[str, str, int, float]


def default_topology(shards: int = 16) -> list[Leaf]:
    """Sixteen shards in four regions of two racks of two; every further shard is a region of its own.

    A shard added as a region of its own takes rows only into itself, whatever the weights are.
    """
    leaves = [(f"r{i // 4}", f"k{i // 2}", i, 1.0) for i in range(min(shards, 16))]
    return leaves + [(f"r{i}", f"k{i}", i, 1.0) for i in range(16, shards)]


def draw(key: Column, node: Column, weight: Column) -> Column:
    """A weighted draw of one node: ln(u) / weight with u uniform from the hash of (key, node); the largest wins.

    A change of one node's weight changes that node's draw alone, so rows only move into or out of it.
    """
    hexes = F.substring(F.md5(F.concat(key, F.lit("|"), node)), 1, 12)
    u = (F.conv(hexes, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    return F.log(u) / weight


def children_of(topology: list[Leaf]) -> dict[str, list[tuple[str, float]]]:
    """The children (path, weight) of each inner node of the tree; the root is the empty path."""
    tree: dict[str, dict[str, float]] = {}
    for region, rack, shard, weight in topology:
        if weight <= 0:
            continue
        paths = ["", region, f"{region}/{rack}", f"{region}/{rack}/{shard}"]
        for parent, child in zip(paths, paths[1:]):
            own = tree.setdefault(parent, {})
            own[child] = own.get(child, 0.0) + weight
    return {k: list(v.items()) for k, v in tree.items()}


def place(df: DataFrame, key: Column, topology: list[Leaf], out: str) -> DataFrame:
    """Add the shard of a key: descend region, rack, shard, drawing among the children of one node at each level.

    Only the children of the node drawn are evaluated. If the weight of a leaf changes, then so do those of its
    rack and region, and rows move only into or out of these subtrees; other subtrees keep all that stays in them.
    """
    tree = children_of(topology)
    if not tree:
        raise ValueError("no shard has a positive weight")
    nodes = {
        k: F.array(*[F.struct(F.lit(path).alias("path"), F.lit(w).alias("weight")) for path, w in v]) for k, v in tree.items()
    }
    table = F.create_map(*[x for k, v in nodes.items() for x in (F.lit(k), v)])
    df = df.withColumn("_key", F.coalesce(key.cast("string"), F.lit("null"))).withColumn("_path", F.lit(""))
    for _ in range(3):
        drawn = F.transform(F.try_element_at(table, F.col("_path")), lambda c: F.struct(draw(F.col("_key"), c["path"], c["weight"]).alias("d"), c["path"].alias("path")))
        df = df.withColumn("_path", F.array_max(drawn)["path"])
    return df.withColumn(out, F.substring_index("_path", "/", -1).cast("int")).drop("_path", "_key")


def assign_shards(df: DataFrame, key: str, topology: list[Leaf], out: str = "shard") -> DataFrame:
    """Add the shard of each row by its key alone. A null key is a key of its own; equal keys share a shard."""
    return place(df, F.col(key), topology, out)


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Place documents by doc_id (law `key`), with a gapless slot in the shard and the shard with one more shard.

    Nulls: a null text has no bytes (size 1) and the CRC of an empty string; rows with a null doc_id share one
    shard. Repeated rows share a shard and have slots of their own. Other columns of docs are ignored.
    An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
    )
    rows = rows.withColumn("law", F.lit("key"))
    rows = assign_shards(rows, "doc_id", default_topology(shards), "shard")
    rows = assign_shards(rows, "doc_id", default_topology(shards + 1), "grown_shard")
    # 4,096 buckets of the key hash a shard: at 10^11 rows a bucket has about 1.5 million
    hexes = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 1, 3)
    rows = gapless_rank(rows, "shard", hexes, ["doc_id", "size", "text_crc32"], "slot")
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
