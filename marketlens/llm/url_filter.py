"""URL filters: a blocked Bloom filter in front of an exact hash join (native DataFrame expressions only)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits that the driver holds for the filter at most (8 MB); beyond it the filter is joined by block.
FILTER_WORDS = 1 << 20
BITS_PER_KEY = 16
PROBES = 5


def url_host(url: Column) -> Column:
    """Between the first :// and the next /, ?, # or the end, A-Z lower-cased; empty without ://."""
    rest = F.regexp_extract(url, r"(?s)://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def _mask(key: Column) -> Column:
    """PROBES bits of one 64-bit word, from a second hash."""
    h = F.xxhash64(key, F.lit("bits"))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(PROBES)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def build_filter(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """(block, word) of a blocked Bloom filter with one 64-bit word a block, and the number of blocks."""
    n = keys.select(F.count(key)).first()[0]
    blocks = max(1, math.ceil(max(n, 1) * BITS_PER_KEY / 64))
    k = F.col(key)
    words = keys.where(k.isNotNull()).groupBy(_block(k, F.lit(blocks)).alias("block")).agg(F.bit_or(_mask(k)).alias("word"))
    return words, blocks


def candidates(rows: DataFrame, array: str, key: str, listed: DataFrame, listed_key: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows with a key of `array` that may be listed, exploded, and the other rows as they are (with a null key).

    A filter of more than FILTER_WORDS words is joined by block; then all rows are exploded (without a key that may be
    listed their key is null), and there are no other rows.
    """
    words, blocks = build_filter(listed, listed_key)
    if blocks <= FILTER_WORDS:
        table = [0] * blocks
        for b, w in words.collect():  # at most FILTER_WORDS rows
            table[b] = w
        bits = F.lit(table).cast("array<bigint>")
        probe = F.filter(F.col(array), lambda k: F.get(bits, _block(k, F.lit(blocks)).cast("int")).bitwiseAND(_mask(k)) == _mask(k))
        rows = rows.withColumn(array, probe)
        none = F.coalesce(F.size(array), F.lit(0)) <= 0
        return rows.where(~none).withColumn(key, F.explode(array)).drop(array), rows.where(none).drop(array).withColumn(key, F.lit(None).cast("string"))
    spread = rows.withColumn(key, F.explode_outer(array)).drop(array)
    spread = spread.withColumn("_b", _block(F.col(key), F.lit(blocks)))
    hit = spread.join(words.withColumnRenamed("block", "_b"), "_b", "left")
    passed = F.coalesce(F.col("word").bitwiseAND(_mask(F.col(key))) == _mask(F.col(key)), F.lit(False))
    return hit.withColumn(key, F.when(passed, F.col(key))).drop("_b", "word"), None


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Judge each page's url by listed (host, path, verdict) rules; the longest fitting rule wins.

    A rule fits its host and all subdomains of it where the url's path starts with the rule's path. The keys
    of a url (each suffix of its host with each path prefix of a length that the list has) go through the
    blocked Bloom filter; what passes meets the rules in an exact hash join, which removes false positives. Only suffixes
    of as many labels as the longest listed host are made, and only rows with a possible hit are shuffled.

    Nulls: a null url, or one without ://, has an empty host and path and no rule. Rules with a null host are
    ignored, a null path is empty; of rules repeated for one host and path, `block` wins. Repeated pages are each
    judged. Other columns are ignored; an empty page table gives an empty result, an empty rule table the default.
    """
    spread = F.concat(F.col("r_host"), F.lit("\n"), F.col("r_path"))
    rules = (
        rules.where(F.col("host").isNotNull())
        .select(F.lower("host").alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), F.col("verdict").alias("r_verdict"))
        .groupBy("r_host", "r_path")
        .agg(F.max("r_verdict").alias("r_verdict"))
        .withColumn("key", spread)
    )
    lengths = sorted(x[0] for x in rules.select(F.length("r_path")).distinct().collect())  # path lengths: at most a url's
    most = rules.agg(F.max(F.size(F.split("r_host", r"\.")))).first()[0] or 1  # labels of a listed host
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    labels = F.split("host", r"\.")
    # a longer suffix than the longest listed host is in no rule
    ends = F.slice(labels, F.greatest(F.size(labels) - (most - 1), F.lit(1)), F.lit(most))
    rows = rows.withColumn("_ends", ends)
    hosts = F.transform(F.sequence(F.lit(1), F.size("_ends")), lambda i: F.array_join(F.slice("_ends", i, F.lit(most)), "."))
    none = F.array().cast("array<string>")

    def keys_of(n: int) -> Column:
        keyed = F.transform(hosts, lambda h: F.concat(h, F.lit("\n"), F.substring("path", 1, n)))
        return F.when(F.length("path") >= n, keyed).otherwise(none)

    keys = F.flatten(F.array(*[keys_of(n) for n in lengths])) if lengths else none
    rows = rows.withColumn("_keys", F.when(F.col("host") != "", keys).otherwise(none)).drop("_ends")
    hits, rest = candidates(rows, "_keys", "key", rules, "key")
    name = F.concat("r_host", "r_path")
    best = F.max(F.when(F.col("r_host").isNotNull(), F.struct(F.length(name).alias("n"), name.alias("rule"), F.col("r_verdict").alias("verdict"))))
    judged = hits.join(rules, "key", "left").groupBy("_row", "page_id", "host", "path").agg(best.alias("best"))
    judged = judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    if rest is None:
        return judged
    return judged.unionByName(rest.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")))


def drop_listed(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """Pages whose canonical url (lower-case scheme and host, no fragment, no trailing /) is not listed.

    A null url is kept. `listed` has a column url. The Bloom filter lets most pages skip the join.
    """
    canon = lambda u: F.regexp_replace(
        F.concat(F.lower(F.regexp_extract(u, r"^([^:]*://[^/?#]*)", 1)), F.regexp_replace(F.regexp_replace(u, r"^[^:]*://[^/?#]*", ""), r"(?s)#.*$", "")),
        r"/$",
        "",
    )
    black = listed.select(canon(F.col("url")).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    rows = pages.withColumn("_keys", F.when(F.col("url").isNull(), F.array().cast("array<string>")).otherwise(F.array(canon(F.col("url")))))
    hits, rest = candidates(rows, "_keys", "_key", black, "_key")
    kept = hits.join(black, "_key", "left_anti").drop("_key")
    return kept if rest is None else kept.unionByName(rest.drop("_key"))
