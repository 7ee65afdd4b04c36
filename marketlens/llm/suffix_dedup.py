"""Removal of long repeated byte strings, by suffix arrays over groups of passages that share an anchor.

1. Each window of `min_bytes` bytes is given to its minimiser, the k-byte gram in it with the least hash; equal
   windows choose equal grams at equal places. Consecutive windows with one minimiser are a run.
2. Grams alone are counted first. Nearly all occur once, and only runs of the others (and of those that a bitmap of
   fixed size can't tell from them) go on.
   Runs are grouped by gram (hash). Runs with equal bytes are one context with a count; from two on, all their
   windows are repeated. A gram with a single context needs no more.
3. The other contexts are dealt into bounded bins of whole gram groups. In a bin, contexts are cut into blocks of 16
   bytes on the grid of their anchors, and a suffix array over the blocks (see suffix_array) brings equal stretches
   of whole blocks together; what is left of a window at both ends is then compared exactly.
   A group too large for a bin is split by where the anchor lies in the window, with a longer gram in each part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, by_chars, extended, in_bitmap, join_checked, seen_twice, small_batches
from .suffix_array import suffix_array

BLOCK = 16
#: Contexts of a bin, and the size beyond which one gram's group is split.
BIN_CONTEXTS = 8192
GROUP_CONTEXTS = 20_000
_LOW = np.uint64((1 << 32) - 1)
_rng = np.random.default_rng(20240229)
_TABLES = _rng.integers(0, 1 << 64, (2, 256), np.uint64, endpoint=False)
_BASES = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, out=out)


class _Hasher:
    """Polynomial hashes of any substring of a buffer, from prefix sums modulo 2^64 over a random byte table."""

    def __init__(self, buf: np.ndarray, which: int):
        n = len(buf)
        base = _BASES[which]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLES[which][buf] * _powers(base, n)[:n], out=self.sums[1:])
        self.inverse = _powers(pow(base, -1, 1 << 64), n)

    def of(self, start, end) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x)
    y = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    y[:n] = x
    y = y.reshape(-1, w)
    pre = np.minimum.accumulate(y, axis=1).ravel()
    suf = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suf[: n - w + 1], pre[w - 1 : n])


def runs_of(texts: list[bytes], min_bytes: int, k: int, grams_only: bool = False) -> dict[str, np.ndarray]:
    """Runs of windows with one minimiser: doc (index), lo (first start), n (starts), off, gram hash, two content hashes.

    grams_only: the gram hashes alone."""
    lens = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lens)
    buf = np.frombuffer(b"".join(texts), np.uint8)
    none = {c: np.zeros(0, np.int64) for c in ("doc", "lo", "n", "off", "h", "c1", "c2")}
    if len(buf) < min_bytes:
        return none
    one, two = _Hasher(buf, 0), _Hasher(buf, 1)
    at = np.arange(len(buf) - k + 1)
    keys = (one.of(at, at + k) & ~_LOW) | at.astype(np.uint64)
    low = (_sliding_min(keys, min_bytes - k + 1) & _LOW).astype(np.int64)
    p = np.arange(len(low))
    doc = np.repeat(np.arange(len(lens)), lens)[: len(low)]
    ok = p + min_bytes <= ends[doc]
    same = np.zeros(len(low), bool)
    same[1:] = ok[1:] & ok[:-1] & (low[1:] == low[:-1]) & (doc[1:] == doc[:-1])
    first = np.flatnonzero(ok & ~same)
    if not len(first):
        return none
    more = np.zeros(len(low), bool)
    more[:-1] = same[1:]
    last = np.flatnonzero(ok & ~more)
    anchor, d = low[first], doc[first]
    if grams_only:
        return {"h": two.of(anchor, anchor + k).view(np.int64)}
    stop = last + min_bytes
    return {
        "doc": d,
        "lo": first - (ends - lens)[d],
        "n": last - first + 1,
        "off": anchor - first,
        "h": two.of(anchor, anchor + k).view(np.int64),
        "c1": one.of(first, stop).view(np.int64),
        "c2": two.of(first, stop).view(np.int64),
    }


def _emit_grams(min_bytes: int, k: int):
    """(h, n): the grams of some texts' runs with their counts."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t.encode() for t in pdf["text"]]
            for a, b in by_chars(texts, 2_000_000):
                h, n = np.unique(runs_of(texts[a:b], min_bytes, k, grams_only=True)["h"], return_counts=True)
                yield pd.DataFrame({"h": h, "n": n})

    return emit


def _emit_runs(min_bytes: int, k: int, seen):
    """The runs whose grams are in the broadcast bitmap."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t.encode() for t in pdf["text"]]
            cls = pdf["cls"].to_numpy()
            for a, b in by_chars(texts, 2_000_000):
                r = runs_of(texts[a:b], min_bytes, k)
                ok = in_bitmap(seen.value, r["h"])
                if ok.any():
                    yield pd.DataFrame({"cls": cls[a:b][r["doc"][ok]], **{c: r[c][ok] for c in ("lo", "n", "off", "h", "c1", "c2")}})

    return emit


def repeated_starts(bodies: list[bytes], off: np.ndarray, n: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, start) of the windows that occur more than once in these contexts.

    off: where the anchor is in the body; n: the starts of a body, from 0.
    """
    whole = (min_bytes - BLOCK + 1) // BLOCK  # whole blocks that any window holds
    rest = min_bytes - whole * BLOCK
    lens = np.array([len(b) for b in bodies], np.int64)
    base = np.cumsum(lens) - lens
    buf = np.frombuffer(b"".join(bodies), np.uint8)
    lead = off % BLOCK
    blocks = (lens - lead) // BLOCK
    cell = np.cumsum(blocks + 1) - blocks - 1  # where a context's blocks begin in the block text
    owner = np.repeat(np.arange(len(bodies)), blocks)
    j = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    byte = base[owner] + lead[owner] + BLOCK * j
    words = buf[byte[:, None] + np.arange(BLOCK)].reshape(-1).view(">u8").reshape(-1, 2)
    order = np.lexsort((words[:, 1], words[:, 0]))
    ranked = words[order]
    new = np.r_[True, (ranked[1:] != ranked[:-1]).any(axis=1)]
    text = np.zeros(int((blocks + 1).sum()), np.int64)  # 0 ends each context
    text[(cell[owner] + j)[order]] = np.cumsum(new)
    starts = np.array(suffix_array(text), np.int64)
    # block starts from which a window can hold `whole` blocks
    valid = np.zeros(len(text), bool)
    valid[cell[owner] + j] = (lead[owner] + BLOCK * j <= n[owner] - 1 + BLOCK - 1) & (j + whole <= blocks[owner])
    starts = starts[valid[starts]]
    if len(starts) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    equal = np.ones(len(starts) - 1, bool)
    for i in range(whole):
        equal &= text[starts[1:] + i] == text[starts[:-1] + i]
    group = np.r_[0, np.cumsum(~equal)]
    shared = np.r_[False, equal] | np.r_[equal, False]
    starts, group = starts[shared], group[shared]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.zeros(len(text), np.int64)
    at[cell[owner] + j] = np.arange(len(owner))
    ctx = owner[at[starts]]
    b = lead[ctx] + BLOCK * j[at[starts]]
    found_ctx, found_start = [], []
    for r in range(BLOCK):  # r bytes of the window lie before the first whole block
        s = b - r
        use = (s >= 0) & (s < n[ctx])
        c, s, g = ctx[use], s[use], group[use]
        if len(c) < 2:
            continue
        places = np.r_[np.arange(r), r + whole * BLOCK + np.arange(rest - r)]
        ends = np.zeros((len(c), 32), np.uint8)
        ends[:, :rest] = buf[(base[c] + s)[:, None] + places]
        ends = ends.view(np.uint64)
        by = np.lexsort((ends[:, 3], ends[:, 2], ends[:, 1], ends[:, 0], g))
        x, y = ends[by], g[by]
        same = (x[1:] == x[:-1]).all(axis=1) & (y[1:] == y[:-1])
        hit = by[np.r_[False, same] | np.r_[same, False]]
        found_ctx.append(c[hit])
        found_start.append(s[hit])
    if not found_ctx:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_ctx), np.concatenate(found_start)


def _solve_bin(min_bytes: int):
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        uid = pdf["uid"].to_numpy()
        ctx, start = repeated_starts(list(pdf["body"]), pdf["off"].to_numpy(), pdf["n"].to_numpy(), min_bytes)
        order = np.lexsort((start, ctx))
        ctx, start = ctx[order], start[order]
        first = np.flatnonzero(np.r_[True, (ctx[1:] != ctx[:-1]) | (start[1:] != start[:-1] + 1)]) if len(ctx) else np.zeros(0, np.int64)
        last = np.r_[first[1:] - 1, len(ctx) - 1] if len(ctx) else first
        return pd.DataFrame({"uid": uid[ctx[first]], "s": start[first], "e": start[last]})

    return solve


def _solve(scratch: Scratch, parts: DataFrame, min_bytes: int, width: int, bin_contexts: int, group_contexts: int) -> DataFrame:
    """(uid, s, e): repeated starts of distinct parts (h, uid, off, n, mult, body); width: offsets a group may have."""
    sizes = scratch.stored(parts.groupBy("h").agg(F.count("*").alias("m"), F.min("mult").alias("least")), "groups")
    sizes = sizes.where("m > 1 and least = 1")
    parts = join_checked(parts, sizes, "h")
    total, most = sizes.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.max("m"), F.lit(0))).first()
    bins = max(1, total // bin_contexts)
    small = parts.where(F.col("m") <= group_contexts) if width > 1 else parts
    small = small.withColumn("bin", F.pmod(F.xxhash64("h"), F.lit(bins)))
    done = small.select("bin", "uid", "off", "n", "body").repartition(max(1, min(bins, 100_000)), "bin").groupBy("bin").applyInPandas(_solve_bin(min_bytes), "uid string, s long, e long")
    if most <= group_contexts or width == 1:
        return done
    # large groups: cells of an eighth of the offsets, each with all bytes that its windows have in common as its gram
    w = max(1, -(-width // 8))
    large = parts.where(F.col("m") > group_contexts).select("h", "uid", "off", "n", "mult", "body")
    least = F.col("off") - F.col("n") + 1
    cells = large.withColumn("c", F.explode(F.sequence(F.floor(least / w), F.floor(F.col("off") / w))))
    top = F.least(F.col("off"), F.col("c") * w + (w - 1))
    cells = cells.withColumn("top", top).withColumn("n2", F.col("top") - F.greatest(least, F.col("c") * w) + 1)
    cells = cells.withColumn("shift", F.col("off") - F.col("top"))
    body = F.substring(F.col("body"), (F.col("shift") + 1).cast("int"), (F.col("n2") + (min_bytes - 1)).cast("int"))
    cells = cells.withColumn("body", body)
    core = F.substring(F.col("body"), (F.col("top") - F.col("c") * w + 1).cast("int"), F.lit(min_bytes - w + 1))
    cells = cells.select("uid", "shift", F.xxhash64("h", "c", core).alias("h"), F.col("top").alias("off"), F.col("n2").alias("n"), "mult", "body")
    cells = cells.withColumn("sub", F.md5(F.concat(F.concat_ws("|", "h", "off", "n", F.lit("")).cast("binary"), F.col("body"))))
    cells = scratch.stored(cells, "cells")
    distinct = cells.groupBy("sub").agg(
        F.first("h").alias("h"), F.first("off").alias("off"), F.first("n").alias("n"), F.sum("mult").alias("mult"), F.first("body").alias("body")
    )
    distinct = scratch.stored(distinct.withColumnRenamed("sub", "uid"), "parts")
    found = _solve(scratch, distinct, min_bytes, w, bin_contexts, group_contexts)
    full = distinct.where("mult > 1").select("uid", F.lit(0).cast("long").alias("s"), (F.col("n") - 1).alias("e"))
    found = full.unionByName(found).withColumnRenamed("uid", "sub")
    back = cells.select("uid", "shift", "sub").join(found, "sub").select("uid", (F.col("s") + F.col("shift")).alias("s"), (F.col("e") + F.col("shift")).alias("e"))
    return done.unionByName(back)


def repeated_spans(docs: DataFrame, min_bytes: int = 400, bin_contexts: int = BIN_CONTEXTS, group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """(cls, spans): for each text (md5) with repeats, the sorted, disjoint byte ranges [start, end) that repeats cover.

    docs needs columns doc_id and text. Stored in the shared folder.
    """
    if min_bytes < 64:
        raise ValueError("min_bytes must be 64 at least")
    k = max(BLOCK * 2, min_bytes // 3)
    scratch = Scratch(docs.sparkSession, "repeats")
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text")).withColumn("cls", F.unhex(F.md5("text")))
    runs = keyed.where(F.octet_length("text") >= min_bytes).select("cls", "text")
    seen = docs.sparkSession.sparkContext.broadcast(seen_twice(runs.select("text").mapInPandas(_emit_grams(min_bytes, k), "h long, n long")))
    runs = scratch.stored(runs.mapInPandas(_emit_runs(min_bytes, k, seen), "cls binary, lo int, n int, off int, h long, c1 long, c2 long"), "runs")
    same = ["h", "c1", "c2", "off", "n"]
    contexts = runs.groupBy(*same).agg(F.count("*").alias("mult"), F.min(F.struct("cls", "lo")).alias("at"))
    contexts = scratch.stored(contexts, "contexts")
    groups = contexts.groupBy("h").agg(F.count("*").alias("m"), F.min("mult").alias("least")).where("m > 1 and least = 1")
    groups = scratch.stored(groups.select("h"), "needed-groups")  # so that the contexts of a frequent gram can be split over tasks
    needed = contexts.join(groups, "h", "left_semi")
    uid = F.md5(F.concat_ws("|", *same))
    needed = needed.select("h", uid.alias("uid"), "off", "n", "mult", F.col("at.cls").alias("cls"), F.col("at.lo").alias("lo"))
    by_text = scratch.stored(needed.groupBy("cls").agg(F.collect_list(F.struct("h", "uid", "off", "n", "mult", "lo")).alias("parts")), "needed")  # those of one text
    # one row of each text
    one = keyed.groupBy("cls").agg(F.min("doc_id").alias("_doc"))
    wanted = scratch.stored(by_text.select("cls").join(one, "cls"), "wanted")
    rows = join_checked(keyed, wanted, "cls").where(F.col("doc_id").eqNullSafe(F.col("_doc"))).select("cls", "text")
    rows = join_checked(rows, by_text, "cls", limit=20_000).select(F.encode("text", "UTF-8").alias("text"), F.explode("parts").alias("p"))
    body = F.substring(F.col("text"), F.col("p.lo") + 1, F.col("p.n") + (min_bytes - 1))
    parts = rows.select(F.col("p.h").alias("h"), F.col("p.uid").alias("uid"), F.col("p.off").cast("long").alias("off"), F.col("p.n").cast("long").alias("n"), F.col("p.mult").alias("mult"), body.alias("body"))
    parts = scratch.stored(parts.dropDuplicates(["uid"]), "parts")
    found = scratch.stored(_solve(scratch, parts, min_bytes, min_bytes - k + 1, bin_contexts, group_contexts), "found")
    # back to the runs: contexts that occur twice are repeated as a whole
    single = contexts.where("mult = 1").select(F.md5(F.concat_ws("|", *same)).alias("uid"), F.col("at.cls").alias("cls"), F.col("at.lo").alias("lo"))
    single = join_checked(single, found, "uid").select("cls", (F.col("lo") + F.col("s")).alias("a"), (F.col("lo") + F.col("e") + min_bytes).alias("b"))
    many = contexts.where("mult > 1").select(*same)
    whole = runs.join(many, same, "left_semi").select("cls", F.col("lo").cast("long").alias("a"), (F.col("lo") + F.col("n") - 1 + min_bytes).cast("long").alias("b"))
    # spans that overlap or touch become one: of one text, in order
    in_text = Window.partitionBy("cls").orderBy("a", "b")
    spans = single.unionByName(whole).distinct().withColumn("_before", F.max("b").over(in_text.rowsBetween(Window.unboundedPreceding, -1)))
    opens = F.when(F.col("_before") >= F.col("a"), 0).otherwise(1)
    spans = spans.withColumn("_g", F.sum(opens).over(in_text.rowsBetween(Window.unboundedPreceding, 0)))
    merged = spans.groupBy("cls", "_g").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    merged = merged.groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans"))
    out = scratch.stored(merged, "spans")
    scratch.keep(out)
    seen.destroy()
    return out


def _cut(whole_chars: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, n_spans, digests = [], [], [], []
            for text, spans in zip(batch.column("_text").to_pylist(), batch.column("_spans").to_pylist()):
                data = text.encode()
                pieces, at = [], 0
                for span in spans or ():
                    x, y = span["a"], span["b"]
                    if whole_chars:  # a character cut at either end is removed whole
                        while x > at and data[x] & 0xC0 == 0x80:
                            x -= 1
                        while y < len(data) and data[y] & 0xC0 == 0x80:
                            y += 1
                    pieces.append(data[at:x])
                    at = y
                pieces.append(data[at:])
                rest = b"".join(pieces)
                kept.append(rest.decode() if whole_chars else None)
                removed.append(len(data) - len(rest))
                n_spans.append(len(spans or ()))
                digests.append(hashlib.sha256(rest).hexdigest())
            new = {"kept_text": pa.array(kept, pa.string())} if whole_chars else {}
            new |= {"n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
            yield extended(batch, ["_text", "_spans"], new)

    return cut


def remove_repeats(docs: DataFrame, min_bytes: int = 400, carry: list[str] = (), keep_text: bool = False, **limits) -> DataFrame:
    """Remove from each document each byte covered by a string of min_bytes bytes that also starts elsewhere.

    Returns doc_id, the carried columns, n_bytes, n_removed, n_spans and kept_sha256; with keep_text also kept_text,
    where a character that a span cuts is removed whole (n_removed and kept_sha256 are then those of that text).
    Nulls: a null text is an empty one. Texts shorter than min_bytes keep all. Repeated rows are documents with equal
    texts: from min_bytes bytes on both lose everything. Rows with a null doc_id are documents like others. Other
    columns are ignored; an empty table gives an empty result.
    """
    spans = repeated_spans(docs, min_bytes, **limits)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", *carry, text.alias("_text"), F.unhex(F.md5(text)).alias("cls"))
    rows = join_checked(rows, spans, "cls", "left")
    rows = rows.select("doc_id", *carry, F.octet_length("_text").cast("long").alias("n_bytes"), "_text", F.col("spans").alias("_spans"))
    small_batches(docs.sparkSession)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    kept = ["kept_text string"] if keep_text else []
    out = ", ".join([*(f"`{c}` {types[c]}" for c in ("doc_id", *carry, "n_bytes")), *kept, "n_removed long", "n_spans long", "kept_sha256 string"])
    return rows.mapInArrow(_cut(keep_text), out)
