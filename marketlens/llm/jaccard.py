"""Exact Jaccard join of word-shingle sets in their metric space: pivots, Voronoi regions, windows, recursion.

Equal sets are one class. Nearly every document is at distance 1 from nearly every other, so document pivots alone
would put all documents into each other's windows. The first level therefore takes one-shingle sets as pivots, in one
fixed order (rare shingles first): the pivots nearest to a set are its own shingles. A set within eps = 1 - t of x
misses at most (1 - t)|x| of x's shingles, so x lies in the windows of its first floor((1 - t)|x|) + 1 pivots, and two
linked sets meet in the region of a shared one: these are the Voronoi regions of the pivots, with the boundary
documents that the windows replicate. Inside regions the pivots are documents. A region's members are compared with its
first one, which links most groups at once. Small regions that still hold several components go on by the windows of the
triangle inequality around that pivot, |d(x, p) - d(y, p)| <= eps.

Larger ones are divided into cells, again and again. A cell's metric is that of signatures, the parities of the shingles
in each of some buckets: the bits H in which two differ are at most the shingles in which the sets differ, so that the
signature is the set's image in a space where distances only shrink. A few pivots of different components are chosen; a
member belongs to the ball of the nearest pivot that its signature lets it be linked with, else to the rest. If x of the
ball of p is linked with y, then H(y, p) <= H(y, x) + H(x, p), so the documents within that window are replicated into
the cell as guests, to be compared with the ball's own members. Cells of one component are done; cells that are large
and still shrink are divided further. In the others members are compared by signature, block by block inside tasks;
first only the nearest of other components are measured, which joins what belongs together, then all that the signatures
allow. All distances are exact, from whole sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, by_chars, extended, fits, in_bitmap, join_by_heat, join_checked, mix64, seen_twice, small_batches

#: Shingles whose estimated counts order them behind others; bounds the broadcast (16 MB), never the result.
COMMON_SHINGLES = 1 << 20
#: Regions up to this size are joined pair by pair.
LEAF = 128
#: Members of a block of a larger region, and how many of the nearest each round measures (None: all that can be linked).
BLOCK = 2048
ROUNDS = (2, 8, None)
#: Pivots of a division, divisions in a row, the part of a cell's members that one may keep to be divided again, and how
#: often its members may be in its cells together; beyond it they are too near one another to be divided.
PIVOTS = 16
DEPTH = 3
SHRINK = 0.9
COPIES = 1.5


def shingle_sets(texts: list[str], n: int, salt: int = 0) -> list[np.ndarray]:
    """Each text's sorted distinct 64-bit hashes of n consecutive words; all words as one for a shorter text."""
    words = [t.encode().lower().split() if t else [] for t in texts]  # bytes: A-Z, and \x20 \x09-\x0D
    lens = np.array([len(w) for w in words], np.int64)
    total = int(lens.sum())
    flat = np.empty(total, object)
    flat[:] = [x for w in words for x in w]
    codes, distinct = pd.factorize(flat)
    hashed = np.array([xxhash.xxh3_64_intdigest(x, salt) for x in distinct], np.uint64)
    h = hashed[codes] if total else np.zeros(0, np.uint64)
    odd = [np.uint64((2 * i + 1) * 0x9E3779B97F4A7C15 % (1 << 64) | 1) for i in range(n)]
    grams = np.zeros(max(0, total - n + 1), np.uint64)
    for i in range(n):
        grams += mix64(h[i : i + len(grams)] + np.uint64(i)) * odd[i]
    grams = mix64(grams)
    out, at = [], 0
    for m in lens.tolist():
        if m >= n:
            out.append(np.unique(grams[at : at + m - n + 1]))
        elif m:
            short = sum(int(x) * int(o) for x, o in zip(mix64(h[at : at + m]), odd)) + m
            out.append(mix64(np.array([short % (1 << 64)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += m
    return out


def class_ids(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set's digest, as two signed integers."""
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def _batches(batch: pa.RecordBatch, n: int, salt: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    texts = batch.column("text").to_pylist()
    for a, b in by_chars(texts):
        yield a, b, shingle_sets(texts[a:b], n, salt)


def signature(s: np.ndarray) -> bytes:
    """The parity of the shingles in each of 2^k buckets, 2^k >= 2 len(s), 128 at least: unrelated sets then differ in
    more bits than a ball's windows are wide. Two halves, combined by exclusive or, are the signature with half the buckets."""
    bits = 1 << max(7, (2 * len(s) - 1).bit_length() if len(s) else 7)
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


_KEYS = "kind int, doc_id long, cls long, check long, n long, sig binary"


def _emit_keys(n: int, salt: int):
    """kind 0: a document's class and set size; kind 1: a shingle (cls) found in n documents of a batch, from 2 on."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for a, b, sets in _batches(batch, n, salt):
                keys = np.array([class_ids(s) for s in sets], np.int64).reshape(-1, 2)
                sizes = np.array([len(s) for s in sets], np.int64)
                _, once = np.unique(keys[:, 0], return_index=True)
                shingles, counts = np.unique(np.concatenate([sets[i] for i in once]), return_counts=True)
                often = counts >= 2
                shingles, counts = shingles[often].view(np.int64), counts[often]
                for kind, doc, cls, check, size, sigs in (
                    (0, ids.slice(a, b - a), keys[:, 0], keys[:, 1], sizes, pa.array([signature(s) for s in sets], pa.binary())),
                    (1, pa.nulls(len(shingles), pa.int64()), shingles, np.zeros(len(shingles), np.int64), counts, pa.nulls(len(shingles), pa.binary())),
                ):
                    cols = [pa.array(np.full(len(cls), kind, np.int32)), doc, pa.array(cls), pa.array(check), pa.array(size.astype(np.int64)), sigs]
                    yield pa.RecordBatch.from_arrays(cols, names=["kind", "doc_id", "cls", "check", "n", "sig"])

    return emit


def _emit_regions(n: int, salt: int, num: int, den: int, common):
    """(pivot, cls, n): the first-level regions in whose windows a set lies."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = common.value
        for batch in batches:
            for _, _, sets in _batches(batch, n, salt):
                seen, pivots, classes, sizes = set(), [], [], []
                for s in sets:
                    if not len(s):
                        continue
                    cls = class_ids(s)[0]
                    if cls in seen:
                        continue
                    seen.add(cls)
                    most = len(s) * (den - num) // den + 1
                    if len(known):
                        i = np.searchsorted(known, s)
                        i[i == len(known)] = 0
                        hot = known[i] == s
                        rare = s[~hot]
                        if len(rare) < most:
                            h, c = s[hot], count[i[hot]]
                            rare = np.concatenate([rare, h[np.lexsort((h, c))]])
                    else:
                        rare = s
                    own = rare[:most]
                    pivots.append(own)
                    classes.append(np.full(len(own), cls, np.int64))
                    sizes.append(np.full(len(own), len(s), np.int32))
                if pivots:
                    cols = [np.concatenate(pivots).view(np.int64), np.concatenate(classes), np.concatenate(sizes)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["region", "cls", "n"])

    return emit


def _in_shared(seen):
    """The rows whose regions are in the broadcast bitmap."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(seen.value, batch.column("region").to_numpy())))

    return keep


def _emit_sets(n: int, salt: int):
    """Replace the text by its set (bytes), where the text is of the class that is looked for."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want = batch.column("cls").to_pylist()
            for a, b, sets in _batches(batch, n, salt):
                ok = [class_ids(s)[0] == w for s, w in zip(sets, want[a:b])]
                part = batch.slice(a, b - a)
                blobs = pa.array([s.tobytes() for s in sets], pa.binary())
                yield extended(part, ["text"], {"body": blobs}).filter(pa.array(ok, pa.bool_()))

    return emit


def _intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = []
        for x, y in zip(batch.column("x"), batch.column("y")):
            u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            z = np.concatenate([u, v])
            z.sort()
            both.append((int((z[1:] == z[:-1]).sum()), len(u), len(v)))
        both = np.array(both, np.int64).reshape(-1, 3)
        yield extended(batch, ["x", "y"], {c: pa.array(both[:, i]) for i, c in enumerate(("common", "nx", "ny"))})


def _allowed(x: dict, y: dict, num: int, den: int) -> np.ndarray:
    """By sizes, shared regions, distances to the region's pivot, and components: which of x may be linked with which of y."""
    nx, ny = x["n"][:, None], y["n"][None]
    behind = [n - (n * (den - num) // den + 1) for n in (nx, ny)]
    most = np.minimum(x["deg"][:, None], y["deg"][None]) + np.maximum(*behind)
    ok = (most * (den + num) >= (nx + ny) * num) & (nx * den >= ny * num) & (ny * den >= nx * num)
    far = np.abs(x["dist"][:, None] - y["dist"][None]) > 1 - num / den + 1e-9  # false where one is unknown
    return ok & ~far & (x["root"][:, None] != y["root"][None]) & (x["own"][:, None] | y["own"][None])


def _folded(sig: np.ndarray, words: int) -> np.ndarray:
    """Signatures with fewer buckets: halves combined by exclusive or."""
    while sig.shape[1] > words:
        half = sig.shape[1] // 2
        sig = sig[:, :half] ^ sig[:, half:]
    return sig


def divide_members(n: np.ndarray, sig: np.ndarray, pivots: list[tuple[int, bytes]], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Each member's cell (the place of its pivot, -1 for the rest), and (members, pivots) whether it is a guest of a cell.
    pivots are (set size, signature)."""
    c = (den - num) / (den + num)
    h = np.empty((len(n), len(pivots)))
    for k, (_, raw) in enumerate(pivots):
        p = np.frombuffer(raw, np.uint64)[None]
        words = min(p.shape[1], sig.shape[1])
        h[:, k] = np.bitwise_count(_folded(sig, words) ^ _folded(p, words)).sum(axis=1, dtype=np.int64)
    size = np.array([x for x, _ in pivots], float)[None]
    n = n[:, None].astype(float)
    near = (n * den >= size * num) & (size * den >= n * num) & (h <= c * (n + size) + 1e-6)
    cell = np.where(near.any(axis=1), np.where(near, h, np.inf).argmin(axis=1), -1)
    # the largest set that can be linked with the member and lie in the pivot's ball
    between = np.minimum(n, size) * den / num
    guest = h <= c * (n + size + 2 * between) + 1e-6
    guest[np.arange(len(cell))[cell >= 0], cell[cell >= 0]] = False
    return cell, guest


def _divide(num: int, den: int):
    """Rows with their region's pivots, as rows of cells: own members and guests."""

    def cell_id(region: int, pivot: int) -> int:
        mixed = mix64(np.array([region], np.int64).view(np.uint64) ^ mix64(np.array([pivot], np.int64).view(np.uint64)))
        return int(mixed.view(np.int64)[0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for region, rows in pdf.groupby("region"):
                pivots = rows["pivots"].iloc[0]
                ids = [cell_id(region, p["cls"]) for p in pivots] + [cell_id(region, 0)]
                for _, part in rows.groupby(rows["sig"].str.len()):
                    sig = np.frombuffer(b"".join(part["sig"]), np.uint64).reshape(len(part), -1)
                    cell, guest = divide_members(part["n"].to_numpy(), sig, [(p["n"], p["sig"]) for p in pivots], num, den)
                    out = part.drop(columns=["pivots", "region"])
                    out.insert(0, "region", np.array(ids, np.int64)[cell])
                    yield out.assign(parent=region, rest=cell < 0)
                    i, k = np.nonzero(guest)
                    if len(i):
                        more = part.drop(columns=["pivots", "region"]).iloc[i]
                        more.insert(0, "region", np.array(ids, np.int64)[k])
                        yield more.assign(own=False, parent=region, rest=False)

    return run


def _by_signature(x: dict, y: dict, num: int, den: int, nearest: int | None) -> list[np.ndarray]:
    """Pairs (cls of x, cls of y) that may be linked: all, or the nearest for each of x by what the signatures tell."""
    found = []
    step = max(1, (1 << 22) // max(1, len(y["n"]) * y["sig"].shape[1]))
    for a in range(0, len(x["n"]), step):
        part = {k: v[a : a + step] for k, v in x.items()}
        differ = np.bitwise_count(part["sig"][:, None] ^ y["sig"][None]).sum(axis=2, dtype=np.int64)
        total = part["n"][:, None] + y["n"][None]
        ok = _allowed(part, y, num, den) & (differ * (den + num) <= total * (den - num))
        if nearest and ok.shape[1] > nearest:
            differ[~ok] = np.iinfo(np.int64).max
            best = np.argpartition(differ, nearest - 1, axis=1)[:, :nearest]
            keep = np.zeros_like(ok)
            np.put_along_axis(keep, best, True, axis=1)
            ok &= keep
        i, j = np.nonzero(ok)
        found.append(np.stack([part["cls"][i], y["cls"][j]], axis=1))
    return found


def _block_pairs(num: int, den: int, nearest: int | None):
    """(p, x) of a pair of blocks of a region: pairs of different components that the windows and signatures allow."""

    def by_width(pdf: pd.DataFrame) -> dict[int, dict]:
        out = {}
        for width, rows in pdf.groupby(pdf["sig"].str.len()):
            sig = np.frombuffer(b"".join(rows["sig"]), np.uint64).reshape(len(rows), -1)
            out[width] = {c: rows[c].to_numpy() for c in ("cls", "n", "root", "deg", "dist", "own")} | {"sig": sig}
        return out

    def folded(rows: dict) -> dict:
        return rows | {"sig": _folded(rows["sig"], rows["sig"].shape[1] // 2)}

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        pdf["dist"] = pdf["dist"].astype(float)
        main = pdf["root"].mode().iloc[0]
        one, two = pdf[pdf["block"] == i], pdf[pdf["block"] == j]
        found = [np.zeros((0, 2), np.int64)]
        for a, b in ((one, two), (two, one))[: 1 if i == j else 2]:
            left, right = by_width(a[a["root"] != main]), by_width(b)
            for w, x in left.items():
                for v, y in right.items():
                    if v in (w, 2 * w, w // 2):  # sizes further apart can't be linked
                        found += _by_signature(folded(x) if w > v else x, folded(y) if v > w else y, num, den, nearest)
        both = np.sort(np.concatenate(found), axis=1)
        return pd.DataFrame(np.unique(both, axis=0), columns=["p", "x"])

    return pairs


def _files(rows: int) -> int:
    """Files for a table of about so many rows: few for small ones, so that rounds over them are short."""
    return max(12, rows // 100_000)


class _Join:
    """State of one join: the documents, their classes, and the distances measured so far."""

    def __init__(self, docs: DataFrame, n: int, num: int, den: int):
        self.docs = docs.select("doc_id", "text")
        self.scratch = Scratch(docs.sparkSession, "jaccard")
        self.stored = self.scratch.stored
        self.n, self.num, self.den = n, num, den
        small_batches(docs.sparkSession)
        salt = 0
        while True:
            keys = self.stored(self.docs.mapInArrow(_emit_keys(n, salt), _KEYS), "keys")
            self.keys = keys.where("kind = 0").select("doc_id", "cls", "check", "n")
            if self.keys.groupBy("cls").agg((F.min("check") != F.max("check")).alias("bad")).where("bad").isEmpty():
                break
            salt += 1  # two sets with one class id: take other hashes
        self.salt = salt
        self.sigs = keys.where("kind = 0 and n > 0").select("cls", "sig")
        self.keys = self.keys.drop("check")
        totals = keys.where("kind = 1").groupBy("cls").agg(F.sum("n").alias("n"))
        top = totals.orderBy(F.desc("n"), "cls").limit(COMMON_SHINGLES).toPandas()  # at most COMMON_SHINGLES rows
        known = top["cls"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(known)
        self.common = docs.sparkSession.sparkContext.broadcast((known[order], top["n"].to_numpy(np.int64)[order]))
        self.reps = self.keys.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))

    def regions(self) -> DataFrame:
        emit = _emit_regions(self.n, self.salt, self.num, self.den, self.common)
        return self.stored(self.docs.mapInArrow(emit, "region long, cls long, n int"), "regions")

    def behind(self, n):
        """Shingles of a set of n that lie behind its windows."""
        return n - (F.floor(n * (self.den - self.num) / self.den) + 1)

    def linkable(self, pn, xn, shared):
        """Whether two sets of these sizes that share at most so many first-level pivots can be linked: what they have
        in common is shared, or behind the windows of one of them."""
        most = shared + F.greatest(self.behind(pn), self.behind(xn))
        return self.near(pn, xn) & (most * (self.den + self.num) >= (pn + xn) * self.num)

    def near(self, nx, ny):
        """Sizes that allow a link: by the triangle inequality over the empty set."""
        return (nx * self.den >= ny * self.num) & (ny * self.den >= nx * self.num)

    def leaf_pairs(self, leaf: DataFrame, large: DataFrame | None, eps: float, files: int) -> DataFrame:
        """(p, x), p < x: pairs of different components in one small region that the windows allow.

        By the triangle inequality over the region's pivot, |d(p) - d(x)| <= eps. With `large` (the first division,
        when each region of a pair is still there) the regions that a pair shares are counted: the sets have at most
        so many shingles in common, and those behind the windows of one of them.
        """
        a = leaf.select("region", F.col("cls").alias("p"), F.col("n").alias("pn"), F.col("root").alias("_pr"), F.col("dist").alias("_pd"), F.col("deg").alias("_pg"))
        b = leaf.select("region", F.col("cls").alias("x"), F.col("n").alias("xn"), F.col("root").alias("_xr"), F.col("dist").alias("_xd"), F.col("deg").alias("_xg"))
        window = F.coalesce(F.abs(F.col("_pd") - F.col("_xd")) <= eps + 1e-9, F.lit(True))
        met = a.join(b, "region").where((F.col("p") < F.col("x")) & (F.col("_pr") != F.col("_xr")) & self.linkable(F.col("pn"), F.col("xn"), F.least("_pg", "_xg")) & window)
        if large is None:
            return met.select("p", "x").distinct()
        # the shared pivots that a pair of these sizes needs at least
        common = F.ceil((F.col("pn") + F.col("xn")) * self.num / (self.den + self.num) - 1e-6)
        need = common - F.greatest(self.behind(F.col("pn")), self.behind(F.col("xn")))
        pairs = met.select("p", "x", need.cast("int").alias("need")).groupBy("p", "x", "need").agg(F.count("*").alias("c"))
        more = self.stored(large.groupBy("cls").agg(F.count("*").alias("m")), "large", files)
        pairs = join_checked(pairs, more.select(F.col("cls").alias("p"), F.col("m").alias("_pm")), "p", "left")
        pairs = join_checked(pairs, more.select(F.col("cls").alias("x"), F.col("m").alias("_xm")), "x", "left")
        shared = F.col("c") + F.least(F.coalesce("_pm", F.lit(0)), F.coalesce("_xm", F.lit(0)))
        return pairs.where(shared >= F.col("need")).select("p", "x")

    def signed(self, members: DataFrame, files: int) -> DataFrame:
        """Members of large regions with their signatures, all their own."""
        wanted = self.stored(members.select("cls").distinct(), "signed", files)
        sigs = self.stored(join_checked(self.sigs, wanted, "cls", "left_semi").groupBy("cls").agg(F.first("sig").alias("sig")), "signatures", files)
        out = self.stored(join_checked(members, sigs, "cls").withColumn("own", F.lit(True)), "members", files)
        self.scratch.drop(wanted, sigs)
        return out

    def cells(self, members: DataFrame, files: int) -> DataFrame:
        """Divide regions (region, cls, n, deg, dist, root, sig, own, size) into cells, whose ids are new regions."""
        done, kept = [], members.select("region", "cls", "n", "deg", "dist", "root", "sig", "own", "size")
        cols = kept.columns[:-1]
        for level in range(DEPTH):
            wide = kept.where(F.col("size") > LEAF)
            done.append(kept.where(F.col("size") <= LEAF))
            # pivots of different components: the set of most regions in each group of components
            group = F.pmod(F.xxhash64("root", F.lit(level)), F.lit(PIVOTS))
            best = wide.where("own").groupBy("region", group.alias("g")).agg(F.max_by(F.struct("cls", "n", "sig"), F.struct("deg", "cls")).alias("p"))
            best = best.groupBy("region").agg(F.collect_list("p").alias("pivots"), F.count("*").alias("k"))  # PIVOTS at most
            sizes = wide.groupBy("region").agg(F.count("*").alias("w"))
            pivots = self.stored(best.join(sizes, "region").drop("k"), "pivots", files)
            if pivots.isEmpty():
                break
            kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.select(*cols).schema) + ", parent long, rest boolean"
            split = join_by_heat(wide.select(*cols), pivots, "region", "w").select(*cols, "pivots").mapInPandas(_divide(self.num, self.den), kind)
            split = self.stored(split, "split", files)
            # a cell of one component, or of guests alone, holds nothing to find
            told = split.groupBy("region", "parent").agg(F.count("*").alias("size"), F.min("root").alias("_a"), F.max("root").alias("_b"), F.max("own").alias("_own")).where("_a != _b and _own")
            told = self.stored(told.join(pivots.select(F.col("region").alias("parent"), "w"), "parent"), "told", files)
            dense = told.groupBy("parent", "w").agg(F.sum("size").alias("copies")).where(F.col("copies") > F.col("w") * COPIES).select("parent")
            dense = self.stored(dense, "dense", files)
            done.append(join_checked(wide, dense.withColumnRenamed("parent", "region"), "region", "left_semi"))
            told = join_checked(told, dense, "parent", "left_anti").select("region", "size", (F.col("size") <= F.col("w") * SHRINK).alias("_go"))
            split = self.stored(join_checked(split, self.stored(told, "open", files), "region"), "cells", files)
            stuck = split.where(~F.col("_go") & (F.col("size") > LEAF)) if level < DEPTH - 1 else split.where(F.col("size") > LEAF)
            done.append(stuck.select(*cols, "size"))
            kept = split.where((F.col("size") <= LEAF) | F.col("_go")) if level < DEPTH - 1 else split.where(F.col("size") <= LEAF)
            kept = kept.select(*cols, "size")
        else:
            done.append(kept)
        out = done[0]
        for d in done[1:]:
            out = out.unionByName(d)
        return self.stored(out.drop("size"), "divided", files)

    def block_pairs(self, cells: DataFrame, nearest: int | None) -> DataFrame:
        """(p, x): pairs of different components in one cell that its windows and the signatures allow."""
        rows = cells.withColumn("_k", F.ceil(F.col("size") / BLOCK).cast("int"))
        rows = rows.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("_k")).cast("int")).withColumn("_c", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        rows = rows.select("region", F.least("block", "_c").alias("i"), F.greatest("block", "_c").alias("j"), "block", "cls", "n", "root", "deg", "dist", "own", "sig")
        return rows.groupBy("region", "i", "j").applyInPandas(_block_pairs(self.num, self.den, nearest), "p long, x long")

    def measure(self, pairs: DataFrame, files: int) -> DataFrame:
        """(p, x, dist, link) of stored distinct pairs (p, x): each set travels to the pivots it is compared with."""
        roles = pairs.select(F.col("x").alias("cls"), "p").union(pairs.select(F.col("p").alias("cls"), "p")).distinct()
        wanted = roles.groupBy("cls").agg(F.collect_list("p").alias("pivots")).join(self.reps, "cls")
        wanted = self.stored(wanted.withColumnRenamed("doc_id", "_doc"), "wanted", files)
        small = F.broadcast(wanted) if fits(wanted) else wanted
        rows = self.docs.join(small, self.docs["doc_id"].eqNullSafe(F.col("_doc"))).select("text", "cls", "pivots")
        sets = rows.mapInArrow(_emit_sets(self.n, self.salt), "cls long, pivots array<long>, body binary")
        sets = self.stored(sets, "sets")
        moved = sets.select("cls", F.explode("pivots").alias("p"), "body")
        pivots = moved.where("cls = p").select("p", F.col("body").alias("x"))
        others = moved.where("cls != p").select("p", F.col("cls").alias("x_cls"), F.col("body").alias("y"))
        done = others.join(pivots, "p").select("p", F.col("x_cls").alias("cls"), "x", "y").mapInArrow(_intersect, "p long, cls long, common long, nx long, ny long")
        union = F.col("nx") + F.col("ny") - F.col("common")
        out = done.select("p", F.col("cls").alias("x"), (1 - F.col("common") / union).alias("dist"), (F.col("common") * self.den >= union * self.num).alias("link"))
        out = self.stored(out.distinct(), "measured", files)
        self.scratch.drop(wanted, sets)
        return out


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(cls, root): the smallest class reachable by links (p, x), by label propagation with pointer jumping."""
    files = _files(links.count())
    edges = scratch.stored(links.select(F.col("p").alias("u"), F.col("x").alias("v")).union(links.select("x", "p")).distinct(), "edges", files)
    labels = scratch.stored(edges.groupBy(F.col("u").alias("cls")).agg(F.least(F.min("v"), F.min("u")).alias("root")), "labels", files)
    while True:
        from_next = edges.join(labels.withColumnRenamed("cls", "v"), "v").groupBy(F.col("u").alias("cls")).agg(F.min("root").alias("_next"))
        up = labels.select(F.col("cls").alias("root"), F.col("root").alias("_up"))
        new = labels.join(from_next, "cls").join(up, "root", "left")
        new = scratch.stored(new.select("cls", F.least("root", "_next", "_up").alias("root"), F.col("root").alias("_old")), "labels", files)
        changed = not new.where("root != _old").isEmpty()
        scratch.drop(labels)
        labels = new
        if not changed:
            scratch.drop(edges)
            return new.select("cls", "root")


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per document: n_shingles (size of its set of n-word shingles) and component_id, the smallest doc_id reachable
    by links, where den * |x & y| >= num * |x | y|.

    Nulls: a null or blank text has no shingles, is linked with nothing and is its own component; a null doc_id is
    never a component_id unless all ids of the component are null. Repeated rows are one class and linked. Other
    columns are ignored; an empty table gives an empty result.
    """
    job = _Join(docs, n, num, den)
    stored, scratch = job.stored, job.scratch
    eps = 1 - num / den
    regions = job.regions()
    # nearly all regions hold one set; these leave before anything is shuffled but their names
    seen = docs.sparkSession.sparkContext.broadcast(seen_twice(regions.select(F.col("region").alias("h"), F.lit(1).alias("n"))))
    rows = stored(regions.mapInArrow(_in_shared(seen), regions.schema), "rows")
    scratch.drop(regions)
    ends = rows.groupBy("region").agg(F.min("cls").alias("_p"), F.max("cls").alias("_q"), F.min("n").alias("_lo"), F.max("n").alias("_hi"))
    ends = ends.where("_p != _q").select("region", "_lo", "_hi")
    shared = stored(rows.join(ends, "region").distinct(), "shared")
    scratch.drop(rows)
    # deg: a set's regions that others share; too few for any size that its region holds: no link there
    deg = shared.groupBy("cls").agg(F.count("*").alias("deg"))
    least = F.greatest(F.col("_lo"), F.ceil(F.col("n") * num / den - 1e-6))
    most = F.least(F.col("_hi"), F.floor(F.col("n") * den / num + 1e-6))
    can = job.linkable(F.col("n"), least, F.col("deg")) | job.linkable(F.col("n"), most, F.col("deg") + 1)  # 1: rounding
    able = stored(shared.join(deg, "cls").where(can).select("region", "cls", "n", "deg"), "able")
    scratch.drop(shared)
    # the first document pivot of a region: the set that shares most
    lead = able.groupBy("region").agg(F.max(F.struct("deg", F.col("cls").alias("p"), "n")).alias("_m"), F.min("cls").alias("_p"), F.max("cls").alias("_q"))
    lead = lead.where("_p != _q").select("region", F.col("_m.p").alias("p"), F.col("_m.n").alias("_pn"), F.col("_m.deg").alias("_pg"))
    led = stored(able.join(lead, "region"), "led")
    scratch.drop(able)
    ok = job.linkable(F.col("n"), F.col("_pn"), F.least("deg", "_pg"))
    pairs = led.where(F.col("cls") != F.col("p")).where(ok).select("p", F.col("cls").alias("x")).distinct()
    files = _files(led.count())
    tested = job.measure(stored(pairs, "pairs", files), files)
    links = tested.where("link").select("p", "x")
    roots = stored(components(links, scratch), "roots", files)
    # each member's distance to its region's pivot, where measured
    to_pivot = tested.select("p", F.col("x").alias("cls"), "dist")
    members = join_checked(led.where("cls != p"), to_pivot, ["p", "cls"], "left").select("region", "cls", "n", "deg", "dist")
    for turn, nearest in enumerate(ROUNDS):
        # regions that still hold two components
        known = join_checked(members, roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        known = stored(known, "known", files)
        open_ = known.groupBy("region").agg(F.min("root").alias("_a"), F.max("root").alias("_b"), F.count("*").alias("size")).where("_a != _b").select("region", "size")
        open_ = stored(open_, "open", files)
        held = stored(join_checked(known, open_, "region"), "members", files)
        scratch.drop(known, open_)
        files = _files(held.count())
        if held.isEmpty():
            break
        if turn == 0:  # the small regions, once; the large ones are divided
            large = held.where(F.col("size") > LEAF)
            members = job.cells(job.signed(large, files), files).drop("root")
            found = join_checked(members, roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
            sizes = stored(found.groupBy("region").agg(F.count("*").alias("size")), "sizes", files)
            pairs = job.block_pairs(join_checked(found, sizes, "region"), nearest)
            pairs = pairs.union(job.leaf_pairs(held.where(F.col("size") <= LEAF).drop("size"), large, eps, files))
        else:
            pairs = job.block_pairs(held, nearest)
        done = tested.select(F.least("p", "x").alias("p"), F.greatest("p", "x").alias("x")).distinct()
        fresh = stored(pairs.distinct().join(done, ["p", "x"], "left_anti"), "pairs", files)
        measured = job.measure(fresh, files)
        new = measured.where("link").select("p", "x")
        if not new.isEmpty():
            links = stored(links.union(new), "links", files)
            roots = stored(components(links, scratch), "roots", files)
        tested = stored(tested.unionByName(measured), "tested", files)
    rooted = join_checked(job.keys, roots, "cls", "left").select("doc_id", "n", F.coalesce("root", "cls").alias("root"))
    rooted = stored(rooted, "rooted")
    # components of one document have its own id
    least = rooted.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("_least"), F.count("*").alias("_docs")).where("_docs > 1")
    least = stored(least, "least", files)
    scratch.keep(rooted, least)
    job.common.destroy()
    seen.destroy()
    out = join_checked(rooted, least, "root", "left")
    in_group = (F.col("n") > 0) & F.col("_docs").isNotNull()
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(in_group, F.col("_least")).otherwise(F.col("doc_id")).alias("component_id"))
