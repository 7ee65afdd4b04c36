"""Cross-tokenizer alignment: two tokenizers' tokens of one text are cut into groups that begin and end at the same bytes.

The two arrays of token ends are compared along a diagonal: at the current shift between their indexes, probes of
doubling width find how far the ends stay equal, and the whole one-to-one stretch is taken at once. Where it ends, the
irregular group is walked token by token, and the shift follows. A group's text and links depend on its ids alone, so
they are made once for each different group and kept.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_chars
from .common import Scratch, by_chars, schema, small_batches
from .tokens import CACHED, _gather

#: Pairs of ids that are broadcast at a time (13 bytes each); more pairs are looked up in several passes.
BLOCK_PAIRS = 2_000_000
#: A pair of ids as one number: a << PAIR_BITS | b.
PAIR_BITS = 15
#: Both tokenizers end a token between a character that is no white space and a space. A space at the end stays.
CUT = re.compile(r"(?<=\S) (?!\Z)")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Encoders:
    """Ids of both tokenizers for texts with a space before them, chunk by chunk with a bounded cache."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        back = {c: b for b, c in byte_chars().items()}
        size = self.a.get_vocab_size()
        self.a_bytes = [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in map(self.a.id_to_token, range(size))]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if len(self.b_bytes) > 1 << PAIR_BITS or len(self.a_bytes) > 1 << 31 - PAIR_BITS:
            raise ValueError(f"vocabularies are too large for pairs of {PAIR_BITS} bits")
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_len, self.b_len = self.a_size.tolist(), self.b_size.tolist()
        #: Whether no piece goes on behind a space, so that chunks are encoded by themselves.
        self.by_chunk = not any("▁" in p.lstrip("▁") for p in pieces)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.pools = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.start = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.size = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.same = np.zeros(0, bool)

    def _raw(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        run = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        a = [e.ids for e in run([" " + c for c in chunks], add_special_tokens=False)]
        b = self.b.encode(chunks, num_threads=1)
        texts = [b" " + c.encode() for c in chunks]
        whole = b"".join(texts)
        sizes = [len(t) for t in texts]
        lost = False
        for ids, known in ((a, self.a_bytes), (b, self.b_bytes)):
            lost |= b"".join([known[i] for i in chain.from_iterable(ids)]) != whole
        if not lost and sizes == [sum([self.a_len[i] for i in x]) for x in a] == [sum([self.b_len[i] for i in y]) for y in b]:
            return a, b, [True] * len(chunks)
        same = [b"".join([self.a_bytes[i] for i in x]) == t and b"".join([self.b_bytes[i] for i in y]) == t for x, y, t in zip(a, b, texts)]
        return a, b, same

    def _learn(self, chunks: list[str]) -> None:
        for s, e in by_chars(chunks):
            *ids, same = self._raw(chunks[s:e])
            for k in (0, 1):
                sizes = np.array([len(x) for x in ids[k]], np.int64)
                at = len(self.pools[k])
                self.pools[k] = np.concatenate([self.pools[k], np.fromiter(chain.from_iterable(ids[k]), np.int32, int(sizes.sum()))])
                self.start[k] = np.concatenate([self.start[k], at + np.cumsum(sizes) - sizes])
                self.size[k] = np.concatenate([self.size[k], sizes])
            self.same = np.concatenate([self.same, np.array(same, bool)])
            self.known.update(zip(chunks[s:e], range(len(self.known), len(self.known) + e - s)))

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(A ids, B ids) of each text; none where one of the two does not give back the text's bytes."""
        chunks = [CUT.split(t) if self.by_chunk and "\0" not in t and "▁" not in t else [t] for t in texts]
        counts = np.array([len(c) for c in chunks], np.int64)
        flat = list(chain.from_iterable(chunks))
        if any("\0" in t for t in texts):  # pd.factorize ends a text at a NUL
            index: dict[str, int] = {}
            codes = np.array([index.setdefault(c, len(index)) for c in flat], np.int64)
            distinct = list(index)
        else:
            codes, distinct = pd.factorize(np.array(flat, object))
            distinct = distinct.tolist()
        if len(self.known) > CACHED or len(self.pools[0]) > 8 * CACHED:
            self.clear()
        missing = [c for c in distinct if c not in self.known]
        if missing:
            self._learn(missing)
        places = np.array([self.known[c] for c in distinct], np.int64)[codes]
        heads = np.cumsum(counts) - counts
        same = np.logical_and.reduceat(self.same[places], heads)
        ids, ends = [], []
        for k in (0, 1):
            sizes = self.size[k][places]
            ids.append(_gather(self.pools[k], self.start[k][places], sizes))
            ends.append(np.r_[0, np.cumsum(np.add.reduceat(sizes, heads))])
        none = np.zeros(0, np.int32)
        for i, ok in enumerate(same.tolist()):
            yield (ids[0][ends[0][i] : ends[0][i + 1]], ids[1][ends[1][i] : ends[1][i + 1]]) if ok else (none, none)


@lru_cache(maxsize=1)
def encoders(a_path: str, b_path: str) -> Encoders:
    """One pair of encoders a worker."""
    return Encoders(a_path, b_path)


def diagonal(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[int, list[tuple[int, int, int, int]], list[tuple[int, int, int, int, int]]]:
    """Groups of two arrays of ends with the same last end: how many, the one-to-one stretches (first group, i, j, groups),
    and the irregular ones (group, i0, i1, j0, j1)."""
    na, nb = len(a_ends), len(b_ends)
    raw_a, raw_b = a_ends.astype(np.int32).tobytes(), b_ends.astype(np.int32).tobytes()
    ends_a, ends_b = a_ends.tolist(), b_ends.tolist()
    runs, odd = [], []
    i = j = g = 0
    while i < na:
        i0, j0 = i, j
        a, b = ends_a[i], ends_b[j]
        i += 1
        j += 1
        if a == b:
            w = 2
            while i + w <= na and j + w <= nb and raw_a[4 * i : 4 * (i + w)] == raw_b[4 * j : 4 * (j + w)]:
                i += w
                j += w
                w *= 2
            while w > 2:
                w >>= 1
                if i + w <= na and j + w <= nb and raw_a[4 * i : 4 * (i + w)] == raw_b[4 * j : 4 * (j + w)]:
                    i += w
                    j += w
            if i < na and j < nb and ends_a[i] == ends_b[j]:
                i += 1
                j += 1
            runs.append((g, i0, j0, i - i0))
            g += i - i0
        else:
            while a != b:
                if a < b:
                    a = ends_a[i]
                    i += 1
                else:
                    b = ends_b[j]
                    j += 1
            odd.append((g, i0, i, j0, j))
            g += 1
    return g, runs, odd


class _Pairs(dict):
    """Texts of one-to-one groups by pair."""

    def __missing__(self, pair: int) -> str:
        text = self[pair] = f"{pair >> PAIR_BITS}|{pair & (1 << PAIR_BITS) - 1}"
        return text


class Groups:
    """Texts and links of groups, which depend on their ids alone, with bounded caches."""

    def __init__(self, a_size: np.ndarray, b_size: np.ndarray):
        self.a_size, self.b_size = a_size, b_size
        self.pairs, self.odd = _Pairs(), {}

    def _resolve(self, a: np.ndarray, b: np.ndarray) -> tuple[str, list[int]]:
        """An irregular group's text and linked pairs, token by token."""
        a, b = a.tolist(), b.tolist()
        i = j = 0
        x, y = int(self.a_size[a[0]]), int(self.b_size[b[0]])
        links = [a[0] << PAIR_BITS | b[0]]
        while x != y:
            if x < y:
                i += 1
                x += int(self.a_size[a[i]])
            else:
                j += 1
                y += int(self.b_size[b[j]])
            links.append(a[i] << PAIR_BITS | b[j])
        return ",".join(map(str, a)) + "|" + ",".join(map(str, b)), links

    def of(self, a: np.ndarray, b: np.ndarray) -> tuple[int, str, np.ndarray]:
        """Number of groups, groups as text (a1,a2|b1;a3|b2,b3), and all linked pairs of ids (with repeats) as numbers."""
        if len(self.pairs) + len(self.odd) > CACHED:
            self.pairs, self.odd = _Pairs(), {}
        n, runs, odd = diagonal(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]))
        at = np.array(runs, np.int64).reshape(-1, 4)
        ends = np.cumsum(at[:, 3])
        step = np.arange(int(at[:, 3].sum())) - np.repeat(ends - at[:, 3], at[:, 3])
        codes = a[np.repeat(at[:, 1], at[:, 3]) + step] << PAIR_BITS | b[np.repeat(at[:, 2], at[:, 3]) + step]
        pairs = self.pairs
        texts, told, done = [pairs[c] for c in codes.tolist()], [""] * n, 0
        for g, _, _, size in runs:
            told[g : g + size] = texts[done : done + size]
            done += size
        links, known = [], self.odd
        raw_a, raw_b = a.tobytes(), b.tobytes()
        for g, i0, i1, j0, j1 in odd:
            key = raw_a[4 * i0 : 4 * i1], raw_b[4 * j0 : 4 * j1]
            found = known.get(key)
            if found is None:
                found = known[key] = self._resolve(a[i0:i1], b[j0:j1])
            told[g] = found[0]
            links += found[1]
        return n, ";".join(told), np.concatenate([codes, np.array(links, np.int32)])


_ALIGNED = "id long, doc_id {}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"


def _align(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoders(*paths)
        groups = Groups(enc.a_size, enc.b_size)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for s, e in by_chars(texts):
                rows, pairs, times = [], [], []
                for a, b in enc.encode([t or "" for t in texts[s:e]]):
                    if not len(a):
                        rows.append((0, 0, 0, 0, ""))
                        pairs.append(a)
                        times.append(a)
                        continue
                    n, told, links = groups.of(a, b)
                    rows.append((len(a), len(b), n, len(links), hashlib.sha256(told.encode()).hexdigest()))
                    found, count = np.unique(links, return_counts=True)
                    pairs.append(found)
                    times.append(count)
                cols = list(zip(*rows))
                cuts = pa.array(np.r_[0, np.cumsum([len(p) for p in pairs])].astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(x).astype(np.int32))) for x in (pairs, times)]
                new = [pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(cols[4], pa.string())] + lists
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(s, e - s) for c in ("id", "doc_id")] + new, names=["id", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return run


def aligned_pairs(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """(id, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of each row; id is its own, pairs are the
    distinct linked pairs of ids, times how often each is linked in the document."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("id"), "doc_id", F.when(F.col("text") == "", None).otherwise(F.col("text")).alias("text"))
    return rows.mapInArrow(_align(paths or default_paths()), schema(_ALIGNED.format(docs.schema["doc_id"].dataType.simpleString())))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked, and whether no pair of its A id has more."""
    n = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    n = n.withColumn("a", F.shiftright("pair", PAIR_BITS))
    most = n.groupBy("a").agg(F.max("n").alias("most"))
    return n.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _scored(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = block.value
        for b in batches:
            pairs, times = b.column("pairs"), b.column("times")
            cuts = pairs.offsets.to_numpy()
            cuts, flat = cuts - cuts[0], pairs.flatten().to_numpy()
            often = times.flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
            hit = keys[at] == flat
            sums = []
            for value in (best[at], n[at]):
                total = np.r_[0, np.cumsum(np.where(hit, often * value, 0))]
                sums.append(pa.array(total[cuts[1:]] - total[cuts[:-1]], pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("id"), *sums], names=["id", "n_best", "count_sum"])

    return run


def align_tokenizers(docs: DataFrame, paths: tuple[str, str] | None = None, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row.

    paths are a byte-level tokenizer's file (A) and a sentence-piece model (B). A pair's count is how many rows hold it
    linked; the counts are looked up in blocks of at most about block_pairs pairs, each broadcast, whose sums add up, so
    that neither a frequent pair nor a large vocabulary is ever dealt by key.

    Nulls: a null or empty text, or one that a tokenizer does not give back byte by byte, has no tokens: zeros and an
    empty digest. A null doc_id is kept. Repeated rows are documents each and count each; an empty table gives an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "aligned")
    aligned = scratch.stored(aligned_pairs(docs, paths), "pairs")
    counts = scratch.stored(pair_counts(aligned), "counts")
    n_blocks = counts.count() // block_pairs + 1
    parts = []
    for block in range(n_blocks):
        part = counts.where(F.pmod(F.xxhash64("pair"), F.lit(n_blocks)) == block).toPandas().sort_values("pair")  # about block_pairs rows
        if len(part):
            arrays = part["pair"].to_numpy(np.int32), part["n"].to_numpy(np.int64), part["best"].to_numpy(bool)
            parts.append(aligned.select("id", "pairs", "times").where(F.size("pairs") > 0).mapInArrow(_scored(spark.sparkContext.broadcast(arrays)), schema("id long, n_best long, count_sum long")))
    sums = parts[0] if parts else spark.createDataFrame([], "id long, n_best long, count_sum long")
    for p in parts[1:]:
        sums = sums.unionByName(p)
    sums = scratch.stored(sums.groupBy("id").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")), "sums")
    out = aligned.drop("pairs", "times").join(sums, "id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = scratch.stored(out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"), "result")
    scratch.keep(out)
    return out
