"""Packing: shortest-pack-first over the histogram of piece lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_chars, gapless_rank, small_batches, stored
from .tokens import default_path, encoder

#: The id that ends each document.
END_ID = 1


def _pieces(path: str, most: int, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in by_chars(texts):
                ids, sizes = enc.encode(texts[a:b])
                ends = np.cumsum(sizes + 1)
                full = np.full(int(ends[-1]), END_ID, "<u4")
                inside = np.ones(len(full), bool)
                inside[ends - 1] = False
                full[inside] = ids
                n = -(-(sizes + 1) // most)  # pieces of a document
                doc = np.repeat(np.arange(b - a), n)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * most
                length = np.minimum(sizes[doc] + 1 - start, most)
                at = (ends - sizes - 1)[doc] + start
                parts = [full[x : x + m] for x, m in zip(at.tolist(), length.tolist())]
                cols = {
                    "doc_id": batch.column("doc_id").slice(a, b - a).take(pa.array(doc)),
                    "start": pa.array(start),
                    "length": pa.array(length),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in parts], pa.int64()),
                    "doc_tokens": pa.array(sizes[doc] + 1),
                }
                if keep_ids:
                    cols["ids"] = pa.array([x.astype(np.int64) for x in parts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return cut


def cut_pieces(docs: DataFrame, path: str | None = None, most: int = 2048, keep_ids: bool = False) -> DataFrame:
    """Each document's ids and END_ID, cut into pieces of `most` ids and a rest: doc_id, start, length, ids_crc32,
    doc_tokens and, if asked, ids."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * keep_ids
    return docs.select("doc_id", "text").mapInArrow(_pieces(path or default_path(), most, keep_ids), out)


def shortest_pack_first(counts: dict[int, int], most: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, packs) patterns: the lengths, longest first, each go to the packs with most room.

    Equal packs are handled together: a pattern with its count is split when only some of its packs get a piece. New
    packs open only where no pack has room and are then filled with as many pieces of that length as fit.
    Work and patterns are bounded by the number of lengths, whatever the counts.
    """
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for length in sorted((x for x, n in counts.items() if n > 0), reverse=True):
        left = counts[length]
        while left > 0:
            room = max((r for r, packs in by_room.items() if packs), default=-1)
            if room >= length:
                n, pattern = by_room[room].pop()
                use = min(n, left)
                if n > use:
                    by_room[room].append((n - use, pattern))
                by_room.setdefault(room - length, []).append((use, pattern + (length,)))
                left -= use
                continue
            per = most // length
            n, rest = divmod(left, per)
            if n:
                by_room.setdefault(most - per * length, []).append((n, (length,) * per))
            if rest:
                by_room.setdefault(most - rest * length, []).append((1, (length,) * rest))
            left = 0
    return [(pattern, n) for packs in by_room.values() for n, pattern in packs]


def pattern_ranges(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): ranks of a length that go to one place of a pattern."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, n in sorted(patterns):
        offset = 0
        for length in pattern:
            rank = used.get(length, 0)
            out.append((length, rank, rank + n, sequence, offset))
            used[length] = rank + n
            offset += length
        sequence += n
    return out


def pack(docs: DataFrame, path: str | None = None, most: int = 2048, keep_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most `most` ids: the pieces of cut_pieces with sequence_id and offset.

    The driver sees the histogram of piece lengths alone (`most` rows at most). Pieces get their place by their rank
    among the pieces of one length, dealt over hash buckets.
    Nulls: a null text is empty and has the end id alone; a null doc_id is kept. Repeated rows are packed each. Other
    columns are ignored; an empty table gives an empty result.
    """
    pieces = stored(cut_pieces(docs, path, most, keep_ids), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranges = pattern_ranges(shortest_pack_first(counts, most))
    places = docs.sparkSession.createDataFrame(ranges or [(0, 0, 0, 0, 0)], "_length long, _from long, _to long, _first long, offset long")
    buckets = F.pmod(F.xxhash64("doc_id", "start"), F.lit(1024))
    ranked = gapless_rank(pieces, "length", buckets, ["doc_id", "start", "ids_crc32"], "_place")
    fits = (F.col("length") == F.col("_length")) & (F.col("_place") >= F.col("_from")) & (F.col("_place") < F.col("_to"))
    out = ranked.join(F.broadcast(places), fits)  # bounded by `most`
    ids = ["ids"] if keep_ids else []
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_first") + F.col("_place") - F.col("_from")).alias("sequence_id"), "offset", *ids)
