"""Byte-pair merges of many words at once, with the ranks of a tokenizer file."""

from __future__ import annotations

import json
import unicodedata

import numpy as np

_NONE = np.uint32(0xFFFFFFFF)


def byte_chars() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + i)
    return out


class WordMerger:
    """Ids of words of letters. Each round merges in every word its pair of least rank, the leftmost of equal ones;
    words without a known pair leave."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        chars = byte_chars()
        self.inner = np.array([vocab[chars[b]] for b in range(256)], np.uint32)
        self.last = np.array([vocab[chars[b] + end] for b in range(256)], np.uint32)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.uint32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.uint32)

    @staticmethod
    def plain(word: str) -> bool:
        """Letters whose lower case and composition leave no room for doubt."""
        return word.isalpha() and (word.isascii() or (max(word) < "ɐ" and "İ" not in word and unicodedata.is_normalized("NFC", word)))

    def _rank(self, sym: np.ndarray, head: np.ndarray) -> np.ndarray:
        """Rank of each symbol with the next one of its word."""
        out = np.full(len(sym), _NONE, np.uint32)
        if len(sym) < 2:
            return out
        key = sym[:-1] << np.uint32(16) | sym[1:]
        i = np.searchsorted(self.keys, key)
        i[i == len(self.keys)] = 0
        ok = (self.keys[i] == key) & ~head[1:]
        out[:-1] = np.where(ok, self.ranks[i], _NONE)
        return out

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row and the ids of each word; words are plain, lower-case and not empty."""
        raw = [w.encode() for w in words]
        size = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[data]
        ends = np.cumsum(size)
        sym[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), size)
        head = np.zeros(len(sym), bool)
        head[ends - size] = True
        done_w, done_s = [], []
        rank = self._rank(sym, head)
        while len(sym):
            start = np.flatnonzero(head)
            best = np.minimum.reduceat(rank, start)
            n = np.diff(np.r_[start, len(sym)])
            full = np.repeat(best, n)
            stop = full == _NONE
            if stop.any():
                done_w.append(word[stop])
                done_s.append(sym[stop])
                go = ~stop
                sym, word, head, rank, full = sym[go], word[go], head[go], rank[go], full[go]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == full)
            hit = hit[np.r_[True, word[hit[1:]] != word[hit[:-1]]]]
            sym[hit] = self.merged[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            sym, word, head, rank = sym[keep], word[keep], head[keep], rank[keep]
            at = hit - np.arange(len(hit))  # where the merged symbols are now
            for i in (at, at[at > 0] - 1):  # only their own and their left pairs change
                j = np.minimum(i + 1, len(sym) - 1)
                key = sym[i] << np.uint32(16) | sym[j]
                k = np.searchsorted(self.keys, key)
                k[k == len(self.keys)] = 0
                ok = (self.keys[k] == key) & ~head[j] & (j > i)
                rank[i] = np.where(ok, self.ranks[k], _NONE)
        if not done_w:
            return np.zeros(0, np.uint32), np.zeros(len(words), np.int64)
        w, s = np.concatenate(done_w), np.concatenate(done_s)
        order = np.argsort(w, kind="stable")
        return s[order], np.bincount(w, minlength=len(words)).astype(np.int64)
