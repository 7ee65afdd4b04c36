"""Encoding of whole texts with a public tokenizer file, chunk by chunk with a bounded cache."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd

from .bpe import WordMerger

#: ASCII marks; a run of them behind letters is tokens of its own, whatever the letters are.
MARKS = ".,;:!?*#$%&)(\"-"
#: Chunks that a worker keeps; the cache starts anew beyond it.
CACHED = 1_000_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts. With space_splits, the tokenizer must end a token at each space and drop spaces (as the word-level
    vocabularies do), so that the ids of a text are those of its space-separated chunks in a row."""

    def __init__(self, path: str, space_splits: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.space_splits = space_splits
        self.merger = WordMerger(path) if space_splits else None
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.pool = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def _raw(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        run = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        ids = [e.ids for e in run(texts, add_special_tokens=False)]
        sizes = np.array([len(x) for x in ids], np.int64)
        return np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum())), sizes

    def _add(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        at, base = len(self.pool), len(self.known)
        self.pool = np.concatenate([self.pool, ids])
        self.start = np.concatenate([self.start, at + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.known.update(zip(keys, range(base, base + len(keys))))

    def _learn(self, chunks: list[str], kind: str) -> None:
        if kind == "word":
            self._add(chunks, *self.merger.encode(chunks))
        else:
            self._add([kind + c for c in chunks], *self._raw(chunks))

    def _places(self, keys: list[str], kind: str) -> np.ndarray:
        """Cache places of chunks; new ones are encoded in one batch."""
        get, pre = self.known.get, "" if kind == "word" else kind
        places = np.array([get(pre + x, -1) for x in keys] if pre else [get(x, -1) for x in keys], np.int64)
        new = np.flatnonzero(places < 0)
        if len(new):
            missing = list(dict.fromkeys(keys[i] for i in new))
            self._learn(missing, kind)
            places[new] = [self.known[pre + keys[i]] for i in new]
        return places

    def _codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Two cache places of each chunk in a row (the second for marks behind a word), and the chunks of each text.

        Chunks of letters in lower case, without the marks behind them, are merged in batches; all others go to the
        tokenizer as they are (under a key that no word has).
        """
        chunks = [t.replace("\n", " ").split(" ") if self.space_splits else [t] for t in texts]
        counts = np.array([len(c) for c in chunks], np.int64)
        if any("\0" in t for t in texts):  # pd.factorize ends a text at a NUL
            index: dict[str, int] = {}
            codes = np.array([index.setdefault(c, len(index)) for c in chain.from_iterable(chunks)], np.int64)
            distinct = np.array(list(index), object)
        else:
            codes, distinct = pd.factorize(np.array(list(chain.from_iterable(chunks)), object))
        if len(self.known) > CACHED:
            self.clear()
        places = np.zeros((len(distinct), 2), np.int64)
        if not self.space_splits:
            places[:, 0], places[:, 1] = self._places(distinct.tolist(), " "), self._places([""], " ")[0]
            return places[codes].ravel(), counts
        bare = [c.rstrip(MARKS) for c in distinct]
        lower = [w.lower() for w in bare]
        plain, known = self.merger.plain, self.known
        is_word = np.array([w in known or plain(w) for w in lower], bool)
        word, rest = np.flatnonzero(is_word), np.flatnonzero(~is_word)
        places[word, 0] = self._places([lower[i] for i in word], "word")
        places[word, 1] = self._places([distinct[i][len(bare[i]) :] for i in word], " ")
        places[rest, 0] = self._places([distinct[i] for i in rest], " ")
        places[rest, 1] = self._places([""], " ")[0]
        return places[codes].ravel(), counts * 2

    def lengths(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0, np.int64)
        places, counts = self._codes(texts)
        return np.add.reduceat(self.size[places], np.cumsum(counts) - counts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the ids of each text."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        places, counts = self._codes(texts)
        sizes = self.size[places]
        return _gather(self.pool, self.start[places], sizes), np.add.reduceat(sizes, np.cumsum(counts) - counts)


def _gather(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pool's slices one after the other."""
    at = np.cumsum(size) - size
    return pool[np.arange(int(size.sum())) + np.repeat(start - at, size)]


@lru_cache(maxsize=2)
def encoder(path: str, space_splits: bool = True) -> Encoder:
    """One encoder a worker."""
    return Encoder(path, space_splits)
