"""Language ID: unigram piece probabilities per language, marginalised over all segmentations of each word.

A text's likelihood in a language is the product over its words of the sum, over all ways to cut the word into pieces
of a fixed public vocabulary, of the product of the pieces' probabilities (a forward algorithm). Pieces never cross
words, so words are scored once each. The probabilities are fitted by expectation maximisation over the word counts
of labelled documents, with forward and backward sums; each round is a Spark job over the stored word counts, and the
driver holds the model alone (pieces x languages).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_chars, extended, small_batches, stored

WORDS = re.compile(r"[^\W\d_]+")
#: Characters of the longest piece of the default vocabulary, with its mark; a lattice takes its own vocabulary's.
PIECE_CHARS = 16
#: Cells (characters x words x languages) that are worked on at once; longer words go strip by strip.
CELLS = 2_000_000
#: Words up to this length are summed without rescaling.
PLAIN_CHARS = 24
#: Documents of each language that the model is fitted on, in expectation.
SAMPLE_PER_LANGUAGE = 4000
MAX_LANGUAGES = 500
ROUNDS = 3
#: Probability of a character that no piece covers.
UNKNOWN = 1e-7


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def pieces_of(path: str) -> tuple[str, ...]:
    """The vocabulary's pieces of letters (lower-cased, a leading mark for the start of a word), in its order."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out = dict.fromkeys(
        p.lower() for p in (sp.id_to_piece(i) for i in range(sp.get_piece_size())) if not (sp.is_control(sp.piece_to_id(p)) or sp.is_byte(sp.piece_to_id(p)))
    )
    return tuple(p for p in out if re.fullmatch(r"▁?[^\W\d_]+|▁", p))


_MULT = np.uint64(0x9E3779B97F4A7C15)


def _hash_step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    h = (h ^ (c + np.uint64(0x632BE59BD9B4E019))) * _MULT
    return h ^ (h >> np.uint64(29))


@lru_cache(maxsize=2)
def _index(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Sorted hashes of the pieces, each one's place in the vocabulary, a filter of the hashes, the longest piece."""
    out = []
    for p in pieces_of(path):
        h = np.zeros(1, np.uint64)
        for ch in p:
            h = _hash_step(h, np.array([ord(ch)], np.uint64))
        out.append(h[0])
    hashes = np.array(out, np.uint64)
    order = np.argsort(hashes)
    seen = np.zeros(1 << 20, bool)
    seen[hashes >> np.uint64(44)] = True
    return hashes[order], order, seen, max(map(len, pieces_of(path)))


class Lattice:
    """All pieces in all words of a list, and the sums over their segmentations.

    The words should be of like length (see `blocks`). Pieces are found in strips of characters; sums carry the
    last alphas alone from strip to strip, so a word of any length is scored whole. Long words' sums are rescaled.
    """

    def __init__(self, words: list[str], path: str):
        self.path, self.n, self.size = path, len(words), len(pieces_of(path))
        self.longest = _index(path)[3]
        marked = ["▁" + w for w in words]
        self.lens = np.array([len(w) for w in marked], np.int64)
        self.width = int(self.lens.max()) if len(words) else 0
        flat = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
        grid = np.zeros((self.n, self.width), np.uint32)
        grid[np.arange(self.width) < self.lens[:, None]] = flat
        self.grid = np.ascontiguousarray(grid.T)
        self.strip = min(16_384, max(64, CELLS // 16 // max(1, self.n)))
        self._last = (-1, [])

    def hits(self, start: int) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each character of the strip from start: (length, words, places) of the pieces that begin there.

        A single character that is no piece has the place behind the vocabulary (unknown).
        """
        if self._last[0] == start:
            return self._last[1]
        hashes, places, seen, _ = _index(self.path)
        k = min(self.strip, self.width - start)
        out: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(k)]
        h = np.zeros((k, self.n), np.uint64)
        for m in range(1, min(self.longest, self.width - start) + 1):
            chars = self.grid[start + m - 1 : start + m - 1 + k]
            h = _hash_step(h[: len(chars)], chars.astype(np.uint64))
            inside = chars != 0
            maybe = np.flatnonzero(inside if m == 1 else seen[h >> np.uint64(44)] & inside)
            own = h.ravel()[maybe]
            i = np.searchsorted(hashes, own)
            i[i == len(hashes)] = 0
            ok = hashes[i] == own
            place = np.where(ok, places[i], self.size)
            if m > 1:
                maybe, place = maybe[ok], place[ok]
            col, row = np.divmod(maybe, self.n)
            at = np.searchsorted(col, np.arange(len(chars) + 1))
            for c in np.flatnonzero(np.diff(at)).tolist():
                out[c].append((m, row[at[c] : at[c + 1]], place[at[c] : at[c + 1]]))
        self._last = (start, out)
        return out

    def arcs(self, probs: np.ndarray) -> np.ndarray:
        """Probability of each place; the one behind the vocabulary is an uncovered character's."""
        return np.concatenate([probs, np.full((1, *probs.shape[1:]), UNKNOWN)])

    def _strip(self, arcs: np.ndarray, start: int, ring: np.ndarray, logs: np.ndarray, out: np.ndarray, keep: list | None = None) -> None:
        """Carry the alphas in ring, divided by exp(logs), over the strip from start; words that end in it go to out.

        keep takes each character's alphas and the logarithm that they are divided by.
        """
        slots = len(ring)
        for c, found in enumerate(self.hits(start), start):
            alpha = ring[c % slots]
            if keep is not None:
                keep.append((alpha.copy(), logs.copy()))
            for m, row, place in found:
                ring[(c + m) % slots][row] += alpha[row] * arcs[place]
            alpha[:] = 0
            done = np.flatnonzero(self.lens == c + 1)
            if len(done):
                out[done] = np.log(ring[(c + 1) % slots][done]) + logs[done]
            if c % 8 == 7:
                self._rescale(ring, logs)

    def _rescale(self, ring: np.ndarray, logs: np.ndarray) -> None:
        if self.width > PLAIN_CHARS:
            most = ring.max(0)
            most[most == 0] = 1
            ring /= most
            logs += np.log(most)

    def forward(self, arcs: np.ndarray, starts: list | None = None) -> np.ndarray:
        """Logarithm of each word's sum over its segmentations (words, or words x languages, as arcs).

        starts takes what each strip begins with.
        """
        shape = (self.n, *arcs.shape[1:])
        ring, logs, out = np.zeros((self.longest + 1, *shape)), np.zeros(shape), np.zeros(shape)
        ring[0] = 1
        for start in range(0, self.width, self.strip):
            if starts is not None:
                starts.append((start, ring.copy(), logs.copy()))
            self._strip(arcs, start, ring, logs, out)
        return out

    def totals(self, logs: np.ndarray) -> np.ndarray:
        return np.exp(logs)

    def expected(self, arcs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, from forward and backward sums, with each word's weight."""
        starts: list = []
        total = self.forward(arcs, starts)
        slots = self.longest + 1
        ring = np.zeros((slots, self.n))
        logs = np.zeros(self.n)
        uses = np.zeros(self.size + 1)
        for start, *begin in reversed(starts):
            used: list[tuple[np.ndarray, np.ndarray]] = []
            keep: list = []
            self._strip(arcs, start, *begin, np.empty(self.n), keep)
            found = self.hits(start)
            for c in range(start + len(found) - 1, start - 1, -1):
                ring[(c + 1) % slots][self.lens == c + 1] = 1
                beta = ring[c % slots]
                beta[:] = 0
                alpha, scale = keep.pop()
                scale = alpha * weight * np.exp(scale + logs - total)
                for m, row, place in found[c - start]:
                    way = arcs[place] * ring[(c + m) % slots][row]
                    beta[row] += way
                    used.append((place, scale[row] * way))
                if c % 8 == 0:
                    self._rescale(ring, logs)
            if used:
                uses += np.bincount(np.concatenate([p for p, _ in used]), np.concatenate([u for _, u in used]), self.size + 1)
        return uses[:-1]


def blocks(words: list[str], languages: int = 1) -> Iterator[np.ndarray]:
    """Places of words of like length, about CELLS cells (characters x languages) at once; a longer word is alone."""
    lens = np.array([len(w) + 1 for w in words], np.int64)
    order = np.argsort(lens, kind="stable")
    sizes = lens[order]
    start = 0
    while start < len(order):
        # up to a quarter longer than the shortest, as far as the cells go
        end = int(np.searchsorted(sizes, sizes[start] * 5 // 4, "right"))
        end = max(start + 1, min(end, start + CELLS // 2 // int(sizes[end - 1] * languages)))
        yield order[start:end]
        start = end


def words_in(text: str) -> list[str]:
    """Lower-cased runs of letters, each whole."""
    return WORDS.findall(text.lower())


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(g, w) for g, t in zip(pdf["lang"], pdf["text"]) for w in words_in(t)]
        if rows:
            yield pd.DataFrame(rows, columns=["lang", "word"]).groupby(["lang", "word"], sort=False).size().rename("n").reset_index()


def _expect(path: str, shared):
    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                words, n = part["word"].tolist(), part["n"].to_numpy(np.float64)
                for at in blocks(words):
                    lattice = Lattice([words[i] for i in at], path)
                    got = lattice.expected(lattice.arcs(model[lang]), n[at])
                    sums[lang] = sums.get(lang, 0) + got
        for lang, s in sums.items():
            at = np.flatnonzero(s)
            yield pd.DataFrame({"lang": lang, "piece": at, "uses": s[at]})

    return expect


def fit(docs: DataFrame, path: str | None = None, per_language: int = SAMPLE_PER_LANGUAGE, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """{language: piece probabilities} from rows with a text and a lang, by EM over their word counts.

    A language with more than per_language labelled documents is sampled by the hash of the text (whole texts; the
    bound holds in expectation); the sample is the same however rows are dealt. MAX_LANGUAGES bounds the model.
    """
    path = path or default_vocabulary()
    spark = docs.sparkSession
    small_batches(spark)
    labelled = docs.where("text is not null and lang is not null").select("text", F.col("lang").alias("lang"))
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return {}
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, per_language / r["n"])))])
    chosen = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.try_element_at(share, F.col("lang")) * (1 << 20)
    counted = labelled.where(chosen).select("lang", "text").mapInPandas(_count_words, "lang string, word string, n long")
    words = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    size = len(pieces_of(path))
    flat = np.array([2.0 ** -len(p) for p in pieces_of(path)])
    model = {r["lang"]: flat / flat.sum() for r in sizes}
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)  # pieces x languages
        uses = words.mapInPandas(_expect(path, shared), "lang string, piece long, uses double")
        uses = uses.groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).toPandas()  # pieces x languages at most
        shared.unpersist()
        for lang in model:
            own = uses[uses["lang"] == lang]
            c = np.full(size, 0.02)
            np.add.at(c, own["piece"].to_numpy(np.int64), own["uses"].to_numpy())
            model[lang] = c / c.sum()
    return model


def _predict(path: str, shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, probs = shared.value
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            pred, score = [], []
            for a, b in by_chars(texts):
                p, s = score_texts(texts[a:b], langs, probs, path)
                pred += p
                score += s
            yield extended(batch, ["_text"], {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64())})

    return predict


def score_texts(texts: list[str | None], langs: list[str], probs: list[np.ndarray], path: str) -> tuple[list[str], list[float]]:
    """Best language and its posterior (equal priors) for each whole text; `und` with 0 without letters."""
    words = [words_in(t) if t else [] for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    flat = np.empty(int(counts.sum()), object)
    flat[:] = [x for w in words for x in w]
    codes, distinct = pd.factorize(flat)
    logp = np.zeros((len(distinct), len(langs)))
    if len(langs):
        table = np.stack(probs, axis=1)
        for at in blocks(distinct, len(langs)):
            lattice = Lattice([distinct[i] for i in at], path)
            logp[at] = lattice.forward(lattice.arcs(table))
    sums = np.zeros((len(texts), len(langs)))
    doc = np.repeat(np.arange(len(texts)), counts)
    for j in range(len(langs)):
        sums[:, j] = np.bincount(doc, logp[codes, j], len(texts)) if len(codes) else 0
    pred, score = [], []
    for t, n, s in zip(texts, counts, sums):
        if not t or not n and not any(map(str.isalpha, t)) or not any(map(str.isalpha, t)) or not len(langs):
            pred.append("und")
            score.append(0.0)
            continue
        best = int(np.argmax(s))
        pred.append(langs[best])
        score.append(float(1 / np.exp(s - s[best]).sum()))
    return pred, score


def predict(docs: DataFrame, model: dict[str, np.ndarray], path: str | None = None, carry: list[str | Column] = ("doc_id",)) -> DataFrame:
    """The carried columns, lang_pred and score of each whole text.

    Nulls: a null text, or one without a letter, is `und` with score 0. Ties go to the first language by name.
    Repeated rows each get the same result. An empty table gives an empty result; an empty model gives `und`.
    """
    small_batches(docs.sparkSession)
    langs = sorted(model)
    shared = docs.sparkSession.sparkContext.broadcast((langs, [model[x] for x in langs]))
    rows = docs.select(*carry, F.col("text").alias("_text"))
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text"), "lang_pred string", "score double"])
    return rows.mapInArrow(_predict(path or default_vocabulary(), shared), out)
