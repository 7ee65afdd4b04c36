"""Training-data operators do the whole job: whole words, repeated and null ids, archives that hold the magic."""

import math
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import ROOT

sys.path.insert(0, ROOT)
import corpus_pipeline  # noqa: E402

from marketlens.llm import language_id, warc  # noqa: E402


def brute_sums(word, table, unknown):
    """Logarithm of the sum over all segmentations and the expected uses, piece by piece, in exact fractions."""
    from fractions import Fraction as Fr

    s = "▁" + word
    arcs = [(i, j, s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1) if s[i:j] in table or j == i + 1]
    p = {x: Fr(table.get(x[2], unknown)) for x in arcs}
    alpha, beta = [Fr(1)] + [Fr(0)] * len(s), [Fr(0)] * len(s) + [Fr(1)]
    for x in sorted(arcs, key=lambda x: x[1]):
        alpha[x[1]] += alpha[x[0]] * p[x]
    for x in sorted(arcs, key=lambda x: -x[0]):
        beta[x[0]] += beta[x[1]] * p[x]
    z = alpha[-1]
    log = math.log(z.numerator) - math.log(z.denominator)
    uses = {}
    for i, j, t in arcs:
        if t in table:
            uses[t] = uses.get(t, 0) + float(alpha[i] * p[i, j, t] * beta[j] / z)
    return log, uses


@pytest.mark.parametrize("cells", [language_id.CELLS, 1])
def test_language_sums_are_over_whole_words_and_pieces(monkeypatch, cells):
    monkeypatch.setattr(language_id, "CELLS", cells)
    path = language_id.default_vocabulary()
    pieces = language_id.pieces_of(path)
    assert {"▁gouvernement", "▁dezember", "algorithm"} <= set(pieces) and max(map(len, pieces)) == language_id.PIECE_CHARS
    probs = np.random.default_rng(0).random(len(pieces))
    probs /= probs.sum()
    table = dict(zip(pieces, probs.tolist()))
    words = ["gouvernement", "x", "dezember" * 3, "the" * 30, "日本語" * 60 + "algorithm", "b" * 47 + "and", "ꙮ" * 70, "a"]
    assert language_id.words_in(" ".join(words)) == words
    want = [brute_sums(w, table, language_id.UNKNOWN) for w in words]
    weight = np.arange(1.0, len(words) + 1)
    uses, seen = np.zeros(len(pieces)), []
    for at in language_id.blocks(words):
        lattice = language_id.Lattice([words[i] for i in at], path)
        assert np.allclose(lattice.forward(lattice.arcs(probs)), [want[i][0] for i in at], rtol=1e-10)
        two = lattice.forward(lattice.arcs(np.stack([probs, probs[::-1]], axis=1)))
        assert np.allclose(two[:, 0], [want[i][0] for i in at], rtol=1e-10)
        uses += lattice.expected(lattice.arcs(probs), weight[at])
        seen += at.tolist()
    assert sorted(seen) == list(range(len(words)))
    brute = np.zeros(len(pieces))
    for w, (_, u) in zip(weight, want):
        for t, x in u.items():
            brute[pieces.index(t)] += w * x
    assert np.allclose(uses, brute, rtol=1e-8, atol=1e-12)


def test_near_copies_with_repeated_and_null_ids(spark):
    words = lambda k, n=60: " ".join(f"{k}{i}" for i in range(n))
    rows = [
        (7, words("a")), (7, words("a") + " more"),  # one id, two near copies
        (5, words("t")), (5, words("b")), (2, words("b") + " more"),  # 5 is kept for one text alone
        (None, words("c")), (None, words("c") + " more"), (None, words("d")), (1, words("d") + " more"), (None, words("e")),
        (8, words("f")), (8, words("f")), (9, ""), (9, ""), (10, None), (None, None),
    ]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs.repartition(3), "")
    assert out.dtypes == docs.dtypes
    got = sorted(((r["doc_id"], (r["text"] or "-")[:1]) for r in out.collect()), key=repr)
    want = [(7, "a"), (5, "t"), (2, "b"), (None, "c"), (1, "d"), (None, "e"), (8, "f"), (9, "-"), (10, "-"), (None, "-")]
    assert got == sorted(want, key=repr)


def test_warc_urls_with_the_magic(spark, tmp_path):
    urls = ["http://a/WARC/1.0", "http://b", "http://c/WARC/1.0/WARC/1.1?WARC/1.", "WARC/1%2E", "WARC/1%25WARC/1.", "WARC/1%252E", "WARC/1%", "http://d"]
    pages = spark.createDataFrame([(i, u, f"<p>{i}</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    for df, name in ((pages.coalesce(1).orderBy("page_id"), "first"), (pages.coalesce(1).orderBy(F.desc("page_id")), "middle")):
        got = warc.round_trip(df, str(tmp_path / name)).collect()
        assert sorted((r["page_id"], r["url"], bytes(r["payload"]).decode()) for r in got) == [(i, u, f"<p>{i}</p>") for i, u in enumerate(urls)]
