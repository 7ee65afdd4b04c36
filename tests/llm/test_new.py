"""Secret scans, ranked search and token alignment against brute force."""

import collections
import hashlib
import math
import random
import re
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.llm import alignment, ranked, secrets

CLASH = "doc_id long, text string, source string, id long, n long, hash string, spans string, term string, pairs string, start int"


def table(spark, rows):
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, None, 1, "h", "s", "t", "p", 0) for r in rows], CLASH).repartition(3)


ODD = [(900, None), (901, ""), (902, " \n\t "), (None, "null id"), (905, "x" * 300), (905, "x" * 300), (906, "é ñ 日本 \U0001f600 ")]


def brute_secrets(rows):
    pats = [
        ("assign", re.compile(r"""(?a:(?i:(password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")),
        ("access", re.compile(r"AKIA[A-Z0-9]+")),
        ("hex", re.compile(r"[0-9a-f]+")),
        ("mixed", re.compile(r"[A-Za-z0-9+/_-]+")),
    ]
    least = {"assign": 12, "access": 18, "hex": 16, "mixed": 20}
    owners, out = collections.defaultdict(set), []
    for doc_id, text, *owner in rows:
        spans, values = set(), []
        for k, (kind, p) in enumerate(pats):
            for m in p.finditer(text or ""):
                v = m.group(2) if kind == "assign" else m.group()
                if len(v) < least[kind] or kind == "mixed" and not (re.search("[0-9]", v) and re.search("[a-z]", v) and re.search("[A-Z]", v)):
                    continue
                owners[v].add((owner or [None])[0] or "")
                if k < 3:
                    spans.add((m.start(), k, m.end(), v))
                if re.search("[0-9]", v) and re.search("[A-Za-z]", v) and len(set(v)) >= 8 and not re.search(secrets.PLACEHOLDER, v):
                    values.append((m.end() - len(v), 4, m.end(), v))
        out.append((doc_id, spans, values))
    done = []
    for doc_id, spans, values in out:
        spans = spans | {s for s in values if len(owners[s[3]]) == 1}
        done.append((doc_id, tuple(sorted({(s[0], secrets.KINDS[s[1]], s[2], len(owners[s[3]])) for s in spans}))))
    return sorted(done, key=repr)


def test_secrets(spark):
    rng = random.Random(3)
    bits = ["password=", "Token : \"", "api_key='", "apikey=", "SECRET =  ", "passwd:", "AKIA", "akia", "\n", " ", "é", "😀", "=", ":"]
    values = ["".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in (11, 12, 16, 40)] + ["ABCDEFGH12345678ZZ", "aB3" * 8, "changeme_please1", "short", "Qz81kLmn0PqR7sTuVwXy", "token=secretvalue12345"]
    rows = list(ODD) + [(10, "password=token:abcdefghijklmnop1", "o1"), (11, "ſecret=abcdefghijkl1", "o1"), (12, "a" * 5000 + " password=" + "b1" * 3000, "o2")]
    for i in range(150):
        rows.append((i, "".join(rng.choice(bits + values) for _ in range(rng.randint(0, 30))), rng.choice(["o1", "o2", "o3", "o4", None])))
    rows += rows[-2:]
    got = secrets.scan_secrets(table(spark, rows), F.col("source"), F.col("source")).collect()
    told = sorted(((r["doc_id"], tuple(sorted((s["start"], s["kind"], s["end"], s["owners"]) for s in r["spans"]))) for r in got), key=repr)
    assert told == brute_secrets(rows)
    assert any(s["kind"] == "live" for r in got for s in r["spans"]) and any(s["copied"] for r in got for s in r["spans"])
    assert secrets.scan_secrets(table(spark, rows).limit(0), F.col("source"), F.col("source")).count() == 0


def test_secrets_split_hot_values(spark, monkeypatch):
    """The same result where no side is broadcast, with a value that one owner repeats in a third of all rows."""
    from marketlens.llm import common

    rows = [(i, f"password={'abcdef123456' if i % 3 == 0 else hashlib.md5(str(i).encode()).hexdigest()} x", "hot" if i % 3 == 0 else f"o{i % 7}") for i in range(600)]
    monkeypatch.setattr(common, "fits", lambda *a, **k: False)
    got = secrets.scan_secrets(table(spark, rows), F.col("source"), F.col("source")).collect()
    assert sorted(((r["doc_id"], tuple(sorted((s["start"], s["kind"], s["end"], s["owners"]) for s in r["spans"]))) for r in got), key=repr) == brute_secrets(rows)


def test_many_secrets_in_one_text(spark):
    text = "password=abcdefgh12345 " * 50_000
    got = secrets.scan_secrets(table(spark, [(1, text, "a"), (2, "x" * 3_000_000, "b")]), F.col("source"), F.col("source"))
    assert {r["doc_id"]: r["n"] for r in got.select("doc_id", F.size("spans").alias("n")).collect()} == {1: 100_000, 2: 0}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_rank(docs, items, k):
    bags = [(d, collections.Counter(words(t))) for d, t, *_ in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text, *_ in items:
        scores = []
        for d, b in bags:
            m = 25 + 75 * sum(b.values()) * n_docs // n_terms
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m)) for t, q in collections.Counter(words(text)).items() if t in b)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item_id, r, None if no else d, -s) for r, (s, no, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_terms", [1 << 18, 40])
def test_ranked(spark, block_terms):
    rng = random.Random(8)
    vocab = ["the", "The", "and", "of", "Ünö", "日本", "x1", "9"] + [f"w{i}" for i in range(60)]
    text = lambda n: rng.choice([" ", ", "]).join(rng.choices(vocab, [30, 5, 20, 20] + [2] * (len(vocab) - 4), k=n))
    docs = list(ODD) + [(i, text(rng.randint(0, 60))) for i in range(200)]
    docs += docs[-3:] + [(1000 + i, "w1 w2 w3") for i in range(30)]
    items = [(i, text(rng.randint(0, 25))) for i in range(30)] + [(3, "the w1 w1"), (None, "w2"), (77, None), (78, "zzz")]
    got = ranked.rank(table(spark, docs), table(spark, items).withColumnRenamed("doc_id", "item_id"), 4, block_terms)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_rank(docs, items, 4)
    empty = table(spark, items).withColumnRenamed("doc_id", "item_id").limit(0)
    assert ranked.rank(table(spark, docs), empty, 4).count() == 0
    assert ranked.rank(table(spark, docs).limit(0), table(spark, items).withColumnRenamed("doc_id", "item_id"), 4).count() == 0


def test_graph_shares_sums():
    rng = random.Random(2)
    shared = [f"s{i}" for i in range(20)]
    rows = [(i, t.encode(), 1 + (t == "s3")) for i in range(50) for t in shared[: rng.randint(10, 20)] + [f"own{i}"]]
    graph = ranked.mine(pd.DataFrame(rows, columns=["iid", "term", "times"]))
    assert graph.additions < (len(rows) - 50) / 3
    of_terms = np.random.default_rng(0).integers(0, 1000, (len(graph.terms), 7))
    want = [[sum(n * of_terms[graph.terms.index(t), d] for i, t, n in rows if i == iid) for d in range(7)] for iid in range(50)]
    assert ranked.sums(graph, of_terms).tolist() == want


def brute_align(texts):
    enc = alignment.encoders(*alignment.default_paths())
    out, docs_of = [], collections.Counter()
    for t in texts:
        a = enc.a.encode(" " + (t or ""), add_special_tokens=False).ids if t else []
        b = enc.b.encode(t) if t else []
        want = (" " + t).encode() if t else b""
        if not t or b"".join(enc.a_bytes[i] for i in a) != want or b"".join(enc.b_bytes[i] for i in b) != want:
            out.append((0, 0, 0, [], ""))
            continue
        of_byte = [[k for k, i in enumerate(ids) for _ in range(size[i])] for ids, size in ((a, enc.a_size), (b, enc.b_size))]
        links = sorted(set(zip(*of_byte)))
        ends = [set(np.cumsum(size[np.array(ids)]).tolist()) for ids, size in ((a, enc.a_size), (b, enc.b_size))]
        cuts = [0, *sorted(ends[0] & ends[1])]
        told = ";".join("|".join(",".join(str(ids[k]) for k in dict.fromkeys(of[x:y])) for ids, of in zip((a, b), of_byte)) for x, y in zip(cuts, cuts[1:]))
        pairs = [(a[i], b[j]) for i, j in links]
        docs_of.update(set(pairs))
        out.append((len(a), len(b), len(cuts) - 1, pairs, hashlib.sha256(told.encode()).hexdigest()))
    most = collections.defaultdict(int)
    for (a, _), n in docs_of.items():
        most[a] = max(most[a], n)
    return sorted((na, nb, g, len(p), sum(docs_of[x] == most[x[0]] for x in p), sum(docs_of[x] for x in p), h) for na, nb, g, p, h in out)


@pytest.mark.parametrize("block_pairs", [2_000_000, 30])
def test_alignment(spark, block_pairs):
    rng = random.Random(4)
    bits = ["the ", "tion", " ", "  ", "\n", " \n ", "\t", "é", "日本語", "😀", "<s>", "<|endoftext|>", "<0x41>", "'s", "don't", "1234", "Hello", " world", " ", "\x1c", "xq", "ä", "..."]
    texts = [t for _, t, *_ in ODD] + ["a▁b", "▁", "a\0b \0c", "   ", "a ", " a"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(120)]
    texts += texts[-2:]
    got = alignment.align_tokenizers(table(spark, list(enumerate(texts))), block_pairs=block_pairs)
    cols = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == brute_align(texts)
    assert alignment.align_tokenizers(table(spark, []), block_pairs=block_pairs).count() == 0


def test_diagonal_takes_stretches_at_once():
    ends = np.arange(1, 10_001) * 3
    other = np.delete(ends, 5000)
    assert alignment.diagonal(ends, other) == (9999, [(0, 0, 0, 5000), (5001, 5002, 5001, 4998)], [(5000, 5000, 5002, 5000, 5001)])
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 60)
        a, b = (np.array(sorted({n, *rng.sample(range(1, n + 1), rng.randint(0, n))})) for _ in range(2))
        g, runs, odd = alignment.diagonal(a, b)
        cuts = sorted({*a.tolist()} & {*b.tolist()})
        got = {k + d: (i + d, i + d + 1, j + d, j + d + 1) for k, i, j, size in runs for d in range(size)} | {k: tuple(x) for k, *x in odd}
        assert g == len(cuts) and [(a[got[k][1] - 1], b[got[k][3] - 1]) for k in range(g)] == [(c, c) for c in cuts]


def test_long_text(spark):
    rng = random.Random(6)
    vocab = ["".join(rng.choice("abcdefgéilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(20_000)]
    text = " ".join(rng.choice(vocab) for _ in range(1_000_000))
    assert len(text) > 5_000_000
    docs = table(spark, [(1, text, "a"), (2, text[:100], "a")])
    got = {r["doc_id"]: r for r in alignment.align_tokenizers(docs).collect()}
    assert got[1]["n_links"] == got[1]["n_a"] + got[1]["n_b"] - got[1]["n_groups"] > 1_000_000
    items = table(spark, [(5, text[:400])]).withColumnRenamed("doc_id", "item_id")
    assert {r["doc_id"] for r in ranked.rank(docs, items).collect()} <= {1, 2}


def test_close_removes_what_results_read(spark):
    import os

    from marketlens.llm import common

    found = secrets.scan_secrets(table(spark, [(1, "password=abcdef123456", "o")]), F.col("source"), F.col("source"))
    assert found.count() == 1
    base = common.shared_dir(spark).removeprefix("file://")
    held = {p for p in common._LEFT if os.path.isdir(p.removeprefix("file://"))}
    assert any("/secrets-" in p for p in held) and os.path.isdir(base)
    common.close(spark)
    assert not common._LEFT and not any(os.path.isdir(p.removeprefix("file://")) for p in held)
