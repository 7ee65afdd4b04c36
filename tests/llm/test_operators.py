"""Each operator against a brute-force version, on small tables with nulls, empty and repeated rows and odd columns."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import decontaminate, jaccard, language_id, packing, sharding, suffix_dedup, token_counts, topk, url_filter, warc
from marketlens.llm.suffix_array import suffix_array

DOCS = "doc_id long, text string, lang string, cls string, shard int, `_key` string, n long, row string"


def docs_of(spark, rows):
    """rows of (doc_id, text[, lang]); the other columns clash with names that the operators use."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, "x", 7, "y", None, None) for r in rows], DOCS)


ODD = [(900, None), (901, ""), (902, " \n\t "), (903, "a b"), (904, "A  b"), (None, "null id " * 40), (905, "x" * 5000), (905, "x" * 5000), (906, "é ñ 日本 " * 30)]


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(400):
        t = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 40))]
        t = t[:6] * 6 if rng.random() < 0.3 else t
        assert suffix_array(np.array(t, np.int64)) == sorted(range(len(t)), key=lambda i: t[i:])


def brute_repeats(texts, m):
    seen = collections.Counter(t[i : i + m] for t in texts for i in range(len(t) - m + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - m + 1):
            if seen[t[i : i + m]] > 1:
                gone[i : i + m] = b"\1" * m
        kept = bytes(x for x, g in zip(t, gone) if not g)
        out.append((len(t), len(t) - len(kept), sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("limits", [{}, {"bin_contexts": 5, "group_contexts": 3}])
def test_suffix_dedup(spark, limits):
    rng = random.Random(5)
    base = ["".join(rng.choice("abc é") for _ in range(300)) for _ in range(5)]
    rows = list(ODD)
    for i in range(40):
        t = ""
        for _ in range(rng.randint(1, 3)):
            x = rng.randint(0, 150)
            t += rng.choice(base)[x : x + rng.randint(50, 250)] + rng.choice(["", "xyz", str(i)])
        rows.append((i, t))
    rows += rows[-2:]
    got = suffix_dedup.remove_repeats(docs_of(spark, rows), 80, **limits)
    got = [tuple(r) for r in got.collect()]
    want = [(d, *w) for (d, _), w in zip(rows, brute_repeats([(r[1] or "").encode() for r in rows], 80))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = suffix_dedup.remove_repeats(docs_of(spark, rows), 80, keep_text=True, carry=["lang"], **limits).collect()
    assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in kept)
    assert suffix_dedup.remove_repeats(docs_of(spark, []), 80).count() == 0


def test_many_spans_in_one_text(spark):
    """Thousands of spans of one text are merged in one pass."""
    rng = random.Random(7)
    shared = ["".join(rng.choices("abcdefghij", k=70)) for _ in range(40)]
    text = "".join(rng.choice(shared) + f"-{i}-" for i in range(5000))
    got = suffix_dedup.remove_repeats(docs_of(spark, [(1, text), (2, "z" * 300)]), 64).where("doc_id = 1").first()
    assert tuple(got)[1:] == brute_repeats([text.encode()], 64)[0] and got["n_spans"] > 1000


def test_contexts_of_a_frequent_gram_are_split(spark, monkeypatch):
    """One passage in many texts: the join that deals contexts by gram can be split inside a gram."""
    rng = random.Random(11)
    passage = "".join(rng.choices("abcdefghij", k=90))
    rows = [(i, "".join(rng.choices("klmnop", k=200)) + passage + "".join(rng.choices("klmnop", k=200))) for i in range(600)]
    conf = {"autoBroadcastJoinThreshold": "-1", "adaptive.advisoryPartitionSizeInBytes": "2k", "adaptive.coalescePartitions.enabled": "false"}
    conf |= {"adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "adaptive.skewJoin.skewedPartitionFactor": "1.0", "files.maxPartitionBytes": "4k", "files.openCostInBytes": "1"}
    plans, keep = {}, suffix_dedup.Scratch.stored

    def stored(self, df, name, files=None):
        if name == "needed":
            df.collect()
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(self, df, name, files)

    monkeypatch.setattr(suffix_dedup.Scratch, "stored", stored)
    before = {f"spark.sql.{k}": spark.conf.get(f"spark.sql.{k}") for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(f"spark.sql.{k}", v)
        got = [tuple(r) for r in suffix_dedup.remove_repeats(docs_of(spark, rows), 80).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = [(d, *w) for (d, _), w in zip(rows, brute_repeats([r[1].encode() for r in rows], 80))]
    assert sorted(got) == sorted(want)
    assert "skew=true" in plans["needed"]


def brute_components(rows, n, num, den):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                root[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[find(i)].append(d)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return [(d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("leaf, block, pivots", [(32, 2048, 16), (3, 2048, 2), (3, 20, 4)])
def test_jaccard(spark, monkeypatch, leaf, block, pivots):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(vocab) for _ in range(rng.randint(20, 60))] for _ in range(8)]
    rows = [x for x in ODD if x[0] is not None]
    for i in range(150):
        b = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            b[rng.randrange(len(b))] = rng.choice(vocab)
        rows.append((i, (bases[0][:20] if rng.random() < 0.3 else []) and " ".join(bases[0][:20] + b) or " ".join(b)))
    rows += rows[-3:]
    got = [tuple(r) for r in jaccard.jaccard_components(docs_of(spark, rows), 2, 70, 100).collect()]
    assert sorted(got) == sorted(brute_components(rows, 2, 70, 100))


def _families(rng, families, members, singles, words=60):
    """Near copies of few texts, and texts of their own, all of which share one passage."""
    vocab, shared = [f"v{i}" for i in range(5000)], [f"s{i}" for i in range(6)]
    bases = [shared + rng.choices(vocab, k=words) for _ in range(families)]
    out = []
    for b in bases:
        for _ in range(members):
            t = list(b)
            t[rng.randrange(6, len(t))] = rng.choice(vocab)
            out.append(t)
    return out + [shared + rng.choices(vocab, k=words) for _ in range(singles)]


def test_cells_divide_families(spark, monkeypatch):
    """Balls take their families whole, guests are few, and no linked pair is in no common cell."""
    rng = random.Random(1)
    sets = jaccard.shingle_sets([" ".join(t) for t in _families(rng, 5, 40, 30)], 3)
    sig = np.stack([np.frombuffer(jaccard.signature(s), np.uint64) for s in sets])
    n = np.array([len(s) for s in sets])
    pivots = [(int(n[i]), sig[i].tobytes()) for i in (0, 40, 80, 120, 205)]
    cell, guest = jaccard.divide_members(n, sig, pivots, 80, 100)
    assert [set(cell[40 * f : 40 * f + 40]) for f in range(4)] == [{0}, {1}, {2}, {3}] and set(cell[160:200]) == {-1}
    assert guest.sum() < len(sets) / 10  # replicas: far fewer than members
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = cell[i], cell[j]
                assert a == b or a >= 0 and guest[j, a] or b >= 0 and guest[i, b]


def test_cells_are_linear_in_members(spark, monkeypatch):
    """On regions whose members are near one another, cells and replicas grow with the members; results stay exact."""
    monkeypatch.setattr(jaccard, "LEAF", 8)
    counted = []
    plain = jaccard._Join.cells

    def cells(job, members, files):
        out = plain(job, members, files)
        counted.append((members.count(), out.count(), out.where("not own").count()))
        return out

    monkeypatch.setattr(jaccard._Join, "cells", cells)
    rng = random.Random(2)
    sentences = [" ".join(rng.choices([f"v{i}" for i in range(400)], k=9)) for _ in range(16)]
    for docs in (40, 100):
        rows = [(i, " ".join(s for k, s in enumerate(sentences) if k not in set(rng.sample(range(16), 5)))) for i in range(docs)]
        got = [tuple(r) for r in jaccard.jaccard_components(docs_of(spark, rows), 3, 75, 100).collect()]
        assert sorted(got) == sorted(brute_components(rows, 3, 75, 100))
    assert len(counted) == 2 and all(given > 0 for given, _, _ in counted)
    assert counted[1][0] > counted[0][0] and all(out <= jaccard.COPIES**jaccard.DEPTH * given for given, out, _ in counted)


def test_jaccard_empty(spark):
    assert jaccard.jaccard_components(docs_of(spark, []), 4, 85, 100).count() == 0
    only = jaccard.jaccard_components(docs_of(spark, [(1, None), (None, "a b c d e"), (None, "a b c d e")]), 4, 85, 100).collect()
    assert sorted(map(tuple, only), key=repr) == sorted([(1, 0, 1), (None, 2, None), (None, 2, None)], key=repr)


def test_decontaminate(spark):
    items = [(1, "The quick Brown fox jumps over the lazy dog and runs away home"), (2, "short one"), (3, None), (4, "?!"), (5, "short one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    text = "zero one THE quick brown, fox jumps over the lazy dog and runs! end short one"
    rows = [*ODD, (1, text), (1, text), (2, "the quick brown fox jumps over the lazy cat"), (3, "one short")]
    got = {(r["doc_id"], r["n_words"]): (r["n_hit"], r["items"], r["contaminated"]) for r in decontaminate.contamination(docs_of(spark, rows), bench, 10).collect()}
    assert got[(1, 16)] == (13, ["1", "2", "5"], True)
    assert got[(2, 9)] == (0, [], False) and got[(3, 2)] == (0, [], False) and got[(900, 0)] == (0, [], False)
    assert decontaminate.contamination(docs_of(spark, rows), bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(docs_of(spark, []), bench).count() == 0
    near = [(1, "dog lazy the over jumps x fox y brown quick the"), (2, text), (3, "the quick brown fox")]
    found = {tuple(r) for r in decontaminate.proximity_matches(docs_of(spark, near), bench, 10, 2).select("doc_id", "item_id").distinct().collect()}
    assert found == {(2, 1), (2, 2), (2, 5)}


def test_sharding(spark):
    rows = [*ODD, *((i, f"text {i}") for i in range(400))]
    got = sharding.shard_documents(docs_of(spark, rows)).collect()
    assert len(got) == len(rows) and {r["shard"] for r in got} == set(range(16))
    for s in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert all(r["grown_shard"] in (r["shard"], 16) for r in got)
    assert 5 < sum(r["grown_shard"] == 16 for r in got) < 60
    want = collections.Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert sharding.shard_documents(docs_of(spark, [])).count() == 0


def test_sharding_confines_movement(spark):
    before = sharding.default_topology(16)
    after = [(a, b, s, 2.0 if s == 5 else w) for a, b, s, w in before]
    df = sharding.assign_shards(sharding.assign_shards(spark.range(4000), "id", before, "x"), "id", after, "y")
    moved = df.where("x != y").collect()
    inside = {s for a, _, s, _ in before if a == "r1"}
    assert moved and all(r["y"] in inside for r in moved)  # rows move only into the region whose weight grew
    share = df.where("y = 5").count() / 4000
    assert 0.07 < share < 0.17


def test_warc(spark, tmp_path):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1."
    rows = [(1, "http://a/b", "<p>x</p>"), (2, "http://a/c", "<p>x</p>"), (3, None, None), (4, "u\r\nX: y", ""), (5, "http://é", fake), (6, "z", fake * 3 + "é"), (6, "z", fake * 3 + "é"), (None, "n", "n" * 9000), (7, "q", "\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, offset string, file int")
    path = str(tmp_path / "w")
    got = warc.round_trip(pages.repartition(2), path).collect()
    best = {}
    for p, _, h in rows:
        h = h or ""
        best[h] = max(best.get(h, -1), -1 if p is None else p)
    want, seen = [], set()
    for p, _, h in rows:
        data = (h or "").encode()
        first = (best[h or ""] == (-1 if p is None else p)) and h not in seen
        seen |= {h} if first else set()
        want.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first else "revisit", None if first else best[h or ""]))
    assert sorted((tuple(r)[0], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got if r["page_id"] is not None) == sorted(w for w in want if w[0] is not None)
    texts = {r["page_id"]: bytes(r["payload"]).decode() for r in got if r["record_type"] == "response"}
    assert texts[5] == fake and texts[6] == fake * 3 + "é" and texts[None] == "n" * 9000
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # the same archives in many splits
    again = warc.page_records(warc.read_archives(spark, path)).collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert warc.round_trip(pages.limit(0), str(tmp_path / "e")).count() == 0


def test_url_rules(spark):
    rules = spark.createDataFrame([("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("org", None, "block"), (None, "/", "block")], "host string, path string, verdict string")
    urls = {"http://a.Example.com/en/77?x": "example.com/en/7", "http://b.com/en/1": "com/en/", "http://com/en/": "com/en/", "http://xcom/en/": None, "http://a.org": "org", "no": None, None: None, "http:///en/": None, "https://example.com/EN/7#f": None}
    pages = spark.createDataFrame([(i, u, "k", "r") for i, u in enumerate([*urls, *urls])], "page_id long, url string, key string, rule string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages, rules).collect()}
    assert [got[i]["rule"] for i in range(len(urls) * 2)] == [*urls.values()] * 2
    assert got[0]["verdict"] == "allow" and got[1]["verdict"] == "block" and got[5]["verdict"] == "allow" and got[0]["host"] == "a.example.com"
    assert url_filter.judge_urls(pages, rules.limit(0)).where("verdict = 'allow'").count() == len(urls) * 2
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    listed = spark.createDataFrame([("HTTP://b.com/en/1#x",), (None,)], "url string")
    assert url_filter.drop_listed(pages, listed).count() == len(urls) * 2 - 2


def test_hosts_of_many_labels(spark):
    """Only suffixes that a rule can have are made: linear in the labels."""
    import time

    rules = spark.createDataFrame([("example.com", "/en/", "block"), ("com", "/x", "block"), ("a.b.c.d.com", "/", "allow")], "host string, path string, verdict string")
    long = "http://" + "a." * 100_000
    pages = spark.createDataFrame([(1, long + "example.com/en/1"), (2, long + "org/en/"), (3, "http://c.d.com/en/"), (4, "http://z.a.b.c.d.com/en/"), (5, "http://" + "." * 200_000 + "com/x")], "page_id long, url string").repartition(2)
    url_filter.judge_urls(pages.limit(1), rules).count()  # warm
    start = time.time()
    got = {r["page_id"]: r["rule"] for r in url_filter.judge_urls(pages, rules).select("page_id", "rule").collect()}
    assert got == {1: "example.com/en/", 2: None, 3: None, 4: "a.b.c.d.com/", 5: "com/x"} and time.time() - start < 5


def test_language_of_null_ids(spark, tmp_path):
    from marketlens.llm import queries

    rows = [(None, "the cat sat on the mat " * 9, "en"), (None, "der hund und die katze " * 9, "de"), (7, "the mat", "en"), (8, None, "de")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op1_language_id(spark, str(tmp_path)).collect()
    assert sorted(r["lang_pred"] for r in got) == ["de", "en", "en", "und"] and not any(r["held_out"] is None for r in got)


def test_url_filter_by_block(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "FILTER_WORDS", 0)
    test_url_rules(spark)


def test_packing_and_counts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(2)
    rows = [*ODD, *((i, " ".join(rng.choice(["the", "<|endoftext|>", "don't", "ÉTÉ", "x1y", "\n", "a  b", "日本", "…!", "hello\0world", "hello\0moon", "\0"]) for _ in range(rng.randint(0, 300)))) for i in range(60))]
    df = docs_of(spark, rows)
    got = packing.pack(df, most=64, keep_ids=True).collect()
    want = collections.Counter()
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for s in range(0, len(ids), 64):
            part = ids[s : s + 64]
            want[(d, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids))] += 1
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 64
    lens = sorted(len(tok.encode(t or "", add_special_tokens=False).ids) for _, t in rows)
    sums = token_counts.token_counts(df)
    for r in sums.collect():
        n = r["length"]
        assert r["n_docs"] == lens.count(n) and r["docs_at_least"] == sum(x >= n for x in lens) and r["tokens_at_least"] == sum(x for x in lens if x >= n)
        assert r["truncated_total"] == sum(min(x, n) for x in lens) and abs(r["quantile"] - sum(x <= n for x in lens) / len(lens)) < 1e-8
    assert token_counts.truncated_total(sums, 17).first()[0] == sum(min(x, 17) for x in lens)
    assert token_counts.quantile_length(sums, 0.5).first()[0] == lens[-(-len(lens) // 2) - 1]
    assert token_counts.quantile_length(sums, 1).first()[0] == lens[-1] and token_counts.quantile_length(sums, 0).first()[0] == lens[0]
    exact = sums.select((F.col("docs_at_most") * 10**9).alias("docs_at_most"), (F.col("n_docs") * 10**9).alias("n_docs"), "length")
    assert token_counts.quantile_length(exact, f"{1 / len(lens):.18f}").first()[0] == lens[0]
    assert packing.pack(docs_of(spark, [])).count() == 0 and token_counts.token_counts(docs_of(spark, [])).count() == 0


def test_shortest_pack_first():
    rng = random.Random(4)
    for _ in range(50):
        counts = {rng.randint(1, 64): rng.randint(0, 50) for _ in range(20)}
        used = collections.Counter()
        for pattern, n in packing.shortest_pack_first(counts, 64):
            assert sum(pattern) <= 64
            for x in pattern:
                used[x] += n
        assert used == collections.Counter({k: v for k, v in counts.items() if v})


def test_topk(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(1)
    vecs = {i: rng.normal(size=6).round(1).tolist() for i in range(120)}
    vecs |= {i: vecs[0] for i in range(120, 150)}
    rows = [(i, v, "x") for i, v in vecs.items()] + [(0, vecs[0], "x"), (200, None, "x"), (250, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x"), (300, [float("nan")] * 6, "x"), (350, [], "x"), (400, [0.0] * 6, "x"), (450, [1.0], "x"), (None, vecs[1], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = collections.defaultdict(list)
    for r in topk.exact_top_k(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    vecs[400] = [0.0] * 6
    ints = {i: np.floor(256 * np.float32(v).astype(np.float64)).astype(int) for i, v in vecs.items()}
    for q in (0, 50, 100, 400):
        want = sorted(((int(ints[q] @ v), i) for i, v in ints.items() if i != q), key=lambda x: (-x[0], x[1]))[:5]
        assert got[q] == [(i, s) for s, i in want]
    assert set(got) == {0, 50, 100, 400}
    assert topk.exact_top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    with pytest.raises(ValueError):
        topk.exact_top_k(spark.createDataFrame([(1, [1e16])], "vec_id long, embedding array<double>"), F.lit(True))


def test_language_marginal():
    path = language_id.default_vocabulary()
    pieces = language_id.pieces_of(path)
    probs = np.random.default_rng(0).random(len(pieces))
    probs /= probs.sum()
    table = dict(zip(pieces, probs))

    def brute(s):
        if not s:
            return 1.0
        out = 0.0
        for m in range(1, min(len(s), language_id.PIECE_CHARS) + 1):
            p = table.get(s[:m], language_id.UNKNOWN if m == 1 else 0)
            out += p * brute(s[m:])
        return out

    words = ["the", "été", "日", "strasse", "aaaa"]
    lattice = language_id.Lattice(words, path)
    got = lattice.totals(lattice.forward(lattice.arcs(probs)))
    assert np.allclose(got, [brute("▁" + w) for w in words], rtol=1e-9)


def brute_segmentations(word, table):
    """Every way to cut a marked word into pieces of the table or single unknown characters, with its probability."""
    if not word:
        return [((), 1.0)]
    out = []
    for m in range(1, len(word) + 1):
        p = table.get(word[:m], language_id.UNKNOWN if m == 1 else 0)
        if p:
            out += [((word[:m], *rest), p * q) for rest, q in brute_segmentations(word[m:], table)]
    return out


def test_language_model_against_plain_em(spark):
    path = language_id.default_vocabulary()
    pieces = language_id.pieces_of(path)
    rows = [(1, "the cat and the dog", "en"), (2, "a dog ran", "en"), (3, "le chat et le chien", "fr"), (4, "été ici", "fr"), (5, None, "fr"), (6, "the", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.fit(docs, rounds=2)
    want = {}
    for lang in ("en", "fr"):
        words = collections.Counter(w for _, t, g in rows if g == lang and t for w in language_id.words_in(t))
        flat = [2.0 ** -len(p) for p in pieces]
        table = {p: x / sum(flat) for p, x in zip(pieces, flat)}
        for _ in range(2):
            uses = collections.Counter()
            for w, n in words.items():
                ways = brute_segmentations("▁" + w, table)
                total = sum(q for _, q in ways)
                for way, q in ways:
                    for piece in way:
                        uses[piece] += n * q / total
            counts = np.array([0.02 + uses[p] for p in pieces])
            table = dict(zip(pieces, counts / counts.sum()))
        want[lang] = table
        assert np.allclose(got[lang], [table[p] for p in pieces], rtol=1e-6)
    text = "the chien ran ici ici"
    logs = {g: sum(np.log(sum(q for _, q in brute_segmentations("▁" + w, want[g]))) for w in language_id.words_in(text)) for g in want}
    r = language_id.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), got).first()
    best = max(sorted(logs), key=logs.get)
    assert r["lang_pred"] == best and r["score"] == pytest.approx(1 / sum(np.exp(v - logs[best]) for v in logs.values()), rel=1e-6)


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.fit(docs.where(~held))
    out = language_id.predict(docs, model, carry=["doc_id", "lang", held.alias("held")])
    assert out.where("held and lang != lang_pred").count() <= 0.05 * out.where("held").count()
    odd = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(docs_of(spark, ODD), model).collect()}
    assert odd[900] == ("und", 0.0) and odd[901][0] == odd[902][0] == "und" and odd[903][0] in model and 0 <= odd[906][1] <= 1
    assert language_id.predict(docs_of(spark, []), model).count() == 0
    assert language_id.predict(docs_of(spark, [(1, "abc")]), language_id.fit(docs.limit(0))).first()["lang_pred"] == "und"
