"""What a step holds, sends or makes does not grow faster than its input."""

import datetime
import random

from pyspark.sql import functions as F

from marketlens.functions.text import fold
from marketlens.operators import intervals, lineage, reconcile, relational, search, store
from marketlens.plans import registry
from tests.conftest import SF


def test_lexical_keeps_few_rows_of_a_batch(spark, monkeypatch):
    rows = [(i, f"doc{i}", f"Été n{i % 7} " + "ab" * (i % 5) + "x" * 40 * (i % 3), None if i % 4 else "Straße ab") for i in range(3000)]
    corpus = spark.createDataFrame(rows, "id long, ident string, title string, words string").repartition(3)
    asked = [(1, "ete ab n3"), (2, "doc17"), (3, "x" * 40 + " strasse"), (4, None), (5, "zz"), (6, "abab"), (6, "abab n1")]
    made = {}
    keep = search.stored
    monkeypatch.setattr(search, "stored", lambda df, name: made.setdefault(name, keep(df, name)))
    got = search.lexical(corpus, spark.createDataFrame(asked, "q long, text string"), "id", "q", "text", "ident", "title", "words")
    want = []
    for q in range(1, 7):
        terms = [t for n, text in asked if n == q for t in dict.fromkeys((text or "").split())]
        score = {i: sum(10 * (fold(ident) == t) + 3 * (t in fold(title)) + 2 * (t in (fold(words) or "")) for t in terms) for i, ident, title, words in rows}
        best = sorted((-s, i) for i, s in score.items() if s)[:5]
        want += [(q, i, -s, r) for r, (s, i) in enumerate(best, 1)]
    assert sorted((r["q"], r["id"], r["score"], r["rank"]) for r in got.collect()) == sorted(want)
    assert made["found"].count() <= 3 * 6 * 5  # three batches of records


def test_lineage_gathers_rows_by_page(spark, monkeypatch):
    made = {}
    keep = lineage.stored
    monkeypatch.setattr(lineage, "stored", lambda df, name: made.setdefault(name, keep(df, name)))
    assert registry.queries()["l1_request_lineage"](spark, SF).count()
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert made["pages"].count() <= lines.select("l_orderkey").distinct().count() * 33 // 32 + 1  # a row a page, and the planted later ones
    assert made["ends"].where("newest <= last").count() == 0  # only these look for a next time


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dealt_bounds_the_rows_of_a_task(spark, monkeypatch):
    assert store.dealt(spark.range(1000), "id").rdd.getNumPartitions() == spark.range(1000).rdd.getNumPartitions()
    monkeypatch.setattr(store, "TASK_ROWS", 100)
    assert [store.dealt(spark.range(n), "id").rdd.getNumPartitions() for n in (1000, 4000)] == [10, 40]


def test_page_rows_are_neither_copied_nor_joined(spark):
    rows = spark.createDataFrame([(1, 0), (1, 300), (1, 300), (1, None), (2, 0)], "page long, t long")
    pages = spark.createDataFrame([(1, "5m", 0, 600), (2, "d1", 0, 86400), (3, "5m", 0, 300)], "page long, frequency string, begin long, stop long")
    got = reconcile.page_issues(rows, pages, "page", "t")
    assert [tuple(r) for r in got.collect()] == [(1, "twice")]
    assert "Expand" not in plan(got)


def test_key_differences_group_once(spark):
    a = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, None)], "k long, n long")
    b = spark.createDataFrame([(1, 1), (4, 1), (4, 1), (3, None)], "k long, n long")
    got = relational.key_differences(a, b, ["k", "n"])
    assert sorted(tuple(r) for r in got.collect()) == [(2, 1, "missing"), (4, 1, "unexpected")]  # as EXCEPT has it, NULL too
    assert "Join" not in plan(got)


def test_equal_key_sets_group_once(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 1), (3, None), (None, 1)], "g long, n long")
    b = spark.createDataFrame([(1, 2), (1, 1), (2, 1), (3, None), (4, 1), (None, 1)], "g long, n long")
    got = reconcile.equal_key_sets(a, b, "g", ["n"])
    assert {tuple(r) for r in got.collect()} == {(1, True), (2, False), (3, False), (4, False), (None, False)}
    assert "Join" not in plan(got)


def test_both_sides_of_an_append_are_dealt_alike(spark, monkeypatch):
    monkeypatch.setattr(store, "TASK_ROWS", 1000)
    for name in ("k5_append_only", "j15_receipt_reconstruction"):
        assert plan(registry.queries()[name](spark, SF)).count("REPARTITION_BY_NUM") >= 2


def test_long_titles_are_not_sent_around(spark, monkeypatch):
    sent, keep = [], search.checked
    monkeypatch.setattr(search, "checked", lambda df: sent.append(df) or keep(df))
    rows = [("a", 1, i, f"u{i}", None if i > 4 else f"{i % 2}" * 5000) for i in range(8)]
    got = search.dedupe_news(spark.createDataFrame(rows, "g string, p int, n int, u string, t string"), ["g"], "p", "n", "u", "t")
    assert sorted(r["n"] for r in got.collect()) == [0, 1, 5] and got.columns == ["g", "p", "n", "u", "t"]
    assert all(len(r["_k"] or "") <= 32 for df in sent for r in df.collect())


def test_snapshots_hash_each_table_once_and_numbers_cheaply(spark):
    got = plan(registry.queries()["a29_changed_tables"](spark, SF))
    assert got.count("sha2(") == 1  # the changed one; the others are stored
    numbers = [0.0, -0.0, 5e-7, -5e-7, 1.5e-6, -1e-6, 0.1, 2.675, 901.005, 99999999999.99, 1e11, -1e300, 5e-324, float("nan"), float("-inf"), None]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    c = F.col("x")
    want = F.when(c.isNotNull(), F.format_string("%.6f", F.when(c == 0, F.abs(c)).otherwise(c)))
    assert df.where(~want.eqNullSafe(relational.six_digits(c))).count() == 0
    assert "decimal(18,6)" in plan(df.select(relational.canonical(df)))


def test_points_travel_once_to_their_windows(spark, monkeypatch):
    rng = random.Random(5)
    day = lambda n: datetime.date(2020, 1, 1) + datetime.timedelta(n)
    points = [(rng.choice(["a", "b", None]), None if i % 50 == 0 else day(rng.randint(-200, 900)), i) for i in range(900)] + [("c", day(i % 3), i) for i in range(60)]
    windows = [(rng.choice(["a", "b", None]), day(s), day(s + rng.choice([-1, 0, 1, 7, 400, 11_000])), i) for i in range(300) for s in [rng.randint(-300, 900)]] + [("c", day(1), None, 1), ("c", day(1), day(2), 2), ("d", day(1), day(9), 3)]
    p = spark.createDataFrame(points, "k string, t date, i long").repartition(3)
    w = spark.createDataFrame(windows, "k string, lo date, hi date, j long").repartition(3)
    want = sorted((k, i, j) for k, t, i in points for m, lo, hi, j in windows if k and k == m and t and hi and lo <= t < hi)
    got = intervals.point_in_window(p, w, "k", "t", "lo", "hi")
    assert got.columns == ["k", "t", "i", "lo", "hi", "j"] and sorted((r["k"], r["i"], r["j"]) for r in got.collect()) == want
    assert "inline" not in plan(got)  # no copy of a point for each level of cells
    monkeypatch.setattr(intervals, "ROWS", 40)  # stretches and parts of a key
    monkeypatch.setattr(intervals, "PAIRS", 16)
    monkeypatch.setattr(store, "TASK_ROWS", 300)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # groups that go on in the next batch
    try:
        got = intervals.point_in_window(p, w, "k", "t", "lo", "hi")
        assert sorted((r["k"], r["i"], r["j"]) for r in got.collect()) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    made = registry.queries()["j10_interval_join"](spark, SF)
    assert "Join" not in plan(made).replace("BroadcastHashJoin", "") and "inline" not in plan(made)


def test_search_sends_neither_words_nor_pairs(spark, monkeypatch):
    made = {}
    keep = search.stored
    monkeypatch.setattr(search, "stored", lambda df, name: made.setdefault(name, keep(df, name)))
    rows = [(i, f"w{i % 7} w{i % 3} {'zz ' * (i % 50)}", None if i % 5 else "w1") for i in range(6000)]
    corpus = spark.createDataFrame(rows, "id long, title string, body string").repartition(2)
    asked = spark.createDataFrame([(q, f"w{q % 7} w{q % 3} nothing") for q in range(20)], "q long, t string")
    got = search.bm25(corpus, asked, "id", "q", "t", {"title": 3, "body": 0.4}, k=3).collect()
    assert len(got) == 60
    assert made["parts"].count() == len(rows)  # a row a record, with words that are asked for
    assert made["parts"].where("exists(_0, x -> x = 'zz')").isEmpty()
    assert made["found"].count() <= 20 * 3 * 4  # the best of two tasks' blocks, where nearly every record hits
    monkeypatch.setattr(search, "LISTED", 3)  # too many words to list
    made.clear()
    again = search.bm25(corpus, asked, "id", "q", "t", {"title": 3, "body": 0.4}, k=3).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got)) and not made["parts"].where("exists(_0, x -> x = 'zz')").isEmpty()
