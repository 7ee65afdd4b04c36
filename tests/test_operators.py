"""Coverage, as-of, upsert, decoding, text and stream operators on small tables."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from marketlens.functions import scalars as sc
from marketlens.functions import text as tx
from marketlens.operators import coverage as cov
from marketlens.operators import reconcile as rec
from marketlens.operators import relational as rel
from marketlens.operators import search
from marketlens.sources import decode as dc
from marketlens.streaming import operators as st

D = dt.date


def test_gap_candidates(spark):
    df = spark.createDataFrame([("a", 0), ("a", 600), ("b", 0), ("b", 7)], "k string, slot long")
    got = {(r["k"], r["state"], r["start"], r["end"]) for r in cov.gap_candidates(df, ["k"], 300).collect()}
    assert got == {("a", "OK", 300, 600), ("b", "BLOCKED_DRIFT", None, None)}
    assert cov.gap_candidates(df.where("k = 'a'"), ["k"], 300, budget=2).first()["state"] == "BLOCKED_BUDGET"


def test_next_window(spark):
    df = spark.createDataFrame([("a", D(2026, 10, 6)), ("b", D(2026, 10, 8))], "s string, day date")
    series = spark.createDataFrame([("a",), ("b",), ("new",)], "s string")
    got = {r["s"]: (r["start"], r["end"]) for r in cov.next_window(df, series, ["s"], "day", F.lit("2026-10-08").cast("date"), 7).collect()}
    assert got == {"a": (D(2026, 10, 7), D(2026, 10, 8)), "new": (D(2026, 10, 2), D(2026, 10, 8))}


def test_interval_union(spark):
    df = spark.createDataFrame([(1, 5), (5, 9), (11, 12), (2, 3)], "start int, end int").withColumn("k", F.lit(1))
    assert {(r["start"], r["end"]) for r in cov.interval_union(df, ["k"]).collect()} == {(1, 9), (11, 12)}


def brute_union(windows):
    out = []
    for a, b in sorted(windows):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
            out[-1][2] += 1
        else:
            out.append([a, b, 1])
    return sorted(map(tuple, out))


@pytest.mark.parametrize("width", [1, 7, 10_000])
def test_series_in_stretches(spark, width):
    """Islands, unions, gaps and neighbours are the same whatever the stretches are."""
    rng = random.Random(width)
    slots = sorted(rng.sample(range(300), 170)) + list(range(400, 460))
    df = spark.createDataFrame([("a", s) for s in slots] + [(None, s * 2) for s in range(20)], "k string, slot long").repartition(3)
    runs = brute_union([(s, s + 1) for s in slots])
    got = {(r["start"], r["end"], r["slots"]) for r in cov.merge_runs(df, ["k"], 1, width=width).where("k = 'a'").collect()}
    assert got == set(runs)
    assert cov.merge_runs(df, ["k"], 1, width=width).where("k is null").count() == 20
    holes = {(a[1], b[0]) for a, b in zip(runs, runs[1:])}
    assert {(r["start"], r["end"]) for r in cov.missing_windows(df, ["k"], 1, width=width).where("k = 'a'").collect()} == holes
    parts = cov.merge_runs(df.where("k = 'a'"), ["k"], 1, most=3, width=width).collect()
    assert max(r["slots"] for r in parts) == 3 and sum(r["slots"] for r in parts) == len(slots) and len(parts) == sum(-(-r[2] // 3) for r in runs)
    windows = [(a, a + rng.randint(1, 12)) for a in (rng.randint(0, 500) for _ in range(60))] + [(100, 300)]
    w = spark.createDataFrame([("a", *x) for x in windows], "k string, start long, end long").repartition(3)
    assert sorted(tuple(r)[1:] for r in cov.interval_union(w, ["k"], width=width).collect()) == brute_union(windows)
    rows = [("a", rng.randint(0, 200), i) for i in range(150)]
    ev = spark.createDataFrame(rows, "k string, t long, id long").repartition(3)
    in_time, arrival = sorted(r[1] for r in rows), [r[1] for r in rows]
    d, a = [y - x for x, y in zip(in_time, in_time[1:])], [y - x for x, y in zip(arrival, arrival[1:])]
    got = cov.chronology(ev, ["k"], "t", "id", 2, width, width).first()
    assert tuple(got)[1:] == (d.count(0), d.count(1), sum(x > 2 for x in d), sum(x <= 0 for x in a))
    assert {r["delta_min"]: r["n"] for r in cov.cadence(ev.withColumn("t", F.col("t") * 60), ["k"], "t", width=width * 60).collect()} == {x: d.count(x) for x in sorted(set(d), key=lambda x: (-d.count(x), x))[:10]}


@pytest.mark.parametrize("width", [5, 10_000])
def test_windows_minus_done_ones(spark, width):
    rng = random.Random(width)
    for _ in range(3):
        tiles = [(10 * i, 10 * i + 10) for i in range(20)] + [(15, 15), (3, 17)]
        done = [(a, a + rng.randint(0, 25)) for a in (rng.randint(-5, 210) for _ in range(9))] + [(50, 50), (60, 70), (60, 70), (70, 75)]
        frame = lambda rows: spark.createDataFrame([("a", *r) for r in rows] + [(None, 1, 3)], "k string, start long, end long")
        got = cov.subtract_windows(frame(tiles), frame(done).where("k is not null"), ["k"], width=width).collect()
        bounds = {x for t in tiles if t[0] < t[1] for x in t}
        left = [h for h in range(0, 220) if any(a <= h < b for a, b in tiles) and not any(a <= h < b for a, b in done)]
        runs = []
        for h in left:
            if runs and runs[-1][1] == h and h not in bounds:
                runs[-1][1] = h + 1
            else:
                runs.append([h, h + 1])
        assert sorted((r["start"], r["end"]) for r in got if r["k"]) == sorted(map(tuple, runs))
        assert [(r["start"], r["end"]) for r in got if r["k"] is None] == [(1, 3)]


def test_gaps_by_session_calendar(spark):
    days = [D(2024, 1, 1) + dt.timedelta(i) for i in range(60)]
    cal = spark.createDataFrame([("x", d, d.weekday() < 5 and d.day != 10) for d in days] * 2, "name string, d date, open boolean")
    calendars = cov.session_calendar(cal, "name", "d", width=7)
    assert {r["day"]: r["rank"] for r in calendars.collect()}[D(2024, 1, 11)] == 8
    seen = [d for d in days if d.day not in (4, 5, 6, 17)] + [D(2024, 1, 10)]  # 10 and week-ends are closed
    df = spark.createDataFrame([("s", d) for d in seen] + [("all", d) for d in seen] + [("odd", d) for d in seen] + [("odd2", days[0])], "k string, day date")
    series = spark.createDataFrame([("s", "x", True), ("all", None, False), ("odd", "none such", True), ("odd2", None, True), ("idle", "x", True)], "k string, calendar string, required boolean")
    got = {r["k"]: (r["gap_count"], r["sample"]) for r in cov.session_gaps(df, series, calendars, ["k"], "day", sample=3, width=7).collect()}
    missing = [d for d in days if d not in seen]
    sessions = [d for d in missing if d.weekday() < 5 and d.day != 10]
    told = lambda x: (len(x), ",".join(map(str, x[:3])))
    assert got == {"s": told(sessions), "all": told(missing), "odd": (None, None), "odd2": (None, None), "idle": (0, "")}


def test_monthly_gap(spark):
    df = spark.createDataFrame([("CPI", D(2026, 7, 1)), ("CPI", D(2026, 9, 1))], "s string, d date")
    assert cov.internal_gaps_monthly(df, ["s"], "d").first()["gap_count"] == 1


def test_as_of(spark):
    v = spark.createDataFrame([("x", D(2026, 9, 10), 322.0), ("x", D(2026, 10, 13), 324.0)], "s string, known date, value double")
    at = lambda d: rec.as_of(v, ["s"], "known", "value", F.lit(d).cast("date")).first()["value"]
    assert at("2026-10-12") == 322 and at("2026-10-14") == 324
    probes = spark.createDataFrame([("x", D(2026, 9, 1)), ("x", D(2026, 9, 10)), ("x", D(2026, 11, 1)), ("y", D(2026, 11, 1))], "s string, p date")
    got = {(r["s"], r["p"]): r["value"] for r in rec.as_of_probes(v, probes, ["s"], "known", "p", "value").collect()}
    assert list(got.values()).count(None) == 2 and got[("x", D(2026, 9, 10))] == 322 and got[("x", D(2026, 11, 1))] == 324


def test_upserts_and_revisions(spark):
    old = spark.createDataFrame([(1, 1.35, "a"), (2, 2.0, None)], "k int, v double, sha string")
    new = spark.createDataFrame([(1, 1.48, "b"), (2, 2.0, "c"), (3, 3.0, "d")], "k int, v double, sha string")
    r = rec.revisions(old, new, ["k"], ["v"]).collect()
    assert len(r) == 1 and json.loads(r[0]["old_json"]) == {"v": 1.35} and json.loads(r[0]["new_json"]) == {"v": 1.48}
    assert rec.revisions(new, new, ["k"], ["v"]).isEmpty()
    assert {tuple(x) for x in rec.insert_ignore(old, new, ["k"]).collect()} == {(1, 1.35, "a"), (2, 2.0, None), (3, 3.0, "d")}
    assert rec.upsert(old, new, ["k"]).count() == 3
    twice = new.unionByName(new.withColumn("v", F.col("v") - 1)).withColumn("at", F.when(F.col("v") < 1, 2).otherwise(1))
    assert {x["k"]: x["v"] for x in rec.upsert(old.withColumn("at", F.lit(0)), twice, ["k"], "at").collect()}[1] == 0.48
    assert {x["state"] for x in rec.append_only(old, new, ["k"], "sha").where("k != 2").collect()} == {"conflict", "new"}
    merged = {x["k"]: x["v"] for x in rec.merge_coalesce(old, new.withColumn("v", F.lit(None).cast("double")), ["k"]).collect()}
    assert merged == {1: 1.35, 2: 2.0, 3: None}


def test_fingerprint_is_free_of_order(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    a = rel.table_fingerprint(df).first()
    assert a == rel.table_fingerprint(df.orderBy(F.desc("id")).repartition(7)).first()
    assert a != rel.table_fingerprint(df.union(df.limit(1))).first()


def test_quality_blocks_on_critical(spark):
    issues = spark.createDataFrame([(1, "numeric", "warning"), (2, "news", "critical")], "report int, category string, severity string")
    got = {r["report"]: (r["score"], r["passed"]) for r in rec.quality_score(issues, spark.createDataFrame([(1,), (2,), (3,)], "report int")).collect()}
    assert got == {1: (98.25, True), 2: (100.0, False), 3: (100.0, True)}


def test_scalars(spark):
    row = spark.range(1).select(
        sc.parse_number(F.lit("(1.2)")), sc.parse_number(F.lit("−3,400.5 €")), sc.parse_number(F.lit("-")),
        sc.strict_utc(F.lit("2026-01-01T00:00:00-05:00")), sc.localized_date(F.lit("7 de octubre de 2026")), sc.localized_date(F.lit("October 7, 2026")),
        sc.zone("rsi", F.lit(75)), sc.redact(F.lit("a?token=abc&x=1")), sc.closed_slot(F.lit(1_000_000)),
    ).first()
    assert tuple(row) == (-1.2, -3400.5, None, None, D(2026, 10, 7), D(2026, 10, 7), "overbought", "a?token=***&x=1", 999_300)


def test_zones_at_their_bounds(spark):
    at = lambda kind, v: sc.zone(kind, F.lit(float(v)))
    row = spark.range(1).select(at("rsi", 70), at("rsi", 70.5), at("rsi", 30), at("williams", -20), at("cci", 100), at("mvrv", 1), at("mvrv", 2.4), at("mvrv", 3.5), at("asopr", 1.2), at("asopr", 1.3), at("vix", 25), at("us10y", 5.5), at("nupl", float("nan"))).first()
    assert tuple(row) == ("neutral", "overbought", "neutral", "neutral", "neutral", "accumulation", "intermediate", "euphoria", "profit", "high profit", "low premium", "pressing", None)


def test_redaction(spark):
    said = ["Authorization: Bearer abc123.def", '{"api_key": "k1", "x": 2}', "bearer  tok/en== and password='hunter2'", "access_token=zz&y=1"]
    got = [r[0] for r in spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i int, s string").orderBy("i").select(sc.redact(F.col("s"))).collect()]
    assert not any(w in " ".join(got) for w in ("abc123", "k1", "tok/en", "hunter2", "zz")) and got[1].endswith('"x": 2}') and got[3].endswith("&y=1")


def test_url_and_title_keys(spark):
    urls = {"HTTP://A.b/C/?UTM_x=1&utm_1=2&ref=r&b=2&a=&a=1#f": "http://a.b/C?a=1&b=2&ref=r", "https://x.y/?fbclid=1": "https://x.y", "https://x.y/p?b=1&a=2&a=10": "https://x.y/p?a=10&a=2&b=1"}
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", tx.canonical_url(F.col("u"))).collect()
    assert {r[0]: r[1] for r in rows} == urls
    assert spark.range(1).select(tx.title_key(F.lit("Él, UP 5 %"))).first()[0] == "l up 5"


def test_news_ages(spark):
    kinds = [("research", 21, True), ("research", 22, False), ("primary", 14, True), ("primary", 15, False), ("discovery", 7, True), ("discovery", 8, False), ("official", 8, False), ("primary", -1, False)]
    rows = spark.createDataFrame(kinds, "k string, a int, want boolean")
    assert rows.where(tx.news_fresh(F.col("a"), F.col("k")) != F.col("want")).isEmpty()


def test_excerpts(spark):
    body = "word " * 60
    rows = [("A Title", "  .. A title - a TITLE: ## Body of it", "Body of it"), ("Only", "only", "only"), ("", body, None), ("x" * 3, "#### Head " + "y" * 400, "Head " + "y" * 275 + "…")]
    got = [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, b string, w string").orderBy("i").select(tx.excerpt(F.col("t"), F.col("b"))).collect()]
    assert got[0] == rows[0][2] and got[1] == "only" and got[2] == ("word " * 55).strip() + "…" and got[3] == rows[3][2]


def test_text(spark):
    row = spark.range(1).select(
        tx.canonical_url(F.lit("HTTPS://Ex.com/a/?utm_source=x&b=2&a=1#t")), tx.strip_markup(F.lit("<p>a &amp; b</p><script>x</script>  c")),
        tx.strip_markup(F.lit("word " * 40), 30), F.array_join(tx.tokens(F.lit("A MVRV z_score, x!")), ","), tx.on_domains(F.lit("evil-ex.com"), ["ex.com"]),
        tx.excerpt(F.lit("Title"), F.lit("Title: Title - body text")), tx.title_key(F.lit("  Coin, UP 5%! ")),
    ).first()
    assert row[0] == "https://ex.com/a?a=1&b=2" and row[1] == "a & b c" and row[2].endswith("…") and len(row[2]) <= 31
    assert row[3] == "mvrv,z_score" and row[4] is False and row[5] == "body text" and row[6] == "coin up 5"


def test_news_dedupe_is_greedy(spark):
    rows = [("btc", 0, 0, "u1", "t1"), ("btc", 0, 1, "u2", "t1"), ("btc", 0, 2, "u2", "t2"), ("btc", 1, 0, "u1", "t3"), ("btc", 1, 1, "u4", "t4")]
    df = spark.createDataFrame(rows, "asset string, pri int, pos int, u string, t string")
    got = search.dedupe_news(df, ["asset"], "pri", "pos", "u", "t").collect()
    assert {(r["u"], r["t"]) for r in got} == {("u1", "t1"), ("u2", "t2"), ("u4", "t4")}
    many = spark.createDataFrame([("btc", 0, i, f"u{i % 13}", f"t{i % 11}") for i in range(200)] + [("eth", 0, 0, None, "t"), ("eth", 0, 1, None, "s")], "asset string, pri int, pos int, u string, t string")
    kept = search.dedupe_news(many, ["asset"], "pri", "pos", "u", "t").collect()
    assert sorted(r["pos"] for r in kept if r["asset"] == "btc") == list(range(7)) and [r["pos"] for r in kept if r["asset"] == "eth"] == [0]


def test_decoders(spark):
    body = json.dumps({"timestamp": [0, 86400, 172800], "open": [1, 2, 3], "high": [2, 3, 4], "low": [0.5, 1, 2], "close": [1.5, None, 3], "volume": [1, 1, 1]})
    df = spark.createDataFrame([("x", body), ("bad", "{}")], "symbol string, body string")
    assert [r["close"] for r in dc.quote_envelope(df).orderBy("day").collect()] == [1.5, 3.0]
    assert {r["reason"] for r in dc.five_series(df, ["symbol"]).collect()} == {"prices", "shape"}
    page = json.dumps({"retCode": 0, "result": {"symbol": "x", "list": [{"openInterest": "1", "timestamp": "5"}, {"openInterest": "2", "timestamp": "5"}]}})
    assert dc.exchange_pages(spark.createDataFrame([("x", page)], "symbol string, body string"), ["symbol"]).first()["reason"] == "duplicate time"
    nested = json.dumps({"index": "height", "start": 144, "data": ["[1.0, 2.0]", None, "3.5"]})
    assert sorted(r["value"] for r in dc.positional_period(spark.createDataFrame([(nested,)], "body string")).collect()) == [1.0, 2.0, 3.5]
    html = "<table><tr><th>Date</th><th>IBIT</th><th>TOTAL</th></tr><tr><td>1 Oct</td><td>(1.2)</td><td>-</td></tr></table>"
    assert {(r["ticker"], r["flow"]) for r in dc.html_flow_table(spark.createDataFrame([(html,)], "html string")).collect()} == {("IBIT", -1.2), ("TOTAL", None)}


def run(stream, tmp_path, name):
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


def test_replays_in_a_later_batch_are_dropped(spark, tmp_path):
    first = [(i, dt.datetime(2024, 1, 1, 0, i), "x") for i in range(20)]
    for n, rows in enumerate([first, first[::3] + [(50, dt.datetime(2024, 1, 1, 0, 30), "x")]]):
        spark.createDataFrame(rows, "id int, ts timestamp, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("id int, ts timestamp, v string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    assert sorted(r["id"] for r in run(st.once_per_key(s, "ts", ["id"], "1 day"), tmp_path, "once").collect()) == [*range(20), 50]


def test_corrections_rewrite_touched_parts_only(spark, tmp_path):
    path, log = str(tmp_path / "table"), str(tmp_path / "log")
    write = st.revise_batch(path, log, ["k"], ["v"], "at")
    rows = lambda *r: spark.createDataFrame(r, "k int, v double, at int")
    write(rows(*[(i, float(i), 0) for i in range(200)]), 0)
    late = rows((7, 9.0, 1), (7, 1.0, 2), (300, 3.0, 1))
    for _ in range(2):  # a batch that is run again gives the same tables
        write(late, 1)
    got = {r["k"]: r["v"] for r in st.latest_parts(spark, path).collect()}
    assert len(got) == 201 and got[7] == 1.0 and got[300] == 3.0 and got[8] == 8.0
    assert spark.read.option("basePath", path).parquet(path).where("_v = 1").select("_b").distinct().count() <= 2
    assert [json.loads(r["new_json"]) for r in spark.read.parquet(f"{log}/v=1").collect()] == [{"v": 1.0}]


def test_rows_in_order_over_triggers(spark, tmp_path):
    """Rows out of order, replays in later triggers and late rows; state of an idle key goes."""
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    files = [[("a", 10, 3.0), ("a", 0, 1.0), ("b", 5, 1.0), ("a", 5, 2.0)], [("a", 5, 2.0), ("a", 30, 5.0), ("a", 20, 4.0)], [("a", 30, 5.0), ("a", 10, 9.0), ("b", 3000, 2.0), ("a", 3005, 6.0)], [("a", 9000, 7.0)]]
    for rows in files:
        spark.createDataFrame([(k, t(m), v) for k, m, v in rows], "k string, at timestamp, v double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = lambda: spark.readStream.schema("k string, at timestamp, v double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = run(st.contiguity(s(), "k", "at", 300, "10 minutes", idle_days=1), tmp_path, "kinds").collect()
    at = {(r["k"], round((r["at"] - t(0)).total_seconds() / 60)): r["kind"] for r in got}
    assert len(got) == len(at) and at == {("a", 0): "first", ("a", 5): "next", ("a", 10): "next", ("a", 20): "gap", ("a", 30): "gap", ("b", 5): "first", ("b", 3000): "first", ("a", 3005): "first"}
    rows = run(st.running_indicators(s(), "k", "at", "v", 2, 2, "10 minutes"), tmp_path, "running").where("k = 'a'").orderBy("at").collect()
    assert [r["ema"] for r in rows] == pytest.approx([None, 1.5, 2.5, 3.5, 4.5, 5.5]) and [r["rsi"] for r in rows] == [None, None, 100.0, 100.0, 100.0, 100.0]


def test_hash_trees(spark):
    from marketlens.operators import hashtree as ht

    rows = [(i * 3, float(i), f"x{i}") for i in range(3000)] + [(None, 1.0, "n")]
    a = spark.createDataFrame(rows, "key long, v double, s string").repartition(3)
    assert ht.changed_keys(a, a.repartition(5), "key").isEmpty()
    other = [r for r in rows if r[0] != 300] + [(-7, 0.0, "new"), rows[50]]
    b = spark.createDataFrame([(k, v + (k == 6000), s) if k is not None else (k, v, "other") for k, v, s in other], "key long, v double, s string").repartition(4)
    got = {(r["key"], r["change"], r["lo"], r["hi"]) for r in ht.changed_keys(a, b, "key").collect()}
    assert got == {(300, "removed", 256, 319), (-7, "added", -64, -1), (150, "changed", 128, 191), (6000, "changed", 5952, 6015), (None, "changed", None, None)}
    differing = ht.differing_leaves(*[ht.stored(ht.leaves(x, "key"), "leaves") for x in (a, b)])
    assert {r["node"] for r in differing.collect()} == {4, -1, 2, 93, None}
    assert ht.changed_keys(a.limit(0), a.limit(0), "key").isEmpty() and ht.changed_keys(a.limit(0), a, "key").count() == 3001


def test_points_in_windows_of_any_length(spark):
    from marketlens.operators import intervals as iv

    rng = random.Random(4)
    windows = [(k, a, a + rng.choice([0, 1, 2, 7, 365, 11_000])) for k in "ab" for a in (rng.randint(-400, 400) for _ in range(40))]
    points = [(k, rng.randint(-500, 1200)) for k in "ab" for _ in range(150)]
    w, p = spark.createDataFrame(windows, "k string, lo long, hi long"), spark.createDataFrame(points, "k string, t long")
    got = sorted(map(tuple, iv.point_in_window(p, w, "k", "t", "lo", "hi").select("k", "t", "lo", "hi").collect()))
    assert got == sorted((k, t, lo, hi) for k, t in points for j, lo, hi in windows if j == k and lo <= t < hi)
    copies = w.where("lo < hi").select((F.col("hi") - F.col("lo")).alias("n"), F.size(iv.dyadic_cells(F.col("lo"), F.col("hi"))).alias("c"))
    assert copies.where(F.col("c") > 2 * F.ceil(F.log2(F.col("n") + 1))).isEmpty() and copies.agg(F.max("c")).first()[0] <= 28


def test_dictionaries(spark):
    """One pass over a whole dictionary against phrase by phrase."""
    rng = random.Random(9)
    words = ["a", "ab", "abc", "b", "ñu", "où", "x_1", "The"]
    phrases = sorted({" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(60)})
    rules = [(p.upper() if i % 3 == 0 else p, f"<{i}>") for i, p in enumerate(phrases)] + [(" ", "no"), (phrases[0], "<z>"), ("never", None)]
    texts = [rng.choice(["", " ", "-"]).join(rng.choice([w, w.upper(), " ", ", "]) for w in rng.choices(words, k=25)) for _ in range(60)] + ["", None, "ÀB ab", "ab\u0301 ab", "aB,ab"]

    def plain(text):
        new, out, i = {}, "", 0
        for p, r in sorted((p, r) for p, r in rules if r is not None and p.strip()):
            new.setdefault(p.lower(), r)
        word = lambda c: c.isalnum() or c == "_" or c == "\u0301"
        while i < len(text):
            fits = [p for p in new if text[i : i + len(p)].lower() == p and not (i and word(text[i - 1])) and not (i + len(p) < len(text) and word(text[i + len(p)]))]
            best = max(fits, key=len, default=None)
            out, i = (out + new[best], i + len(best)) if best else (out + text[i], i + 1)
        return out

    d = spark.createDataFrame(rules, "phrase string, replacement string")
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["x"] for r in rows.select("i", tx.replace_phrases(F.col("t"), d).alias("x")).collect()}
    assert got == {i: None if t is None else plain(t) for i, t in enumerate(texts)}
    topics = [("abc", "one", 2), ("AB", "two", 1), ("c-", "three", 0), ("où", "four", 0), (" ", "blank", 0)]
    want = lambda t: min(((p, n) for w, n, p in topics if w.strip() and w.lower() in (t or "").lower()), default=(9, "other"))[1]
    table = spark.createDataFrame(topics, "word string, topic string, priority int")
    got = {r["i"]: r["x"] for r in rows.select("i", tx.first_topic(F.col("t"), table).alias("x")).collect()}
    assert got == {i: want(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("bits, first", [(0, 1), (2, 1), (6, 4)])
def test_search_reads_few_blocks(spark, monkeypatch, bits, first):
    """The best hits are the same whatever blocks there are, ties included."""
    monkeypatch.setattr(search, "BLOCK_BITS", bits)
    monkeypatch.setattr(search, "FIRST_BLOCKS", first)
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(40)]
    corpus = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 12))), " ".join(rng.choices(vocab, k=3))) for i in range(120)] + [(200 + i, "w1 w2", "w3") for i in range(20)]
    queries = [(i, " ".join(rng.choices(vocab, k=4))) for i in range(12)] + [(90, "w1 w2 w3"), (91, "nothing"), (92, "")]
    c = spark.createDataFrame(corpus, "id long, title string, body string").repartition(3)
    got = search.bm25(c, spark.createDataFrame(queries, "q long, t string"), "id", "q", "t", {"title": 3, "body": 1}, k=3).collect()
    bags = {i: [(w, x) for f, w in ((t, 3.0), (b, 1.0)) for x in f.split()] for i, t, b in corpus}
    lens = [len(b) for b in bags.values() if b]
    avg, want = sum(lens) / len(lens), []
    import math

    for q, t in queries:
        scores = []
        for i, bag in bags.items():
            s, hit = 0.0, False
            for term in dict.fromkeys(t.split()):
                tf = sum(w for w, x in bag if x == term)
                n = sum(any(x == term for _, x in b) for b in bags.values())
                if tf:
                    hit = True
                    s += max(math.log((len(corpus) - n + 0.5) / (n + 0.5)), 1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(bag) / avg))
            if hit:
                scores.append((-round(s, 6), i))
        want += [(q, i, k) for k, (_, i) in enumerate(sorted(scores)[:3], 1)]
    assert sorted((r["q"], r["id"], r["rank"]) for r in got) == sorted(want)
