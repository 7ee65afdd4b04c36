"""Cells of markup, and values shown against archived ones, on odd documents."""

import datetime as dt

from pyspark.sql import functions as F

from marketlens.operators import documents as dm

DAY = dt.date(2024, 5, 31)


def frame(spark, *html):
    return spark.createDataFrame([(i, DAY, h) for i, h in enumerate(html)], "report long, day date, html string")


def test_cells(spark):
    odd = '<div data-asset="A" data-x=1><p data-x=2>one <b>bold</b> two<br>three<p class=c>&lt;4 &amp; 5</div></i><img src=a><script>var a = "<p>";</script>'
    rows = dm.cells(frame(spark, odd, None, "", "plain", "<" * 50 + "a")).orderBy("report", "node").collect()
    got = [(r["report"], r["path"], r["scope"].get("data-asset"), r["scope"].get("data-x"), r["text"]) for r in rows if r["report"] == 0]
    assert got == [
        (0, "div", "A", "1", ""), (0, "div/p", "A", "2", "one two three"), (0, "div/p/b", "A", "2", "bold"), (0, "div/p/br", "A", "2", ""),
        (0, "div/p", "A", "1", "<4 & 5"), (0, "img", None, None, ""), (0, "script", None, None, ""),
    ]
    assert not [r for r in rows if r["report"] in (1, 2, 3)]
    deep = dm.cells(frame(spark, "<i>" * 3000 + "x")).orderBy(F.desc("node")).first()
    assert deep["path"] == "/".join("i" * dm.PATH) and deep["text"] == "x" and deep["parent"] == 2998


def test_shown_and_archived(spark):
    card = lambda **k: "<figure " + " ".join(f'data-{a}="{v}"' for a, v in ({"metric": "mvrv", "raw": "2.1", "asof": "2024-05-30", "unit": "ratio", "sha": "a" * 64} | k).items()) + ">2.1</figure>"
    page = lambda body: f'<section data-asset="CHAIN">{body}</section>'
    html = [page(card()), page(card() * 2), page(card(sha="x")), page(card(unit="USD")), page(card(asof="2024-05-29")), page(card(raw="nan")), page(card(metric="other") + card()), page("")]
    reports = frame(spark, *html)
    archive = reports.select("report", F.lit("CHAIN").alias("asset"), F.lit("mvrv").alias("metric"), F.lit(2.1).alias("value"))
    found = dm.compare_with_archive(reports, archive).where("asset = 'CHAIN'").orderBy("report", "metric").collect()
    assert [(r["report"], r["metric"], r["issue"]) for r in found] == [(1, "mvrv", "duplicated"), (2, "mvrv", "malformed card"), (3, "mvrv", "wrong unit"), (4, "mvrv", "wrong day"), (5, "mvrv", "malformed card"), (6, "other", "unexpected"), (7, "mvrv", "not shown")]


def test_tables_and_repeated_levels(spark):
    html = '<section data-asset="BTC"><table><tr><th>rsi_14<td>71.5%<tr><td>no name</td></tr></table><ol data-part="support"><li data-field="level">$1,200.50<li data-field="level">9</ol></section>'
    f = dm.fields(dm.cells(frame(spark, html)))
    n = dm.section_numbers(f).first()["n"]
    assert n == {"rsi_14": 71.5, "support.highest": 1200.5, "support.lowest": 9.0}
