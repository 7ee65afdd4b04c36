"""Rules over rendered reports: what they show, whether it agrees with the archive, and whether it may be published.

A report is one row: report (a key), day, html. Its markup is first turned into cells, one row for each element, with the
data attributes that it inherits. Every rule reads cells, none reads markup:

* a field is an element with data-field, in the scope of data-asset and maybe of data-part (a plan, a side);
* a table row is a field named by its th, with its td as the text;
* a card is an element with data-metric, data-asof, data-raw, data-unit and data-sha;
* data-seen on a section is when its asset was last observed, data-made when the report was.

Every function returns rows (report, ..., issue) and collects nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Assets on the board with the difference in price that passes.
BOARD = {"BTC": 0.51, "SPY": 0.011, "GOLD": 0.51, "SILVER": 0.011, "OIL": 0.011}
#: Differences that pass for the other values that are due: asset, metric, tolerance.
DUE = [("BTC", "rsi_14", 0.055), ("BTC", "macd_hist", 0.015), ("BTC", "close_ts", 0.5), ("CHAIN", "mvrv", 0.005)]
#: Assets with a section of their own, and units that cards have.
SECTIONS, UNITS = ("BTC", "SPY", "GOLD"), {"mvrv": "ratio"}
#: Hours after which an observation is too old for a report.
MAX_AGE = {"BTC": 72, "CHAIN": 240}
#: Elements that have no end tag, and ancestors that a path names at most.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
PATH = 8
#: Open elements that the start of another one ends, as HTML allows to leave out their end tags.
ENDS = {"td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_BATCH = 10_000
CELL = "node long, parent long, path string, tag string, attrs map<string,string>, scope map<string,string>, text string"


class _Cells(HTMLParser):
    """Elements in order: [parent, path, tag, attributes, inherited data attributes, texts]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.open = [], []

    def handle_starttag(self, tag, attrs):
        attrs = {k: v if v is not None else "" for k, v in attrs}
        while self.open and self.rows[self.open[-1]][2] in ENDS.get(tag, ()):
            self.open.pop()
        parent = self.open[-1] if self.open else None
        above = self.rows[parent] if parent is not None else (None, "", "", {}, {}, [])
        data = {k: v for k, v in attrs.items() if k.startswith("data-")}
        path = "/".join([*above[1].split("/")[1 - PATH :], tag]) if above[1] else tag
        self.rows.append((parent, path, tag, attrs, {**above[4], **data} if data else above[4], []))
        if tag not in VOID:
            self.open.append(len(self.rows) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[at]][2] == tag:
                del self.open[at:]
                return

    def handle_data(self, data):
        if self.open and self.rows[self.open[-1]][2] not in ("script", "style"):
            self.rows[self.open[-1]][5].append(data)


def _parse(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reports = batch.column("report")
            for i, html in enumerate(batch.column("html").to_pylist()):
                parser = _Cells()
                parser.feed(html or "")
                parser.close()
                for s in range(0, len(parser.rows), _BATCH):
                    part = parser.rows[s : s + _BATCH]
                    parent, path, tag, attrs, scope, texts = zip(*part)
                    cols = [range(s, s + len(part)), parent, path, tag, [list(a.items()) for a in attrs], [list(a.items()) for a in scope], [" ".join(" ".join(t).split()) for t in texts]]
                    same = reports.take(pa.array([i] * len(part)))
                    yield pa.RecordBatch.from_arrays([same.cast(schema.field(0).type), *[pa.array(list(c), f.type) for c, f in zip(cols, list(schema)[1:])]], schema=schema)

    return run


def cells(reports: DataFrame) -> DataFrame:
    """(report, node, parent, path, tag, attrs, scope, text): each element with its attributes, its own and inherited data
    attributes, and its own text. Unclosed and stray tags are borne; path names the last PATH elements."""
    kind = T.StructType([reports.schema["report"], *T._parse_datatype_string(CELL).fields])
    strings = pa.map_(pa.string(), pa.string())
    key = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string()}[type(reports.schema["report"].dataType)]
    names = [("report", key), ("node", pa.int64()), ("parent", pa.int64()), ("path", pa.string()), ("tag", pa.string()), ("attrs", strings), ("scope", strings), ("text", pa.string())]
    return reports.select("report", "html").mapInArrow(_parse(pa.schema(names)), kind)


def number(text: Column) -> Column:
    """A finite number without $, %, K, + and thousands marks, else NULL."""
    value = F.trim(F.translate(text, "$,%K+", "")).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def moment(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm"))


def _of(name: str, attr: str) -> Column:
    return F.try_element_at(F.col(name), F.lit(attr))


def fields(cell: DataFrame) -> DataFrame:
    """(report, kind, asset, part, metric, text, day, unit, sha, node): what a report shows, from cells.

    Kinds: board (a field in a list), field, row (of a table), card, seen (an asset's time of observation).
    """
    asset, part = _of("scope", "data-asset").alias("asset"), _of("scope", "data-part").alias("part")
    none = F.lit(None).cast("string")
    marked = cell.where(_of("attrs", "data-field").isNotNull()).select(
        "report", F.when(F.col("tag") == "li", F.when(_of("scope", "data-part").isNull(), "board").otherwise("field")).otherwise("field").alias("kind"), asset, part,
        _of("attrs", "data-field").alias("metric"), "text", _of("attrs", "data-day").alias("day"), none.alias("unit"), none.alias("sha"), "node",
    )
    rows = cell.where(F.col("tag").isin("th", "td")).groupBy("report", "parent").agg(
        F.max(F.when(F.col("tag") == "th", F.col("text"))).alias("metric"), F.max(F.when(F.col("tag") == "td", F.col("text"))).alias("text"), F.max(_of("scope", "data-asset")).alias("asset"), F.min("node").alias("node")
    )
    rows = rows.where("metric is not null").select("report", F.lit("row").alias("kind"), "asset", none.alias("part"), "metric", "text", none.alias("day"), none.alias("unit"), none.alias("sha"), "node")
    cards = cell.where(_of("attrs", "data-metric").isNotNull()).select(
        "report", F.lit("card").alias("kind"), asset, part, _of("attrs", "data-metric").alias("metric"), _of("attrs", "data-raw").alias("text"), _of("attrs", "data-asof").alias("day"), _of("attrs", "data-unit").alias("unit"), _of("attrs", "data-sha").alias("sha"), "node"
    )
    seen = cell.where(_of("attrs", "data-seen").isNotNull()).select("report", F.lit("seen").alias("kind"), asset, part, F.lit("close_ts").alias("metric"), _of("attrs", "data-seen").alias("text"), none.alias("day"), none.alias("unit"), none.alias("sha"), "node")
    return marked.unionByName(rows).unionByName(cards).unionByName(seen)


def displayed_values(reports: DataFrame) -> DataFrame:
    """(report, kind, asset, metric, shown, day, unit, sha) of the board, of tables, of cards and of observation times."""
    f = fields(cells(reports)).where("kind in ('board', 'row', 'card', 'seen')")
    seen = F.unix_timestamp(moment(F.col("text"))).cast("double")
    shown = F.when(F.col("kind") == "seen", seen).otherwise(number(F.col("text")))
    return f.select("report", "kind", "asset", "metric", shown.alias("shown"), "day", "unit", "sha")


def compare_with_archive(reports: DataFrame, archive: DataFrame) -> DataFrame:
    """(report, asset, metric, issue): not shown, not archived (or not finite), duplicated, differing beyond the metric's
    tolerance, unexpected, cards that are malformed or of another unit or day, and bars that end on the report's day or
    later. archive: report, asset, metric, value."""
    due = [(a, "price", t) for a, t in BOARD.items()] + DUE
    wanted = F.array(*[F.struct(F.lit(a).alias("asset"), F.lit(m).alias("metric"), F.lit(float(t)).alias("tolerance")) for a, m, t in due])
    keys = ["report", "asset", "metric"]
    shown = displayed_values(reports)
    unit = F.create_map(*[x for m, u in UNITS.items() for x in (F.lit(m), F.lit(u))])
    card = F.col("kind") == "card"
    bad = F.coalesce(F.col("day"), F.lit("")).isin("") | F.col("unit").isNull() | ~F.coalesce(F.col("sha").rlike("^[0-9a-f]{64}$"), F.lit(False)) | F.col("shown").isNull()
    per = shown.groupBy(*keys).agg(
        F.count("shown").alias("times"), F.min("shown").alias("shown"), F.count_if(card & bad).alias("bad"),
        F.count_if(card & ~bad & (F.col("unit") != F.try_element_at(unit, F.col("metric")))).alias("units"), F.max(F.when(card & ~bad, F.try_to_date("day"))).alias("at"),
    )
    per = per.where("times > 0 or bad > 0")
    asked = reports.select("report", "day", F.inline(wanted)).join(archive.select(*keys, "value"), keys, "left")
    j = asked.join(per, keys, "full")
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf"))
    known = F.col("tolerance").isNotNull()
    rules = [
        ("unexpected", ~known & F.col("times").isNotNull() & (F.col("metric") != "close_ts")),
        ("not shown", known & F.col("times").isNull()),
        ("malformed card", known & (F.col("bad") > 0)),
        ("wrong unit", known & (F.col("units") > 0)),
        ("wrong day", known & (F.col("at") != F.date_sub("day", 1))),
        ("duplicated", known & (F.col("times") > 1)),
        ("not archived", known & (F.col("times") > 0) & ~finite),
        ("differs", known & finite & (F.abs(F.col("shown") - F.col("value")) > F.col("tolerance"))),
    ]
    differing = broken_rules(j, keys, rules)
    closes = reports.select("report", "day", F.explode(F.array(*[F.lit(a) for a in BOARD])).alias("asset"))
    closes = closes.join(archive.where("metric = 'close_ts'").select("report", "asset", "value"), ["report", "asset"], "left").withColumn("metric", F.lit("close_ts"))
    ends = [("no closed bar", ~finite), ("bar of the day or later", finite & (F.to_date(F.timestamp_seconds("value")) >= F.col("day")))]
    return differing.unionByName(broken_rules(closes, keys, ends))


def broken_rules(df: DataFrame, keys: list[str], rules: list[tuple[str, Column]]) -> DataFrame:
    found = [F.when(F.coalesce(broken, F.lit(False)), name) for name, broken in rules]
    return df.select(*keys, F.explode(F.array_distinct(F.array_compact(F.array(*found)))).alias("issue"))


def made_at(cell: DataFrame) -> DataFrame:
    """(report, made) of reports that tell it."""
    return cell.where(_of("attrs", "data-made").isNotNull()).groupBy("report").agg(F.max(moment(_of("attrs", "data-made"))).alias("made"))


def freshness_issues(reports: DataFrame) -> DataFrame:
    """(report, issue): the age of each asset's last observation, as the report tells it, when it was made."""
    c = cells(reports)
    f = fields(c)
    told = f.where("kind = 'seen'").groupBy("report", "asset").agg(F.max("text").alias("text"))
    of = [told.where(F.col("asset") == a).select("report", F.col("text").alias(f"t_{a}")) for a in MAX_AGE]
    r = reports.select("report").join(made_at(c), "report", "left")
    for t in of:
        r = r.join(t, "report", "left")
    made = F.col("made").isNotNull()
    rules = [("no time of generation", ~made)]
    for asset, hours in MAX_AGE.items():
        text, name = F.coalesce(f"t_{asset}", F.lit("")), asset.lower()
        seen = moment(text)
        age = (F.unix_timestamp("made") - F.unix_timestamp(seen)) / 3600
        rules += [(f"{name}: no observation", made & (text == "")), (f"{name}: bad time", made & (text != "") & seen.isNull())]
        rules += [(f"{name}: future", age < -0.1), (f"{name}: stale", age > hours)]
    rules.append(("btc: open day", F.to_date(moment(F.col("t_BTC"))) >= F.to_date("made")))
    return broken_rules(r, ["report"], rules)


#: Comparisons that a section's numbers must pass where both sides are shown: issue, left, operator, right.
ORDERED = [
    ("bull scenario", "spot", "<", "bull.trigger"), ("bull scenario", "bull.trigger", "<", "bull.target"),
    ("bear scenario", "bear.trigger", "<", "spot"), ("bear scenario", "bear.target", "<", "bear.trigger"),
    ("base range", "base.low", "<", "spot"), ("base range", "spot", "<", "base.high"),
    ("supports side", "support.highest", "<", "spot"), ("resistances side", "spot", "<", "resistance.lowest"),
    ("year bounds", "low_52w", "<=", "high_52w"),
]
#: Numbers that must be there, wherever (NULL) or where another one is.
NEEDED = [("no spot", "spot", None), ("bull without target", "bull.target", "bull.trigger"), ("bear without target", "bear.target", "bear.trigger")]
#: Fixed value: percentage points that a stated fall may be off.
FALL = 0.3


def section_numbers(f: DataFrame) -> DataFrame:
    """(report, asset, n, days, texts): maps from a number's name (part.metric) to it, to its day and to its text. Of levels
    the highest and the lowest count."""
    name = F.concat_ws(".", "part", "metric")
    f = f.where("kind in ('field', 'row')").select("report", "asset", "part", "metric", "text", "day", name.alias("name"), number(F.col("text")).alias("v"))
    plain = f.where("metric != 'level'").groupBy("report", "asset", "name").agg(F.min("v").alias("v"), F.min("day").alias("day"), F.min("text").alias("text"))
    levels = f.where("metric = 'level' and v is not null").groupBy("report", "asset", "part").agg(F.max("v").alias("hi"), F.min("v").alias("lo"))
    both = F.array(F.struct(F.lit("highest").alias("m"), F.col("hi").alias("v")), F.struct(F.lit("lowest").alias("m"), F.col("lo").alias("v")))
    levels = levels.select("report", "asset", "part", F.inline(both)).select("report", "asset", F.concat_ws(".", "part", "m").alias("name"), "v", F.lit(None).cast("string").alias("day"), F.lit("").alias("text"))
    entries = lambda c: F.map_from_entries(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("name", c))))  # noqa: E731  # of one section
    return plain.unionByName(levels).groupBy("report", "asset").agg(entries("v").alias("n"), entries("day").alias("days"), entries("text").alias("texts"))


def content_issues(reports: DataFrame) -> DataFrame:
    """(report, asset, issue): unrendered or doubled marks, labels and levels that contradict the numbers beside them."""
    from marketlens.functions.scalars import zone

    c = cells(reports)
    f = fields(c)
    text, when = F.col("text"), F.try_to_date(_of("attrs", "datetime"))
    news = F.array_contains(F.split(_of("attrs", "class"), " "), "news")
    marks = c.join(made_at(c), "report", "left").groupBy("report").agg(
        F.max(F.contains(text, F.lit("{")) & F.contains(text, F.lit("}"))).alias("template"),
        F.max(F.contains(text, F.lit("%%")) | F.contains(text, F.lit("xx "))).alias("units"),
        F.max(F.contains(text, F.lit("$$"))).alias("currency"),
        F.max(news & (when > F.to_date("made"))).alias("future"),
        F.max(news & when.isNull() & F.col("made").isNotNull()).alias("undated"),
        F.max((_of("attrs", "data-field") == "price") & (_of("scope", "data-asset") == "BTC") & (number(text) > 0)).alias("priced"),
    )
    whole = reports.select("report").join(marks, "report", "left")
    flags = {"template": "template", "doubled unit": "units", "doubled currency": "currency", "future news": "future", "news date": "undated"}
    general = broken_rules(whole, ["report"], [(issue, F.col(flag)) for issue, flag in flags.items()] + [("no price", ~F.coalesce("priced", F.lit(False)))])
    s = section_numbers(f).where(F.col("asset").isin(*SECTIONS))
    missing = reports.select("report", F.explode(F.array(*[F.lit(a) for a in SECTIONS])).alias("asset")).join(s.select("report", "asset"), ["report", "asset"], "left_anti")
    at = lambda name: F.try_element_at("n", F.lit(name))
    holds = {"<": lambda x, y: x < y, "<=": lambda x, y: x <= y}
    rules = [(issue, ~holds[op](at(a), at(b))) for issue, a, op, b in ORDERED]
    rules += [(issue, at(name).isNull() & (at(given).isNotNull() if given else F.lit(True))) for issue, name, given in NEEDED]
    rules.append(("RSI label", zone("rsi", at("rsi_14")) != F.try_element_at("texts", F.lit("rsi_zone"))))
    rules.append(("fall from top", F.abs(at("fall_pct") - (at("low_52w") / at("ath") - 1) * 100) > FALL))
    # the 52 weeks before the last closed bar
    seen = f.where("kind = 'seen'").groupBy("report", "asset").agg(F.max("text").alias("seen"))
    s = s.join(seen, ["report", "asset"], "left").join(reports.select("report", "day"), "report")
    last = F.when(F.coalesce("seen", F.lit("")) != "", F.to_date(moment(F.col("seen")))).otherwise(F.date_sub("day", 1))
    for name in ("high_52w", "low_52w"):
        told = F.try_element_at("days", F.lit(name))
        outside = ~F.coalesce(F.try_to_date(told).between(F.date_sub(last, 364), last), F.lit(False))
        rules += [(f"{name}: bad cut", told.isNotNull() & last.isNull()), (f"{name}: outside", told.isNotNull() & last.isNotNull() & outside)]
    out = general.select("report", F.lit(None).cast("string").alias("asset"), "issue")
    out = out.unionByName(missing.select("report", "asset", F.lit("no section").alias("issue")))
    return out.unionByName(broken_rules(s, ["report", "asset"], rules))


def gate_issues(reports: DataFrame, archive: DataFrame, prices: DataFrame) -> DataFrame:
    """(report, issue, severity): ranges and agreement with other sources before publication.

    archive: report, asset, metric, value; prices: report, price, ath, high_52w, cpi_day (the report's day counts).
    """
    of = lambda m: F.max(F.when(F.col("metric") == m, F.col("value"))).alias(f"a_{m}")
    known = archive.groupBy("report").agg(of("cpi_yoy"), of("nfp"), of("mvrv"), of("yield_10y"))
    f = fields(cells(reports))
    v = number(F.col("text"))
    get = lambda asset, metric: F.max(F.when((F.col("asset") == asset) & (F.col("metric") == metric), v))
    shown = f.groupBy("report").agg(
        get("MACRO", "cpi_yoy").alias("cpi"), get("MACRO", "nfp").alias("nfp"), get("MACRO", "yield_10y").alias("y10"), get("CHAIN", "mvrv").alias("mvrv"), get("BTC", "price").alias("btc"),
        F.max((F.col("metric") == "usd_index") & (F.lower("text") == "ratio")).alias("as_ratio"), F.max(F.lower("text").isin("none", "nan")).alias("blank"),
    )
    j = reports.select("report", "day").join(shown, "report", "left").join(known, "report", "left").join(prices, "report", "left")
    c = F.col
    age = F.datediff("day", "cpi_day")
    rules = [
        ("cpi differs", "critical", F.abs(c("cpi") - c("a_cpi_yoy")) > 0.1),
        ("cpi range", "warning", c("a_cpi_yoy").isNotNull() & ~c("cpi").between(1, 10)),
        ("cpi unknown", "warning", c("cpi").isNotNull() & c("a_cpi_yoy").isNull()),
        ("cpi age", "warning", c("cpi").isNotNull() & ~age.between(-31, 120)),
        ("nfp level", "critical", F.abs(c("nfp")) > 500),
        ("nfp unknown", "warning", c("nfp").isNotNull() & c("a_nfp").isNull()),
        ("index as ratio", "warning", c("as_ratio")),
        ("price range", "warning", ~c("btc").between(1000, 500_000)),
        ("price differs", "warning", F.abs(c("btc") - c("price")) / c("price") > 0.02),
        ("missing number", "warning", c("blank")),
        ("mvrv differs", "warning", F.abs(c("mvrv") - c("a_mvrv")) > 0.2),
        ("yield differs", "warning", F.abs(c("y10") - c("a_yield_10y")) > 0.1),
        ("top below year", "critical", c("ath") < c("high_52w") * 0.995),
    ]
    return _graded(j, rules)


def _graded(df: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    found = [F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(n).alias("issue"), F.lit(s).alias("severity"))) for n, s, broken in rules]
    return df.select("report", F.explode(F.array_compact(F.array(*found))).alias("_i")).select("report", "_i.*")


def traceability_issues(reports: DataFrame, archive: DataFrame, macro: DataFrame, few: int = 30, enough: int = 50) -> DataFrame:
    """(report, issue, severity): too few archived metrics, metrics without a source, unverified macro observations and
    links without a target. archive: report, asset, metric, source; macro: report, status."""
    a = archive.groupBy("report").agg(F.count_distinct("asset", "metric").alias("n"), F.count_if(F.coalesce("source", F.lit("")) == "").alias("blank"))
    m = macro.groupBy("report").agg(F.count_if(F.col("status") != "VERIFIED").alias("unverified"))
    target = F.regexp_replace(_of("attrs", "href"), "^[a-z]+:/*", "")
    links = cells(reports).where("tag = 'a'").groupBy("report").agg(F.max(target == "").alias("empty"))
    j = reports.select("report").join(links, "report", "left").join(a, "report", "left").join(m, "report", "left")
    n = F.coalesce("n", F.lit(0))
    rules = [("too few metrics", "critical", n < few), ("few metrics", "warning", (n >= few) & (n < enough)), ("no source", "warning", F.col("blank") > 0), ("unverified macro", "warning", F.col("unverified") > 0), ("empty link", "critical", F.col("empty"))]
    return _graded(j, rules)


def incident_checks(facts: DataFrame, key: str) -> DataFrame:
    """(key, check, outcome) of the recurring incidents: PASS, CHECK or FAIL.

    facts: cpi, nfp, usd, future_events, oil_rows, share_price, price, sma200, support, resistance, units_missing,
    bad_titles, gate_score, ath, high_52w, low_52w.
    """
    c = F.col
    ok = lambda passed, otherwise="FAIL": F.when(F.coalesce(passed, F.lit(False)), "PASS").otherwise(otherwise)
    checks = {
        "cpi": F.when((c("cpi") > 2.5) & (c("cpi") < 5), "PASS").when(c("cpi") > 5, "CHECK").otherwise("FAIL"),
        "nfp": ok((F.abs("nfp") < 1500) & (c("nfp") != 0)),
        "usd": ok((c("usd") > 80) & (c("usd") < 150)),
        "events": ok(c("future_events") == 0),
        "oil": ok(c("oil_rows") > 0),
        "share": ok(c("share_price").isNotNull(), "CHECK"),
        "sma200": F.when(c("sma200").isNotNull() & c("price").isNotNull(), "PASS").when(c("sma200").isNull(), "FAIL").otherwise("CHECK"),
        "levels": F.when(c("support").isNull() | c("resistance").isNull(), "CHECK").otherwise(ok((c("support") < c("price")) & (c("price") < c("resistance")), "CHECK")),
        "units": ok(c("units_missing") == 0),
        "news": ok(c("bad_titles") == 0),
        "gate": F.when(c("gate_score").isNull(), "CHECK").otherwise(ok(c("gate_score") >= 95)),
        "extremes": F.when(c("ath").isNull() | c("high_52w").isNull(), "CHECK").when(c("low_52w").isNull(), ok(c("ath") > c("high_52w"))).otherwise(ok((c("high_52w") > c("low_52w")) & (c("ath") > c("high_52w")))),
    }
    rows = F.array(*[F.struct(F.lit(n).alias("check"), o.alias("outcome")) for n, o in checks.items()])
    return facts.select(key, F.inline(rows))


#: What a metric is compared with, and how its sides are called.
CENTERS = {"mvrv": (1, "cap above realized", "cap below realized", "cap as realized"), "asopr": (1, "spent above cost", "spent below cost", "spent at cost"), "nupl": (0, "unrealized profit", "unrealized loss", "balanced")}


def snapshot_facts(snapshot: DataFrame, corpus: DataFrame) -> DataFrame:
    """A fact for each finite value of a known metric that the corpus has a method for: metric, value, reading, as_of (NULL
    unless a date or a date with minutes), method, caveat, url. snapshot: metric, value, as_of (and other columns)."""
    v = F.col("value")
    reading = F.lit(None).cast("string")
    for name, (center, above, below, at) in CENTERS.items():
        reading = F.when(F.col("metric") == name, F.when(v > center, above).when(v < center, below).otherwise(at)).otherwise(reading)
    fine = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")) & F.col("metric").isin(list(CENTERS))
    dated = F.when(F.col("as_of").rlike(r"^\d{4}-\d{2}-\d{2}(?: [0-2]\d:[0-5]\d(?: UTC)?)?$"), F.col("as_of"))
    rows = snapshot.where(fine).withColumn("reading", reading).withColumn("as_of", dated)
    return rows.join(F.broadcast(corpus.where(F.col("metric").isin(list(CENTERS))).select("metric", "method", "caveat", "url")), "metric")  # a record for each metric
