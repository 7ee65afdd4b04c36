"""Landed payloads (JSON, XML, HTML, text) to typed rows; what does not fit its contract is set aside with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_addressed(df: DataFrame, body: str, key: str) -> DataFrame:
    """One row a distinct body: SHA-256, how often it came and its first key."""
    rows = df.where(F.col(body).isNotNull())
    return rows.groupBy(F.sha2(body, 256).alias("digest")).agg(F.count("*").alias("receipts"), F.min(key).alias("first_id"))


QUOTE = "timestamp array<bigint>, open array<double>, high array<double>, low array<double>, close array<double>, volume array<double>"


def quote_envelope(df: DataFrame, body: str = "body", today: Column | None = None) -> DataFrame:
    """Parallel arrays to bars; bars without a finite close, and those of the open day, are dropped."""
    j = df.withColumn("_j", F.from_json(body, QUOTE))
    names = ["timestamp", "open", "high", "low", "close", "volume"]
    rows = j.select(*[c for c in df.columns if c != body], F.inline(F.arrays_zip(*[F.col(f"_j.{n}").alias(n) for n in names])))
    rows = rows.withColumn("day", F.to_date(F.timestamp_seconds("timestamp")))
    rows = rows.where(F.col("close").isNotNull() & ~F.isnan("close") & (F.abs("close") < float("inf")))
    return rows if today is None else rows.where(F.col("day") < today)


def five_series(df: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """The same payload as five series (keys, metric, day, value) with the reason of a payload's rejection."""
    j = df.withColumn("_j", F.from_json(body, QUOTE))
    names = ["open", "high", "low", "close", "volume"]
    sizes = [F.coalesce(F.size(f"_j.{n}"), F.lit(-1)) for n in ["timestamp", *names]]
    same = sizes[0] > 0
    for s in sizes[1:]:
        same = same & (s == sizes[0])
    zipped = F.arrays_zip(*[F.col(f"_j.{n}").alias(n) for n in ["timestamp", *names]])
    days = F.transform(F.col("_j.timestamp"), lambda t: F.to_date(F.timestamp_seconds(t)))
    good = F.forall(zipped, lambda b: (b["low"] > 0) & (b["low"] <= b["open"]) & (b["open"] <= b["high"]) & (b["low"] <= b["close"]) & (b["close"] <= b["high"]))
    j = j.withColumn("reason", F.when(F.col("_j").isNull() | ~same, "shape").when(F.size(F.array_distinct(days)) != sizes[0], "duplicate day").when(~F.coalesce(good, F.lit(False)), "prices"))
    rows = j.where("reason is null").select(*keys, F.inline(zipped))
    rows = rows.withColumn("day", F.to_date(F.timestamp_seconds("timestamp"))).unpivot([*keys, "day"], names, "metric", "value")
    return rows.withColumn("reason", F.lit(None).cast("string")).unionByName(j.where("reason is not null").select(*keys, "reason"), allowMissingColumns=True)


def positional_daily(df: DataFrame, body: str = "body", epoch: str = "2009-01-01") -> DataFrame:
    """{index, start, data}: the value at a position belongs to the day start + position after the epoch; null is absent."""
    j = df.withColumn("_j", F.from_json(body, "index string, start int, data array<double>"))
    rows = j.select(*[c for c in df.columns if c != body], F.col("_j.index").alias("index"), F.col("_j.start").alias("_s"), F.posexplode("_j.data").alias("pos", "value"))
    return rows.where("value is not null").withColumn("day", F.date_add(F.lit(epoch).cast("date"), F.col("_s") + F.col("pos"))).drop("_s", "pos")


def positional_period(df: DataFrame, body: str = "body", epoch: str = "2009-01-01", block_seconds: int = 600) -> DataFrame:
    """As positional_daily for day, week, 30-day month or block height; lists nested in a block are flattened."""
    j = df.withColumn("_j", F.from_json(body, "index string, start int, data array<string>"))
    rows = j.select(*[c for c in df.columns if c != body], F.col("_j.index").alias("index"), F.col("_j.start").alias("_s"), F.posexplode_outer("_j.data").alias("pos", "_raw"))
    nested = F.coalesce(F.from_json("_raw", "array<double>"), F.array(F.col("_raw").try_cast("double")))
    rows = rows.withColumn("value", F.explode_outer(nested)).where("value is not null")
    at = F.col("_s") + F.col("pos")
    days = F.when(F.col("index") == "week", at * 7).when(F.col("index") == "month", at * 30).when(F.col("index") == "height", F.floor(at * block_seconds / 86400).cast("int")).otherwise(at)
    return rows.withColumn("day", F.date_add(F.lit(epoch).cast("date"), days)).withColumn("position", at).drop("_s", "pos", "_raw")


def macro_observations(df: DataFrame, body: str = "body") -> DataFrame:
    """{observations: [{date, realtime_start, value}]}; `.` and empty values are dropped, dates and vintages kept apart."""
    j = df.withColumn("_j", F.from_json(body, "observations array<struct<date string, realtime_start string, value string>>"))
    rows = j.select(*[c for c in df.columns if c != body], F.inline("_j.observations"))
    return rows.select(*[c for c in df.columns if c != body], F.try_to_date("date").alias("observed_date"), F.try_to_date("realtime_start").alias("realtime_start"), F.col("value").try_cast("double").alias("value")).where("value is not null")


def exchange_pages(df: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """Open interest from a bare list or from {retCode, result.list}; error codes, other symbols and repeated times reject a page."""
    bare = F.from_json(body, "array<struct<symbol string, sumOpenInterest string, timestamp bigint>>")
    wrapped = F.from_json(body, "retCode int, result struct<symbol string, list array<struct<openInterest string, timestamp string>>>")
    is_list = F.ltrim(body).startswith("[")
    j = df.withColumn("_b", F.when(is_list, bare)).withColumn("_w", F.when(~is_list, wrapped))
    rows = F.when(is_list, F.transform("_b", lambda x: F.struct(x["symbol"].alias("symbol"), x["timestamp"].alias("ms"), x["sumOpenInterest"].try_cast("double").alias("value")))).otherwise(
        F.transform("_w.result.list", lambda x: F.struct(F.col("_w.result.symbol").alias("symbol"), x["timestamp"].try_cast("bigint").alias("ms"), x["openInterest"].try_cast("double").alias("value")))
    )
    j = j.withColumn("_r", rows)
    times = F.transform("_r", lambda x: x["ms"])
    reason = F.when(F.col("_w.retCode") != 0, "code").when(F.col("_r").isNull(), "shape").when(F.size(F.array_distinct(times)) != F.size("_r"), "duplicate time").when(F.exists("_r", lambda x: x["symbol"] != F.col("symbol")), "symbol")
    j = j.withColumn("reason", reason)
    ok = j.where("reason is null").select(*keys, F.inline("_r")).select(*keys, F.timestamp_millis("ms").alias("observed"), "value", F.lit(None).cast("string").alias("reason")) if "symbol" not in keys else j.where("reason is null").select(*keys, F.explode("_r").alias("_x")).select(*keys, F.timestamp_millis("_x.ms").alias("observed"), F.col("_x.value").alias("value"), F.lit(None).cast("string").alias("reason"))
    return ok.unionByName(j.where("reason is not null").select(*keys, "reason"), allowMissingColumns=True)


def slug_rows(df: DataFrame, slug: str, body: str = "body", time_keys=("date", "time", "timestamp"), others: tuple[str, ...] = ()) -> DataFrame:
    """Scalar rows whose value is under the metric's own name or `value`; exactly one time key; another metric rejects."""
    m = F.from_json(body, "map<string,string>")
    j = df.withColumn("_m", m).withColumn("_t", F.array_intersect(F.map_keys("_m"), F.array(*[F.lit(k) for k in time_keys])))
    value = F.coalesce(F.try_element_at("_m", F.lit(slug)), F.try_element_at("_m", F.lit("value"))).try_cast("double")
    strange = F.arrays_overlap(F.map_keys("_m"), F.array(*[F.lit(o) for o in others])) if others else F.lit(False)
    reason = F.when(F.col("_m").isNull(), "shape").when(F.size("_t") != 1, "time key").when(strange, "other metric").when(value.isNull(), "value")
    return j.withColumn("value", value).withColumn("at", F.try_element_at("_m", F.col("_t")[0])).withColumn("reason", reason).drop("_m", "_t")


def html_flow_table(df: DataFrame, html: str = "html") -> DataFrame:
    """Rows of an HTML table (first row: tickers) as (date, ticker, flow); (1.2) is -1.2, - and blanks are NULL."""
    from marketlens.functions.scalars import parse_number

    cells = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[hd][^>]*>(.*?)</t[hd]>"), F.lit(1)), lambda c: F.trim(F.regexp_replace(c, "<[^>]*>", "")))
    keep = [c for c in df.columns if c != html]
    rows = df.withColumn("_rows", F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1)))
    rows = rows.withColumn("_head", cells(F.col("_rows")[0])).select(*keep, "_head", F.explode(F.slice("_rows", 2, F.greatest(F.size("_rows"), F.lit(1)))).alias("_row"))
    rows = rows.withColumn("_cells", cells(F.col("_row"))).select(*keep, "_head", F.col("_cells")[0].alias("date"), F.posexplode("_cells").alias("_pos", "_cell"))
    return rows.where("_pos > 0").select(*keep, "date", F.get("_head", F.col("_pos")).alias("ticker"), parse_number(F.col("_cell")).alias("flow"))


def ical_events(df: DataFrame, body: str = "body") -> DataFrame:
    """VEVENTs: unfolded lines, UTC, date-only or New York local starts; another zone is `unconfirmed`."""
    keep = [c for c in df.columns if c != body]
    flat = F.regexp_replace(F.regexp_replace(body, r"\r\n|\r", "\n"), r"\n[ \t]", "")
    rows = df.select(*keep, F.explode(F.regexp_extract_all(flat, F.lit(r"(?s)BEGIN:VEVENT\n(.*?)END:VEVENT"), F.lit(1))).alias("_e"))
    field = lambda n: F.nullif(F.trim(F.regexp_extract("_e", rf"(?m)^{n}[^:\n]*:(.*)$", 1)), F.lit(""))
    zone = F.regexp_extract("_e", r"(?m)^DTSTART[^:\n]*TZID=([^:;\n]+)", 1)
    start = field("DTSTART")
    at = F.try_to_timestamp(F.regexp_replace(start, "Z$", ""), F.lit("yyyyMMdd'T'HHmmss"))
    utc, date_only = start.endswith("Z"), F.length(start) == 8
    precision = F.when(date_only, "date").when(utc | (zone == "America/New_York"), "time").otherwise("unconfirmed")
    ts = F.when(utc, at).when(zone == "America/New_York", F.to_utc_timestamp(at, "America/New_York"))
    day = F.try_to_date(F.substring(start, 1, 8), "yyyyMMdd")
    return rows.select(*keep, field("UID").alias("uid"), field("SUMMARY").alias("title"), F.coalesce(F.to_date(ts), day).alias("day"), ts.alias("ts"), precision.alias("precision"))


def release_dates(df: DataFrame, body: str = "body") -> DataFrame:
    """{release_dates: [{release_id, release_name, date}]} as date-only events keyed id:date."""
    keep = [c for c in df.columns if c != body]
    j = df.select(*keep, F.explode(F.from_json(body, "release_dates array<struct<release_id int, release_name string, date string>>")["release_dates"]).alias("_r"))
    return j.select(*keep, F.concat_ws(":", F.col("_r.release_id").cast("string"), "_r.date").alias("key"), F.col("_r.release_name").alias("title"), F.try_to_date("_r.date").alias("day"), F.lit("date").alias("precision"))


FEED = "struct<channel struct<item array<struct<title string, link string, pubDate string, description string>>>>"


def feed_items(df: DataFrame, now: Column, body: str = "body", domains: tuple[str, ...] = (), days: int = 7, most: int = 10, max_bytes: int = 2_000_000, per: list[str] | None = None) -> DataFrame:
    """RSS items: size cap, no DTD, own domain, age and length filters, the newest `most` a feed (keys: the other columns).

    per: the keys of the newest `most` where several feeds share them; tasks rank their own items before they are dealt.
    """
    from pyspark.sql import Window

    from marketlens.functions.scalars import feed_date
    from marketlens.functions.text import on_domains, strip_markup, url_host

    keep = [c for c in df.columns if c != body]
    ok = (F.octet_length(body) <= max_bytes) & ~F.upper(body).contains("<!DOCTYPE") & ~F.upper(body).contains("<!ENTITY")
    rows = df.where(ok).withColumn("_x", F.from_xml(body, FEED[7:-1])).select(*keep, F.explode("_x.channel.item").alias("i"))
    rows = rows.select(*keep, F.trim("i.title").alias("title"), F.trim("i.link").alias("url"), feed_date(F.col("i.pubDate")).alias("published"), strip_markup(F.col("i.description")).alias("highlight"))
    rows = rows.where((F.col("published") <= now) & (F.col("published") >= now - F.expr(f"interval {days} days")) & (F.length("title") >= 5))
    if domains:
        rows = rows.where(on_domains(url_host(F.col("url")), domains))
    rank = F.row_number().over(Window.partitionBy(*(per or keep)).orderBy(F.desc("published"), "url"))
    return rows.withColumn("_r", rank).where(F.col("_r") <= most).drop("_r")


def search_blocks(df: DataFrame, body: str = "body") -> DataFrame:
    """Search-result text: records that begin with `Title:`."""
    keep = [c for c in df.columns if c != body]
    rows = df.select(*keep, F.explode(F.split(F.concat(F.lit("\n"), F.col(body)), r"\nTitle:")).alias("_b")).where(F.trim("_b") != "")
    field = lambda n: F.nullif(F.trim(F.regexp_extract("_b", rf"(?m)^{n}:[ \t]*(.*)$", 1)), F.lit(""))
    rows = rows.select(*keep, F.trim(F.regexp_extract("_b", r"^(.*)", 1)).alias("title"), field("URL").alias("url"), field("Published").alias("published"), F.trim(F.regexp_extract("_b", r"(?s)\nHighlights:(.*)$", 1)).alias("highlight"))
    return rows.where(F.col("url").isNotNull())


def payload_shape(df: DataFrame, body: str = "body") -> DataFrame:
    """Keys and kinds of payloads, never values."""
    obj = F.json_object_keys(F.col(body))
    kind = F.when(obj.isNotNull(), "object").when(F.json_array_length(body).isNotNull(), "array").otherwise("other")
    return df.select(kind.alias("kind"), F.array_join(F.array_sort(obj), ",").alias("keys"), F.octet_length(body).alias("bytes")).groupBy("kind", "keys").agg(F.count("*").alias("n"), F.min("bytes").alias("min_bytes"), F.max("bytes").alias("max_bytes"))


def both_parsers_agree(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one of two decoders gives and the other does not."""
    return a.exceptAll(b).withColumn("only", F.lit("first")).unionByName(b.exceptAll(a).withColumn("only", F.lit("second")))


def corpus_issues(df: DataFrame, ident: str, families: list[str], kinds: list[str], domains: list[str]) -> DataFrame:
    """(row, issue) of records that a corpus must not hold: blank or missing fields, ids that are malformed or stand more
    than once, unknown families or source kinds, urls that are not plain https of a listed host, fields too short or long."""
    fields = [ident, "family", "title", "keywords", "method", "caveat", "url", "source_kind"]
    blank = [F.col(f).isNull() | (F.trim(F.col(f)) == "") for f in fields]
    host = F.regexp_extract("url", r"^https://([^/?#@:]+)(/[^#]*)$", 1)
    rules = [
        ("required", F.exists(F.array(*blank), lambda x: x)),
        ("id", ~F.col(ident).rlike("^[a-z][a-z0-9_]{1,63}$")),
        ("family", ~F.col("family").isin(families)),
        ("source kind", ~F.col("source_kind").isin(kinds)),
        ("url", ~F.lower(host).isin(domains)),
        ("length", (F.length("method") < 24) | (F.length("caveat") < 20) | (F.length("keywords") > 500)),
    ]
    found = F.array_compact(F.array(*[F.when(broken, name) for name, broken in rules]))
    single = df.select("*", F.explode(found).alias("issue"))
    twice = df.groupBy(F.col(ident).alias("_id")).agg(F.count("*").alias("_n")).where("_n > 1 and _id is not null")
    return single.unionByName(df.join(twice, df[ident] == F.col("_id")).drop("_id", "_n").withColumn("issue", F.lit("duplicate id")))


def payload_types(df: DataFrame, body: str = "body", depth: int = 8) -> DataFrame:
    """(path, kind, n, min_length, max_length) over all payloads, down to `depth` levels, never a value.

    Kinds: object, array, string, number, boolean, null, other, malformed (no JSON); elements of an array are path[].
    Lengths are an object's fields, an array's elements, a string's characters. Each level takes the variants below apart.
    """
    spark = df.sparkSession
    parsed = df.where(F.col(body).isNotNull()).select(F.lit("$").alias("path"), F.try_parse_json(body).alias("v"))
    bad = parsed.where("v is null").select("path", F.lit("malformed").alias("kind"), F.lit(None).cast("long").alias("length"))
    name = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
    kind = F.when(name == "OBJECT", "object").when(name == "ARRAY", "array").when(name == "STRING", "string").when(name == "BOOLEAN", "boolean").when(name == "VOID", "null").when(name.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "number").otherwise("other")
    fields = F.size(F.map_keys(F.try_variant_get("v", "$", "map<string,variant>")))
    length = F.when(F.col("kind") == "object", fields).when(F.col("kind") == "array", F.size(F.try_variant_get("v", "$", "array<variant>"))).when(F.col("kind") == "string", F.length(F.try_variant_get("v", "$", "string")))
    level, levels = parsed.where("v is not null"), [bad]
    for _ in range(depth):
        level = level.withColumn("kind", kind)
        levels.append(level.select("path", "kind", length.cast("long").alias("length")))
        level = spark.sql("SELECT concat(path, CASE WHEN kind = 'array' THEN '[]' ELSE concat('.', key) END) AS path, value AS v FROM (SELECT * FROM {rows} WHERE kind IN ('object', 'array')), LATERAL variant_explode(v)", rows=level)
    rows = levels[0]
    for other in levels[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("path", "kind").agg(F.count("*").alias("n"), F.min("length").alias("min_length"), F.max("length").alias("max_length"))
