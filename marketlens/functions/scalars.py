"""Scalar expressions: dates, validity rules, bands, numbers, formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# --- time -------------------------------------------------------------------------------------------------------
def epoch_to_utc(col: Column, unit: str = "s") -> Column:
    return F.timestamp_millis(col) if unit == "ms" else F.timestamp_seconds(col)


def strict_utc(text: Column) -> Column:
    """ISO time with a zero offset (Z or +00:00), else NULL; naive and offset times are rejected."""
    fits = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|\+00:00)$")
    return F.when(fits, F.try_to_timestamp(F.regexp_replace(text, r"\+00:00$", "Z")))


def previous_completed_day(now: Column) -> Column:
    return F.date_sub(F.to_date(now), 1)


def window_52w(day: Column) -> Column:
    """(first, last) of the 52 weeks that end with a closed day."""
    return F.struct(F.date_sub(day, 364).alias("first"), day.alias("last"))


def closed_slot(epoch: Column, step: int = 300, margin: int = 600) -> Column:
    """Start of the last bar of `step` seconds that is closed for `margin` seconds."""
    return ((epoch - margin) - F.pmod(epoch - margin, F.lit(step))).cast("long")


def month_index(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day) - 1).cast("long")


def month_text(index: Column) -> Column:
    return F.format_string("%04d-%02d", F.floor(index / 12), index % 12 + 1)


def feed_date(text: Column) -> Column:
    """RFC-822 (weekday dropped) or ISO feed time, else NULL."""
    bare = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", "")
    bare = F.regexp_replace(bare, r"\s(GMT|UT|UTC|Z)$", " +0000")
    return F.coalesce(F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(text))


#: Month names in Spanish and English.
MONTHS = {
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
}


def localized_date(text: Column) -> Column:
    """`7 de octubre de 2026`, `October 7, 2026` or `7 October 2026` as a date, else NULL."""
    t = F.lower(text)
    months = F.create_map(*[x for k, v in MONTHS.items() for x in (F.lit(k), F.lit(v))])
    month = F.coalesce(*[F.try_element_at(months, F.nullif(F.regexp_extract(t, p, 1), F.lit(""))) for p in (r"\d{1,2}\s+(?:de\s+)?([a-z]+)", r"([a-z]+)\s+\d{1,2}\b")])
    day, year = F.regexp_extract(t, r"\b(\d{1,2})\b", 1), F.regexp_extract(t, r"\b(\d{4})\b", 1)
    made = F.format_string("%s-%02d-%02d", year, month, F.expr("1").cast("int") * day.try_cast("int"))
    return F.when((year != "") & (day != "") & month.isNotNull(), F.try_to_date(made, "yyyy-MM-dd"))


def days_left(day: Column, today: Column) -> Column:
    return F.greatest(F.datediff(day, today), F.lit(0)).cast("long")


def earliest_start(tier: Column, explicit: Column, today: Column) -> Column:
    """First day a plan tier may ask for: 364 days back for tier 0, else the explicit day."""
    return F.when(tier == 0, F.date_sub(today, 364)).otherwise(explicit)


# --- validity ---------------------------------------------------------------------------------------------------
def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def closed_valid_bars(df: DataFrame, today: str, day: str = "day") -> DataFrame:
    """Bars of days before today whose four prices are finite and positive."""
    ok = reduce(lambda a, b: a & b, [finite(F.col(c)) & (F.col(c) > 0) for c in ("open", "high", "low", "close")])
    return df.where((F.col(day) <= F.date_sub(F.col(today), 1)) & ok)


def ohlcv_valid() -> Column:
    o, h, low, c, v = (F.col(x) for x in ("open", "high", "low", "close", "volume"))
    return (v >= 0) & (low > 0) & (low <= o) & (o <= h) & (low <= c) & (c <= h)


def close_to(a: Column, b: Column, absolute: float = 1e-12, relative: float = 1e-10) -> Column:
    """Equal within the larger of an absolute and a relative tolerance."""
    return F.abs(a - b) <= F.greatest(F.lit(absolute), F.abs(a) * relative)


def first_failing(rules: list[tuple[str, Column]], otherwise: str | None = None) -> Column:
    """The name of the first rule that fails (is not true)."""
    out = None
    for name, ok in rules:
        bad = ~F.coalesce(ok, F.lit(False))
        out = F.when(bad, name) if out is None else out.when(bad, name)
    return out.otherwise(F.lit(otherwise)) if otherwise else out


def derivative_rules(metric: Column, unit: Column, value: Column) -> list[tuple[str, Column]]:
    oi, funding = metric == "open_interest", metric == "funding_rate"
    return [
        ("metric", oi | funding),
        ("unit", (oi & unit.isin("contracts", "base", "usd")) | (funding & (unit == "fraction"))),
        ("finite", finite(value)),
        ("range", F.when(oi, value >= 0).otherwise(F.abs(value) <= 0.2)),
    ]


def request_rules() -> list[tuple[str, Column]]:
    """Rules of a logged request: status, attempts, sha, returned_rows, persisted_rows, direction, path."""
    c = F.col
    failed = c("status") == "failed"
    return [
        ("status", c("status").isin("success", "empty", "failed")),
        ("attempts", c("attempts").between(0, 1)),
        ("rows", c("returned_rows").between(0, 1000) & c("persisted_rows").between(0, 1000)),
        ("direction", c("direction").isin("backward", "forward")),
        ("path", c("path").startswith("/") & ~F.contains("path", F.lit("?"))),
        ("evidence", failed | ((c("attempts") == 1) & c("sha").isNotNull())),
        ("failure", ~failed | (c("sha").isNull() & (c("persisted_rows") == 0))),
    ]


def event_rules(precision: Column, day: Column, ts: Column, title: Column) -> list[tuple[str, Column]]:
    return [
        ("precision", precision.isin("date", "time", "unconfirmed")),
        ("timestamp", (precision == "time") == ts.isNotNull()),
        ("day", ts.isNull() | (F.to_date(ts) == day)),
        ("title", F.length(F.trim(title)).between(1, 300)),
    ]


# --- labels -----------------------------------------------------------------------------------------------------
def banded(value: Column, bands: list[tuple[float, str]], last: str) -> Column:
    """The label of the first band whose upper bound exceeds the value; NULL and NaN stay NULL."""
    out = F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(None).cast("string"))
    for top, label in bands:
        out = out.when(value < top, label)
    return out.otherwise(last)


#: Below the first an indicator is oversold, above the second overbought, both bounds neutral.
ZONES = {"rsi": (30, 70), "stochastic": (20, 80), "williams": (-80, -20), "cci": (-100, 100)}

#: Bands of on-chain metrics (upper bounds, which belong to the next band; last label).
BANDS = {
    "mvrv": ([(1, "below cost"), (1.5, "accumulation"), (2.5, "intermediate"), (3.5, "elevated")], "euphoria"),
    "asopr": ([(1, "loss"), (1.1, "moderate profit"), (1.3, "profit")], "high profit"),
    "nupl": ([(0, "capitulation"), (0.25, "low risk"), (0.5, "optimism"), (0.75, "belief")], "euphoria"),
}

#: Bands of macro series (bounds to be exceeded, from the top; last label).
LEVELS = {
    "us10y": ([(5.5, "near highs"), (5, "pressing")], "normal"),
    "vix": ([(25, "fear"), (15, "low premium")], "calm"),
    "usd": ([(125, "strong"), (110, "elevated")], "normal"),
}


def zone(kind: str, value: Column) -> Column:
    if kind in ZONES:
        low, high = ZONES[kind]
        return F.when(value < low, "oversold").when((value > high) & ~F.isnan(value.cast("double")), "overbought").when(value <= high, "neutral")
    if kind in BANDS:
        return banded(value, *BANDS[kind])
    levels, last = LEVELS[kind]
    out = F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(None).cast("string"))
    for bottom, label in levels:
        out = out.when(value > bottom, label)
    return out.otherwise(last)


def sign_label(value: Column, up: str = "bullish", down: str = "bearish") -> Column:
    return F.when(value > 0, up).when(value < 0, down).when(value == 0, "neutral")


def scenario(kind: str, s1: Column, s2: Column, r1: Column, r2: Column) -> Column:
    """Trigger, target and invalidation of a directional scenario from two supports and two resistances."""
    picks = {"bull": (r1, r2, s1), "bear": (s1, s2, r1), "base": (s1, r1, s2)}[kind]
    return F.struct(*[c.alias(n) for c, n in zip(picks, ("trigger", "target", "invalidation"))])


def scenario_coherent(kind: Column, spot: Column, trigger: Column, target: Column) -> Column:
    return (
        F.when(kind == "bull", (spot < trigger) & (trigger < target))
        .when(kind == "bear", (spot > trigger) & (trigger > target))
        .when(kind == "base", (spot >= F.least(trigger, target)) & (spot <= F.greatest(trigger, target)))
    )


# --- numbers and text -------------------------------------------------------------------------------------------
def parse_number(text: Column) -> Column:
    """A displayed number: thousands, currency and percent signs, unicode minus, (1.2) as -1.2, - or blank as NULL."""
    t = F.regexp_replace(F.trim(text), "[−–—]", "-")
    negative = t.rlike(r"^\(.*\)$")
    bare = F.regexp_replace(t, r"[()$€£,%\s]", "")
    value = F.when(~bare.isin("", "-"), bare.try_cast("double"))
    return F.when(negative, -value).otherwise(value)


def display(value: Column, unit: Column) -> Column:
    """Value as shown for its unit."""
    return (
        F.when(value.isNull(), "n/a")
        .when(unit == "percent", F.concat(F.format_string("%.2f", value), F.lit("%")))
        .when(unit == "usd", F.concat(F.lit("$"), F.format_number(value, 2)))
        .when(unit == "fraction", F.concat(F.format_string("%.2f", value * 100), F.lit("%")))
        .otherwise(F.format_string("%.4f", value))
    )


def row_hash(*cols: Column) -> Column:
    """SHA-256 over the canonical JSON of the fields, nulls included."""
    return F.sha2(F.to_json(F.struct(*[c.cast("string").alias(f"f{i}") for i, c in enumerate(cols)]), {"ignoreNullFields": "false"}), 256)


def request_identity(params: Column) -> Column:
    """Hash of a parameter map, whatever its order."""
    return F.sha2(F.to_json(F.array_sort(F.map_entries(params))), 256)


def redact(text: Column) -> Column:
    """Bearer tokens, then values of secret-looking parameters and headers, replaced."""
    t = F.regexp_replace(text, r"(?i)\b(bearer)\s+[A-Za-z0-9._~+/=-]+", "$1 ***")
    names = r"api[_-]?key|access[_-]?key|access[_-]?token|token|secret|password|signature|authorization"
    return F.regexp_replace(t, rf"(?i)\b({names})(\"?\s*[=:]\s*['\"]?)(?!bearer \*)([^&\s\"',}}<>]+)", "$1$2***")


def backoff_seconds(attempt: Column, identity: Column, base: int = 2, most: int = 300) -> Column:
    """Exponential wait with a jitter of 0 to 3 seconds from the request's hash, up to a maximum."""
    jitter = F.conv(F.substring(F.sha2(identity, 256), 1, 8), 16, 10).cast("long") % 4
    return F.least(F.lit(most).cast("long"), (F.lit(base) * F.pow(F.lit(2), attempt - 1)).cast("long") + jitter)


def retry_class(status: Column) -> Column:
    return F.when(status == 429, "rate_limited").when(status >= 500, "transient").when(status >= 400, "permanent").otherwise("none")


def error_category(kind: Column, code: Column, reason: Column) -> Column:
    """Category of a failed request, without its message: an HTTP status, the reason of a URL error, or the kind itself."""
    http = F.when(code.between(100, 599), F.concat(F.lit("HTTPError_"), code.cast("string"))).otherwise("HTTPError_UNKNOWN")
    url = (
        F.when(reason == "gaierror", "URLError_DNS")
        .when(reason.isin("SSLError", "SSLCertVerificationError"), "URLError_TLS")
        .when(reason.isin("TimeoutError", "timeout"), "URLError_TIMEOUT")
        .when(reason == "ConnectionRefusedError", "URLError_REFUSED")
        .when(reason.isin("ConnectionResetError", "ConnectionAbortedError", "BrokenPipeError"), "URLError_RESET")
        .otherwise("URLError_UNCLASSIFIED")
    )
    return F.when(kind == "HTTPError", http).when(kind == "URLError", url).otherwise(kind)


#: What an answer of the search service holds instead of results.
SEARCH_ERRORS = ["rate limit", "429", "401", "403", "500", "Error:", "error_code", "exceeded", "quota", "timeout", "connection refused"]


def is_error_text(body: Column) -> Column:
    """An empty answer, or one without a title that names an error."""
    named = F.lit(False)
    for word in SEARCH_ERRORS:
        named = named | F.lower(body).contains(word.lower())
    return body.isNull() | (F.trim(body) == "") | (named & ~body.contains("Title:"))


def expected_request(host: Column, path: Column, symbol: Column, start: Column, end: Column, limit: int) -> Column:
    return F.format_string("https://%s%s?symbol=%s&start=%d&end=%d&limit=" + str(limit), host, path, symbol, start, end)


def ratio_in(numerator: Column, denominator: Column, low: float, high: float) -> Column:
    r = F.try_divide(numerator, denominator)
    return F.when((r > low) & (r < high), r)


def freshness(age_seconds: Column, budget_seconds: Column) -> Column:
    return F.when(age_seconds < 0, "FUTURE").when(age_seconds <= budget_seconds, "WITHIN").otherwise("STALE")
