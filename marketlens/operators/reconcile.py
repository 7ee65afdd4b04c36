"""Keys with history: upserts, revisions, conflicts, bitemporal picks, reconciliation, lineage and quality rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.scalars import close_to
from marketlens.operators.store import dealt
from marketlens.operators.stretches import cut, positions, with_side


# --- sinks as table functions: (stored, incoming) -> new state, ready to be written ----------------------------
def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """First write wins; of several incoming rows of one key the least is written."""
    rest = [c for c in new.columns if c not in keys]
    fresh = new.join(old.select(*keys), keys, "left_anti").groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
    return old.unionByName(fresh)


def last_writes(new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row a key: the last by `order`, of equal ones (and without an order) the largest row."""
    rest = [c for c in new.columns if c not in keys]
    by = F.struct(*([order] if order else []), *[c for c in rest if c != order])
    return new.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_r")).select(*keys, "_r.*").select(*new.columns)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Last write wins, whole rows; of several incoming rows of a key the last (see last_writes)."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(last_writes(new, keys, order))


def merge_coalesce(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert of attributes: an incoming NULL keeps the stored value."""
    rest = [c for c in old.columns if c not in keys]
    j = old.alias("o").join(new.alias("n"), keys, "full_outer")
    return j.select(*keys, *[F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in rest])


def revisions(old: DataFrame, new: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, old_json, new_json) of stored rows whose fields change; other fields (fetch time, digest) do not count."""
    a = old.select(*keys, F.struct(*fields).alias("_o"))
    b = new.select(*keys, F.struct(*fields).alias("_n"))
    j = a.join(b, keys).where(~F.col("_o").eqNullSafe(F.col("_n")))
    return j.select(*keys, F.to_json("_o").alias("old_json"), F.to_json("_n").alias("new_json"))


def append_only(old: DataFrame, page: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """State of each incoming row: `new`, `replay` (same digest stored) or `conflict` (another one is)."""
    j = page.join(old.select(*keys, F.col(digest).alias("_d")), keys, "left")
    return j.withColumn("state", F.when(F.col("_d").isNull(), "new").when(F.col("_d") == F.col(digest), "replay").otherwise("conflict")).drop("_d")


def accept_pages(rows: DataFrame, page: str) -> DataFrame:
    """All or nothing: new rows of pages without a conflict."""
    bad = rows.where("state = 'conflict'").select(page).distinct()
    return rows.join(bad, page, "left_anti").where("state = 'new'")


def next_versions(old: DataFrame, new: DataFrame, keys: list[str], order: str, width: float | None = None) -> DataFrame:
    """Incoming reports with the versions that follow the stored ones, without a gap; a key's reports are numbered in
    stretches of `order`, by the rows of the stretches before."""
    top = old.groupBy(*keys).agg(F.max("version").alias("_v"))
    rows = with_side(positions(cut(new, keys, order, width), keys, [order]), top, keys)
    return rows.withColumn("version", (F.coalesce("_v", F.lit(0)) + F.col("_pos") + 1).cast("long")).drop("_v", "_pos", "_c")


def reconcile_window(old: DataFrame, new: DataFrame, keys: list[str], value: str, tolerance: float = 1e-4) -> DataFrame:
    """Action for each incoming row: INSERT, RECONCILED (differs by more than the tolerance) or UNCHANGED."""
    j = new.join(old.select(*keys, F.col(value).alias("old_value")), keys, "left")
    action = F.when(F.col("old_value").isNull(), "INSERT").when(F.abs(F.col(value) - F.col("old_value")) > tolerance, "RECONCILED").otherwise("UNCHANGED")
    return j.withColumn("action", action)


# --- bitemporal --------------------------------------------------------------------------------------------------
def as_of(vintages: DataFrame, keys: list[str], known: str, value: str, at: Column) -> DataFrame:
    """The last vintage of each key known at a time."""
    return vintages.where(F.col(known) <= at).groupBy(*keys).agg(F.max_by(value, known).alias(value), F.max(known).alias(known))


def as_of_probes(vintages: DataFrame, probes: DataFrame, keys: list[str], known: str, at: str, value: str) -> DataFrame:
    """The last vintage known at each probe's time: events and probes in one order, no range join."""
    v = vintages.select(*keys, F.col(known).alias("_t"), F.lit(0).alias("_p"), F.struct(F.col(value).alias("v")).alias("_v"))
    p = probes.select(*keys, F.col(at).alias("_t"), F.lit(1).alias("_p"), F.lit(None).cast(v.schema["_v"].dataType).alias("_v"))
    w = Window.partitionBy(*keys).orderBy("_t", "_p").rowsBetween(Window.unboundedPreceding, 0)
    both = v.unionByName(p).withColumn("_v", F.last("_v", ignorenulls=True).over(w))
    return both.where("_p = 1").select(*keys, F.col("_t").alias(at), F.col("_v.v").alias(value))


def as_of_max_age(df: DataFrame, keys: list[str], day: str, cutoff: Column, age: int, valid: Column | None = None) -> DataFrame:
    """The latest valid row of each key on or before a cutoff and at most `age` days old."""
    rows = df.where((F.col(day) <= cutoff) & (F.datediff(cutoff, F.col(day)) <= age))
    rows = rows if valid is None else rows.where(valid)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(day)))
    return rows.withColumn("_r", rank).where("_r = 1").drop("_r")


def merge_evidence(newer: DataFrame, legacy: DataFrame, keys: list[str], captured: str, unit: str) -> DataFrame:
    """One row a key: the newer source before the legacy one, then the last captured; keys with two units are BLOCKED."""
    both = newer.withColumn("_p", F.lit(0)).unionByName(legacy.withColumn("_p", F.lit(1)))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_p", F.desc(captured)))
    units = F.size(F.collect_set(unit).over(Window.partitionBy(*keys)))
    both = both.withColumn("_r", rank).withColumn("state", F.when(units > 1, "BLOCKED").otherwise("OK"))
    return both.where("_r = 1").withColumn("origin", F.when(F.col("_p") == 0, "newer").otherwise("legacy")).drop("_r", "_p")


# --- reconciliation ----------------------------------------------------------------------------------------------
def two_way(raw: DataFrame, stored: DataFrame, keys: list[str], value: str, absolute: float = 1e-12, relative: float = 1e-10, same: dict[str, str] | None = None, near: dict[str, str] | None = None) -> DataFrame:
    """Differences between decoded and stored rows: MISSING (only raw), EXTRA (only stored) or else the first of VALUE
    and what further columns tell. same: {column: issue} of columns that must be equal, NULL like NULL (unit, endpoint);
    near: of numbers that must agree like the value, where the payload has one (quote)."""
    same, near = same or {}, near or {}
    more = [*same, *near]
    a = raw.select(*keys, F.col(value).alias("raw_value"), *[F.col(c).alias(f"_a_{c}") for c in more], F.lit(True).alias("_a"))
    b = stored.select(*keys, F.col(value).alias("stored_value"), *[F.col(c).alias(f"_b_{c}") for c in more], F.lit(True).alias("_b"))
    j = a.join(b, keys, "full_outer")
    agree = lambda x, y: F.coalesce(close_to(F.col(x), F.col(y), absolute, relative), F.lit(False))
    issue = F.when(F.col("_b").isNull(), "MISSING").when(F.col("_a").isNull(), "EXTRA").when(~agree("raw_value", "stored_value"), "VALUE")
    for c, name in same.items():
        issue = issue.when(~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), name)
    for c, name in near.items():
        issue = issue.when(F.col(f"_a_{c}").isNotNull() & ~agree(f"_a_{c}", f"_b_{c}"), name)
    return j.select(*keys, "raw_value", "stored_value", issue.alias("issue")).where("issue is not null")


def receipt_reconstruction(decoded: DataFrame, stored: DataFrame, keys: list[str], receipt: str, digest: str) -> DataFrame:
    """Per receipt: what its payload, decoded again, and the stored rows that name it say about each other.

    decoded: keys, receipt, digest; stored: keys, receipt (the owner), digest. n decoded rows; missing: not stored with
    this digest under any owner; extra: stored under this receipt and in no payload; origin: stored under this receipt, but
    another one's payload holds the row, or this one's holds it with another digest. Receipts without a fault are left out.
    """
    d = decoded.select(*keys, F.col(receipt).alias("_from"), F.col(digest).alias("_want"))
    s = stored.select(*keys, F.col(receipt).alias("_owner"), F.col(digest).alias("_have"))
    j = d.join(s, keys, "full_outer")
    have = F.col("_have").isNotNull()
    facts = F.array(
        F.struct(F.col("_from").alias(receipt), F.lit(1).alias("n"), (~F.col("_want").eqNullSafe(F.col("_have"))).cast("int").alias("missing"), F.lit(0).alias("extra"), F.lit(0).alias("origin")),
        F.struct(F.col("_owner").alias(receipt), F.lit(0).alias("n"), F.lit(0).alias("missing"), (have & F.col("_from").isNull()).cast("int").alias("extra"), (have & ~(F.col("_from").eqNullSafe(F.col("_owner")) & F.col("_want").eqNullSafe(F.col("_have")))).cast("int").alias("origin")),
    )
    g = j.select(F.inline(facts)).where(F.col(receipt).isNotNull()).groupBy(receipt).agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "missing", "extra", "origin")])
    return g.where("missing + extra + origin > 0")


def page_issues(rows: DataFrame, pages: DataFrame, page: str, at: str) -> DataFrame:
    """(page, issue): rows (page, epoch second) against what was asked for (page, frequency, begin, stop).

    All: outside [begin, stop), and a time twice. `d1`, `monthly` and `weekly`: midnight. `5m`: whole multiples of 300
    seconds, from begin to the last bar before stop, without a gap. A page without rows has no issue here.
    """
    t, c = F.col(at), F.col
    once = dealt(rows.select(page, at), page).groupBy(page, at).agg(F.count("*").alias("n"))
    day, grid = F.pmod(t, F.lit(86400)), F.pmod(t, F.lit(300))
    g = once.groupBy(page).agg(
        F.sum("n").alias("n"), F.count(at).alias("d"), F.min(at).alias("lo"), F.max(at).alias("hi"),
        F.max(day != 0).alias("off_day"), F.max(grid != 0).alias("off_grid"), (F.min(grid) != F.max(grid)).alias("grids"),
    )
    g = g.join(pages.select(page, "frequency", "begin", "stop"), page)  # one row a page on both sides
    five, dated = c("frequency") == "5m", c("frequency").isin("d1", "monthly", "weekly")
    rules = [
        ("outside", (c("lo") < c("begin")) | (c("hi") >= c("stop"))), ("twice", c("n") > c("d")), ("not midnight", dated & c("off_day")), ("not aligned", five & c("off_grid")),
        ("begins late", five & (c("lo") != c("begin"))), ("ends early", five & ((F.pmod(c("stop") - c("begin"), F.lit(300)) != 0) | (c("hi") != c("stop") - 300))),
        ("gap", five & (c("grids") | ((c("hi") - c("lo")) / 300 + 1 != c("d")))),  # a neighbour that is not 300 seconds off
    ]
    return g.select(page, F.explode(F.array_compact(F.array(*[F.when(broken, name) for name, broken in rules]))).alias("issue"))


def contract_issues(df: DataFrame, contracts: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that no contract allows, with the first column (in the order given) that no contract has behind the values of
    those before it. contracts: the allowed combinations, a small table of rules."""
    for i in range(1, len(columns) + 1):
        known = F.broadcast(contracts.select(*columns[:i]).distinct().withColumn(f"_k{i}", F.lit(True)))
        df = df.join(known, columns[:i], "left")
    issue = F.coalesce(*[F.when(F.col(f"_k{i}").isNull(), c) for i, c in enumerate(columns, 1)])
    return df.withColumn("issue", issue).where("issue is not null").drop(*[f"_k{i}" for i in range(1, len(columns) + 1)])


def equal_key_sets(a: DataFrame, b: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """For each group whether both sides have the same keys, as often; a NULL in a key is equal to nothing. Both sides are
    grouped at once."""
    side = lambda df, x, y: df.select(group, *keys, F.lit(x).alias("_x"), F.lit(y).alias("_y"))
    both = dealt(side(a, 1, 0).unionByName(side(b, 0, 1)), group, *keys)
    j = both.groupBy(group, *keys).agg((F.sum("_x") == F.sum("_y")).alias("_e"))
    known = F.lit(True)
    for c in (group, *keys):
        known = known & F.col(c).isNotNull()
    return j.groupBy(group).agg(F.bool_and(F.col("_e") & known).alias("equal"))


def lineage_audit(runs: DataFrame, run: str, ordinal: str, status: str) -> DataFrame:
    """Ordinals 0 to n - 1 without a gap, successes as a prefix, and the status that the attempts give."""
    g = runs.groupBy(run).agg(
        F.count("*").alias("n"), F.max(ordinal).alias("_m"), F.count_distinct(ordinal).alias("_d"),
        F.min(F.when(F.col(status) != "ok", F.col(ordinal))).alias("_bad"), F.max(F.when(F.col(status) == "ok", F.col(ordinal))).alias("_ok"),
    )
    return g.select(
        run, "n",
        ((F.col("_m") + 1 == F.col("n")) & (F.col("_d") == F.col("n"))).alias("contiguous"),
        (F.col("_bad").isNull() | F.col("_ok").isNull() | (F.col("_ok") < F.col("_bad"))).alias("prefix_ok"),
        F.when(F.col("_bad").isNull(), "ok").when(F.col("_ok").isNull(), "failed").otherwise("partial").alias("derived_status"),
    )


def operational_evidence(runs: DataFrame, expected: DataFrame, key: str, order: str, end: str) -> DataFrame:
    """Per expected key: its runs, the status of the latest one and how far it reaches; MISSING where there is none."""
    g = runs.groupBy(key).agg(F.count("*").alias("runs"), F.max_by("status", order).alias("latest_status"), F.max(end).alias("latest"))
    j = expected.select(key).distinct().join(g, key, "left")
    return j.select(key, F.coalesce("runs", F.lit(0)).cast("long").alias("runs"), F.coalesce("latest_status", F.lit("MISSING")).alias("latest_status"), "latest")


# --- quality -----------------------------------------------------------------------------------------------------
#: Weights of the categories.
WEIGHTS = {"numeric": 0.35, "content": 0.25, "traceability": 0.20, "news": 0.15, "format": 0.05}


def quality_score(issues: DataFrame, reports: DataFrame, report: str = "report", threshold: int = 95) -> DataFrame:
    """Score of each report: 100 minus 5 for each warning in a category (0 at least), weighted; a critical issue blocks."""
    g = issues.groupBy(report).agg(
        *[F.count_if((F.col("severity") == "warning") & (F.col("category") == c)).alias(c) for c in WEIGHTS],
        F.count_if(F.col("severity") == "critical").alias("critical"),
    )
    j = reports.select(report).distinct().join(g, report, "left")
    parts = [F.greatest(100 - 5 * F.coalesce(c, F.lit(0)), F.lit(0)) * w for c, w in WEIGHTS.items()]
    j = j.withColumn("critical", F.coalesce("critical", F.lit(0)).cast("long")).withColumn("score", F.round(sum(parts[1:], parts[0]), 4))
    return j.withColumn("passed", (F.col("score") >= threshold) & (F.col("critical") == 0)).select(report, "score", "critical", "passed")


def evidence_gate(audits: DataFrame, required: DataFrame, stream: str) -> DataFrame:
    """Whether every audit is valid and every required stream is there, with the number missing."""
    missing = required.select(stream).distinct().join(audits.select(stream), stream, "left_anti").agg(F.count("*").alias("missing"))
    ok = audits.agg(F.coalesce(F.bool_and("valid"), F.lit(False)).alias("valid"))
    return ok.crossJoin(missing).select((F.col("valid") & (F.col("missing") == 0)).alias("passed"), "missing")


def budget_use(attempts: DataFrame, budgets: DataFrame, keys: list[str]) -> DataFrame:
    used = attempts.groupBy(*keys).agg(F.count("*").alias("used"))
    j = budgets.join(used, keys, "left").withColumn("used", F.coalesce("used", F.lit(0)).cast("long"))
    return j.withColumn("left", F.greatest(F.col("budget") - F.col("used"), F.lit(0)).cast("long")).withColumn("exceeded", F.col("used") > F.col("budget"))


def identical_groups(df: DataFrame, group: list[str], fields: list[str]) -> DataFrame:
    """Groups whose members all have equal fields."""
    return df.groupBy(*group).agg((F.count_distinct(F.struct(*fields)) == 1).alias("identical"), F.count("*").alias("n"))
