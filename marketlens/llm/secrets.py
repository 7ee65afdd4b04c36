"""Secret scans: candidates are judged by how many owners and repositories hold the same value (native DataFrame only).

Every pattern cuts a text into matches and the gaps between them, so that places are running sums of lengths. Values
travel as hashes; a value that several owners hold is a copied example, one that a single owner holds and that looks
like a credential is reported as live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, join_by_heat, join_checked

#: The base patterns, with the characters that a match (of assign: its value) has at least.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_CHARS = 12
#: Further candidates: long runs of letters and digits in both cases.
MIXED = r"[A-Za-z0-9+/_-]{20,}"
#: Kinds in the order of results; `mixed` only brings values, `live` is what the method adds.
KINDS = ("assign", "access", "hex", "mixed", "live")
#: Words of values that are there to be replaced.
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|change_?me|your|xxxx|test|\.\.\."
#: Different characters of a live value at least.
VARIETY = 8
#: A value of so many owners is a copied example.
COPIED_OWNERS = 3


def looks_live(value: Column) -> Column:
    """Letters and digits, many different characters, no word that stands for a value."""
    several = F.size(F.array_distinct(F.split(value, ""))) >= VARIETY
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & several & ~value.rlike(PLACEHOLDER)


def _found(text: Column, kind: int, pattern: str, value=lambda x: x, fits=lambda x, v: F.lit(True)) -> Column:
    """All matches of a pattern as (kind, i, gap, len, v_len, fits, looks, hash): gap are the characters since the last one."""
    # zipped outside of the function of an element, which would cut the text anew for each
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))
    pairs = pairs.cast("array<struct<m:string,g:string>>")

    def one(p: Column, i: Column) -> Column:
        x = p["m"]
        v = value(x)
        ok = fits(x, v)
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.char_length(p["g"]).alias("gap"),
            F.char_length(x).alias("len"),
            F.char_length(v).alias("v_len"),
            ok.alias("fits"),
            (ok & looks_live(v)).alias("looks"),
            F.unhex(F.md5(v)).alias("hash"),
        )

    return F.when(text.rlike(pattern), F.transform(F.filter(pairs, lambda p: p["m"].isNotNull()), one))


def _candidates(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    mixed = lambda x, v: x.rlike("[0-9]") & x.rlike("[A-Z]") & x.rlike("[a-z]")
    parts = [
        _found(text, 0, ASSIGN, lambda x: F.regexp_extract(x, ASSIGN, 2), lambda x, v: F.char_length(v) >= ASSIGN_CHARS),
        _found(text, 1, ACCESS),
        _found(text, 2, HEX),
        _found(text, 3, MIXED, fits=mixed),
    ]
    return F.flatten(F.array_compact(F.array(*parts)))


def scan_secrets(docs: DataFrame, owner: Column, repository: Column, copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """(doc_id, spans): per document all spans as (start, rank, kind, end, owners, repositories, copied), by place.

    Base spans are the matches of `assign`, `access` and `hex`. `live` spans are added: the values of base spans, and
    long mixed runs, that look like a credential and that one owner alone holds. owners and repositories tell how many
    hold the span's value, copied whether owners reach copied_owners. Places are code points, the end is exclusive.

    Nulls: a null or empty text has no spans; a null owner or repository counts as one of an empty name. Repeated rows
    and ids each get their own result and count as one owner; an empty table gives an empty result. One value in most
    documents is split off before the join; one document's spans meet in one task. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    named = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("id"), F.col("doc_id"), named(owner).alias("owner"), named(repository).alias("repository"), _candidates(F.col("text")).alias("found"))
    rows = scratch.stored(rows, "rows")
    each = rows.where(F.size("found") > 0).select("id", "owner", "repository", F.explode("found").alias("f")).select("id", "owner", "repository", "f.*")
    so_far = Window.partitionBy("id", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(so_far)).where("fits")
    placed = scratch.stored(placed.drop("i", "gap", "fits"), "placed")
    holders = placed.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    held = holders.groupBy("hash").agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repository").alias("repositories"), F.sum("n").alias("n"))
    known = join_by_heat(placed, scratch.stored(held, "held"), "hash", "n")
    # a value that several patterns find is one live span
    value = F.struct((F.col("end") - F.col("v_len")).alias("start"), F.lit(KINDS.index("live")).alias("rank"), "end", "owners", "repositories")
    base = F.struct((F.col("end") - F.col("len")).alias("start"), F.col("kind").alias("rank"), "end", "owners", "repositories")
    live = F.when(F.col("looks") & (F.col("owners") == 1), value)
    spans = known.select("id", F.explode(F.array_compact(F.array(F.when(F.col("kind") < 3, base), live))).alias("s")).distinct()
    spans = spans.groupBy("id").agg(F.array_sort(F.collect_list("s")).alias("spans"))  # those of one document
    spans = scratch.stored(spans, "spans")
    scratch.keep(rows, spans)
    out = join_checked(rows.select("id", "doc_id"), spans, "id", "left")
    name = F.array(*[F.lit(k) for k in KINDS])
    full = lambda s: F.struct(
        s["start"].alias("start"),
        s["rank"].alias("rank"),
        F.get(name, s["rank"]).alias("kind"),
        s["end"].alias("end"),
        s["owners"].alias("owners"),
        s["repositories"].alias("repositories"),
        (s["owners"] >= copied_owners).alias("copied"),
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,owners:bigint,repositories:bigint>>")
    return out.select("doc_id", F.transform(F.coalesce("spans", none), full).alias("spans"))

