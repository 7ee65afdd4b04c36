"""Benchmark decontamination: a positional inverted index of the rarest test terms (native DataFrame only).

The index stores the places (term, key, pos) of each test window's two rarest terms in the documents. Where both lists
of a window hold places near enough to each other, the window is a candidate; the few candidates are compared with the
document's words at that place: all words in a row for a phrase, all within a few more words for a proximity match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, join_checked, letters

#: What stands between words: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the text with A-Z in lower case are the words.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Further words that may stand between those of a proximity match.
SLOP = 4


def _lower(term: Column) -> Column:
    """A-Z in lower case; `lower` does just that, and faster, where all is ASCII."""
    return F.when(F.octet_length(term) == F.char_length(term), F.lower(term)).otherwise(letters(term))


def _parts(text: Column) -> Column:
    """The words in their own case, with an empty one before or behind them where the text begins or ends between words."""
    return F.split(F.coalesce(text, F.lit("")), BREAK, -1)


def _empty(parts: Column, at: int) -> Column:
    return (F.element_at(parts, at) == "").cast("int")


def count_words(text: Column) -> Column:
    parts = _parts(text)
    return F.greatest(F.size(parts) - _empty(parts, 1) - _empty(parts, -1), F.lit(0)).cast("long")


def words_of(text: Column) -> Column:
    return F.transform(F.filter(_parts(text), lambda x: x != ""), _lower)


def tokens_of(docs: DataFrame, *cols: Column) -> DataFrame:
    """(..., term, pos): the words of each text with their places, from 0."""
    rows = docs.select(*cols, _parts(F.col("text")).alias("_w"))
    rows = rows.select("*", _empty(F.col("_w"), 1).alias("_first"))
    rows = rows.select("*", F.posexplode("_w").alias("_pos", "_term")).where("_term != ''").drop("_w")
    return rows.select("*", _lower(F.col("_term")).alias("term"), (F.col("_pos") - F.col("_first")).alias("pos")).drop("_first", "_pos", "_term")


def test_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """Distinct (window, words, items): n consecutive words of an item, all words of a shorter one."""
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", words_of(F.col("text")).alias("w"))
    items = items.where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1)))
    rows = items.select("item_id", "w", F.explode(starts).alias("s")).select("item_id", F.slice("w", F.col("s"), n).alias("words"))
    return rows.groupBy("words").agg(F.collect_set("item_id").alias("items")).withColumn("window", F.md5(F.array_join("words", " ")))


def row_key(doc_id: Column, text: Column) -> Column:
    """One key for equal rows, so that repeated ids with other texts stay apart."""
    return F.unhex(F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(text, F.lit("")))))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences of each test term over all documents (0 where a term does not occur)."""
    counted = join_checked(tokens_of(docs).select("term"), terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    return terms.join(counted, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def rarest(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Add to each window its two rarest terms (t1, t2; t2 is null where all words are one) and t1's first place p1."""
    terms = windows.select("window", F.posexplode("words").alias("p", "term")).groupBy("window", "term").agg(F.min("p").alias("p")).join(counts, "term")
    ranked = terms.groupBy("window").agg(F.array_sort(F.collect_list(F.struct("n", "p", "term"))).alias("by"))  # at most n terms each
    two = ranked.select("window", F.col("by")[0]["term"].alias("t1"), F.col("by")[0]["p"].alias("p1"), F.get("by", F.lit(1))["term"].alias("t2"))
    return windows.join(two, "window")


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The positional index: (term, key, pos) for each place of a test term in a document."""
    tokens = tokens_of(docs, row_key(F.col("doc_id"), F.col("text")).alias("key"))
    return join_checked(tokens, terms, "term", "left_semi").select("term", "key", "pos")


def intersect(index: DataFrame, windows: DataFrame, reach: int, scratch: Scratch) -> DataFrame:
    """(key, pos, t1, t2): places of a window's rarest term from which the next rarest is less than `reach` words away.

    Lists are cut into stretches of `reach` places, so that they meet by an equi-join that no long document can skew.
    """
    pairs = scratch.stored(windows.select("t1", "t2").distinct(), "pairs", files=8)
    lead = join_checked(index.withColumnRenamed("term", "t1"), pairs, "t1")
    stretch = F.expr(f"pos div {reach}")
    near = lead.where("t2 is not null").withColumn("_s", F.explode(F.array(stretch - 1, stretch, stretch + 1)))
    seconds = scratch.stored(pairs.where("t2 is not null").select("t2").distinct(), "seconds", files=8)
    other = join_checked(index.withColumnRenamed("term", "t2"), seconds, "t2", "left_semi").withColumn("_s", stretch)
    met = near.join(other.withColumnRenamed("pos", "_pos"), ["t2", "key", "_s"]).where(F.abs(F.col("pos") - F.col("_pos")) < reach)
    return met.select("key", "pos", "t1", "t2").distinct().unionByName(lead.where("t2 is null").select("key", "pos", "t1", "t2"))


def matches(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, n: int = 10, slop: int = SLOP) -> DataFrame:
    """(key, start, len, items, exact, near), one row for each candidate: whether the window's words stand in a row from
    `start`, and whether all of them stand, in any order, within size + slop consecutive words around."""
    windows = scratch.stored(test_windows(benchmark, n), "windows", files=8)
    terms = scratch.stored(windows.select(F.explode("words").alias("term")).distinct(), "terms", files=8)
    counts = scratch.stored(term_counts(docs, terms), "counts", files=8)
    windows = scratch.stored(rarest(windows, counts), "rarest", files=8)
    leads = windows.select(F.explode(F.array("t1", "t2")).alias("term")).where("term is not null").distinct()
    index = scratch.stored(build_index(docs, scratch.stored(leads, "leads", files=8)), "postings")
    reach = n + slop
    found = intersect(index, windows, reach, scratch)
    windows = scratch.stored(windows.withColumn("id", F.monotonically_increasing_id()), "numbered", files=8)
    places = windows.select(F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "id")
    cands = join_checked(found, scratch.stored(places, "places", files=8), (found["t1"] == F.col("_t1")) & found["t2"].eqNullSafe(F.col("_t2")))
    by_doc = cands.groupBy("key").agg(F.collect_list(F.struct("pos", "id")).alias("c"))  # those of one text
    by_doc = scratch.stored(by_doc, "candidates")
    rows = docs.select("text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    rows = join_checked(rows, by_doc, "key").dropDuplicates(["key"]).select("key", words_of(F.col("text")).alias("w"), "c")
    rows = rows.select("key", "w", F.explode("c").alias("c")).select("key", "c.*", F.greatest(F.col("c.pos") - (reach - 1), F.lit(0)).alias("from"), "w")
    rows = rows.withColumn("w", F.slice("w", F.col("from") + 1, F.lit(2 * reach - 1)))
    rows = join_checked(rows, windows.select("id", "p1", "words", "items"), "id").withColumn("start", F.col("pos") - F.col("p1"))
    size = F.size("words")
    exact = (F.col("start") >= 0) & (F.slice("w", F.greatest(F.col("start") - F.col("from") + 1, F.lit(1)), size) == F.col("words"))
    spans = F.sequence(F.lit(0), F.greatest(F.size("w") - (size + slop), F.lit(0)))
    near = F.exists(spans, lambda s: F.size(F.array_except("words", F.slice("w", s + 1, size + slop))) == 0)
    return rows.select("key", "pos", "start", size.alias("len"), "items", exact.alias("exact"), near.alias("near"))


def phrase_matches(found: DataFrame) -> DataFrame:
    """(key, start, len, items): the exact phrases of `matches`."""
    return found.where("exact").select("key", "start", "len", "items").distinct()


def proximity_matches(docs: DataFrame, benchmark: DataFrame, n: int = 10, slop: int = SLOP) -> DataFrame:
    """(doc_id, item_id, pos): every word of a test window within its size + slop consecutive words around its rarest
    term's place. Order and repeats of the words do not matter. Same handling of nulls and repeats as `contamination`.
    """
    found = matches(docs, benchmark, Scratch(docs.sparkSession, "proximity"), n, slop)
    found = found.where("near").select("key", "pos", F.explode("items").alias("item_id")).distinct()
    keyed = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key")).distinct()
    return keyed.join(found, "key").select("doc_id", "item_id", "pos")


def _sorted_items(found: DataFrame, out: str) -> DataFrame:
    items = found.select("key", F.explode("items").alias("item_id")).distinct()
    return items.groupBy("key").agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias(out))  # at most the benchmark


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, carry: list[str] = ()) -> DataFrame:
    """Per document: words, words inside an occurrence of a test window, the items found, and those found nearby
    (all words of a window, in any order, with at most SLOP others among them).

    Nulls: a null or empty text has no words and is clean; a null item text, or one without words, matches
    nothing, and items with a null id are ignored. Repeated rows each get the same result; items with equal
    texts are all reported. Empty tables give an empty result, or clean documents. `carry` names columns of
    docs to return too; others are ignored.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    found = scratch.stored(matches(docs, benchmark, scratch, n).where("exact or near"), "matches")
    phrases = phrase_matches(found)
    # union of the intervals, without listing positions
    before = Window.partitionBy("key").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    places = phrases.select("key", "start", "len").distinct()
    new = end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0)))
    hits = places.withColumn("new", F.greatest(new, F.lit(0))).groupBy("key").agg(F.sum("new").alias("n_hit"))
    hit = hits.join(_sorted_items(phrases, "items"), "key").join(_sorted_items(found.where("near"), "near"), "key", "full")
    hit = scratch.stored(hit, "hits")
    scratch.keep(hit)
    rows = docs.select("doc_id", *carry, count_words(F.col("text")).alias("n_words"), row_key(F.col("doc_id"), F.col("text")).alias("key"))
    out = join_checked(rows, hit, "key", "left")
    none = F.array().cast("array<string>")
    return out.select(
        "doc_id",
        *carry,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("near", none).alias("near"),
    )
