"""The corpus pipeline: language ID, near duplicates, repeated passages, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept; all but the last return
the columns of docs. Columns of docs travel as one struct, so that names never clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import decontaminate, jaccard, language_id, packing, suffix_dedup
from marketlens.llm.common import join_checked, remove, shared_dir, space, stored, written

#: Bytes of a repeated string; 50 words of the shortest kind are longer.
PASSAGE_BYTES = 200


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language (null text, or no letter); the model is fitted on labelled documents of docs.

    Nulls in other columns stay, documents without a lang are judged like others; repeated rows each get the same
    decision; a tie of two languages keeps the document. An empty table, or one without any label, keeps none.
    """
    train = docs.where(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(True)))
    found = language_id.predict(_rows(docs), language_id.fit(train), carry=["row"])
    return found.where("lang_pred != 'und'").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near copies (five-word shingles, similarity 0.8) the document with the smallest doc_id.

    Decisions are taken and applied by row, as ids may be repeated or null: of rows with the smallest id (a null is the
    largest) the one with the smallest hash of its text stays. Repeated rows count as copies. Documents without words
    stay, once. An empty table stays empty.
    """
    rows = stored(docs.select(F.monotonically_increasing_id().alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "rows")
    groups = jaccard.jaccard_components(rows.select(F.col("id").alias("doc_id"), F.col("row.text").alias("text")), n=5, num=80, den=100)
    groups = groups.select(F.col("doc_id").alias("id"), "component_id", (F.col("n_shingles") > 0).alias("words"))
    order = F.struct(F.col("row.doc_id").isNull().alias("no_id"), F.col("row.doc_id").alias("doc_id"), F.xxhash64("row.text").alias("hash"), F.col("id").alias("id"))
    best = groups.join(rows.select("id", order.alias("order")), "id").groupBy("component_id", "words").agg(F.min("order").alias("order"))
    kept = join_checked(rows, stored(best.select("order.id", "words"), "kept"), "id")
    blank = kept.where("not words").groupBy(F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text")).agg(F.first("row").alias("row"))
    return kept.where("words").select("row.*").unionByName(blank.select("row.*"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut strings of PASSAGE_BYTES bytes that occur elsewhere too; n_chars follows. Documents left empty go.

    Nulls: a null text is empty and goes unless nothing was cut, so it stays; repeated rows lose what they share, ids do
    not matter. An empty table stays empty.
    """
    found = suffix_dedup.remove_repeats(_rows(docs), PASSAGE_BYTES, carry=["row"], keep_text=True)
    found = found.where("n_removed = 0 or trim(kept_text) != ''")
    changed = F.col("n_removed") > 0
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text")}
    cols = [F.when(changed, new[c].cast(docs.schema[c].dataType)).otherwise(F.col(f"row.`{c}`")).alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return found.select(*cols)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten consecutive words of a benchmark item (all words of a shorter one).

    Nulls: a null or empty text is clean and stays, whatever its id; repeated rows each get the same decision. An empty
    table, or an empty benchmark, changes nothing.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(_rows(docs), benchmark, n=10, carry=["row"])
    return found.where("not contaminated").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2,048 ids.

    A null text is an empty document of one id; repeated rows are documents each. An empty table gives no sequence.
    """
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packed", packed),
]

#: Tokens, suffix arrays and fitted models are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents. A stage's own tables, and its input where that is a stage's, go when it is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        with space(spark, name):
            docs = written(stage(spark, docs, sf_dir), path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
