"""Every operator and stage on one text of over five million characters, among short ones, and on odd tables."""

import base64
import hashlib
import random
import sys
import zlib

import pytest
from pyspark.sql import functions as F
from tests.conftest import ROOT, SF

sys.path.insert(0, ROOT)
import corpus_pipeline as pipeline  # noqa: E402

from marketlens.llm import decontaminate, jaccard, language_id, packing, sharding, suffix_dedup, token_counts, topk, url_filter, warc  # noqa: E402

#: Names that operators use for columns of their own.
CLASHING = ["row", "id", "key", "cls", "_w", "order", "words", "term", "pos", "region", "_rank", "length", "_text", "spans", "component_id", "lang_pred", "n_words", "sequence_id"]


@pytest.fixture(scope="module")
def long_text():
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdefgé ilmnorstu").strip() or "a" for _ in range(rng.randint(2, 9))) for _ in range(60_000)]
    return " ".join(rng.choice(vocab) for _ in range(1_000_000))


@pytest.fixture(scope="module")
def docs(spark, long_text):
    assert len(long_text) > 5_000_000
    rows = [(1, long_text, "en", "s", len(long_text)), (2, "the quick brown fox jumps over the lazy dog and runs away", "en", None, 1), (2, "the quick brown fox jumps over the lazy dog and runs away", "en", None, 1), (3, long_text[: len(long_text) // 2], None, "s", 1), (None, None, None, None, None), (5, "", "fr", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)]).repartition(3)


def test_tokens(docs, long_text):
    import public_tokenizers
    from tokenizers import Tokenizer

    n = len(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(long_text, add_special_tokens=False).ids)
    assert token_counts.token_counts(docs).agg(F.max("length")).first()[0] == n
    got = packing.pack(docs)
    assert got.where("doc_id = 1").agg(F.sum("length")).first()[0] == n + 1
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


def test_language(docs, spark):
    model = language_id.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    got = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    assert got[1]["lang_pred"] in model and 0 <= got[1]["score"] <= 1 and got[None]["lang_pred"] == got[5]["lang_pred"] == "und"


def test_jaccard(docs, long_text):
    got = {r["doc_id"]: r for r in jaccard.jaccard_components(docs, 4, 85, 100).collect()}
    words = long_text.encode().lower().split()
    assert got[1]["n_shingles"] == len({tuple(words[i : i + 4]) for i in range(len(words) - 3)})
    assert got[1]["component_id"] == 1 and got[3]["component_id"] == 3 and got[2]["component_id"] == 2 and got[None]["component_id"] is None


def test_repeats(docs, long_text):
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs).collect()}
    n, half = len(long_text.encode()), len(long_text[: len(long_text) // 2].encode())
    assert got[1]["n_bytes"] == n and got[1]["n_removed"] == half and got[3]["n_removed"] == half and got[1]["n_spans"] == 1
    assert got[1]["kept_sha256"] == hashlib.sha256(long_text.encode()[half:]).hexdigest() and got[5]["n_removed"] == 0


def test_shards_and_urls(docs, long_text, spark):
    got = {r["doc_id"]: r for r in sharding.shard_documents(docs).collect()}
    assert got[1]["size"] == len(long_text.encode()) + 1 and got[1]["text_crc32"] == zlib.crc32(long_text.encode())
    rules = spark.createDataFrame([("com", "/en/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/en/" + long_text), (2, "http://" + "x" * 5_000_000 + ".com/en/")], "page_id long, url string")
    assert {r["verdict"] for r in url_filter.judge_urls(pages, rules).collect()} == {"block"}


def test_archives(docs, long_text, tmp_path):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a.b/WARC/1.c").alias("url"), F.concat(F.col("text"), F.lit("WARC/1.0\r\n\r\n")).alias("html"), *CLASHING)
    got = {r["page_id"]: r for r in warc.round_trip(pages, str(tmp_path / "w")).select("page_id", "payload_bytes", "payload_digest").collect()}
    data = (long_text + "WARC/1.0\r\n\r\n").encode()
    assert got[1]["payload_bytes"] == len(data) and got[1]["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_leaks(docs, long_text, spark):
    words = long_text.split()
    items = spark.createDataFrame([("a", " ".join(words[700_000:700_012])), ("b", "quick brown fox jumps over the lazy dog and runs"), ("c", "not to be found here at all by anyone looking for it")], "item_id string, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs, items).collect()}
    assert got[1]["items"] == ["a"] and got[1]["n_hit"] == 12 and got[2]["items"] == ["b"] and not got[3]["contaminated"] and got[5]["n_words"] == 0


def test_stages(docs, spark):
    out = docs
    for name, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, out, SF)
        assert kept.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        rows = kept.collect()
        out = spark.createDataFrame(rows, docs.schema)
    left = sorted((r["doc_id"] is None, r["doc_id"]) for r in rows)
    assert left in ([(False, 1), (False, 2)], [(False, 1), (False, 2), (False, 3)])
    assert pipeline.packed(spark, docs.limit(0), SF).count() == 0 and topk.exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0
