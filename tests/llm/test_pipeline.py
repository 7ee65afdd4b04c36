"""The pipeline's stages against brute force, on the smallest table and planted cases."""

import sys

import pytest
from tests.conftest import ROOT, SF

sys.path.insert(0, ROOT)
import corpus_pipeline as pipeline  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from marketlens.llm.common import stored  # noqa: E402
from tests.llm.test_operators import brute_components, brute_repeats  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    passage = " ".join(f"planted{i}" for i in range(55))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    extra = [
        (10_000, "12345 !!", "en", "s", 8),
        (10_001, None, "en", "s", 0),
        (10_002, f"first text here {passage} and its own end", "en", "s", 1),
        (10_003, f"quite another beginning {passage} with other words", "en", "s", 1),
        (10_004, f"some clean words then {item} more", None, None, None),
        (10_005, "a clean and short document of its own", "en", "s", 1),
        (10_005, "a clean and short document of its own", "en", "s", 1),
    ]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    out = [("in", docs)]
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        out.append((name, docs))
    return dict(out)


def test_columns(stages):
    for name in ("language", "near_duplicates", "repeated_passages", "benchmark_leaks"):
        assert stages[name].dtypes == stages["in"].dtypes


def test_language(stages):
    gone = stages["in"].exceptAll(stages["language"])
    assert {r["doc_id"] for r in gone.collect()} == {10_000, 10_001}


def test_near_duplicates(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["language"].select("doc_id", "text").collect()]
    want = {d for d, _, c in brute_components(rows, 5, 80, 100) if d == c}
    got = [r["doc_id"] for r in stages["near_duplicates"].collect()]
    assert sorted(got) == sorted(want)


def test_repeated_passages(stages):
    rows = stages["near_duplicates"].collect()
    brute = {r["doc_id"]: w for r, w in zip(rows, brute_repeats([(r["text"] or "").encode() for r in rows], pipeline.PASSAGE_BYTES))}
    got = {r["doc_id"]: r for r in stages["repeated_passages"].collect()}
    for r in rows:
        n, removed, _, _ = brute[r["doc_id"]]
        if not removed:
            assert got[r["doc_id"]] == r
        elif r["doc_id"] in got:
            now = got[r["doc_id"]]
            assert removed <= n - len(now["text"].encode()) <= removed + 6 * brute[r["doc_id"]][2] and now["n_chars"] == len(now["text"])
        else:
            assert removed >= n - 20
    assert "planted30" not in got[10_002]["text"] and "planted30" not in got[10_003]["text"] and got[10_002]["text"].startswith("first text")


def test_leaks_and_packing(stages):
    kept = {r["doc_id"] for r in stages["benchmark_leaks"].collect()}
    assert 10_004 not in kept and 10_005 in kept
    tokens = stages["packed"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert {r["doc_id"] for r in tokens} == kept and all(r["n"] == r["m"] for r in tokens)
    fill = stages["packed"].groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert fill.where("n > 2048").count() == 0
