"""Queries do the whole job on tables that are larger or more skewed than the given ones."""

import duckdb

from marketlens.plans import registry


def test_feed_items_of_a_large_source(spark, tmp_path):
    rows = spark.range(15_000).selectExpr("id AS doc_id", "'text' AS text", "'en' AS lang", "if(id < 14900, 'hot', 'cold') AS source", "4L AS n_chars")
    rows.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(con.execute(registry.oracles()["s14_feed_items"]).fetchall())
    df = registry.queries()["s14_feed_items"](spark, str(tmp_path))
    assert sorted((r["source"], r["url"]) for r in df.collect()) == want and len(want) == 8
