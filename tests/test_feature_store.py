"""Bucketed feature tables, and how often the transactions are read."""

from __future__ import annotations

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.operators import interactions as inter
from tallyloom.operators import training as tr
from tallyloom.plans import features
from tallyloom.sources import retail
from tallyloom.sources.feature_store import write_bucketed


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_are_joined_bucket_by_bucket(spark):
    customers = spark.range(200).select(F.col("id").alias("customer_id"), (F.col("id") * 2).alias("age"))
    articles = spark.range(50).select(F.col("id").alias("article_id"), F.lit("x").alias("colour"))
    samples = spark.range(1000).select((F.col("id") % 200).alias("customer_id"), (F.col("id") % 50).alias("article_id"))
    tables = write_bucketed(customers, "c", "customer_id", buckets=4), write_bucketed(articles, "a", "article_id", buckets=4)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tr.attach_features(samples, *tables)
        text = plan(joined)
        assert text.count("SortMergeJoin") == 2 and text.count("Bucketed: true") == 2
        assert text.count("Exchange hashpartitioning(customer_id") == 1  # the samples alone
        assert text.count("Exchange hashpartitioning(article_id") == 1
        plain = tr.attach_features(samples, customers, articles)
        assert rows(joined, *joined.columns) == rows(plain.select(*joined.columns), *joined.columns)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    for table in tables:
        table.drop()


@pytest.mark.parametrize("keys", [[1, 2, 2], [1, None]])
def test_repeated_and_missing_keys_are_errors(spark, keys):
    with pytest.raises(ValueError, match="repeated or missing"):
        write_bucketed(spark.createDataFrame([(k, 1) for k in keys], "customer_id long, v int"), "c", "customer_id", buckets=2)


def test_transactions_are_read_once(spark, sf_dir, monkeypatch):
    """Preferences, favourites and history come from one stored pass over the transactions."""
    seen = []
    keep = inter.stored
    monkeypatch.setattr(inter, "stored", lambda df, label: seen.append((label, plan(df))) or keep(df, label))
    tx, articles = retail.transactions(spark, sf_dir), retail.articles(spark, sf_dir)
    for table in (inter.customer_preferences(tx, articles), features.customer_table(retail.customers(spark, sf_dir), tx, articles)):
        assert "lineitem.parquet" not in plan(table)
    inter.article_popularity(tx)
    assert [label for label, _ in seen] == ["pair-counts", "pair-counts", "popularity"]
    assert all(text.count("lineitem.parquet") == 1 for _, text in seen)


def test_best_articles_without_a_favourite_or_enough_matches(spark):
    articles = spark.createDataFrame([(i, f"d{i % 3}" if i < 9 else None) for i in range(12)], "article_id long, department_name string")
    tx = spark.createDataFrame([(i,) for i in range(11) for _ in range(i + 1)], "article_id long")
    preferences = spark.createDataFrame([(1, "d0"), (2, "Unknown"), (3, None)], "customer_id long, favorite_department string")
    got = rows(inter.best_articles(preferences, articles, tx, k=5).select("customer_id", "rank", "article_id", "department_affinity"), "customer_id", "rank")
    best = [10, 9, 8, 7, 6]
    assert got == [
        (1, 1, 6, 1.0), (1, 2, 3, 1.0), (1, 3, 0, 1.0), (1, 4, 10, 0.5), (1, 5, 9, 0.5),
        *((c, rank, article, 0.5) for c in (2, 3) for rank, article in enumerate(best, 1))]
