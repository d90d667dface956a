"""Physical plans: what must not appear at scale, and what must."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import interactions as inter
from tallyloom.operators import metrics as m
from tallyloom.operators import temporal as temp
from tallyloom.operators import training as tr
from tallyloom.sources import retail

def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_customer_history_shuffles_once_after_the_scan(spark, sf_dir):
    tx = retail.transactions(spark, sf_dir).select("customer_id", "t_dat")
    text = plan(temp.customer_temporal(tx, reference_date="2001-08-01"))
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id", text)) <= 1
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    text = plan(inter.article_popularity(retail.transactions(spark, sf_dir)))
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schema and all("l_tax" not in s and "l_quantity" not in s for s in schema)


def test_date_filter_reaches_the_scan(spark, sf_dir, tmp_path):
    from tallyloom.sources.readers import load_transactions

    path = str(tmp_path / "tx")
    retail.transactions(spark, sf_dir).select("t_dat", "price").write.parquet(path)
    text = plan(load_transactions(spark, path, fmt="parquet", date_range=("1996-01-01", "1996-02-01")))
    assert "GreaterThanOrEqual(t_dat,1996-01-01)" in text


@pytest.mark.parametrize("build", [
    lambda tx: tr.last_interactions(tx),
    lambda tx: m.top_k(tx.select(F.col("customer_id").alias("query_id"), F.col("article_id").alias("item_id"),
                                 F.col("price").alias("score")), 10),
])
def test_ranks_are_limited_before_the_shuffle(spark, sf_dir, build):
    text = plan(build(retail.transactions(spark, sf_dir)))
    assert "WindowGroupLimit" in text and "Partial" in text
