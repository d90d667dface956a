"""Customer and article tables: what a task holds, and that customers with very many rows give the same."""

from __future__ import annotations

import re

import pytest
from frames import rows

from tallyloom.operators import interactions as inter
from tallyloom.plans import features
from tallyloom.sources import retail


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, sf_dir):
    return retail.customers(spark, sf_dir), retail.transactions(spark, sf_dir), retail.articles(spark, sf_dir)


def test_no_aggregate_by_customer_and_article(tables, monkeypatch):
    """Pairs are nearly as many as rows: an aggregate by pair holds the rows of its task, each with all counters."""
    customers, tx, articles = tables
    seen, keep = [], inter.stored
    monkeypatch.setattr(inter, "stored", lambda df, label: seen.append((label, plan(df))) or keep(df, label))
    features.customer_table(customers, tx, articles)
    inter.customer_preferences(tx, articles)
    features.training_features(customers, articles, tx)
    assert [text for label, text in seen if label == "pair-counts" and "Aggregate" in text] == []


def test_values_are_counted_where_a_customer_s_rows_meet(tables, monkeypatch):
    """Partitions follow the rows, and counts by (customer, attribute, value) are not gathered by bytes again."""
    customers, tx, articles = tables
    monkeypatch.setattr(inter, "TASK_ROWS", 500)
    for table in (features.customer_table(customers, tx, articles), inter.customer_preferences(tx, articles)):
        text = plan(table)
        n = tx.count() // 500 + 1
        assert re.search(rf"Exchange hashpartitioning\(customer_id#\d+L, {n}\), REPARTITION_BY_NUM", text)
        assert not re.search(r"Exchange hashpartitioning\(customer_id#\d+L, attribute", text)
        assert len(re.findall(r"REBALANCE_PARTITIONS_BY_COL", text)) == 1  # history and prices


def test_customers_of_crowded_slots_give_the_same(tables, monkeypatch):
    customers, tx, articles = tables
    busy = tx.unionByName(tx.where("customer_id % 5 = 0"))
    plain = rows(inter.customer_preferences(busy, articles), "customer_id")
    per_customer = sorted(r["count"] for r in busy.groupBy("customer_id").count().collect())
    for most in (0, per_customer[len(per_customer) // 2]):  # all slots, and about half of them
        monkeypatch.setattr(inter, "CROWDED_ROWS", most)
        spread = inter.customer_preferences(busy, articles)
        assert re.search(r"Exchange hashpartitioning\(customer_id#\d+L, attribute", plan(spread))  # collapsed before they meet
        assert rows(spread, "customer_id") == plain
