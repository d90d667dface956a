"""Registered queries: features from a state of all days but the last, into which the last day is merged."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.plans import feature_queries as f
from tallyloom.plans.registry import query
from tallyloom.session import scratch_path
from tallyloom.sources import retail
from tallyloom.streaming import daily


def _state(spark: SparkSession, sf_dir: str, key: str, other: str) -> daily.State:
    """Two merges: the history, then the last day. The transactions are a join, so they are stored first."""
    transactions = daily.by_key(retail.transactions(spark, sf_dir).select("customer_id", "article_id", "t_dat", "price"), key)
    last = transactions.agg(F.max("t_dat")).first()[0]
    state = daily.open_state(spark, scratch_path(spark, "daily-state"), transactions, key=key, other=other)
    state = daily.merge(state, transactions.where(F.col("t_dat") < F.lit(last)), other=other)
    return daily.merge(state, transactions.where(F.col("t_dat") == F.lit(last)), other=other)


@query("t0_incremental_customers", f"{f.CUSTOMER_TEMPORAL_SQL} SELECT * FROM customer_temporal", doubles=f.CT_DOUBLES)
def customers(spark, sf_dir) -> DataFrame:
    return daily.customer_temporal(_state(spark, sf_dir, "customer_id", "article_id"), reference_date=retail.REFERENCE_DATE)


@query("t8_incremental_articles", f"{f.ARTICLE_TEMPORAL_SQL} SELECT * FROM article_temporal", doubles=("avg_sales_per_day",))
def articles(spark, sf_dir) -> DataFrame:
    return daily.article_temporal(_state(spark, sf_dir, "article_id", "customer_id"), reference_date=retail.REFERENCE_DATE)


@query("i6_incremental_popularity", f"{f.POPULARITY_SQL} SELECT * FROM article_popularity", doubles=f.POPULARITY_DOUBLES)
def popularity(spark, sf_dir) -> DataFrame:
    return daily.article_popularity(_state(spark, sf_dir, "article_id", "customer_id"))


_END = datetime.date.fromisoformat(retail.REFERENCE_DATE)
_WINDOWS = {f"purchases_last_{d}_days": (_END - datetime.timedelta(days=d), None) for d in (7, 30, 90, 365)} | {
    "purchases_year_before": (_END - datetime.timedelta(days=730), _END - datetime.timedelta(days=365))}


@query("t2_incremental_windows", "SELECT customer_id, count(*) AS total_transactions, " + ", ".join(
    f"count(*) FILTER (t_dat >= DATE '{a}'" + (f" AND t_dat < DATE '{b}'" if b else "") + f") AS {name}"
    for name, (a, b) in _WINDOWS.items()) + " FROM tx GROUP BY customer_id")
def windows(spark, sf_dir) -> DataFrame:
    state = _state(spark, sf_dir, "customer_id", "article_id")
    return daily.with_windows(state, state.totals().select("customer_id", "n"), _WINDOWS).withColumnRenamed("n", "total_transactions")
