"""Recency, frequency, season and trend features, one hash aggregate per key.

Each feature set is a list of aggregates plus a projection over them, so the feature plans can add
them to other aggregates by the same key and shuffle the transactions once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.expressions import days_between, has_time

REFERENCE_DATE = "2020-09-22"  # fixed value: last day of the retail data


class Clock:
    """Day arithmetic against a reference date, for a date or timestamp column."""

    def __init__(self, df: DataFrame, date_col: str, reference_date: str):
        kind = df.schema[date_col].dataType.typeName()
        if kind not in ("date", "timestamp", "timestamp_ntz"):
            raise TypeError(f"{date_col} must be a date or a timestamp, not {kind}")
        self.timed = has_time(df, date_col)
        self.col = F.col(date_col)
        self.reference = F.lit(reference_date).cast(kind)

    def since(self, moment: Column) -> Column:
        return days_between(self.reference, moment, timestamps=self.timed)

    def span(self, first: Column, last: Column) -> Column:
        return days_between(last, first, timestamps=self.timed)

    def within(self, days: int) -> Column:
        """At most ``days`` before the reference; later than it also counts."""
        if self.timed:
            return self.col >= self.reference - F.expr(f"INTERVAL '{days}' DAY")
        return self.col >= F.date_sub(self.reference, days)


def customer_aggregates(clock: Clock, lookbacks: Sequence[int] = (30, 90)) -> list[Column]:
    """Twelve month counters instead of a mode: fixed-width buffers stay in the hash aggregate."""
    weekend = F.when(F.weekday(clock.col).isin(5, 6), 1.0).otherwise(0.0)
    return [
        F.min(clock.col).alias("_first"),
        F.max(clock.col).alias("_last"),
        F.count("*").alias("total_transactions"),
        F.avg(weekend).alias("weekend_purchase_ratio"),
        *[F.count_if(F.month(clock.col) == m).alias(f"_month_{m}") for m in range(1, 13)],
        *[F.count_if(clock.within(d)).alias(f"purchases_last_{d}_days") for d in lookbacks],
    ]


def customer_columns(clock: Clock, lookbacks: Sequence[int] = (30, 90)) -> list[Column]:
    first, last, rows = F.col("_first"), F.col("_last"), F.col("total_transactions")
    months = F.array(*[F.col(f"_month_{m}") for m in range(1, 13)])
    span = clock.span(first, last)
    return [
        clock.since(last).alias("days_since_last_purchase"),
        clock.since(first).alias("days_since_first_purchase"),
        span.alias("customer_lifespan_days"),
        rows,
        F.when(rows > 1, span / rows).otherwise(F.lit(0.0)).alias("avg_days_between_purchases"),
        F.array_position(months, F.array_max(months)).cast("int").alias("favorite_month"),
        F.col("weekend_purchase_ratio"),
        *[F.col(f"purchases_last_{d}_days") for d in lookbacks],
        (F.col(f"purchases_last_{max(lookbacks)}_days") > 0).alias("is_active_customer"),
    ]


def customer_temporal(
    transactions: DataFrame,
    *,
    reference_date: str = REFERENCE_DATE,
    customer_col: str = "customer_id",
    date_col: str = "t_dat",
    lookbacks: Sequence[int] = (30, 90),
) -> DataFrame:
    """One row per customer; rows without a customer are left out."""
    clock = Clock(transactions, date_col, reference_date)
    known = transactions.where(F.col(customer_col).isNotNull())
    grouped = known.groupBy(customer_col).agg(*customer_aggregates(clock, lookbacks))
    return grouped.select(customer_col, *customer_columns(clock, lookbacks))


def distinct_count(col: str, approximate: bool) -> Column:
    """Distinct values: exact in two shuffles (by key and value first, so a hot key is spread), or
    estimated in one with a fixed-size sketch per key."""
    return F.approx_count_distinct(col) if approximate else F.count_distinct(col)


def sales_aggregates(clock: Clock, lookbacks: Sequence[int] = (7, 30)) -> list[Column]:
    """First, last and number of sales, and those of the last days."""
    return [
        F.min(clock.col).alias("_first"),
        F.max(clock.col).alias("_last"),
        F.count("*").alias("total_sales"),
        *[F.count_if(clock.within(d)).alias(f"sales_last_{d}_days") for d in lookbacks],
    ]


def article_aggregates(
    clock: Clock, customer_col: str = "customer_id", lookbacks: Sequence[int] = (7, 30), *,
    approximate: bool = False,
) -> list[Column]:
    return [
        *sales_aggregates(clock, lookbacks),
        distinct_count(customer_col, approximate).alias("unique_customers"),
    ]


def article_columns(clock: Clock, lookbacks: Sequence[int] = (7, 30)) -> list[Column]:
    first, last = F.col("_first"), F.col("_last")
    shortest, longest = min(lookbacks), max(lookbacks)
    span = clock.span(first, last)
    per_day = F.col("total_sales") / (span + 1)
    return [
        clock.since(first).alias("days_since_first_sale"),
        clock.since(last).alias("days_since_last_sale"),
        span.alias("product_lifespan_days"),
        F.col("total_sales"),
        F.col("unique_customers"),
        per_day.alias("avg_sales_per_day"),
        *[F.col(f"sales_last_{d}_days") for d in lookbacks],
        (F.col(f"sales_last_{shortest}_days") > per_day * shortest).alias("is_trending"),
        (clock.since(first) <= longest).alias("is_new_product"),
    ]


def article_temporal(
    transactions: DataFrame,
    *,
    reference_date: str = REFERENCE_DATE,
    article_col: str = "article_id",
    customer_col: str = "customer_id",
    date_col: str = "t_dat",
    lookbacks: Sequence[int] = (7, 30),
    approximate: bool = False,
) -> DataFrame:
    """One row per article; rows without an article are left out.

    ``approximate`` estimates the distinct customers.
    """
    clock = Clock(transactions, date_col, reference_date)
    known = transactions.where(F.col(article_col).isNotNull())
    grouped = known.groupBy(article_col).agg(
        *article_aggregates(clock, customer_col, lookbacks, approximate=approximate)
    )
    return grouped.select(article_col, *article_columns(clock, lookbacks))
