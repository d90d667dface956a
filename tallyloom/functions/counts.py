"""Statistics of sorted counts, computed from (count value, multiplicity).

The distinct values of a positive integer count that sums to N over a table number at most
sqrt(2 N): 2 million for 2 * 10^12 rows. So the running sums below may use one ordered window over
the distinct values, and no item is ever sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def multiplicities(counts: DataFrame, count_col: str) -> DataFrame:
    """(v, m): how many items have count v."""
    return counts.groupBy(F.col(count_col).cast("long").alias("v")).agg(F.count("*").alias("m"))


def items_within_share(
    counts: DataFrame, count_col: str, shares: Sequence[tuple[str, int, int]]
) -> DataFrame:
    """One row: the number of largest items whose cumulative count is <= share of the total.

    ``shares`` holds (output name, numerator, denominator); comparisons are made in integers. Of m
    items with equal count v after a running sum S, ``floor((share * T - S) / v)`` still fit.
    """
    groups = multiplicities(counts, count_col).where(F.col("v") > 0)
    before = Window.orderBy(F.col("v").desc()).rowsBetween(Window.unboundedPreceding, -1)
    running = groups.select(
        "v",
        "m",
        F.coalesce(F.sum(F.col("v") * F.col("m")).over(before), F.lit(0)).alias("s"),
        F.sum(F.col("v") * F.col("m")).over(Window.partitionBy()).alias("t"),
    )
    columns = []
    for name, num, den in shares:
        room = F.floor(
            (F.lit(num).cast("decimal(3,0)") * F.col("t") - F.lit(den).cast("decimal(3,0)") * F.col("s"))
            / (F.lit(den).cast("decimal(3,0)") * F.col("v"))
        ).cast("long")
        fit = F.least(F.greatest(room, F.lit(0)), F.col("m"))
        columns.append(F.coalesce(F.sum(fit), F.lit(0)).cast("long").alias(name))
    return running.agg(*columns)


def gini_of_counts(counts: DataFrame, count_col: str, out: str = "gini") -> DataFrame:
    """One row: Gini coefficient over all items of ``counts`` (zero counts included), 0 if empty.

    (n + 1 - 2 * sum(cumulative sums) / total) / n, where m equal counts v at ascending offset r
    contribute v * (m (n - r) - m (m - 1) / 2) to the sum of cumulative sums.
    """
    groups = multiplicities(counts, count_col)
    before = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.select(
        F.col("v").cast("double").alias("v"),
        F.col("m").cast("double").alias("m"),
        F.coalesce(F.sum("m").over(before), F.lit(0)).cast("double").alias("r"),
        F.sum("m").over(Window.partitionBy()).cast("double").alias("n"),
    )
    v, m, r, n = (F.col(c) for c in "vmrn")
    sums = placed.agg(
        F.max(n).alias("n"),
        F.sum(v * m).alias("total"),
        F.sum(v * (m * (n - r) - m * (m - 1) / 2)).alias("area"),
    )
    value = F.when(
        F.col("total") > 0, (F.col("n") + 1 - 2 * F.col("area") / F.col("total")) / F.col("n")
    ).otherwise(F.lit(0.0))
    return sums.select(value.alias(out))
