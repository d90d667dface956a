"""Customer features: age, club membership, fashion news, activity, lifecycle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.expressions import bin_label, flag
from tallyloom.functions.ordering import exact_quantiles, named_column

# Fixed values
AGE_EDGES = (0, 20, 25, 30, 35, 40, 45, 50, 55, 60, 65, 70, 100)
NEWS_SCORES = {"NONE": 0, "Monthly": 1, "Regularly": 2}


def edge_labels(edges: Sequence[float], fmt: str = "{}-{}") -> list[str]:
    return [fmt.format(low, high) for low, high in zip(edges, edges[1:])]


def age_group(age: Column, edges: Sequence[float] = AGE_EDGES) -> Column:
    """Right-closed age bins labelled ``low-high``; out of range or unknown is NULL."""
    return bin_label(age, edges, edge_labels(edges))


def median(df: DataFrame, col: str) -> Column:
    """The exact median of a column as a scalar (NULL if the column has no value)."""
    return exact_quantiles(named_column(df, col), ["column"], "value", [0.5], ["median"]).select(
        "median"
    ).scalar()


def news_score(frequency: Column) -> Column:
    """Ordinal score of the news frequency; unknown texts score 0."""
    out = None
    for text, score in NEWS_SCORES.items():
        hit = frequency == text
        out = F.when(hit, F.lit(score)) if out is None else out.when(hit, F.lit(score))
    return out.otherwise(F.lit(0))


def lifecycle_stage() -> Column:
    """First matching stage of a customer row that already has its flags."""
    member = F.col("is_club_member") == 1
    return (
        F.when(F.col("is_active") == 0, "inactive")
        .when(member & (F.col("fashion_news_score") >= 2), "loyal")
        .when(member, "engaged")
        .when(F.col("receives_fashion_news") == 1, "casual")
        .otherwise("new")
    )


def customer_features(
    customers: DataFrame,
    *,
    age_edges: Sequence[float] = AGE_EDGES,
    fill_age: float | None = None,
) -> DataFrame:
    """All customer features appended to the customer columns.

    Missing ages are filled with the exact median of the table, or with ``fill_age`` if given.
    """
    age = F.nanvl(F.col("age").cast("double"), F.lit(None).cast("double"))
    fill = median(customers, "age") if fill_age is None else F.lit(float(fill_age))
    truncated = {
        name: F.coalesce(F.nanvl(F.col(src).cast("double"), F.lit(0.0)), F.lit(0.0)).cast("int")
        for name, src in (("is_active", "Active"), ("has_FN", "FN"))
    }
    flagged = customers.select(
        "*",
        age_group(age, age_edges).alias("age_group"),
        F.coalesce(age, fill).alias("age_filled"),
        age.isNull().cast("int").alias("is_age_missing"),
        flag(F.col("club_member_status") == "ACTIVE").alias("is_club_member"),
        F.coalesce("club_member_status", F.lit("UNKNOWN")).alias("club_member_status_filled"),
        F.col("fashion_news_frequency").isNotNull().cast("int").alias("receives_fashion_news"),
        F.coalesce("fashion_news_frequency", F.lit("NONE")).alias("fashion_news_frequency_filled"),
        news_score(F.coalesce("fashion_news_frequency", F.lit("NONE"))).alias("fashion_news_score"),
        *[column.alias(name) for name, column in truncated.items()],
    )
    return flagged.withColumn("lifecycle_stage", lifecycle_stage())
