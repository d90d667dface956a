"""Assembled customer and article feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.expressions import missing
from tallyloom.functions.hashing import together
from tallyloom.operators import articles as art
from tallyloom.operators import customers as cust
from tallyloom.operators import interactions as inter
from tallyloom.operators import temporal as temp

# The feature catalogue, its typed lists and fill values.
FEATURE_GROUPS = {
    "customer_demographic": (
        "age", "age_group", "club_member_status", "fashion_news_active", "customer_lifecycle_stage",
    ),
    "customer_temporal": (
        "days_since_last_purchase", "purchase_frequency", "avg_days_between_purchases",
        "is_active_last_30_days", "seasonal_shopper",
    ),
    "customer_preference": (
        "favorite_department", "department_diversity", "favorite_color", "avg_purchase_price",
        "price_range",
    ),
    "article_product": (
        "department_name", "product_group_name", "is_menswear", "is_kidswear", "is_womenswear",
        "garment_type", "price_bin",
    ),
    "article_temporal": (
        "days_since_first_sale", "sales_velocity", "is_trending", "product_lifecycle_stage",
    ),
    "article_popularity": (
        "total_purchases", "unique_customers", "repurchase_rate", "popularity_score", "is_bestseller",
    ),
}
CUSTOMER_NUMERICAL = {
    "days_since_last_purchase": 365, "purchase_frequency": 0, "avg_purchase_price": 0.05,
    "total_transactions": 0,
}
ARTICLE_NUMERICAL = {
    "popularity_score": 0, "avg_selling_price": 0.05, "sales_velocity": 0,
    "days_since_first_sale": 365,
}


def customer_table(
    customers: DataFrame,
    transactions: DataFrame,
    articles: DataFrame,
    *,
    reference_date: str = temp.REFERENCE_DATE,
    sales: DataFrame | None = None,
) -> DataFrame:
    """Customer features, history and preferences; customers without purchases keep NULLs.

    The transactions are read once and stored as narrow rows, from which history, preferences and favourites are made;
    ``sales`` are those of ``transactions`` if they are stored already. ``article_id`` must be unique in ``articles``.
    """
    clock = temp.Clock(transactions, "t_dat", reference_date)
    known = F.col("customer_id").isNotNull()
    sales = inter.sale_rows(transactions.where(known), "t_dat") if sales is None else sales.where(known)
    grouped = together(sales.select("customer_id", "t_dat", "price"), "customer_id").groupBy("customer_id").agg(
        *temp.customer_aggregates(clock), *inter.preference_aggregates()
    )
    history = grouped.join(inter.favourites(sales, articles), "customer_id", "left").select(
        "customer_id", *temp.customer_columns(clock), *inter.preference_columns()
    )
    return cust.customer_features(customers).join(history, "customer_id", "left")


def article_table(
    articles: DataFrame,
    transactions: DataFrame,
    *,
    reference_date: str = temp.REFERENCE_DATE,
    prices: bool = False,
    sales: DataFrame | None = None,
) -> DataFrame:
    """Article features, sales trend and popularity; unsold articles keep NULLs.

    Trend and popularity share one aggregate by article, over the transactions or over their stored rows, ``sales``: there
    the distinct customers are counted for themselves, in rows of two columns. With ``prices`` the table also gets the
    selling-price spread (``price_std``, ``min_price``, ``max_price``) and price bin.
    """
    known = F.col("article_id").isNotNull()
    clock = temp.Clock(transactions, "t_dat", reference_date)
    trend = temp.article_aggregates(clock) if sales is None else temp.sales_aggregates(clock)
    popularity = [F.count("customer_id").alias("total_purchases")] + [
        F.avg("price").alias("avg_selling_price"),
        F.stddev_samp("price").alias("price_volatility"),
        F.min("t_dat").alias("first_purchase_date"),
        F.max("t_dat").alias("last_purchase_date"),
    ]
    extra = [F.min("price").alias("min_price"), F.max("price").alias("max_price")] if prices else []
    rows = transactions if sales is None else together(sales, "article_id")
    grouped = rows.where(known).groupBy("article_id").agg(*trend, *popularity, *extra)
    if sales is not None:
        pairs = sales.where(known & F.col("customer_id").isNotNull()).select("article_id", "customer_id").distinct()
        unique = pairs.groupBy("article_id").agg(F.count("*").alias("_unique"))
        grouped = grouped.join(unique, "article_id", "left").withColumn(
            "unique_customers", F.coalesce("_unique", F.lit(0))).drop("_unique")
    popular = inter.with_popularity(grouped)
    columns = [
        *temp.article_columns(clock),
        *[F.col(c) for c in (
            "total_purchases", "avg_selling_price", "price_volatility", "first_purchase_date",
            "last_purchase_date", "repurchase_rate", "popularity_score", "popularity_rank",
            "is_bestseller",
        )],
    ]
    if prices:
        columns += [
            F.col("price_volatility").alias("price_std"), F.col("min_price"), F.col("max_price"),
            art.price_range(F.col("avg_selling_price")).alias("price_range"),
        ]
    return art.article_features(articles).join(
        popular.select("article_id", *columns), "article_id", "left"
    )


def training_features(
    customers: DataFrame,
    articles: DataFrame,
    transactions: DataFrame,
    *,
    reference_date: str = temp.REFERENCE_DATE,
) -> tuple[DataFrame, DataFrame]:
    """(customer table, article table), made from the same stored rows: the transactions are read once."""
    some = F.col("customer_id").isNotNull() | F.col("article_id").isNotNull()
    sales = inter.sale_rows(transactions.where(some), "t_dat")
    return (
        customer_table(customers, transactions, articles, reference_date=reference_date, sales=sales),
        article_table(articles, transactions, reference_date=reference_date, sales=sales),
    )


def feature_catalogue() -> list[tuple[str, str]]:
    return [(group, name) for group, names in FEATURE_GROUPS.items() for name in names]


def feature_gap(df: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """Per catalogued feature of ``groups``: is it a column of ``df``, and its share of NULLs."""
    listed = [(group, name) for group, name in feature_catalogue() if group in groups]
    present = [name for _, name in listed if name in df.columns]
    rates = df.agg(
        *[F.avg(missing(df, name).cast("double")).alias(name) for name in dict.fromkeys(present)]
    )
    rows = [
        F.struct(
            F.lit(group).alias("feature_group"),
            F.lit(name).alias("feature"),
            F.lit(name in present).alias("produced"),
            (F.col(name) if name in present else F.lit(None).cast("double")).alias("null_rate"),
        )
        for group, name in listed
    ]
    return rates.select(F.inline(F.array(*rows)))


def fill_declared(df: DataFrame) -> DataFrame:
    """Declared fill values for the numerical features that ``df`` has."""
    fills = {**CUSTOMER_NUMERICAL, **ARTICLE_NUMERICAL}
    return df.fillna({name: value for name, value in fills.items() if name in df.columns})
