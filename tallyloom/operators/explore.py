"""Exploratory aggregates of the three retail tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import brackets
from tallyloom.functions.counts import items_within_share, multiplicities
from tallyloom.functions.expressions import bin_label, safe_ratio, text_columns
from tallyloom.functions.ordering import exact_quantiles, named_column, with_place
from tallyloom.operators.interactions import shared_keys
from tallyloom.operators.quality import missing_by_column, moments_of, ranked_values, text_counts
from tallyloom.session import stored

INF = float("inf")

# Fixed values
ACTIVITY_EDGES, ACTIVITY_LABELS = (0, 1, 5, 20, INF), ("One-time (1)", "Light (2-5)", "Regular (6-20)", "Heavy (20+)")
POPULARITY_EDGES, POPULARITY_LABELS = (0, 1, 10, 100, INF), ("Niche (1)", "Low (2-10)", "Medium (11-100)", "Popular (100+)")
PRICE_EDGES = (0, 10, 25, 50, 100, INF)
PRICE_LABELS = ("Budget (<$10)", "Low ($10-25)", "Mid ($25-50)", "High ($50-100)", "Premium ($100+)")
USER_SEGMENTS = ((20, "Heavy Users (20+)"), (5, "Regular Users (5-19)"), (2, "Occasional Users (2-4)"))
LAST_USER_SEGMENT = "One-time Users (1)"
CHANNELS = {1: "Store", 2: "Online"}
CUSTOMER_TIERS, ARTICLE_TIERS = (5.0, 20.0), (1.0, 10.0)
STRONG_CORRELATION = 0.3
KEY_OVERLAP = 0.9
MANY_TRANSACTIONS = 1_000_000


def percent(part: Column, whole: Column) -> Column:
    return safe_ratio(part, whole) * 100


def one_row(*parts: DataFrame) -> DataFrame:
    """One-row tables side by side, each read as a scalar struct."""
    spark = parts[0].sparkSession
    columns = []
    for i, part in enumerate(parts):
        columns.append(part.select(F.struct(*part.columns).alias("s")).scalar().alias(f"p{i}"))
    return spark.range(1).select(*columns).select(*[f"p{i}.*" for i in range(len(parts))])


# ---------------------------------------------------------------- any table


def overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, item, value): rows, columns, columns per type, missing values per column."""
    out = None
    for name, df in tables.items():
        by_column = missing_by_column(df)
        kinds: dict[str, int] = {}
        for field in df.schema.fields:
            kind = field.dataType.simpleString()
            kinds[kind] = kinds.get(kind, 0) + 1
        fixed = [("columns", len(df.columns)), *[(f"type {k}", n) for k, n in kinds.items()]]
        entries = [F.struct(F.lit(item).alias("item"), F.lit(n).cast("long").alias("value")) for item, n in fixed]
        sums = by_column.agg(F.max("total").alias("_rows"), F.sum("missing_count").alias("_missing"))
        whole = sums.select(
            F.inline(F.array(
                F.struct(F.lit("rows").alias("item"), F.col("_rows").alias("value")),
                F.struct(F.lit("missing").alias("item"), F.col("_missing").alias("value")),
                *entries,
            ))
        )
        holes = by_column.where(F.col("missing_count") > 0).select(
            F.concat(F.lit("missing "), F.col("column")).alias("item"), F.col("missing_count").alias("value")
        )
        part = whole.unionByName(holes).select(F.lit(name).alias("table_name"), "item", "value")
        out = part if out is None else out.unionByName(part)
    return out


def top_values(df: DataFrame, columns: Sequence[str], *, top: int | None = None) -> DataFrame:
    """Values per column by rank, with shares of all rows and of the known values; all of them, or the ``top`` first.

    ``more`` is the number of values beyond those listed.
    """
    counts = text_counts(df, columns)
    distinct = counts.groupBy("column").agg(F.count("*").alias("distinct"), F.sum("n").alias("valid"))
    holes = missing_by_column(df.select(*columns)).select("column", "total", "missing_count")
    size = holes.join(distinct, "column", "left").fillna(0, ["distinct", "valid"])
    if top is None:
        ranked = with_place(counts, ["column"], [F.desc("n"), F.col("value")], "rank")
        more = F.lit(0)
    else:
        ranked, more = ranked_values(counts, top), F.greatest(F.col("distinct") - top, F.lit(0))
    return size.join(ranked, "column", "left").select(
        "column", "distinct", "valid", F.col("missing_count").alias("missing"),
        percent(F.col("missing_count"), F.col("total")).alias("missing_pct"),
        "rank", "value", "n",
        percent(F.col("n"), F.col("total")).alias("pct_of_rows"),
        percent(F.col("n"), F.col("valid")).alias("pct_of_valid"),
        more.alias("more"),
    )


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, median, range, quartiles and missing share per numeric column."""
    found = brackets.bracketed(df, columns)
    quartiles = found.quantiles(brackets.QUARTILES, ["q1", "median", "q3"])
    holes = missing_by_column(df.select(*columns)).select("column", "total", "missing_count")
    return moments_of(found).join(quartiles, "column").join(F.broadcast(holes), "column").select(
        "column", F.col("count").alias("valid"), percent(F.col("missing_count"), F.col("total")).alias("missing_pct"),
        "mean", "median", "min", "max", "q1", "q3",
    )


def missing_tiers(df: DataFrame, tiers: tuple[float, float], *, skip: Sequence[str] = ()) -> DataFrame:
    """(column, missing_pct, tier): high, medium or low quality by two percentages."""
    good, fair = tiers
    pct = F.col("missing_rate") * 100
    return missing_by_column(df.drop(*skip)).select(
        "column", pct.alias("missing_pct"),
        F.when(pct < good, "high").when(pct < fair, "medium").otherwise("low").alias("tier"),
    )


def text_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Lengths (a missing text has length 0), known and distinct values per text column."""
    names = list(columns or text_columns(df))
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot([], names, "column", "value")
    # a digest and the length stand for the text, so whole texts are read but never shuffled
    counts = texts.where(F.col("value").isNotNull()).groupBy(
        "column", F.md5("value").alias("_digest"), F.length("value").alias("_size")
    ).agg(F.count("*").alias("n"))
    sums = counts.groupBy("column").agg(
        F.sum("n").alias("valid"), F.sum(F.col("n") * F.col("_size")).alias("_length"),
        F.max("_size").alias("max_length"), F.count("*").alias("unique_values"),
    )
    holes = missing_by_column(df.select(*names)).select("column", "total", "missing_count")
    return holes.join(sums, "column", "left").select(
        "column", F.col("missing_count").alias("missing"), percent(F.col("missing_count"), F.col("total")).alias("missing_pct"),
        F.coalesce("valid", F.lit(0)).alias("valid"),
        F.coalesce(safe_ratio(F.col("_length"), F.col("total")), F.lit(0.0)).alias("mean_length"),
        F.coalesce("max_length", F.lit(0)).alias("max_length"),
        F.coalesce("unique_values", F.lit(0)).alias("unique_values"),
    )


def segments(df: DataFrame, segment: Column, *extra: Column) -> DataFrame:
    """Rows and share of all rows per segment, with further aggregates; NULL segments are left out."""
    total = df.agg(F.count("*").alias("n")).scalar()
    grouped = df.withColumn("segment", segment).where(F.col("segment").isNotNull()).groupBy("segment").agg(
        F.count("*").alias("n"), *extra
    )
    return grouped.withColumn("pct", percent(F.col("n"), total))


# ---------------------------------------------------------------- transactions


def transaction_overview(transactions: DataFrame) -> DataFrame:
    """One row: transactions, unique customers and articles, first and last date.

    Distinct keys are counted from one small aggregate each, not by expanding the rows.
    """
    by_customer = transactions.groupBy("customer_id").agg(
        F.count("*").alias("n"), F.min("t_dat").alias("first"), F.max("t_dat").alias("last")
    )
    sums = by_customer.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("transactions"), F.count("customer_id").alias("unique_customers"),
        F.min("first").alias("first_date"), F.max("last").alias("last_date"),
    )
    articles = transactions.select("article_id").distinct().agg(F.count("article_id").alias("unique_articles"))
    return one_row(sums, articles)


def calendar(transactions: DataFrame) -> DataFrame:
    """Month, day of week (Monday 0), ISO week and year of each transaction."""
    return transactions.select(
        "*", F.month("t_dat").alias("month"), F.weekday("t_dat").alias("day_of_week"),
        F.weekofyear("t_dat").alias("week"), F.year("t_dat").alias("year"),
    )


def customer_activity(transactions: DataFrame, *, places: int = 2) -> DataFrame:
    """Purchases, spend, mean price and active days per customer; money rounded to ``places``."""
    known = transactions.where(F.col("customer_id").isNotNull())
    grouped = known.groupBy("customer_id").agg(
        F.count("article_id").alias("transaction_count"),
        F.round(F.sum("price"), places).alias("total_spent"),
        F.round(F.avg("price"), places).alias("avg_price"),
        F.min("t_dat").alias("first_purchase"),
        F.max("t_dat").alias("last_purchase"),
    )
    return grouped.withColumn("days_active", F.datediff("last_purchase", "first_purchase") + 1)


def article_sales(transactions: DataFrame, *, places: int = 2) -> DataFrame:
    """Purchases, mean price (rounded) and distinct customers per article."""
    known = transactions.where(F.col("article_id").isNotNull())
    return known.groupBy("article_id").agg(
        F.count("price").alias("purchase_count"),
        F.round(F.avg("price"), places).alias("avg_price"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def measure_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, median and maximum per numeric column."""
    # stored, as sketch and count read it: it is mostly an aggregate per key
    found = brackets.bracketed(stored(df.select(*columns), "measures"), columns, [0.5])
    medians = found.quantiles([0.5], ["median"])
    return moments_of(found).join(medians, "column").select("column", "mean", "median", "max")


def activity_segment() -> Column:
    return bin_label(F.col("transaction_count"), ACTIVITY_EDGES, ACTIVITY_LABELS, lowest=False)


def popularity_segment() -> Column:
    return bin_label(F.col("purchase_count"), POPULARITY_EDGES, POPULARITY_LABELS, lowest=False)


def price_segment(edges: Sequence[float] = PRICE_EDGES, labels: Sequence[str] = PRICE_LABELS) -> Column:
    return bin_label(F.col("price"), edges, labels, lowest=False)


def user_segment() -> Column:
    out = None
    for least, label in USER_SEGMENTS:
        hit = F.col("transaction_count") >= least
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(LAST_USER_SEGMENT)


def long_tail(sales: DataFrame) -> DataFrame:
    """One row: articles bought once, and their share of all sold articles."""
    once = F.count_if(F.col("purchase_count") == 1)
    return sales.agg(once.alias("single_purchase_articles"), percent(once, F.count("*")).alias("pct"))


def monthly_seasonality(transactions: DataFrame) -> DataFrame:
    """Transactions, revenue (rounded to 2) and share per calendar month."""
    by_month = transactions.groupBy(F.month("t_dat").alias("month")).agg(
        F.count("customer_id").alias("transactions"), F.round(F.sum("price"), 2).alias("total_revenue"),
        F.count("*").alias("_rows"),
    )
    total = transactions.agg(F.count("*").alias("n")).scalar()
    return by_month.withColumn("pct", percent(F.col("transactions"), total)).drop("_rows")


def peak_and_low_month(transactions: DataFrame) -> DataFrame:
    """One row: the months with most and fewest transactions, the earlier one on ties."""
    by_month = monthly_seasonality(transactions)
    n = F.col("transactions")
    return by_month.agg(
        F.min_by("month", F.struct(-n, F.col("month"))).alias("peak_month"),
        F.min_by("month", F.struct(n, F.col("month"))).alias("low_month"),
    )


def weekday_pattern(transactions: DataFrame) -> DataFrame:
    """Transactions and share per day of week (Monday 0)."""
    total = transactions.agg(F.count("*").alias("n")).scalar()
    grouped = transactions.groupBy(F.weekday("t_dat").alias("day_of_week")).agg(
        F.count("customer_id").alias("transactions")
    )
    return grouped.withColumn("pct", percent(F.col("transactions"), total))


def sales_concentration(sales: DataFrame, count_col: str = "purchase_count") -> DataFrame:
    """One row: how many best-selling articles make up at most 80 and 95 % of all sales."""
    return items_within_share(sales, count_col, [("articles_80pct", 4, 5), ("articles_95pct", 19, 20)])


def price_description(transactions: DataFrame) -> DataFrame:
    """One row: count, mean, std, min, quartiles and max of the price."""
    found = brackets.bracketed(transactions, ["price"])
    quartiles = found.quantiles(brackets.QUARTILES, ["q25", "median", "q75"])
    return moments_of(found).join(quartiles, "column").select("count", "mean", "std", "min", "q25", "median", "q75", "max")


def channel_statistics(transactions: DataFrame) -> DataFrame:
    """Transactions, revenue, mean price (rounded to 2), share and name per sales channel."""
    known = transactions.where(F.col("sales_channel_id").isNotNull())
    total = transactions.agg(F.count("*").alias("n")).scalar()
    name = F.concat(F.lit("Channel "), F.col("sales_channel_id").cast("string"))
    for number, label in CHANNELS.items():
        name = F.when(F.col("sales_channel_id") == number, label).otherwise(name)
    return known.groupBy("sales_channel_id").agg(
        F.count("customer_id").alias("transactions"), F.round(F.sum("price"), 2).alias("total_revenue"),
        F.round(F.avg("price"), 2).alias("avg_price"),
    ).select("*", percent(F.col("transactions"), total).alias("pct"), name.alias("channel"))


def sparsity(transactions: DataFrame) -> DataFrame:
    """One row: possible pairs, transactions, sparsity and density of the customer-article matrix."""
    possible = F.col("unique_customers").cast("double") * F.col("unique_articles")
    share = safe_ratio(F.col("transactions"), possible)
    return transaction_overview(transactions).select(
        possible.alias("possible_interactions"), F.col("transactions").alias("actual_interactions"),
        (1 - share).alias("sparsity"), (share * 100).alias("density_pct"),
    )


def readiness_checks(
    customers: DataFrame, articles: DataFrame, transactions: DataFrame, *,
    many: int = MANY_TRANSACTIONS, overlap: float = KEY_OVERLAP,
) -> DataFrame:
    """(check_name, value, passed): complete tables, volume, known customer keys, and the score.

    The number of shared article keys is reported as well, but is not part of the score.
    """
    parts = []
    for name, df in (("customers", customers), ("articles", articles), ("transactions", transactions)):
        holes = missing_by_column(df).agg(F.sum("missing_count").cast("double").alias("value"))
        parts.append(holes.select(F.lit(f"missing in {name}").alias("check_name"), "value", (F.col("value") == 0).alias("passed")))
    volume = transactions.agg(F.count("*").cast("double").alias("value"))
    parts.append(volume.select(F.lit("transaction volume").alias("check_name"), "value", (F.col("value") > many).alias("passed")))
    for key, side, scored in (("customer_id", customers, True), ("article_id", articles, False)):
        shared = shared_keys(transactions, side, key).agg(F.count("*").cast("double").alias("value"))
        bought = transactions.select(key).distinct().agg(F.count(key).alias("n")).scalar()
        passed = F.col("value") > bought * F.lit(overlap) if scored else F.lit(None).cast("boolean")
        parts.append(shared.select(F.lit(f"shared {key}").alias("check_name"), "value", passed.alias("passed")))
    checks = parts[0]
    for part in parts[1:]:
        checks = checks.unionByName(part)
    score = checks.agg(
        percent(F.count_if("passed"), F.count("passed")).alias("value")
    ).select(F.lit("score").alias("check_name"), "value", F.lit(None).cast("boolean").alias("passed"))
    return checks.unionByName(score)


# ---------------------------------------------------------------- relations


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation, NULL if a side is constant."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def strength(value: Column) -> Column:
    return (
        F.when(value < -STRONG_CORRELATION, "strong negative")
        .when(value > STRONG_CORRELATION, "strong positive")
        .otherwise("weak")
    )


def relation(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: correlation of two columns, its strength, and the least-squares line of y over x."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    both = df.where(xs.isNotNull() & ys.isNotNull())
    sums = both.agg(
        correlation(xs, ys).alias("correlation"),
        F.try_divide(F.covar_pop(xs, ys), F.var_pop(xs)).alias("slope"),
        F.avg(xs).alias("_x"), F.avg(ys).alias("_y"),
    )
    return sums.select(
        "correlation", strength(F.col("correlation")).alias("strength"), "slope",
        (F.col("_y") - F.col("slope") * F.col("_x")).alias("intercept"),
    )


def price_tolerance(transactions: DataFrame) -> DataFrame:
    """Per customer: purchases, rounded spend, and spend per purchase."""
    return customer_activity(transactions).select(
        "customer_id", "transaction_count", "total_spent",
        safe_ratio(F.col("total_spent"), F.col("transaction_count")).alias("avg_price"),
    )


def price_tolerance_summary(tolerance: DataFrame) -> DataFrame:
    """One row: mean, least and highest price per customer, and of heavy and one-time customers."""
    price, n = F.col("avg_price"), F.col("transaction_count")
    return tolerance.agg(
        F.avg(price).alias("mean_price"), F.min(price).alias("min_price"), F.max(price).alias("max_price"),
        F.avg(F.when(n >= USER_SEGMENTS[0][0], price)).alias("heavy_mean_price"),
        F.avg(F.when(n == 1, price)).alias("single_mean_price"),
    )


def sales_histogram(sales: DataFrame, *, bins: int = 40, count_col: str = "purchase_count") -> DataFrame:
    """(bin, bin_start, bin_end, articles, median_mark) of log10(sales + 1), equal-width bins.

    The last bin is closed; equal counts are merged first, so the bins see distinct counts only.
    """
    groups = multiplicities(sales, count_col).withColumn("x", F.log10(F.col("v").cast("double") + 1))
    edges = groups.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).select(
        F.struct(
            F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        ).alias("e")
    ).scalar()
    ranged = groups.withColumn("e", edges)
    width = F.col("e.hi") - F.col("e.lo")
    place = F.least(F.floor((F.col("x") - F.col("e.lo")) / width * bins), F.lit(bins - 1)).cast("int")
    filled = ranged.groupBy(place.alias("bin")).agg(F.sum("m").alias("articles"))
    median = exact_quantiles(named_column(sales, count_col), ["column"], "value", [0.5], ["q"]).select("q").scalar()
    all_bins = sales.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("e", edges)
    start = F.col("e.lo") + F.col("bin") * width / bins
    return all_bins.join(filled, "bin", "left").select(
        "bin", start.alias("bin_start"), (start + width / bins).alias("bin_end"),
        F.coalesce("articles", F.lit(0)).alias("articles"), F.log10(median + 1).alias("median_mark"),
    )


def summary(transactions: DataFrame) -> DataFrame:
    """One row of headline numbers: volume, sparsity, customer shares, catalogue concentration."""
    base = transaction_overview(transactions)
    per_customer = transactions.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count("article_id").alias("n"), F.sum("price").alias("_spent"), F.count("price").alias("_prices")
    )
    buyers = per_customer.agg(
        F.count("*").alias("_customers"),
        F.count_if(F.col("n") >= USER_SEGMENTS[0][0]).alias("heavy_users"),
        F.count_if(F.col("n") == 1).alias("one_time_users"),
        safe_ratio(F.sum("_spent"), F.sum("_prices")).alias("avg_price"),
    )
    sales = transactions.where(F.col("article_id").isNotNull()).groupBy("article_id").agg(
        F.count("customer_id").alias("purchase_count")
    )
    wide = one_row(base, buyers, sales_concentration(sales))
    possible = F.col("unique_customers").cast("double") * F.col("unique_articles")
    return wide.select(
        "transactions", "unique_customers", "unique_articles", "avg_price",
        ((1 - safe_ratio(F.col("transactions"), possible)) * 100).alias("sparsity_pct"),
        "heavy_users", percent(F.col("heavy_users"), F.col("_customers")).alias("heavy_pct"),
        "one_time_users", percent(F.col("one_time_users"), F.col("_customers")).alias("one_time_pct"),
        safe_ratio(F.col("transactions"), F.col("unique_customers")).alias("transactions_per_customer"),
        "articles_80pct", percent(F.col("articles_80pct"), F.col("unique_articles")).alias("pct_80"),
        "articles_95pct", percent(F.col("articles_95pct"), F.col("unique_articles")).alias("pct_95"),
    )
