"""Registered queries: exploratory aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from tallyloom.functions import frequent
from tallyloom.operators import explore as x
from tallyloom.plans.quality_queries import CUSTOMER_COLUMNS, long_sql, missing_sql
from tallyloom.plans.registry import query
from tallyloom.sources import retail

CUSTOMER_TEXTS = ("club_member_status", "fashion_news_frequency", "postal_code")
CUSTOMER_NUMBERS = ("FN", "Active", "age")
ARTICLE_FILE = tuple(c for c in retail.ARTICLE_COLUMNS if c not in ("size_no", "list_price"))
HIERARCHY = ("product_group_name", "product_type_name", "department_name", "section_name", "garment_group_name")
VISUALS = ("colour_group_name", "graphical_appearance_name")
TX_FILE = ("t_dat", "customer_id", "article_id", "price", "sales_channel_id")
INF = x.INF


def _tx(spark, sf_dir):
    return retail.transactions(spark, sf_dir).select(*TX_FILE)


# ---------------------------------------------------------------- tables and columns


def _overview_sql() -> str:
    fixed = {
        "customers": (("columns", 7), ("type bigint", 1), ("type double", 3), ("type string", 3)),
        "articles": (("columns", 11), ("type bigint", 1), ("type string", 10)),
        "transactions": (("columns", 5), ("type date", 1), ("type bigint", 2), ("type double", 1), ("type int", 1)),
    }
    sides = {"customers": ("customers", CUSTOMER_COLUMNS), "articles": ("articles", ARTICLE_FILE),
             "transactions": ("tx", TX_FILE)}
    parts = []
    for name, (table, columns) in sides.items():
        holes = missing_sql(table, columns)
        parts += [f"SELECT '{name}' AS table_name, '{item}' AS item, {n} AS value" for item, n in fixed[name]]
        parts.append(f"SELECT '{name}', 'rows', (SELECT count(*) FROM {table})")
        parts.append(f"SELECT '{name}', 'missing', CAST(sum(missing_count) AS BIGINT) FROM ({holes})")
        parts.append(f"SELECT '{name}', 'missing ' || \"column\", missing_count FROM ({holes}) WHERE missing_count > 0")
    return "\nUNION ALL ".join(parts)


@query("n1_overview", _overview_sql())
def n1(spark, sf_dir):
    return x.overview({
        "customers": retail.customers(spark, sf_dir),
        "articles": retail.articles(spark, sf_dir).select(*ARTICLE_FILE),
        "transactions": _tx(spark, sf_dir),
    })


def _top_sql(table: str, columns: Sequence[str], top: int | None = None) -> str:
    """All values by rank, or the ``top`` first."""
    shown = f"WHERE rank <= {top}" if top else ""
    more = f"greatest(distinct_n - {top}, 0)" if top else "0"
    return f"""
, long AS ({long_sql(table, columns, 'VARCHAR')})
, counts AS (SELECT "column", value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL)
, ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM counts)
, d AS (SELECT "column", count(DISTINCT value) AS distinct_n, count(value) AS valid, count(*) AS total FROM long GROUP BY "column")
SELECT "column", distinct_n AS "distinct", valid, total - valid AS missing, (total - valid) * 100.0 / total AS missing_pct, rank,
  value, n, n * 100.0 / total AS pct_of_rows, n * 100.0 / valid AS pct_of_valid, {more} AS more
FROM d JOIN ranked USING ("column") {shown}"""


TOP_DOUBLES = ("missing_pct", "pct_of_rows", "pct_of_valid")


@query("n2_categorical_summary", _top_sql("customers", CUSTOMER_TEXTS, 3), doubles=TOP_DOUBLES)
def n2(spark, sf_dir):
    return x.top_values(retail.customers(spark, sf_dir), CUSTOMER_TEXTS, top=3)


LINE_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")


@query("n2_frequent_keys", f"""
WITH long AS ({long_sql('lineitem', LINE_KEYS, 'VARCHAR')})
, counts AS (SELECT "column", value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL)
SELECT "column", row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank, value, n FROM counts
QUALIFY rank <= 10""", views=False)
def n2_keys(spark, sf_dir):
    lines = retail.table(spark, sf_dir, "lineitem")
    return frequent.frequent_values(_as_text(lines, LINE_KEYS), LINE_KEYS, 10)


def _as_text(df, columns):
    """Dates, times and numbers in the text form of the SQL they are compared with."""
    kinds = dict(df.dtypes)
    text = {"timestamp": "yyyy-MM-dd HH:mm:ss", "timestamp_ntz": "yyyy-MM-dd HH:mm:ss"}
    return df.select(*(F.date_format(c, text[kinds[c]]).alias(c) if kinds[c] in text else F.col(c).cast("string").alias(c) for c in columns))


@query("n3_numeric_summary", f"""
, long AS ({long_sql('customers', CUSTOMER_NUMBERS)})
SELECT "column", count(value) AS valid, (count(*) - count(value)) * 100.0 / count(*) AS missing_pct, avg(value) AS mean,
  median(value) AS median, min(value) AS min, max(value) AS max, quantile_cont(value, 0.25) AS q1,
  quantile_cont(value, 0.75) AS q3 FROM long GROUP BY "column" """,
       doubles=("missing_pct", "mean", "median", "min", "max", "q1", "q3"))
def n3(spark, sf_dir):
    return x.numeric_summary(retail.customers(spark, sf_dir), CUSTOMER_NUMBERS)


def _tier_sql(name: str, table: str, columns: Sequence[str], good: float, fair: float) -> str:
    return f"""SELECT '{name}' AS table_name, "column", missing_rate * 100 AS missing_pct, CASE WHEN missing_rate * 100 < {good}
  THEN 'high' WHEN missing_rate * 100 < {fair} THEN 'medium' ELSE 'low' END AS tier FROM ({missing_sql(table, columns)})"""


@query("n4_missing_tiers", _tier_sql("customers", "customers", CUSTOMER_COLUMNS[1:], 5, 20) + "\nUNION ALL "
       + _tier_sql("articles", "articles", ARTICLE_FILE[1:], 1, 10), doubles=("missing_pct",))
def n4(spark, sf_dir):
    sides = (
        ("customers", retail.customers(spark, sf_dir), x.CUSTOMER_TIERS, "customer_id"),
        ("articles", retail.articles(spark, sf_dir).select(*ARTICLE_FILE), x.ARTICLE_TIERS, "article_id"),
    )
    parts = [
        x.missing_tiers(df, tiers, skip=[key]).select(F.lit(name).alias("table_name"), "*")
        for name, df, tiers, key in sides
    ]
    return parts[0].unionByName(parts[1])


@query("n5_hierarchy_profile", _top_sql("articles", HIERARCHY), doubles=TOP_DOUBLES)
def n5(spark, sf_dir):
    return x.top_values(retail.articles(spark, sf_dir), HIERARCHY)


@query("n6_visual_profile", _top_sql("articles", VISUALS), doubles=TOP_DOUBLES)
def n6(spark, sf_dir):
    return x.top_values(retail.articles(spark, sf_dir), VISUALS)


TEXTS = ("prod_name", "product_type_name", "detail_desc")


def _text_sql(table: str, columns: Sequence[str]) -> str:
    return f"""
, long AS ({long_sql(table, columns, 'VARCHAR')})
SELECT "column", count(*) - count(value) AS missing, (count(*) - count(value)) * 100.0 / count(*) AS missing_pct,
  count(value) AS valid, avg(length(coalesce(value, ''))) AS mean_length, max(length(coalesce(value, ''))) AS max_length,
  count(DISTINCT value) AS unique_values FROM long GROUP BY "column" """


@query("n7_text_profile", _text_sql("articles", TEXTS), doubles=("missing_pct", "mean_length"))
def n7(spark, sf_dir):
    return x.text_profile(retail.articles(spark, sf_dir), TEXTS)


@query("n7_document_text_profile", _text_sql("documents", ("text", "lang", "source")),
       doubles=("missing_pct", "mean_length"))
def n7_documents(spark, sf_dir):
    return x.text_profile(retail.table(spark, sf_dir, "documents"), ("text", "lang", "source"))


# ---------------------------------------------------------------- transactions


@query("n8_transaction_overview", """
SELECT count(*) AS transactions, count(DISTINCT customer_id) AS unique_customers, count(DISTINCT article_id) AS unique_articles,
  min(t_dat) AS first_date, max(t_dat) AS last_date FROM tx""")
def n8(spark, sf_dir):
    return x.transaction_overview(_tx(spark, sf_dir))


@query("n9_calendar", """
SELECT t_dat, customer_id, article_id, month(t_dat) AS month, isodow(t_dat) - 1 AS day_of_week, week(t_dat) AS week,
  year(t_dat) AS year FROM tx""")
def n9(spark, sf_dir):
    return x.calendar(_tx(spark, sf_dir)).drop("price", "sales_channel_id")


ACTIVITY_SQL = """
, activity AS (SELECT customer_id, count(article_id) AS transaction_count, round(sum(price), 2) AS total_spent,
  round(avg(price), 2) AS avg_price, min(t_dat) AS first_purchase, max(t_dat) AS last_purchase,
  max(t_dat) - min(t_dat) + 1 AS days_active FROM tx GROUP BY customer_id)
"""
SALES_SQL = """
, sales AS (SELECT article_id, count(price) AS purchase_count, round(avg(price), 2) AS avg_price,
  count(DISTINCT customer_id) AS unique_customers FROM tx GROUP BY article_id)
"""


def activity(spark, sf_dir):
    return x.customer_activity(_tx(spark, sf_dir))


def sales(spark, sf_dir):
    return x.article_sales(_tx(spark, sf_dir))


query("n10_customer_activity", f"{ACTIVITY_SQL} SELECT * FROM activity", doubles=("total_spent", "avg_price"))(activity)


def _measure_sql(table: str, columns: Sequence[str]) -> str:
    return f"""
, long AS ({long_sql(table, columns)})
SELECT "column", avg(value) AS mean, median(value) AS median, max(value) AS max FROM long GROUP BY "column" """


@query("n11_activity_summary", ACTIVITY_SQL + _measure_sql("activity", ("transaction_count", "total_spent", "avg_price")),
       doubles=("mean", "median", "max"))
def n11(spark, sf_dir):
    return x.measure_summary(activity(spark, sf_dir), ("transaction_count", "total_spent", "avg_price"))


@query("n12_activity_segments", f"""{ACTIVITY_SQL}
SELECT CASE WHEN transaction_count <= 1 THEN 'One-time (1)' WHEN transaction_count <= 5 THEN 'Light (2-5)'
    WHEN transaction_count <= 20 THEN 'Regular (6-20)' ELSE 'Heavy (20+)' END AS segment,
  count(*) AS n, avg(total_spent) AS avg_spent, count(*) * 100.0 / (SELECT count(*) FROM activity) AS pct
FROM activity WHERE transaction_count > 0 GROUP BY 1""", doubles=("avg_spent", "pct"))
def n12(spark, sf_dir):
    return x.segments(activity(spark, sf_dir), x.activity_segment(), F.avg("total_spent").alias("avg_spent"))


@query("n13_user_segments", f"""{ACTIVITY_SQL}
SELECT CASE WHEN transaction_count >= 20 THEN 'Heavy Users (20+)' WHEN transaction_count >= 5 THEN 'Regular Users (5-19)'
    WHEN transaction_count >= 2 THEN 'Occasional Users (2-4)' ELSE 'One-time Users (1)' END AS segment,
  count(*) AS n, avg(total_spent) AS avg_spent, count(*) * 100.0 / (SELECT count(*) FROM activity) AS pct
FROM activity GROUP BY 1""", doubles=("avg_spent", "pct"))
def n13(spark, sf_dir):
    return x.segments(activity(spark, sf_dir), x.user_segment(), F.avg("total_spent").alias("avg_spent"))


query("n14_article_sales", f"{SALES_SQL} SELECT * FROM sales", doubles=("avg_price",))(sales)


@query("n14_sales_summary", SALES_SQL + _measure_sql("sales", ("purchase_count", "avg_price", "unique_customers")),
       doubles=("mean", "median", "max"))
def n14(spark, sf_dir):
    return x.measure_summary(sales(spark, sf_dir), ("purchase_count", "avg_price", "unique_customers"))


@query("n15_popularity_segments", f"""{SALES_SQL}
SELECT CASE WHEN purchase_count <= 1 THEN 'Niche (1)' WHEN purchase_count <= 10 THEN 'Low (2-10)'
    WHEN purchase_count <= 100 THEN 'Medium (11-100)' ELSE 'Popular (100+)' END AS segment,
  count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM sales) AS pct
FROM sales WHERE purchase_count > 0 GROUP BY 1""", doubles=("pct",))
def n15(spark, sf_dir):
    return x.segments(sales(spark, sf_dir), x.popularity_segment())


@query("n16_long_tail", f"""{SALES_SQL}
SELECT count(*) FILTER (purchase_count = 1) AS single_purchase_articles,
  count(*) FILTER (purchase_count = 1) * 100.0 / count(*) AS pct FROM sales""", doubles=("pct",))
def n16(spark, sf_dir):
    return x.long_tail(sales(spark, sf_dir))


MONTH_SQL = """
, months AS (SELECT month(t_dat) AS month, count(customer_id) AS transactions, round(sum(price), 2) AS total_revenue,
  count(*) * 100.0 / (SELECT count(*) FROM tx) AS pct FROM tx GROUP BY 1)
"""


@query("n17_monthly_seasonality", f"{MONTH_SQL} SELECT * FROM months", doubles=("total_revenue", "pct"))
def n17(spark, sf_dir):
    return x.monthly_seasonality(_tx(spark, sf_dir))


@query("n17_peak_and_low_month", f"""{MONTH_SQL}
SELECT arg_min(month, (-transactions, month)) AS peak_month, arg_min(month, (transactions, month)) AS low_month FROM months""")
def n17_peak(spark, sf_dir):
    return x.peak_and_low_month(_tx(spark, sf_dir))


@query("n18_weekday_pattern", """
SELECT isodow(t_dat) - 1 AS day_of_week, count(customer_id) AS transactions, count(*) * 100.0 / (SELECT count(*) FROM tx) AS pct
FROM tx GROUP BY 1""", doubles=("pct",))
def n18(spark, sf_dir):
    return x.weekday_pattern(_tx(spark, sf_dir))


PARETO_SQL = SALES_SQL + """
, placed AS (SELECT sum(purchase_count) OVER (ORDER BY purchase_count DESC, article_id) AS cum,
  sum(purchase_count) OVER () AS total FROM sales)
, pareto AS (SELECT count(*) FILTER (5 * cum <= 4 * total) AS articles_80pct,
  count(*) FILTER (20 * cum <= 19 * total) AS articles_95pct FROM placed)
"""


@query("n19_sales_concentration", f"{PARETO_SQL} SELECT * FROM pareto")
def n19(spark, sf_dir):
    return x.sales_concentration(sales(spark, sf_dir))


PRICE_DOUBLES = ("mean", "std", "min", "q25", "median", "q75", "max")


@query("n20_price_description", """
SELECT count(price) AS count, avg(price) AS mean, stddev_samp(price) AS std, min(price) AS min,
  quantile_cont(price, 0.25) AS q25, median(price) AS median, quantile_cont(price, 0.75) AS q75, max(price) AS max FROM tx""",
       doubles=PRICE_DOUBLES)
def n20(spark, sf_dir):
    return x.price_description(_tx(spark, sf_dir))


# the prices of these tables lie below 1, so the edges are a hundredth of the defaults
UNIT_EDGES, UNIT_LABELS = (0, 0.1, 0.25, 0.5, 1.0, INF), ("Budget", "Low", "Mid", "High", "Premium")


@query("n20_price_segments", """
SELECT CASE WHEN price <= 0.1 THEN 'Budget' WHEN price <= 0.25 THEN 'Low' WHEN price <= 0.5 THEN 'Mid'
  WHEN price <= 1.0 THEN 'High' ELSE 'Premium' END AS segment, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM tx) AS pct
FROM tx WHERE price > 0 GROUP BY 1""", doubles=("pct",))
def n20_segments(spark, sf_dir):
    return x.segments(_tx(spark, sf_dir), x.price_segment(UNIT_EDGES, UNIT_LABELS))


@query("n21_channel_statistics", """
SELECT sales_channel_id, count(customer_id) AS transactions, round(sum(price), 2) AS total_revenue, round(avg(price), 2) AS avg_price,
  count(*) * 100.0 / (SELECT count(*) FROM tx) AS pct,
  CASE sales_channel_id WHEN 1 THEN 'Store' WHEN 2 THEN 'Online' ELSE 'Channel ' || sales_channel_id END AS channel
FROM tx GROUP BY sales_channel_id""", doubles=("total_revenue", "avg_price", "pct"))
def n21(spark, sf_dir):
    return x.channel_statistics(_tx(spark, sf_dir))


@query("n22_sparsity", """
SELECT CAST(c AS DOUBLE) * a AS possible_interactions, n AS actual_interactions, 1 - n / (CAST(c AS DOUBLE) * a) AS sparsity,
  n / (CAST(c AS DOUBLE) * a) * 100 AS density_pct
FROM (SELECT count(*) AS n, count(DISTINCT customer_id) AS c, count(DISTINCT article_id) AS a FROM tx)""",
       doubles=("possible_interactions", "sparsity", "density_pct"))
def n22(spark, sf_dir):
    return x.sparsity(_tx(spark, sf_dir))


def _holes_sql(name: str, table: str, columns: Sequence[str]) -> str:
    return (f"SELECT 'missing in {name}' AS check_name, CAST(sum(missing_count) AS DOUBLE) AS value, sum(missing_count) = 0 AS passed "
            f"FROM ({missing_sql(table, columns)})")


@query("n23_readiness_checks", f"""
, checks AS ({_holes_sql('customers', 'customers', CUSTOMER_COLUMNS)}
UNION ALL {_holes_sql('articles', 'articles', ARTICLE_FILE)}
UNION ALL {_holes_sql('transactions', 'tx', TX_FILE)}
UNION ALL SELECT 'transaction volume', count(*), count(*) > 1000000 FROM tx
UNION ALL SELECT 'shared customer_id', count(*), count(*) > 0.9 * (SELECT count(DISTINCT customer_id) FROM tx)
  FROM (SELECT customer_id FROM tx INTERSECT SELECT customer_id FROM customers)
UNION ALL SELECT 'shared article_id', count(*), NULL FROM (SELECT article_id FROM tx INTERSECT SELECT article_id FROM articles))
SELECT * FROM checks
UNION ALL SELECT 'score', count(*) FILTER (passed) * 100.0 / count(passed), NULL FROM checks""", doubles=("value",))
def n23(spark, sf_dir):
    return x.readiness_checks(
        retail.customers(spark, sf_dir), retail.articles(spark, sf_dir).select(*ARTICLE_FILE), _tx(spark, sf_dir)
    )


# ---------------------------------------------------------------- relations

TOLERANCE_SQL = ACTIVITY_SQL + """
, tolerance AS (SELECT customer_id, transaction_count, total_spent, total_spent / transaction_count AS avg_price FROM activity)
"""


def tolerance(spark, sf_dir):
    return x.price_tolerance(_tx(spark, sf_dir))


def _relation_sql(table: str, a: str, b: str, name: str) -> str:
    return f"""SELECT '{name}' AS relation, corr({b}, {a}) AS correlation, CASE WHEN corr({b}, {a}) < -0.3 THEN 'strong negative'
  WHEN corr({b}, {a}) > 0.3 THEN 'strong positive' ELSE 'weak' END AS strength, regr_slope({b}, {a}) AS slope,
  regr_intercept({b}, {a}) AS intercept FROM {table}"""


def _relations(spark, sf_dir):
    pairs = (
        ("frequency and price", tolerance(spark, sf_dir), "transaction_count", "avg_price"),
        ("price and sales", sales(spark, sf_dir), "avg_price", "purchase_count"),
    )
    parts = [x.relation(df, a, b).select(F.lit(name).alias("relation"), "*") for name, df, a, b in pairs]
    return parts[0].unionByName(parts[1])


RELATION_SQL = (TOLERANCE_SQL + SALES_SQL + ", relations AS ("
                + _relation_sql("tolerance", "transaction_count", "avg_price", "frequency and price") + " UNION ALL "
                + _relation_sql("sales", "avg_price", "purchase_count", "price and sales") + ")")


@query("n24_correlations", f"{RELATION_SQL} SELECT relation, correlation, strength FROM relations", doubles=("correlation",))
def n24(spark, sf_dir):
    return _relations(spark, sf_dir).select("relation", "correlation", "strength")


@query("n25_trend_lines", f"{RELATION_SQL} SELECT relation, slope, intercept FROM relations", doubles=("slope", "intercept"))
def n25(spark, sf_dir):
    return _relations(spark, sf_dir).select("relation", "slope", "intercept")


@query("n26_sales_histogram", f"""{SALES_SQL}
, logs AS (SELECT log10(purchase_count + 1) AS x FROM sales)
, e AS (SELECT min(x) AS lo, max(x) AS hi FROM logs)
, placed AS (SELECT least(CAST(floor((x - lo) / (hi - lo) * 40) AS INT), 39) AS bin, count(*) AS n FROM logs, e GROUP BY 1)
SELECT CAST(b AS INT) AS bin, lo + b * (hi - lo) / 40 AS bin_start, lo + (b + 1) * (hi - lo) / 40 AS bin_end,
  coalesce(n, 0) AS articles, log10((SELECT median(purchase_count) FROM sales) + 1) AS median_mark
FROM range(40) t(b) CROSS JOIN e LEFT JOIN placed ON bin = b""", doubles=("bin_start", "bin_end", "median_mark"))
def n26(spark, sf_dir):
    return x.sales_histogram(sales(spark, sf_dir))


@query("n27_price_tolerance", f"""{TOLERANCE_SQL}
SELECT avg(avg_price) AS mean_price, min(avg_price) AS min_price, max(avg_price) AS max_price,
  avg(avg_price) FILTER (transaction_count >= 20) AS heavy_mean_price, avg(avg_price) FILTER (transaction_count = 1) AS single_mean_price
FROM tolerance""", doubles=("mean_price", "min_price", "max_price", "heavy_mean_price", "single_mean_price"))
def n27(spark, sf_dir):
    return x.price_tolerance_summary(tolerance(spark, sf_dir))


SUMMARY_DOUBLES = ("avg_price", "sparsity_pct", "heavy_pct", "one_time_pct", "transactions_per_customer", "pct_80", "pct_95")


@query("n28_summary", f"""{ACTIVITY_SQL}{PARETO_SQL}
SELECT n AS transactions, c AS unique_customers, a AS unique_articles, avg_price, (1 - n / (CAST(c AS DOUBLE) * a)) * 100 AS sparsity_pct,
  heavy AS heavy_users, heavy * 100.0 / c AS heavy_pct, once AS one_time_users, once * 100.0 / c AS one_time_pct,
  n / CAST(c AS DOUBLE) AS transactions_per_customer, articles_80pct, articles_80pct * 100.0 / a AS pct_80, articles_95pct,
  articles_95pct * 100.0 / a AS pct_95
FROM (SELECT count(*) AS n, count(DISTINCT customer_id) AS c, count(DISTINCT article_id) AS a, avg(price) AS avg_price FROM tx),
  (SELECT count(*) FILTER (transaction_count >= 20) AS heavy, count(*) FILTER (transaction_count = 1) AS once FROM activity), pareto""",
       doubles=SUMMARY_DOUBLES)
def n28(spark, sf_dir):
    return x.summary(_tx(spark, sf_dir))
