"""Registered queries: data quality profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from tallyloom.operators import quality as q
from tallyloom.plans.registry import query
from tallyloom.sources import retail

CUSTOMER_COLUMNS = tuple(retail.CUSTOMER_COLUMNS)
ARTICLE_TEXTS = ("prod_name", "product_type_name", "product_group_name", "graphical_appearance_name",
                 "colour_group_name", "department_name", "index_name", "section_name", "garment_group_name")
TX_NUMBERS = ("price", "quantity", "sales_channel_id", "line_no")
TX_ROW = ("customer_id", "article_id", "t_dat")


def missing_sql(table: str, columns: Sequence[str], rate: float = 0.5) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS total, count(*) - count({c}) AS missing_count FROM {table}"
        for c in columns
    )
    return (f"SELECT *, missing_count / CAST(total AS DOUBLE) AS missing_rate, "
            f"CASE WHEN missing_count / CAST(total AS DOUBLE) <= {rate} THEN 'good' ELSE 'poor' END AS quality_flag "
            f"FROM ({parts})")


def long_sql(table: str, columns: Sequence[str], kind: str = "DOUBLE") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS {kind}) AS value FROM {table}" for c in columns
    )


# ---------------------------------------------------------------- missing values


@query("q1_missing_by_column", missing_sql("customers", CUSTOMER_COLUMNS), doubles=("missing_rate",))
def q1(spark, sf_dir):
    return q.missing_by_column(retail.customers(spark, sf_dir))


@query("q2_missing_overall", f"""
SELECT CAST(sum(missing_count) AS BIGINT) AS total_missing, CAST(sum(total) AS BIGINT) AS total_values,
  sum(missing_count) / CAST(sum(total) AS DOUBLE) AS missing_rate,
  greatest(0, 1 - sum(missing_count) / CAST(sum(total) AS DOUBLE)) AS quality_score
FROM ({missing_sql('customers', CUSTOMER_COLUMNS)})""", doubles=("missing_rate", "quality_score"))
def q2(spark, sf_dir):
    return q.missing_overall(q1(spark, sf_dir))


@query("q3_missing_summary", f"""
SELECT count(*) FILTER (missing_count > 0) AS columns_with_missing,
  count(*) FILTER (quality_flag = 'poor') AS columns_with_high_missing, max(missing_rate) AS worst_missing_rate,
  avg(missing_rate) AS avg_missing_rate,
  coalesce(string_agg("column", ', ' ORDER BY "column") FILTER (quality_flag = 'poor'), '') AS high_missing_columns
FROM ({missing_sql('customers', CUSTOMER_COLUMNS)})""", doubles=("worst_missing_rate", "avg_missing_rate"))
def q3(spark, sf_dir):
    return q.missing_summary(q1(spark, sf_dir))


# ---------------------------------------------------------------- numeric columns

OUTLIER_SQL = f"""
, long AS ({long_sql('tx', TX_NUMBERS)})
, stats AS (SELECT "column", count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
  max(value) AS max, median(value) AS median, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.75) AS q75
  FROM long GROUP BY "column")
, bounds AS (SELECT *, q25 - 1.5 * (q75 - q25) AS lower_bound, q75 + 1.5 * (q75 - q25) AS upper_bound FROM stats
  WHERE n >= 10)
, tails AS (SELECT "column", count(*) FILTER (value < lower_bound OR value > upper_bound) AS iqr_count,
  count(*) FILTER (abs((value - mean) / nullif(std, 0)) > 3) AS zscore_count
  FROM long JOIN bounds USING ("column") GROUP BY "column")
, outliers AS (SELECT "column", iqr_count, iqr_count / CAST(n AS DOUBLE) AS iqr_rate, lower_bound, upper_bound, zscore_count,
  zscore_count / CAST(n AS DOUBLE) AS zscore_rate, CAST(3 AS DOUBLE) AS threshold, mean, std, min, max, median
  FROM bounds JOIN tails USING ("column"))
"""


def _outlier_query(name: str, *columns: str, doubles=()):
    @query(name, f"{OUTLIER_SQL} SELECT \"column\", {', '.join(columns)} FROM outliers", doubles=doubles)
    def build(spark, sf_dir):
        return q.outliers(retail.transactions(spark, sf_dir), TX_NUMBERS).select("column", *columns)

    return build


_outlier_query("q4_iqr_outliers", "iqr_count", "iqr_rate", "lower_bound", "upper_bound",
               doubles=("iqr_rate", "lower_bound", "upper_bound"))
_outlier_query("q5_zscore_outliers", "zscore_count", "zscore_rate", "threshold", doubles=("zscore_rate", "threshold"))
_outlier_query("q6_column_stats", "mean", "std", "min", "max", "median", doubles=("mean", "std", "min", "max", "median"))

EVENT_OUTLIERS_DOUBLES = ("iqr_rate", "lower_bound", "upper_bound", "zscore_rate", "threshold", "mean", "std", "min",
                          "max", "median")


@query("q4_q6_event_outliers", OUTLIER_SQL.replace(long_sql("tx", TX_NUMBERS), long_sql("events", ("value", "user_id")))
       + "SELECT * FROM outliers", doubles=EVENT_OUTLIERS_DOUBLES)
def event_outliers(spark, sf_dir):
    return q.outliers(retail.table(spark, sf_dir, "events"), ("value", "user_id"))


DISTRIBUTION_DOUBLES = ("mean", "std", "min", "max", "median", "skewness", "kurtosis", "q25", "q75")


@query("q7_numeric_distributions", f"""
, long AS ({long_sql('tx', TX_NUMBERS)})
SELECT "column", count(value) AS count, count(DISTINCT value) AS unique_values, avg(value) AS mean,
  stddev_samp(value) AS std, min(value) AS min, max(value) AS max, median(value) AS median, skewness(value) AS skewness,
  kurtosis(value) AS kurtosis, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.75) AS q75
FROM long GROUP BY "column" HAVING count(value) >= 2""", doubles=DISTRIBUTION_DOUBLES)
def q7(spark, sf_dir):
    return q.numeric_distributions(retail.transactions(spark, sf_dir), TX_NUMBERS)


@query("q7_wide_integers", """
SELECT 'order_code' AS "column", count(*) AS count, count(DISTINCT 9007199254740992 + o_orderkey) AS unique_values FROM orders
UNION ALL SELECT 'amount', count(o_totalprice), count(DISTINCT CAST(o_totalprice AS DECIMAL(20, 2))) FROM orders""", views=False)
def q7_wide(spark, sf_dir):
    orders = retail.table(spark, sf_dir, "orders").select(
        (F.lit(2**53) + F.col("o_orderkey")).alias("order_code"), F.col("o_totalprice").cast("decimal(20, 2)").alias("amount")
    )
    return q.numeric_distributions(orders, ("order_code", "amount")).select("column", "count", "unique_values")


@query("q11_value_ranges", f"""
, long AS ({long_sql('tx', TX_NUMBERS)})
SELECT "column", bool_or(value < 0) AS has_negative, bool_or(value = 0) AS has_zero, bool_or(value > 0) AS has_positive,
  max(value) - min(value) AS range_span, stddev_samp(value) / nullif(avg(value), 0) AS coefficient_of_variation
FROM long GROUP BY "column" """, doubles=("range_span", "coefficient_of_variation"))
def q11(spark, sf_dir):
    return q.value_ranges(retail.transactions(spark, sf_dir), TX_NUMBERS)


# ---------------------------------------------------------------- text columns


@query("q8_categorical_distributions", f"""
, long AS ({long_sql('articles', ARTICLE_TEXTS, 'VARCHAR')})
, counts AS (SELECT "column", value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL)
, top AS (SELECT "column", value, n, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM counts)
SELECT "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS unique_values, count(*) / CAST(sum(n) AS DOUBLE) AS cardinality_rate,
  arg_min(value, (-n, value)) AS most_frequent, max(n) AS most_frequent_count,
  arg_max(value, (-n, value)) AS least_frequent, min(n) AS least_frequent_count,
  (SELECT string_agg(value || '=' || n, ', ' ORDER BY rank) FROM top t WHERE t."column" = counts."column" AND rank <= 5) AS top_values
FROM counts GROUP BY "column" """, doubles=("cardinality_rate",))
def q8(spark, sf_dir):
    profile = q.categorical_distributions(retail.articles(spark, sf_dir), ARTICLE_TEXTS)
    pairs = F.transform(
        F.map_entries("top_values"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    return profile.withColumn("top_values", F.array_join(pairs, ", "))


# ---------------------------------------------------------------- consistency and report


@query("q9_duplicate_rows", f"""
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_count, sum(n - 1) / CAST(sum(n) AS DOUBLE) AS duplicate_rate
FROM (SELECT count(*) AS n FROM tx GROUP BY {', '.join(TX_ROW)})""", doubles=("duplicate_rate",))
def q9(spark, sf_dir):
    return q.duplicate_rows(retail.transactions(spark, sf_dir).select(*TX_ROW))


def _type_sql() -> str:
    kinds = {"customer_id": "bigint", "FN": "double", "Active": "double", "age": "double"}
    parts = []
    for c in CUSTOMER_COLUMNS:
        head = f"'{c}' AS \"column\", '{kinds.get(c, 'string')}' AS type, count(*) - count({c}) AS null_count, count({c}) AS non_null_count"
        if c in kinds:
            parts.append(f"SELECT {head}, CAST(NULL AS DOUBLE) AS number_share, CAST(NULL AS DOUBLE) AS date_share, "
                         f"CAST(NULL AS DOUBLE) AS text_share, true AS type_consistency FROM customers")
        else:
            number = f"count(*) FILTER (regexp_matches({c}, '^[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?$'))"
            date = f"count(*) FILTER (regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}'))"
            parts.append(
                f"SELECT {head}, {number} / CAST(count({c}) AS DOUBLE), {date} / CAST(count({c}) AS DOUBLE), "
                f"(count({c}) - {number} - {date}) / CAST(count({c}) AS DOUBLE), "
                f"CAST({number} > 0 AS INT) + CAST({date} > 0 AS INT) + CAST(count({c}) > {number} + {date} AS INT) <= 1 "
                f"FROM customers")
    return "\nUNION ALL ".join(parts)


@query("q10_type_profile", _type_sql(), doubles=("number_share", "date_share", "text_share"))
def q10(spark, sf_dir):
    return q.type_profile(retail.customers(spark, sf_dir))


def report_sql(name: str, table: str, columns: Sequence[str]) -> str:
    listed = ", ".join(columns)
    return f"""
SELECT '{name}' AS dataset, rows, columns, missing_rate, 1 - missing_rate AS quality_score, duplicate_count, duplicate_rate,
  (1 - missing_rate + 1 - duplicate_rate) / 2 AS score,
  CASE WHEN (1 - missing_rate + 1 - duplicate_rate) / 2 >= 0.9 THEN 'A' WHEN (1 - missing_rate + 1 - duplicate_rate) / 2 >= 0.7
    THEN 'B' WHEN (1 - missing_rate + 1 - duplicate_rate) / 2 >= 0.5 THEN 'C' ELSE 'D' END AS grade
FROM (SELECT (SELECT count(*) FROM {table}) AS rows, {len(columns)} AS columns,
  (SELECT sum(missing_count) / CAST(sum(total) AS DOUBLE) FROM ({missing_sql(table, columns)})) AS missing_rate,
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM {table} GROUP BY {listed})) AS duplicate_count,
  (SELECT sum(n - 1) / CAST(sum(n) AS DOUBLE) FROM (SELECT count(*) AS n FROM {table} GROUP BY {listed})) AS duplicate_rate)"""


REPORT_DOUBLES = ("missing_rate", "quality_score", "duplicate_rate", "score")


@query("q12_quality_report", f"""{report_sql('customers', 'customers', CUSTOMER_COLUMNS)}
UNION ALL {report_sql('transactions', 'tx', TX_ROW)}""", doubles=REPORT_DOUBLES)
def q12(spark, sf_dir):
    transactions = retail.transactions(spark, sf_dir).select(*TX_ROW)
    return q.quality_report(retail.customers(spark, sf_dir), "customers").unionByName(
        q.quality_report(transactions, "transactions")
    )


@query("q13_recommendations", f"""
, looked AS (SELECT FN, "Active", age, club_member_status, CASE WHEN age IS NULL THEN 'unknown' ELSE postal_code END AS contact
  FROM customers)
SELECT 'high_missing' AS code, string_agg("column", ', ' ORDER BY "column") AS columns
FROM ({missing_sql('looked', ('FN', '"Active"', 'age', 'club_member_status', 'contact')).replace("'" + '"Active"' + "'", "'Active'")})
WHERE quality_flag = 'poor' HAVING count(*) > 0
UNION ALL SELECT 'duplicate_rows', '' FROM (SELECT count(*) AS n FROM looked GROUP BY ALL) HAVING sum(n - 1) / CAST(sum(n) AS DOUBLE) > 0.01
UNION ALL SELECT 'mixed_types', 'contact'""")
def q13(spark, sf_dir):
    looked = retail.customers(spark, sf_dir).select(
        "FN", "Active", "age", "club_member_status",
        F.when(F.col("age").isNull(), "unknown").otherwise(F.col("postal_code")).alias("contact"),
    )
    return q.recommendations(looked)


Q14_ARTICLES = ("article_id", *ARTICLE_TEXTS, "detail_desc")


@query("q14_quality_scores", f"""
, reports AS ({report_sql('customers', 'customers', CUSTOMER_COLUMNS)}
  UNION ALL {report_sql('articles', 'articles', Q14_ARTICLES)}
  UNION ALL {report_sql('transactions', 'tx', TX_ROW)})
SELECT dataset, score, grade FROM reports
UNION ALL SELECT 'average', avg(score), CASE WHEN avg(score) >= 0.9 THEN 'A' WHEN avg(score) >= 0.7 THEN 'B' ELSE 'C' END
FROM reports""", doubles=("score",))
def q14(spark, sf_dir):
    return q.quality_scores({
        "customers": retail.customers(spark, sf_dir),
        "articles": retail.articles(spark, sf_dir).select(*Q14_ARTICLES),
        "transactions": retail.transactions(spark, sf_dir).select(*TX_ROW),
    })
