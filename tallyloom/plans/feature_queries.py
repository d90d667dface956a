"""Registered queries: sources, customer, article, temporal and interaction features, joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import articles as art
from tallyloom.operators import customers as cust
from tallyloom.operators import interactions as inter
from tallyloom.operators import temporal as temp
from tallyloom.plans import features
from tallyloom.plans.registry import query
from tallyloom.session import scratch_path
from tallyloom.sources import readers, retail
from tallyloom.sources.retail import REFERENCE_DATE as REF

# ---------------------------------------------------------------- sources

CUSTOMER_FILE = ("customer_id", "FN", "Active", "club_member_status", "fashion_news_frequency",
                 "age", "postal_code")
ARTICLE_FILE = ("article_id", "prod_name", "product_type_name", "product_group_name",
                "graphical_appearance_name", "colour_group_name", "department_name", "index_name",
                "section_name", "garment_group_name", "detail_desc")
TX_FILE = ("t_dat", "customer_id", "article_id", "price", "sales_channel_id")


def _as_csv(spark: SparkSession, df: DataFrame, label: str) -> str:
    path = scratch_path(spark, label)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


@query("s1_load_customers", f"""
SELECT {', '.join(CUSTOMER_FILE)} FROM customers""", doubles=("FN", "Active", "age"))
def s1(spark, sf_dir):
    path = _as_csv(spark, retail.customers(spark, sf_dir).select(*CUSTOMER_FILE), "customers")
    return readers.load_customers(spark, path).withColumn("customer_id", F.col("customer_id").cast("long"))


@query("s2_load_articles", f"SELECT {', '.join(ARTICLE_FILE)} FROM articles")
def s2(spark, sf_dir):
    path = _as_csv(spark, retail.articles(spark, sf_dir).select(*ARTICLE_FILE), "articles")
    return readers.load_articles(spark, path).withColumn("article_id", F.col("article_id").cast("long"))


@query("s3_load_transactions", """
SELECT t_dat, customer_id, article_id, price, sales_channel_id FROM tx
WHERE t_dat BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""", doubles=("price",))
def s3(spark, sf_dir):
    path = scratch_path(spark, "transactions")
    retail.transactions(spark, sf_dir).select(*TX_FILE).write.parquet(path)
    return readers.load_transactions(
        spark, path, fmt="parquet", date_range=("1996-01-01", "1999-12-31")
    )


@query("s4_load_all", """
SELECT 'customers' AS table_name, count(*) AS n FROM customers
UNION ALL SELECT 'articles', count(*) FROM articles
UNION ALL SELECT 'transactions', count(*) FROM tx
WHERE t_dat BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def s4(spark, sf_dir):
    loaded = readers.load_all(
        spark,
        _as_csv(spark, retail.customers(spark, sf_dir).select(*CUSTOMER_FILE), "customers"),
        _as_csv(spark, retail.articles(spark, sf_dir).select(*ARTICLE_FILE), "articles"),
        _as_csv(spark, retail.transactions(spark, sf_dir).select(*TX_FILE), "transactions"),
        date_range=("1996-01-01", "1999-12-31"),
    )
    sizes = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        for name, df in zip(("customers", "articles", "transactions"), loaded)
    ]
    return sizes[0].unionByName(sizes[1]).unionByName(sizes[2])


@query("s5_write_features", """
SELECT customer_id, article_id, t_dat, price, strftime(t_dat, '%Y-%m') AS year_month FROM tx""",
       doubles=("price",))
def s5(spark, sf_dir):
    path = scratch_path(spark, "transactions-by-month")
    tx = retail.transactions(spark, sf_dir).select("customer_id", "article_id", "t_dat", "price")
    readers.write_features(tx, path, month_of="t_dat")
    stored = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", False)
    schema = "customer_id long, article_id long, t_dat date, price double, year_month string"
    return stored.schema(schema).parquet(path)


# ---------------------------------------------------------------- customers

CUSTOMER_SQL = """
, med AS (SELECT median(age) AS m FROM customers)
, c0 AS (
SELECT customers.*,
  CASE WHEN age < 0 THEN NULL WHEN age <= 20 THEN '0-20' WHEN age <= 25 THEN '20-25' WHEN age <= 30 THEN '25-30'
    WHEN age <= 35 THEN '30-35' WHEN age <= 40 THEN '35-40' WHEN age <= 45 THEN '40-45' WHEN age <= 50 THEN '45-50'
    WHEN age <= 55 THEN '50-55' WHEN age <= 60 THEN '55-60' WHEN age <= 65 THEN '60-65' WHEN age <= 70 THEN '65-70'
    WHEN age <= 100 THEN '70-100' END AS age_group,
  coalesce(age, med.m) AS age_filled,
  CAST(age IS NULL AS INT) AS is_age_missing,
  CAST(coalesce(club_member_status = 'ACTIVE', false) AS INT) AS is_club_member,
  coalesce(club_member_status, 'UNKNOWN') AS club_member_status_filled,
  CAST(fashion_news_frequency IS NOT NULL AS INT) AS receives_fashion_news,
  coalesce(fashion_news_frequency, 'NONE') AS fashion_news_frequency_filled,
  CASE fashion_news_frequency WHEN 'Monthly' THEN 1 WHEN 'Regularly' THEN 2 ELSE 0 END AS fashion_news_score,
  CAST(trunc(coalesce("Active", 0)) AS INT) AS is_active,
  CAST(trunc(coalesce(FN, 0)) AS INT) AS has_FN
FROM customers, med)
, customer_basic AS (
SELECT *, CASE WHEN is_active = 0 THEN 'inactive'
  WHEN is_club_member = 1 AND fashion_news_score >= 2 THEN 'loyal'
  WHEN is_club_member = 1 THEN 'engaged'
  WHEN receives_fashion_news = 1 THEN 'casual' ELSE 'new' END AS lifecycle_stage
FROM c0)
"""


def _customer_query(name: str, *columns: str, doubles=()):
    listed = ", ".join(columns)

    @query(name, f"{CUSTOMER_SQL} SELECT customer_id, {listed} FROM customer_basic", doubles=doubles)
    def build(spark, sf_dir):
        return cust.customer_features(retail.customers(spark, sf_dir)).select("customer_id", *columns)

    return build


@query("c0_customer_features", f"{CUSTOMER_SQL} SELECT * FROM customer_basic",
       doubles=("FN", "Active", "age", "age_filled"))
def c0(spark, sf_dir):
    return cust.customer_features(retail.customers(spark, sf_dir))


_customer_query("c1_age_group", "age_group")
_customer_query("c2_age_filled", "age_filled", "is_age_missing", doubles=("age_filled",))
_customer_query("c3_club_member", "is_club_member", "club_member_status_filled")
_customer_query("c4_fashion_news", "receives_fashion_news", "fashion_news_frequency_filled",
                "fashion_news_score")
_customer_query("c5_activity_flags", "is_active", "has_FN")
_customer_query("c6_lifecycle_stage", "lifecycle_stage")

# ---------------------------------------------------------------- articles


def _code_sql(source: str) -> str:
    return (f"CASE WHEN {source} IS NULL THEN -1 ELSE "
            f"dense_rank() OVER (ORDER BY {source} NULLS LAST) - 1 END")


ARTICLE_SQL = f"""
, article_basic AS (
SELECT *,
  coalesce(department_name, 'nan') || '/' || coalesce(product_group_name, 'nan') || '/'
    || coalesce(product_type_name, 'nan') AS category_path,
  CAST(coalesce(colour_group_name = 'Black', false) AS INT) AS is_black,
  CAST(coalesce(colour_group_name = 'White', false) AS INT) AS is_white,
  CAST(coalesce(colour_group_name IN ('Black', 'White', 'Grey', 'Beige'), false) AS INT) AS is_neutral_color,
  CAST(graphical_appearance_name IS DISTINCT FROM 'Solid' AS INT) AS has_graphic,
  CAST(coalesce(graphical_appearance_name IN ('Striped', 'Spotted', 'Checked'), false) AS INT) AS is_patterned,
  CAST(coalesce(index_name ILIKE '%men%', false) AS INT) AS is_menswear,
  CAST(coalesce(index_name ILIKE '%children%' OR index_name ILIKE '%baby%', false) AS INT) AS is_kidswear,
  CAST(NOT coalesce(index_name ILIKE '%men%' OR index_name ILIKE '%children%' OR index_name ILIKE '%baby%', false)
    AS INT) AS is_womenswear,
  CAST(coalesce(section_name = 'Divided', false) AS INT) AS is_divided,
  CAST(coalesce(garment_group_name IN ('Jersey Basic', 'Jersey Fancy', 'Knitwear'), false) AS INT) AS is_upper_body,
  CAST(coalesce(garment_group_name IN ('Trousers', 'Shorts', 'Skirts'), false) AS INT) AS is_lower_body,
  CAST(coalesce(garment_group_name IN ('Dresses', 'Jumpsuit'), false) AS INT) AS is_full_body,
  CAST(detail_desc IS NOT NULL AS INT) AS has_description,
  length(coalesce(detail_desc, '')) AS description_length,
  {_code_sql('department_name')} AS department_idx,
  {_code_sql('product_group_name')} AS product_group_idx,
  {_code_sql('product_type_name')} AS product_type_idx,
  {_code_sql('section_name')} AS section_idx
FROM articles)
"""


def _article_query(name: str, *columns: str):
    listed = ", ".join(columns)

    @query(name, f"{ARTICLE_SQL} SELECT article_id, {listed} FROM article_basic")
    def build(spark, sf_dir):
        articles = retail.articles(spark, sf_dir)
        if set(columns) <= set(art.CODED):
            return art.category_codes(articles, art.CODED).select("article_id", *columns)
        return articles.select("*", *art.style_columns()).select("article_id", *columns)

    return build


@query("a0_article_features", f"{ARTICLE_SQL} SELECT * FROM article_basic", doubles=("list_price",))
def a0(spark, sf_dir):
    return art.article_features(retail.articles(spark, sf_dir))


_article_query("a1_category_codes", "department_idx", "product_group_idx", "product_type_idx", "section_idx")
_article_query("a2_category_path", "category_path")
_article_query("a3_colour_flags", "is_black", "is_white", "is_neutral_color")
_article_query("a4_style_flags", "has_graphic", "is_patterned")
_article_query("a5_index_flags", "is_menswear", "is_kidswear", "is_womenswear")
_article_query("a6_divided_flag", "is_divided")
_article_query("a7_garment_flags", "is_upper_body", "is_lower_body", "is_full_body")
_article_query("a8_description", "has_description", "description_length")

PRICE_SQL = """
, stats AS (SELECT article_id, avg(price) AS avg_selling_price, stddev_samp(price) AS price_std,
  min(price) AS min_price, max(price) AS max_price FROM tx GROUP BY article_id)
, article_prices AS (
SELECT article_id, avg_selling_price, price_std, min_price, max_price,
  coalesce(price_std / nullif(avg_selling_price, 0), 0) AS price_volatility,
  CASE WHEN avg_selling_price < 0 THEN NULL
    WHEN avg_selling_price <= 0.01 THEN '0.00-0.01' WHEN avg_selling_price <= 0.02 THEN '0.01-0.02'
    WHEN avg_selling_price <= 0.03 THEN '0.02-0.03' WHEN avg_selling_price <= 0.05 THEN '0.03-0.05'
    WHEN avg_selling_price <= 0.1 THEN '0.05-0.10' WHEN avg_selling_price <= 0.2 THEN '0.10-0.20'
    WHEN avg_selling_price <= 0.5 THEN '0.20-0.50' WHEN avg_selling_price <= 1.0 THEN '0.50-1.00' END AS price_range
FROM articles LEFT JOIN stats USING (article_id))
"""
PRICE_DOUBLES = ("avg_selling_price", "price_std", "min_price", "max_price", "price_volatility")


@query("a9_price_features", f"{PRICE_SQL} SELECT * FROM article_prices", doubles=PRICE_DOUBLES)
def a9(spark, sf_dir):
    ids = retail.articles(spark, sf_dir).select("article_id")
    return art.price_features(ids, retail.transactions(spark, sf_dir))


@query("a10_price_range", f"""{PRICE_SQL}
SELECT price_range, count(*) AS articles FROM article_prices GROUP BY price_range""")
def a10(spark, sf_dir):
    return a9(spark, sf_dir).groupBy("price_range").agg(F.count("*").alias("articles"))


# ---------------------------------------------------------------- temporal

CUSTOMER_TEMPORAL_SQL = f"""
, months AS (SELECT customer_id, month(t_dat) AS m, count(*) AS n FROM tx GROUP BY ALL)
, fav_month AS (SELECT customer_id, m AS favorite_month FROM months
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, m) = 1)
, hist AS (
SELECT customer_id, min(t_dat) AS f, max(t_dat) AS l, count(*) AS total_transactions,
  avg(CASE WHEN isodow(t_dat) >= 6 THEN 1.0 ELSE 0.0 END) AS weekend_purchase_ratio,
  count(*) FILTER (t_dat >= DATE '{REF}' - 30) AS purchases_last_30_days,
  count(*) FILTER (t_dat >= DATE '{REF}' - 90) AS purchases_last_90_days
FROM tx GROUP BY customer_id)
, customer_temporal AS (
SELECT customer_id, DATE '{REF}' - l AS days_since_last_purchase, DATE '{REF}' - f AS days_since_first_purchase,
  l - f AS customer_lifespan_days, total_transactions,
  CASE WHEN total_transactions > 1 THEN (l - f) / CAST(total_transactions AS DOUBLE) ELSE 0 END
    AS avg_days_between_purchases,
  favorite_month, weekend_purchase_ratio, purchases_last_30_days, purchases_last_90_days,
  purchases_last_90_days > 0 AS is_active_customer
FROM hist JOIN fav_month USING (customer_id))
"""
CT_DOUBLES = ("avg_days_between_purchases", "weekend_purchase_ratio")


def _customer_temporal(spark, sf_dir):
    return temp.customer_temporal(retail.transactions(spark, sf_dir), reference_date=REF)


def _temporal_query(name: str, table: str, sql: str, build, key: str, *columns: str, doubles=()):
    @query(name, f"{sql} SELECT {key}, {', '.join(columns)} FROM {table}", doubles=doubles)
    def run(spark, sf_dir):
        return build(spark, sf_dir).select(key, *columns)

    return run


query("t0_customer_temporal", f"{CUSTOMER_TEMPORAL_SQL} SELECT * FROM customer_temporal",
      doubles=CT_DOUBLES)(_customer_temporal)


@query("t1_recency", """
SELECT user_id,
  CAST(floor((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 86400000000.0) AS INT) AS days_since_last_purchase,
  CAST(floor((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(min(ts))) / 86400000000.0) AS INT) AS days_since_first_purchase,
  CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0) AS INT) AS customer_lifespan_days
FROM events GROUP BY user_id""", views=False)
def t1(spark, sf_dir):
    # event times carry a time of day, so this is the floored form
    return temp.customer_temporal(
        retail.table(spark, sf_dir, "events"), reference_date="2024-02-01", customer_col="user_id",
        date_col="ts",
    ).select("user_id", "days_since_last_purchase", "days_since_first_purchase", "customer_lifespan_days")


_temporal_query("t2_frequency", "customer_temporal", CUSTOMER_TEMPORAL_SQL, _customer_temporal, "customer_id",
                "total_transactions", "avg_days_between_purchases", doubles=("avg_days_between_purchases",))
_temporal_query("t3_favorite_month", "customer_temporal", CUSTOMER_TEMPORAL_SQL, _customer_temporal,
                "customer_id", "favorite_month")
_temporal_query("t4_weekend_ratio", "customer_temporal", CUSTOMER_TEMPORAL_SQL, _customer_temporal,
                "customer_id", "weekend_purchase_ratio", doubles=("weekend_purchase_ratio",))
_temporal_query("t5_recent_activity", "customer_temporal", CUSTOMER_TEMPORAL_SQL, _customer_temporal,
                "customer_id", "purchases_last_30_days", "purchases_last_90_days", "is_active_customer")

ARTICLE_TEMPORAL_SQL = f"""
, sales AS (
SELECT article_id, min(t_dat) AS f, max(t_dat) AS l, count(*) AS total_sales,
  count(DISTINCT customer_id) AS unique_customers,
  count(*) FILTER (t_dat >= DATE '{REF}' - 7) AS sales_last_7_days,
  count(*) FILTER (t_dat >= DATE '{REF}' - 30) AS sales_last_30_days
FROM tx GROUP BY article_id)
, article_temporal AS (
SELECT article_id, DATE '{REF}' - f AS days_since_first_sale, DATE '{REF}' - l AS days_since_last_sale,
  l - f AS product_lifespan_days, total_sales, unique_customers,
  total_sales / CAST(l - f + 1 AS DOUBLE) AS avg_sales_per_day, sales_last_7_days, sales_last_30_days,
  sales_last_7_days > total_sales / CAST(l - f + 1 AS DOUBLE) * 7 AS is_trending,
  DATE '{REF}' - f <= 30 AS is_new_product
FROM sales)
"""


def _article_temporal(spark, sf_dir):
    return temp.article_temporal(retail.transactions(spark, sf_dir), reference_date=REF)


_temporal_query("t6_sale_dates", "article_temporal", ARTICLE_TEMPORAL_SQL, _article_temporal, "article_id",
                "days_since_first_sale", "days_since_last_sale", "product_lifespan_days")
_temporal_query("t7_sales", "article_temporal", ARTICLE_TEMPORAL_SQL, _article_temporal, "article_id",
                "total_sales", "unique_customers", "avg_sales_per_day", doubles=("avg_sales_per_day",))
_temporal_query("t8_trend", "article_temporal", ARTICLE_TEMPORAL_SQL, _article_temporal, "article_id",
                "sales_last_7_days", "sales_last_30_days", "is_trending", "is_new_product")

# ---------------------------------------------------------------- interactions


def _favourite_sql(name: str, source: str) -> str:
    return (f", {name}_n AS (SELECT customer_id, {source} AS v, count(*) AS n FROM joined "
            f"WHERE {source} IS NOT NULL GROUP BY ALL)\n"
            f", {name} AS (SELECT customer_id, arg_min(v, (-n, v)) AS fav, count(*) AS kinds, max(n) AS top "
            f"FROM {name}_n GROUP BY customer_id)\n")


JOINED_SQL = """
, joined AS (SELECT tx.*, product_group_name, department_name, colour_group_name, index_name
  FROM tx LEFT JOIN articles USING (article_id))
"""
PREFERENCE_SQL = (
    JOINED_SQL
    + _favourite_sql("fd", "department_name")
    + _favourite_sql("fg", "product_group_name")
    + _favourite_sql("fc", "colour_group_name")
    + """
, base AS (SELECT customer_id, count(*) AS n, avg(price) AS avg_purchase_price, stddev_samp(price) AS price_std,
  min(price) AS min_purchase_price, max(price) AS max_purchase_price,
  avg(CASE WHEN index_name ILIKE '%men%' THEN 1.0 ELSE 0.0 END) AS menswear_ratio,
  avg(CASE WHEN index_name ILIKE '%children%' OR index_name ILIKE '%baby%' THEN 1.0 ELSE 0.0 END) AS kidswear_ratio
  FROM joined GROUP BY customer_id)
, customer_preferences AS (
SELECT base.customer_id, coalesce(fd.fav, 'Unknown') AS favorite_department, coalesce(fd.kinds, 0) AS department_diversity,
  coalesce(fg.fav, 'Unknown') AS favorite_product_group, coalesce(fg.kinds, 0) AS product_group_diversity,
  coalesce(fc.fav, 'Unknown') AS favorite_color, coalesce(fc.kinds, 0) AS color_diversity,
  coalesce(fd.top / CAST(n AS DOUBLE), 0) AS department_concentration,
  coalesce(fc.fav = 'Black', false) AS prefers_black,
  avg_purchase_price, price_std, min_purchase_price, max_purchase_price,
  max_purchase_price - min_purchase_price AS price_range, menswear_ratio, kidswear_ratio,
  1 - menswear_ratio - kidswear_ratio AS womenswear_ratio
FROM base LEFT JOIN fd USING (customer_id) LEFT JOIN fg USING (customer_id) LEFT JOIN fc USING (customer_id))
"""
)
PREFERENCE_DOUBLES = ("department_concentration", "avg_purchase_price", "price_std", "min_purchase_price",
                      "max_purchase_price", "price_range", "menswear_ratio", "kidswear_ratio", "womenswear_ratio")


def _preferences(spark, sf_dir):
    return inter.customer_preferences(retail.transactions(spark, sf_dir), retail.articles(spark, sf_dir))


query("i0_customer_preferences", f"{PREFERENCE_SQL} SELECT * FROM customer_preferences",
      doubles=PREFERENCE_DOUBLES)(_preferences)
_temporal_query("i1_favourites", "customer_preferences", PREFERENCE_SQL, _preferences, "customer_id",
                "favorite_department", "favorite_product_group", "favorite_color")
_temporal_query("i2_diversity", "customer_preferences", PREFERENCE_SQL, _preferences, "customer_id",
                "department_diversity", "product_group_diversity", "color_diversity")
_temporal_query("i3_concentration", "customer_preferences", PREFERENCE_SQL, _preferences, "customer_id",
                "department_concentration", doubles=("department_concentration",))
_temporal_query("i4_price_preferences", "customer_preferences", PREFERENCE_SQL, _preferences, "customer_id",
                "avg_purchase_price", "price_std", "min_purchase_price", "max_purchase_price", "price_range",
                "prefers_black",
                doubles=("avg_purchase_price", "price_std", "min_purchase_price", "max_purchase_price",
                         "price_range"))
_temporal_query("i5_gender_ratios", "customer_preferences", PREFERENCE_SQL, _preferences, "customer_id",
                "menswear_ratio", "kidswear_ratio", "womenswear_ratio",
                doubles=("menswear_ratio", "kidswear_ratio", "womenswear_ratio"))

POPULARITY_SQL = """
, pop AS (SELECT article_id, count(customer_id) AS total_purchases, count(DISTINCT customer_id) AS unique_customers,
  avg(price) AS avg_selling_price, stddev_samp(price) AS price_volatility, min(t_dat) AS first_purchase_date,
  max(t_dat) AS last_purchase_date FROM tx GROUP BY article_id)
, article_popularity AS (
SELECT *, total_purchases / CAST(unique_customers AS DOUBLE) AS repurchase_rate,
  sqrt(CAST(total_purchases AS DOUBLE) * unique_customers) AS popularity_score,
  dense_rank() OVER (ORDER BY sqrt(CAST(total_purchases AS DOUBLE) * unique_customers) DESC) AS popularity_rank,
  dense_rank() OVER (ORDER BY sqrt(CAST(total_purchases AS DOUBLE) * unique_customers) DESC) <= 100 AS is_bestseller
FROM pop)
"""
POPULARITY_DOUBLES = ("avg_selling_price", "price_volatility", "repurchase_rate", "popularity_score")


def article_popularity(spark, sf_dir):
    return inter.article_popularity(retail.transactions(spark, sf_dir))


query("i6_article_popularity", f"{POPULARITY_SQL} SELECT * FROM article_popularity",
      doubles=POPULARITY_DOUBLES)(article_popularity)
_temporal_query("i7_popularity_rank", "article_popularity", POPULARITY_SQL, article_popularity, "article_id",
                "popularity_rank", "is_bestseller")



@query("i6_popularity_windows", f"""
SELECT article_id, count(*) FILTER (t_dat >= DATE '{REF}' - 7) AS purchases_last_7_days,
  count(*) FILTER (t_dat >= DATE '{REF}' - 30) AS purchases_last_30_days,
  count(*) FILTER (t_dat >= DATE '{REF}' - 90) AS purchases_last_90_days,
  count(*) FILTER (t_dat >= DATE '{REF}' - 365) AS purchases_last_365_days, count(*) < 25 AS is_cold_start,
  count(*) FILTER (t_dat >= DATE '{REF}' - 7) >= 3 AS is_trending FROM tx GROUP BY article_id""")
def i6_windows(spark, sf_dir):
    days = (7, 30, 90, 365)
    return inter.article_popularity(
        retail.transactions(spark, sf_dir), lookbacks=days, reference_date=REF, cold_start=25, trending=3
    ).select("article_id", *[f"purchases_last_{d}_days" for d in days], "is_cold_start", "is_trending")


@query("i4_monetary_percentiles", """
SELECT quantile_cont(s, 0.25) AS p25, quantile_cont(s, 0.5) AS p50, quantile_cont(s, 0.75) AS p75,
  quantile_cont(s, 0.9) AS p90, quantile_cont(s, 0.95) AS p95
FROM (SELECT sum(price) AS s FROM tx GROUP BY customer_id)""", doubles=("p25", "p50", "p75", "p90", "p95"))
def i4_percentiles(spark, sf_dir):
    return inter.monetary_percentiles(retail.transactions(spark, sf_dir))


# ---------------------------------------------------------------- joins and assembled tables


@query("j1_transactions_with_articles", f"""{JOINED_SQL}
SELECT order_id, line_no, customer_id, article_id, price, product_group_name, department_name, colour_group_name,
  index_name FROM joined""", doubles=("price",))
def j1(spark, sf_dir):
    tx = retail.transactions(spark, sf_dir).select("order_id", "line_no", "customer_id", "article_id", "price")
    return inter.with_article_attributes(tx, retail.articles(spark, sf_dir))


J2_SQL = f"""{CUSTOMER_SQL}{CUSTOMER_TEMPORAL_SQL}{PREFERENCE_SQL}
SELECT * FROM customer_basic LEFT JOIN customer_temporal USING (customer_id)
LEFT JOIN customer_preferences USING (customer_id)"""
J2_DOUBLES = ("FN", "Active", "age", "age_filled", *CT_DOUBLES, *PREFERENCE_DOUBLES)


@query("j2_customer_table", J2_SQL, doubles=J2_DOUBLES)
def customer_table(spark, sf_dir):
    return features.customer_table(
        retail.customers(spark, sf_dir), retail.transactions(spark, sf_dir), retail.articles(spark, sf_dir),
        reference_date=REF,
    )


J3_SQL = f"""{ARTICLE_SQL}{ARTICLE_TEMPORAL_SQL}{POPULARITY_SQL}
SELECT * FROM article_basic LEFT JOIN article_temporal USING (article_id)
LEFT JOIN (SELECT * EXCLUDE (unique_customers) FROM article_popularity) USING (article_id)"""


@query("j3_article_table", J3_SQL, doubles=("list_price", "avg_sales_per_day", *POPULARITY_DOUBLES))
def article_table(spark, sf_dir):
    return features.article_table(
        retail.articles(spark, sf_dir), retail.transactions(spark, sf_dir), reference_date=REF
    )


@query("j4_shared_keys", f"""
SELECT 'customer_id' AS key_name, customer_id AS key_value FROM (
  SELECT DISTINCT customer_id FROM tx INTERSECT SELECT customer_id FROM customers)
UNION ALL
SELECT 'article_id', article_id FROM (SELECT article_id FROM tx INTERSECT SELECT article_id FROM articles)""")
def j4(spark, sf_dir):
    tx = retail.transactions(spark, sf_dir)
    shared = [
        inter.shared_keys(tx, side, key).select(F.lit(key).alias("key_name"), F.col(key).alias("key_value"))
        for side, key in ((retail.customers(spark, sf_dir), "customer_id"),
                          (retail.articles(spark, sf_dir), "article_id"))
    ]
    return shared[0].unionByName(shared[1])


@query("j5_affinity_of_pairs", f"""{PREFERENCE_SQL}
, pairs AS (SELECT DISTINCT customer_id, article_id FROM tx)
SELECT customer_id, article_id, CASE WHEN favorite_department = department_name THEN CAST(1 AS DOUBLE)
  ELSE CAST(0.5 AS DOUBLE) END AS department_affinity
FROM pairs JOIN customer_preferences USING (customer_id) JOIN articles USING (article_id)""",
       doubles=("department_affinity",))
def j5_pairs(spark, sf_dir):
    pairs = retail.transactions(spark, sf_dir).select("customer_id", "article_id").distinct()
    return inter.affinity_of_pairs(pairs, _preferences(spark, sf_dir), retail.articles(spark, sf_dir))


@query("j5_affinity_matrix_summary", f"""{PREFERENCE_SQL}
SELECT p.customer_id, favorite_department,
  count(*) FILTER (department_name = favorite_department) AS matching_articles,
  count(*) FILTER (department_name IS DISTINCT FROM favorite_department) AS other_articles,
  avg(CASE WHEN department_name = favorite_department THEN 1.0 ELSE 0.5 END) AS mean_affinity
FROM customer_preferences p, (SELECT * FROM articles WHERE article_id IN (SELECT article_id FROM tx)) a
GROUP BY ALL""", doubles=("mean_affinity",))
def j5_summary(spark, sf_dir):
    return inter.affinity_summary(
        retail.transactions(spark, sf_dir), _preferences(spark, sf_dir), retail.articles(spark, sf_dir)
    )


@query("j5_affinity_grid", f"""{PREFERENCE_SQL}
, active AS (SELECT customer_id FROM tx GROUP BY 1 ORDER BY count(*) DESC, customer_id LIMIT 100)
, selling AS (SELECT article_id FROM tx GROUP BY 1 ORDER BY count(*) DESC, article_id LIMIT 50)
SELECT customer_id, article_id, CASE WHEN favorite_department = department_name THEN CAST(1 AS DOUBLE)
  ELSE CAST(0.5 AS DOUBLE) END AS department_affinity
FROM active CROSS JOIN selling JOIN customer_preferences USING (customer_id) JOIN articles USING (article_id)""",
       doubles=("department_affinity",))
def j5_grid(spark, sf_dir):
    return inter.affinity_grid(
        retail.transactions(spark, sf_dir), _preferences(spark, sf_dir), retail.articles(spark, sf_dir)
    )


@query("j5_best_articles", f"""{PREFERENCE_SQL}
, sold AS (SELECT article_id, any_value(department_name) AS department_name, count(*) AS sales
  FROM tx JOIN articles USING (article_id) GROUP BY article_id)
SELECT customer_id, article_id, CASE WHEN favorite_department = department_name THEN CAST(1 AS DOUBLE)
  ELSE CAST(0.5 AS DOUBLE) END AS department_affinity,
  row_number() OVER (PARTITION BY customer_id ORDER BY favorite_department IS NOT DISTINCT FROM department_name DESC,
    sales DESC, article_id) AS rank
FROM customer_preferences CROSS JOIN sold QUALIFY rank <= 20""", doubles=("department_affinity",))
def j5_best(spark, sf_dir):
    transactions, articles = retail.transactions(spark, sf_dir), retail.articles(spark, sf_dir)
    return inter.best_articles(_preferences(spark, sf_dir), articles, transactions, k=20)


@query("j5_article_affinity", f"""{PREFERENCE_SQL}
SELECT article_id, count(*) FILTER (favorite_department = department_name) AS matching_customers,
  sum(CASE WHEN favorite_department = department_name THEN 1.0 ELSE 0.5 END) AS total_affinity
FROM customer_preferences CROSS JOIN articles GROUP BY article_id""", doubles=("total_affinity",))
def j5_articles(spark, sf_dir):
    return inter.article_affinity(_preferences(spark, sf_dir), retail.articles(spark, sf_dir))


SALES_WINDOWS = {"last_year": ("2000-08", "2001-07"), "spring_2000": ("2000-03", "2000-05"), "ever": ("0000-00", "9999-99")}


def _sketches(spark, sf_dir):
    return inter.monthly_sketches(retail.transactions(spark, sf_dir))


@query("i6_distinct_windows", "SELECT article_id, " + ", ".join(
    f"count(DISTINCT customer_id) FILTER (strftime(t_dat, '%Y-%m') BETWEEN '{a}' AND '{b}') AS {name}"
    for name, (a, b) in SALES_WINDOWS.items()) + " FROM tx GROUP BY article_id")
def i6_distinct(spark, sf_dir):
    return inter.distinct_in_windows(_sketches(spark, sf_dir), SALES_WINDOWS)


@query("i6_retention", """
, seen AS (SELECT DISTINCT article_id, customer_id, year(t_dat) AS y FROM tx WHERE year(t_dat) IN (1999, 2000))
, pairs AS (SELECT article_id, customer_id, count(*) = 2 AS again, min(y) AS first FROM seen GROUP BY ALL)
SELECT article_id, count(*) FILTER (again) AS retained, count(*) FILTER (NOT again AND first = 1999) AS lost
FROM (SELECT DISTINCT article_id FROM tx) LEFT JOIN pairs USING (article_id) GROUP BY article_id""")
def i6_retained(spark, sf_dir):
    return inter.retained(_sketches(spark, sf_dir), ("1999-01", "1999-12"), ("2000-01", "2000-12"))


query("p1_training_features_customers", J2_SQL, doubles=J2_DOUBLES)(
    lambda spark, sf_dir: features.training_features(
        retail.customers(spark, sf_dir), retail.articles(spark, sf_dir), retail.transactions(spark, sf_dir),
        reference_date=REF)[0]
)
query("p1_training_features_articles", J3_SQL,
      doubles=("list_price", "avg_sales_per_day", *POPULARITY_DOUBLES))(
    lambda spark, sf_dir: features.training_features(
        retail.customers(spark, sf_dir), retail.articles(spark, sf_dir), retail.transactions(spark, sf_dir),
        reference_date=REF)[1]
)


def _gap_sql() -> str:
    produced = {
        "age": ("customer_basic", "age"), "age_group": ("customer_basic", "age_group"),
        "club_member_status": ("customer_basic", "club_member_status"),
    }
    zero = {
        "days_since_last_purchase", "avg_days_between_purchases", "favorite_department", "department_diversity",
        "favorite_color", "avg_purchase_price", "price_range",
    }
    sides = {
        "customer_temporal": "customer_temporal", "customer_preference": "customer_preferences",
    }
    parts = []
    for group, name in features.feature_catalogue():
        if not group.startswith("customer"):
            continue
        if name in produced:
            table, column = produced[name]
            rate = f"(SELECT avg(CAST({column} IS NULL AS INT)) FROM {table})"
        elif name in zero:
            rate = (f"(SELECT avg(CAST({name} IS NULL AS INT)) FROM customer_basic "
                    f"LEFT JOIN {sides[group]} USING (customer_id))")
        else:
            rate = "CAST(NULL AS DOUBLE)"
        made = str(name in produced or name in zero).lower()
        parts.append(f"SELECT '{group}' AS feature_group, '{name}' AS feature, {made} AS produced, "
                     f"{rate} AS null_rate")
    return "\nUNION ALL ".join(parts)


@query("p2_feature_gap", f"{CUSTOMER_SQL}{CUSTOMER_TEMPORAL_SQL}{PREFERENCE_SQL}{_gap_sql()}",
       doubles=("null_rate",))
def p2(spark, sf_dir):
    groups = ("customer_demographic", "customer_temporal", "customer_preference")
    return features.feature_gap(customer_table(spark, sf_dir), groups)
