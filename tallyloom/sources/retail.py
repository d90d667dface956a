"""Retail tables seen through the star-schema tables.

Every column is an SQL expression, stated once and used by Spark (``selectExpr``) and, as the text
of a common table expression, by the SQL each query is compared with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REFERENCE_DATE = "2001-08-01"  # last order date of the tables

# A prime just above the highest price: prices lie below 1, and means of few prices do not fall
# halfway between two rounded values, where two engines may round differently.
PRICE_UNIT = 105019

TX_COLUMNS = {
    "customer_id": "o_custkey",
    "article_id": "l_partkey",
    "t_dat": "CAST(o_orderdate AS DATE)",
    "price": f"l_extendedprice / CAST({PRICE_UNIT} AS DOUBLE)",
    "sales_channel_id": "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END",
    "order_id": "l_orderkey",
    "line_no": "l_linenumber",
    "supplier_id": "l_suppkey",
    "amount_cents": "CAST(round(l_extendedprice * 100) AS BIGINT)",
    "quantity": "l_quantity",
    "returned": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
}

CUSTOMER_COLUMNS = {
    "customer_id": "c_custkey",
    "FN": "CASE WHEN c_acctbal > 5000 THEN CAST(1 AS DOUBLE) END",
    "Active": "CASE WHEN c_acctbal > 0 THEN CAST(1 AS DOUBLE) END",
    "club_member_status": (
        "CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'ACTIVE' "
        "WHEN c_mktsegment = 'MACHINERY' THEN 'PRE-CREATE' "
        "WHEN c_mktsegment = 'HOUSEHOLD' THEN 'LEFT CLUB' END"
    ),
    "fashion_news_frequency": (
        "CASE c_nationkey % 4 WHEN 0 THEN 'NONE' WHEN 1 THEN 'Monthly' WHEN 2 THEN 'Regularly' END"
    ),
    "age": "CASE WHEN c_custkey % 17 <> 0 THEN CAST(16 + c_custkey % 90 AS DOUBLE) END",
    "postal_code": "CAST(10000 + c_custkey % 997 AS VARCHAR(16))",
}

ARTICLE_COLUMNS = {
    "article_id": "p_partkey",
    "prod_name": "p_name",
    "product_type_name": "split_part(p_name, ' ', 2)",
    "product_group_name": "p_type",
    "graphical_appearance_name": (
        "CASE p_size % 4 WHEN 0 THEN 'Solid' WHEN 1 THEN 'Striped' WHEN 2 THEN 'All over pattern' END"
    ),
    "colour_group_name": (
        "CASE split_part(p_name, ' ', 1) WHEN 'cold' THEN 'Black' WHEN 'hot' THEN 'White' "
        "WHEN 'old' THEN 'Grey' WHEN 'red' THEN 'Red' WHEN 'blue' THEN 'Blue' END"
    ),
    "department_name": "p_brand",
    "index_name": (
        "CASE p_size % 6 WHEN 0 THEN 'Ladieswear' WHEN 1 THEN 'Menswear' "
        "WHEN 2 THEN 'Children Sizes 92-140' WHEN 3 THEN 'Baby Sizes 50-98' "
        "WHEN 4 THEN 'Divided' END"
    ),
    "section_name": "CASE WHEN p_size % 5 = 0 THEN 'Divided' ELSE p_type END",
    "garment_group_name": (
        "CASE p_size % 7 WHEN 0 THEN 'Jersey Basic' WHEN 1 THEN 'Knitwear' WHEN 2 THEN 'Trousers' "
        "WHEN 3 THEN 'Shorts' WHEN 4 THEN 'Dresses' WHEN 5 THEN 'Accessories' END"
    ),
    "detail_desc": "CASE WHEN p_partkey % 11 <> 0 THEN p_name END",
    "size_no": "p_size",
    "list_price": "p_retailprice",
}


def _exprs(columns: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in columns.items()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.selectExpr(*_exprs(TX_COLUMNS))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*_exprs(CUSTOMER_COLUMNS))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*_exprs(ARTICLE_COLUMNS))


def view_sql() -> dict[str, str]:
    """The same views as SQL text."""
    return {
        "tx": f"SELECT {', '.join(_exprs(TX_COLUMNS))} FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
        "customers": f"SELECT {', '.join(_exprs(CUSTOMER_COLUMNS))} FROM customer",
        "articles": f"SELECT {', '.join(_exprs(ARTICLE_COLUMNS))} FROM part",
    }
