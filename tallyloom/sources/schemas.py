"""Declared types of the three retail tables (fixed values, file column order)."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(),
    "smallint": T.ShortType(), "tinyint": T.ByteType(),
}


def _schema(columns: str) -> T.StructType:
    pairs = (entry.split() for entry in columns.split(","))
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


CUSTOMERS = _schema(
    "customer_id string, FN double, Active double, club_member_status string, "
    "fashion_news_frequency string, age double, postal_code string"
)

ARTICLES = _schema(
    "article_id int, product_code int, prod_name string, "
    "product_type_no smallint, product_type_name string, product_group_name string, "
    "graphical_appearance_no smallint, graphical_appearance_name string, "
    "colour_group_code tinyint, colour_group_name string, "
    "perceived_colour_value_id tinyint, perceived_colour_value_name string, "
    "perceived_colour_master_id tinyint, perceived_colour_master_name string, "
    "department_no smallint, department_name string, "
    "index_code string, index_name string, index_group_no tinyint, index_group_name string, "
    "section_no smallint, section_name string, "
    "garment_group_no smallint, garment_group_name string, detail_desc string"
)

TRANSACTIONS = _schema(
    "t_dat string, customer_id string, article_id int, price double, sales_channel_id tinyint"
)

# Field texts that the pandas CSV reader takes as missing.
MISSING_TEXTS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
