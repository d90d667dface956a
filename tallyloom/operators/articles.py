"""Article features: category codes, style flags, text length, selling prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.expressions import bin_label, flag, safe_ratio
from tallyloom.functions.ordering import dense_rank_of_values
from tallyloom.operators.customers import edge_labels
from tallyloom.session import stored

# Fixed values
PRICE_EDGES = (0, 0.01, 0.02, 0.03, 0.05, 0.1, 0.2, 0.5, 1.0)
DEFAULT_PRICE = 0.05
NEUTRAL_COLOURS = ("Black", "White", "Grey", "Beige")
PATTERNS = ("Striped", "Spotted", "Checked")
UPPER_BODY = ("Jersey Basic", "Jersey Fancy", "Knitwear")
LOWER_BODY = ("Trousers", "Shorts", "Skirts")
FULL_BODY = ("Dresses", "Jumpsuit")
CODED = {
    "department_idx": "department_name",
    "product_group_idx": "product_group_name",
    "product_type_idx": "product_type_name",
    "section_idx": "section_name",
}


def is_menswear(index_name: Column) -> Column:
    """Index name holds "men" in any case ("Womenswear" does)."""
    return F.coalesce(F.lower(index_name).contains("men"), F.lit(False))


def is_kidswear(index_name: Column) -> Column:
    """Index name holds "children" or "baby" in any case."""
    lowered = F.lower(index_name)
    return F.coalesce(lowered.contains("children") | lowered.contains("baby"), F.lit(False))


def category_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): 0-based place of each text among the sorted values of its column."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    places = dense_rank_of_values(texts, ["column"], "value", "_place")
    return places.select("column", "value", (F.col("_place") - 1).cast("int").alias("code"))


def category_codes(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add code columns {output: source}: 0-based place among the sorted values, NULL is -1.

    The dictionary is stored first. Its size is then known when the joins are planned: Spark
    broadcasts a small one and sort-merge joins any other, splitting frequent values.
    """
    dictionary = stored(category_dictionary(df, list(dict.fromkeys(columns.values()))), "dictionary")
    out = df
    for code, source in columns.items():
        values = dictionary.where(F.col("column") == source).select(
            F.col("value").alias(source), F.col("code").alias(code)
        )
        out = out.join(values, source, "left").withColumn(code, F.coalesce(F.col(code), F.lit(-1)))
    return out.select(*df.columns, *columns)


def category_path() -> Column:
    """department/group/type, a missing part printed as ``nan``."""
    parts = ("department_name", "product_group_name", "product_type_name")
    return F.concat_ws("/", *[F.coalesce(F.col(p), F.lit("nan")) for p in parts])


def style_columns() -> list[Column]:
    """All article features that need only the article's own row."""
    colour, look = F.col("colour_group_name"), F.col("graphical_appearance_name")
    index, garment = F.col("index_name"), F.col("garment_group_name")
    men, kids = is_menswear(index), is_kidswear(index)
    return [
        category_path().alias("category_path"),
        flag(colour == "Black").alias("is_black"),
        flag(colour == "White").alias("is_white"),
        flag(colour.isin(*NEUTRAL_COLOURS)).alias("is_neutral_color"),
        (~look.eqNullSafe("Solid")).cast("int").alias("has_graphic"),
        flag(look.isin(*PATTERNS)).alias("is_patterned"),
        men.cast("int").alias("is_menswear"),
        kids.cast("int").alias("is_kidswear"),
        (~men & ~kids).cast("int").alias("is_womenswear"),
        flag(F.col("section_name") == "Divided").alias("is_divided"),
        flag(garment.isin(*UPPER_BODY)).alias("is_upper_body"),
        flag(garment.isin(*LOWER_BODY)).alias("is_lower_body"),
        flag(garment.isin(*FULL_BODY)).alias("is_full_body"),
        F.col("detail_desc").isNotNull().cast("int").alias("has_description"),
        F.length(F.coalesce("detail_desc", F.lit(""))).alias("description_length"),
    ]


def article_features(articles: DataFrame) -> DataFrame:
    """All article features appended to the article columns."""
    return category_codes(articles.select("*", *style_columns()), CODED)


def price_range(price: Column, edges: Sequence[float] = PRICE_EDGES) -> Column:
    """Right-closed price bins with two-decimal labels."""
    return bin_label(price, edges, edge_labels(edges, "{:.2f}-{:.2f}"))


def price_features(
    articles: DataFrame,
    transactions: DataFrame | None = None,
    *,
    edges: Sequence[float] = PRICE_EDGES,
) -> DataFrame:
    """Selling-price statistics and price bin per article; unsold articles keep NULL prices.

    Without transactions every article gets the default middle price.
    """
    if transactions is None:
        priced = articles.withColumn("avg_selling_price", F.lit(DEFAULT_PRICE))
    else:
        stats = transactions.where(F.col("article_id").isNotNull()).groupBy("article_id").agg(
            F.avg("price").alias("avg_selling_price"),
            F.stddev_samp("price").alias("price_std"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
        )
        volatility = F.coalesce(safe_ratio(F.col("price_std"), F.col("avg_selling_price")), F.lit(0.0))
        priced = articles.join(stats, "article_id", "left").withColumn("price_volatility", volatility)
    return priced.withColumn("price_range", price_range(F.col("avg_selling_price"), edges))
