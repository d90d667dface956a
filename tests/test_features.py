"""Hand-computed feature values, NULL, tie and edge rows."""

from __future__ import annotations

import datetime

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.operators import articles as art
from tallyloom.operators import customers as cust
from tallyloom.operators import interactions as inter
from tallyloom.operators import temporal as temp
from tallyloom.plans import features

D = datetime.date


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [("c1", 1.0, 1.0, "ACTIVE", "Regularly", 25.0, "12345"),
         ("c2", 0.5, 1.0, "ACTIVE", "Monthly", 30.0, "67890"),
         ("c3", 0.0, 0.0, "LEFT CLUB", "NONE", 35.0, "11111")],
        "customer_id string, FN double, Active double, club_member_status string, "
        "fashion_news_frequency string, age double, postal_code string",
    )


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame(
        [(1, "Menswear", "Garment Upper body", "T-shirt", "Red", "Solid", "Ladieswear", "S1", "Jersey Basic", "Jersey top"),
         (2, "Ladieswear", "Garment Lower body", "Jeans", "Blue", "Solid", "Menswear", "Divided", "Denim", "Blue jeans"),
         (3, "Sport", "Shoes", "Shoes", "Black", "Solid", "Sport", None, "Footwear", "Black shoes"),
         (4, "Accessories", "Accessories", "Hat", "White", "Solid", "Accessories", "S1", "Hat/Cap", "White hat")],
        "article_id int, department_name string, product_group_name string, product_type_name string, "
        "colour_group_name string, graphical_appearance_name string, index_name string, section_name string, "
        "garment_group_name string, detail_desc string",
    )


@pytest.fixture(scope="module")
def transactions(spark):
    return spark.createDataFrame(
        [(D(2023, 1, 1), "c1", 1, 10.0), (D(2023, 1, 2), "c2", 2, 20.0), (D(2023, 1, 3), "c1", 3, 15.0),
         (D(2023, 1, 4), "c3", 1, 10.0)],
        "t_dat date, customer_id string, article_id int, price double",
    )


def test_customer_features(customers):
    got = rows(cust.customer_features(customers).select(
        "customer_id", "age_group", "has_FN", "is_active", "fashion_news_score", "receives_fashion_news",
        "lifecycle_stage"), "customer_id")
    assert got == [("c1", "20-25", 1, 1, 2, 1, "loyal"), ("c2", "25-30", 0, 1, 1, 1, "engaged"),
                   ("c3", "30-35", 0, 0, 0, 1, "inactive")]


def test_age_bins_and_fill(spark):
    df = spark.createDataFrame(
        [(i, a, None, None, None, None) for i, a in enumerate([0.0, 20.0, 20.5, 100.0, 101.0, None, float("nan")])],
        "customer_id int, age double, FN double, Active double, club_member_status string, fashion_news_frequency string",
    )
    got = rows(cust.customer_features(df).select("customer_id", "age_group", "age_filled", "is_age_missing",
                                                 "club_member_status_filled", "fashion_news_frequency_filled",
                                                 "receives_fashion_news", "lifecycle_stage"), "customer_id")
    assert [r[1] for r in got] == ["0-20", "0-20", "20-25", "70-100", None, None, None]
    assert [r[2] for r in got[5:]] == [20.5, 20.5] and [r[3] for r in got] == [0] * 5 + [1, 1]
    assert got[0][4:] == ("UNKNOWN", "NONE", 0, "inactive")
    fixed = cust.customer_features(df, fill_age=35, age_edges=(16, 25, 35, 45, 55, 65, 99))
    assert [tuple(r) for r in fixed.where("customer_id in (2, 5)").select("age_group", "age_filled").collect()] == [
        ("16-25", 20.5), (None, 35.0)]


def test_median_of_even_count_and_of_nothing(spark):
    even = spark.createDataFrame([(1.0,), (4.0,), (None,)], "age double")
    assert even.select(cust.median(even, "age")).first()[0] == 2.5
    empty = spark.createDataFrame([(None,), (None,)], "age double")
    assert empty.select(cust.median(empty, "age")).first()[0] is None


def test_new_and_casual_customers(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 1.0, None, "other", 20.0), (2, 1.0, 1.0, "PRE-CREATE", None, 20.0)],
        "customer_id int, FN double, Active double, club_member_status string, fashion_news_frequency string, age double")
    assert rows(cust.customer_features(df).select("lifecycle_stage", "fashion_news_score"), "customer_id") == [
        ("casual", 0), ("new", 0)]


def test_article_features(articles):
    got = rows(art.article_features(articles).select(
        "article_id", "department_idx", "is_menswear", "is_upper_body", "is_black", "description_length", "section_idx",
        "is_divided"), "article_id")
    assert got == [(1, 2, 0, 1, 0, 10, 1, 0), (2, 1, 1, 0, 0, 10, 0, 1), (3, 3, 0, 0, 1, 11, -1, 0),
                   (4, 0, 0, 0, 0, 9, 1, 0)]


def test_article_flags_of_missing_values(spark):
    df = spark.createDataFrame(
        [(1, None, None, None, None, None, None, None, None, None),
         (2, "a", None, "c", "Beige", "Striped", "Womenswear", "x", "Dresses", ""),
         (3, "a", "b", "c", "Grey", "Checked", "menchildren", "x", "Shorts", "é—x")],
        "article_id int, department_name string, product_group_name string, product_type_name string, "
        "colour_group_name string, graphical_appearance_name string, index_name string, section_name string, "
        "garment_group_name string, detail_desc string")
    got = rows(art.article_features(df).select(
        "category_path", "is_neutral_color", "has_graphic", "is_patterned", "is_menswear", "is_kidswear", "is_womenswear",
        "is_lower_body", "is_full_body", "has_description", "description_length"), "article_id")
    assert got == [("nan/nan/nan", 0, 1, 0, 0, 0, 1, 0, 0, 0, 0), ("a/nan/c", 1, 1, 1, 1, 0, 0, 0, 1, 1, 0),
                   ("a/b/c", 1, 1, 1, 1, 1, 0, 1, 0, 1, 3)]


def test_price_features(spark, articles, transactions):
    got = rows(art.price_features(articles.select("article_id"), transactions.withColumn("price", F.col("price") / 100)),
               "article_id")
    assert got[0][:2] == (1, 0.1) and got[0][2] == pytest.approx(0) and got[0][-1] == "0.05-0.10"
    assert got[1] == (2, 0.2, None, 0.2, 0.2, 0.0, "0.10-0.20")
    assert got[3] == (4, None, None, None, None, 0.0, None)
    default = art.price_features(articles.select("article_id")).first()
    assert (default["avg_selling_price"], default["price_range"]) == (0.05, "0.03-0.05")


def test_customer_temporal(transactions):
    got = temp.customer_temporal(transactions, reference_date="2023-01-31").where("customer_id = 'c1'").first().asDict()
    assert got == {
        "customer_id": "c1", "days_since_last_purchase": 28, "days_since_first_purchase": 30,
        "customer_lifespan_days": 2, "total_transactions": 2, "avg_days_between_purchases": 1.0, "favorite_month": 1,
        "weekend_purchase_ratio": 0.5, "purchases_last_30_days": 2, "purchases_last_90_days": 2,
        "is_active_customer": True}


def test_temporal_edges(spark):
    df = spark.createDataFrame(
        [("a", 1, D(2023, 3, 5)), ("b", 1, D(2023, 4, 9)), ("b", 2, D(2023, 2, 1)), (None, 1, D(2023, 1, 1)),
         ("a", None, D(2023, 3, 5))],
        "customer_id string, article_id int, t_dat date")
    got = {r["customer_id"]: r for r in temp.customer_temporal(df, reference_date="2023-04-04").collect()}
    assert set(got) == {"a", "b"}
    assert got["a"]["purchases_last_30_days"] == 2  # exactly 30 days before still counts
    assert got["b"]["days_since_last_purchase"] == -5 and got["b"]["favorite_month"] == 2
    art_rows = {r["article_id"]: r for r in temp.article_temporal(df, reference_date="2023-04-04").collect()}
    assert set(art_rows) == {1, 2} and art_rows[1]["unique_customers"] == 2 and art_rows[1]["total_sales"] == 3


def test_estimated_distinct_customers(spark):
    df = spark.range(2000).selectExpr("id % 1000 AS customer_id", "1 AS article_id", "DATE '2023-01-01' AS t_dat")
    got = temp.article_temporal(df, reference_date="2023-01-02", approximate=True).first()
    assert 900 < got["unique_customers"] < 1100 and got["total_sales"] == 2000


def test_timestamps_are_floored(spark):
    df = spark.createDataFrame([("a", datetime.datetime(2023, 1, 2, 23, 0))], "customer_id string, t_dat timestamp_ntz")
    got = temp.customer_temporal(df, reference_date="2023-01-02").first()
    assert got["days_since_last_purchase"] == -1


def test_temporal_needs_dates(spark):
    df = spark.createDataFrame([("a", "2023-01-01")], "customer_id string, t_dat string")
    with pytest.raises(TypeError):
        temp.customer_temporal(df)


def test_popularity(transactions):
    got = rows(inter.article_popularity(transactions).select(
        "article_id", "total_purchases", "unique_customers", "popularity_score", "popularity_rank", "is_bestseller"),
        "article_id")
    assert got == [(1, 2, 2, 2.0, 1, True), (2, 1, 1, 1.0, 2, True), (3, 1, 1, 1.0, 2, True)]


def test_preferences_ties_and_unknown(spark, articles):
    tx = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 3, 3.0), ("b", 99, 2.0), ("c", 3, 5.0), ("c", 3, 5.0), ("c", 2, 5.0), (None, 1, 1.0)],
        "customer_id string, article_id int, price double")
    got = {r["customer_id"]: r for r in inter.customer_preferences(tx, articles).collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["a"]["favorite_department"] == "Menswear" and got["a"]["department_concentration"] == 0.5
    assert got["a"]["price_range"] == 2.0 and got["a"]["favorite_color"] == "Black" and got["a"]["prefers_black"]
    assert got["b"]["favorite_department"] == "Unknown" and got["b"]["department_diversity"] == 0
    assert got["b"]["department_concentration"] == 0 and got["b"]["price_std"] is None
    assert got["b"]["womenswear_ratio"] == 1.0 and not got["b"]["prefers_black"]
    assert got["c"]["favorite_department"] == "Sport" and got["c"]["menswear_ratio"] == pytest.approx(1 / 3)


def test_affinity(spark, articles, transactions):
    preferences = spark.createDataFrame([("c1", "Sport"), ("c9", "Sport")], "customer_id string, favorite_department string")
    pairs = spark.createDataFrame([("c1", a) for a in (1, 2, 3, 4, 77)], "customer_id string, article_id int")
    got = rows(inter.affinity_of_pairs(pairs, preferences, articles), "article_id")
    assert [r[2] for r in got] == [0.5, 0.5, 1.0, 0.5]
    grid = rows(inter.affinity_grid(transactions, preferences, articles, max_customers=1, max_articles=2), "article_id")
    assert grid == [("c1", 1, 0.5), ("c1", 2, 0.5)]
    summary = inter.affinity_summary(transactions, preferences, articles).first()
    assert tuple(summary) == ("c1", "Sport", 1, 2, pytest.approx(2 / 3))


def test_assembled_tables(spark, customers, articles, transactions):
    more = customers.unionByName(customers.limit(1).withColumn("customer_id", F.lit("c0")))
    c, a = features.training_features(more, articles, transactions, reference_date="2023-01-31")
    assert c.count() == 4 and a.count() == 4
    assert c.columns.count("price_std") == 1 and a.columns.count("unique_customers") == 1
    idle = c.where("customer_id = 'c0'").first()
    assert idle["total_transactions"] is None and idle["favorite_department"] is None
    assert features.fill_declared(c).where("customer_id = 'c0'").first()["days_since_last_purchase"] == 365
    gap = {r["feature"]: r for r in features.feature_gap(c, ("customer_temporal",)).collect()}
    assert gap["days_since_last_purchase"]["null_rate"] == 0.25 and not gap["purchase_frequency"]["produced"]


def test_shared_aggregates_equal_separate_ones(customers, articles, transactions):
    table = features.customer_table(customers, transactions, articles, reference_date="2023-01-31")
    history = temp.customer_temporal(transactions, reference_date="2023-01-31")
    preferences = inter.customer_preferences(transactions, articles)
    for part in (history, preferences):
        assert rows(table.select(part.columns), "customer_id") == rows(part, "customer_id")


def test_training_features_read_the_transactions_once(customers, articles, transactions, monkeypatch):
    """Both tables come from the same stored pairs and equal the separate ones, also with rows without customer or article."""
    odd = [transactions.withColumn(c, F.lit(None).cast(transactions.schema[c].dataType)) for c in ("customer_id", "article_id")]
    more = transactions.unionByName(odd[0]).unionByName(odd[1])
    seen, real = [], inter.with_popularity
    monkeypatch.setattr(inter, "with_popularity", lambda grouped: seen.append(grouped) or real(grouped))
    c, a = features.training_features(customers, articles, more, reference_date="2023-01-31")
    assert seen[0].inputFiles() and all("pair-counts" in f for f in seen[0].inputFiles())
    for got, alone, key in ((c, features.customer_table(customers, more, articles, reference_date="2023-01-31"), "customer_id"),
                            (a, features.article_table(articles, more, reference_date="2023-01-31"), "article_id")):
        assert got.columns == alone.columns and got.dtypes == alone.dtypes
        rounded = [[tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(t, key)] for t in (got, alone)]
        assert rounded[0] == rounded[1]
