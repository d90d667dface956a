"""Quality profiles: worked values, constants, NaN and NULL, empty tables."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.functions import frequent
from tallyloom.operators import explore as x
from tallyloom.operators import quality as q


def numbers(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")


def test_missing_values(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, "a")], "x double, t string")
    by_column = q.missing_by_column(df)
    assert [(r["column"], r["missing_count"], r["quality_flag"]) for r in by_column.collect()] == [
        ("x", 2, "poor"), ("t", 2, "poor")]
    overall = q.missing_overall(by_column).first()
    assert (overall["total_missing"], overall["total_values"]) == (4, 6)
    assert overall["quality_score"] == pytest.approx(1 / 3)
    assert q.missing_summary(by_column).first()["high_missing_columns"] == "t, x"


def test_outliers(spark):
    got = q.outliers(numbers(spark, [1, 2, 3, 4, 5, 6, 7, 8, 9, 100, None])).first()
    assert (got["lower_bound"], got["upper_bound"]) == (-3.5, 14.5)
    assert (got["iqr_count"], got["zscore_count"], got["median"]) == (1, 0, 5.5)
    assert q.outliers(numbers(spark, range(9))).count() == 0
    constant = q.outliers(numbers(spark, [5] * 10)).first()
    assert (constant["iqr_count"], constant["zscore_count"]) == (0, 0)


def test_repeated_outliers_count_each_row(spark):
    got = q.outliers(numbers(spark, [0.0, 1.0] * 500 + [50.0] * 3)).first()
    assert (got["iqr_count"], got["zscore_count"]) == (3, 3)


def test_distributions(spark):
    got = q.numeric_distributions(numbers(spark, [1, 2, 4, 9, 11, float("nan")])).first()
    assert got["skewness"] == pytest.approx(0.467046, abs=1e-6)
    assert got["kurtosis"] == pytest.approx(-2.416978, abs=1e-6)
    assert (got["count"], got["unique_values"], got["q25"], got["q75"]) == (5, 5, 2.0, 9.0)
    constant = q.numeric_distributions(numbers(spark, [3, 3, 3, 3])).first()
    assert (constant["skewness"], constant["kurtosis"]) == (0.0, 0.0)
    two = q.numeric_distributions(numbers(spark, [3, 4])).first()
    assert (two["skewness"], two["kurtosis"]) == (None, None)
    assert q.numeric_distributions(numbers(spark, [3])).count() == 0


def test_value_ranges(spark):
    got = q.value_ranges(numbers(spark, [-1, 0, 1])).first()
    assert got["coefficient_of_variation"] == float("inf") and got["range_span"] == 2
    assert got["has_negative"] and got["has_zero"] and got["has_positive"]


def test_categorical(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("c", None)], "t string, empty string")
    got = {r["column"]: r for r in q.categorical_distributions(df, top=2).collect()}
    assert got["t"]["most_frequent"] == "b" and got["t"]["least_frequent"] == "c"
    assert got["t"]["top_values"] == {"b": 2, "a": 1} and got["t"]["cardinality_rate"] == 0.75
    assert got["empty"]["count"] == 0 and got["empty"]["most_frequent"] is None


def test_duplicates_and_report(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "a")], "i int, t string")
    assert tuple(q.duplicate_rows(df).first()) == (2, 0.5)
    report = q.quality_report(df, "d").first()
    assert report["rows"] == 4 and report["score"] == pytest.approx((1 - 3 / 8 + 0.5) / 2) and report["grade"] == "C"
    assert [r["code"] for r in q.recommendations(df).collect()] == ["high_missing", "duplicate_rows"]
    empty = df.limit(0)
    assert tuple(q.duplicate_rows(empty).first()) == (0, 0.0)


def test_type_profile(spark):
    df = spark.createDataFrame([("1", "2020-01-01", "x"), ("2.5", "2021-02-03", "3"), (None, None, "y")],
                               "n string, d string, m string")
    got = {r["column"]: r for r in q.type_profile(df).collect()}
    assert got["n"]["number_share"] == 1.0 and got["d"]["date_share"] == 1.0
    assert got["n"]["type_consistency"] and got["d"]["type_consistency"] and not got["m"]["type_consistency"]
    assert [tuple(r) for r in q.recommendations(df).collect()] == [("mixed_types", "m")]


def test_mean_score_is_never_graded_d(spark):
    bad = spark.createDataFrame([(None,)] * 5, "v int")
    got = rows(q.quality_scores({"bad": bad}).select("dataset", "grade"), "dataset")
    assert got == [("average", "C"), ("bad", "D")]


def test_top_values_and_all_values(spark):
    df = spark.createDataFrame([(str(i % 7), str(i % 3)) for i in range(21)], "many string, few string").repartition(5)
    got = x.top_values(df, ["many", "few"], top=2)
    assert got.where("column = 'many'").count() == 2 and {r["more"] for r in got.collect()} == {5, 1}
    every = x.top_values(df, ["many", "few"])
    listed = {c: [r["value"] for r in every.where(F.col("column") == c).orderBy("rank").collect()] for c in ("many", "few")}
    assert listed == {"many": [str(i) for i in range(7)], "few": ["0", "1", "2"]}
    assert every.agg(F.max("more"), F.max("rank")).first()[:] == (0, 7)


@pytest.mark.parametrize("buckets", [16, 1 << 16])
def test_frequent_values_equal_counting(spark, buckets):
    rng = random.Random(3)
    hot = ["hot"] * 500 + ["warm"] * 90
    skewed = [rng.choice(hot) if rng.random() < 0.5 else f"v{rng.randrange(400)}" for _ in range(3000)]
    even = [f"k{i % 1000}" for i in range(3000)]  # every value three times: ties alone decide
    few = ["a", None, "b", "b"] + [None] * 2996
    df = spark.createDataFrame(list(zip(skewed, even, few)), "skewed string, even string, few string").repartition(4)
    got = rows(frequent.frequent_values(df, ["skewed", "even", "few"], 5, buckets=buckets), "column", "rank")
    want = []
    for name, values in (("even", even), ("few", few), ("skewed", skewed)):
        best = sorted((-n, v) for v, n in Counter(v for v in values if v is not None).items())[:5]
        want += [(name, rank, v, -n) for rank, (n, v) in enumerate(best, 1)]
    assert got == want
    assert frequent.frequent_values(df.limit(0), ["even"], 5).collect() == []


def test_only_candidate_values_are_counted(spark, monkeypatch):
    """With some hot values nearly all others stay uncounted."""
    counted = {}
    keep = frequent.stored
    monkeypatch.setattr(frequent, "stored", lambda df, label: counted.setdefault(label, keep(df, label)))
    rng = random.Random(4)
    values = [(f"hot{rng.randrange(5)}" if rng.random() < 0.3 else f"v{rng.randrange(10**9)}",) for _ in range(20_000)]
    frequent.frequent_values(spark.createDataFrame(values, "v string"), ["v"], 5).collect()
    assert counted["first-candidates"].count() + counted["further-candidates"].count() < 200


def test_relations_of_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 5.0)], "a double, b double")
    assert x.relation(df, "a", "b").first()["correlation"] is None
    line = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0)], "a double, b double")
    got = x.relation(line, "a", "b").first()
    assert (got["strength"], got["slope"], got["intercept"]) == ("strong positive", pytest.approx(2), pytest.approx(1))


def test_histogram(spark):
    sales = spark.createDataFrame([(1,), (1,), (9,), (99,)], "purchase_count long")
    got = rows(x.sales_histogram(sales, bins=4), "bin")
    assert [r[3] for r in got] == [2, 1, 0, 1]
    single = rows(x.sales_histogram(spark.createDataFrame([(3,)], "purchase_count long"), bins=2), "bin")
    assert [r[3] for r in single] == [0, 1]


def test_segments(spark):
    df = spark.createDataFrame([(n, 1.0) for n in (1, 2, 5, 6, 20, 21)], "transaction_count long, total_spent double")
    got = {r["segment"]: r["n"] for r in x.segments(df, x.activity_segment()).collect()}
    assert got == {"One-time (1)": 1, "Light (2-5)": 2, "Regular (6-20)": 2, "Heavy (20+)": 1}
    users = {r["segment"]: r["n"] for r in x.segments(df, x.user_segment(), F.avg("total_spent").alias("s")).collect()}
    assert users == {"One-time Users (1)": 1, "Occasional Users (2-4)": 1, "Regular Users (5-19)": 2, "Heavy Users (20+)": 2}


def test_text_profile(spark):
    df = spark.createDataFrame([("é—",), ("é—",), (None,), ("abcd",)], "t string")
    got = x.text_profile(df).first()
    assert (got["mean_length"], got["max_length"], got["unique_values"], got["missing"]) == (2.0, 4, 2, 1)


def test_large_integers_stay_distinct(spark):
    wide = spark.createDataFrame([(2**53 + i,) for i in range(4)] + [(None,)], "code long")
    assert q.numeric_distributions(wide).first()["unique_values"] == 4


def test_numeric_distributions_read_their_input_once(spark, monkeypatch):
    """All scans of the profile read the stored columns."""
    seen, sketched, distinct = [], q.brackets.sketched, q.distinct_values
    monkeypatch.setattr(q.brackets, "sketched", lambda df, *a: seen.append(df) or sketched(df, *a))
    monkeypatch.setattr(q, "distinct_values", lambda df, *a: seen.append(df) or distinct(df, *a))
    got = q.numeric_distributions(numbers(spark, [1, 2, 4, 9])).first()
    assert got["count"] == 4 and got["unique_values"] == 4
    assert len(seen) == 2 and all(any("numeric-columns" in f for f in df.inputFiles()) for df in seen)
