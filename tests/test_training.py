"""Positives, negatives, splits, shards and feature vectors."""

from __future__ import annotations

import datetime
from collections import Counter

import pytest
from frames import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.operators import training as tr
from tallyloom.operators import vectorize as vec

D = datetime.date


def purchases(spark, pairs):
    data = [(D(2023, 1, 1) + datetime.timedelta(days=i), c, a, 1.0 + i) for i, (c, a) in enumerate(pairs)]
    return spark.createDataFrame(data, "t_dat date, customer_id string, article_id int, price double")


@pytest.fixture(scope="module")
def transactions(spark):
    return purchases(spark, [("c1", 1), ("c2", 2), ("c1", 3), ("c3", 1), ("c2", 3)])


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame([(i,) for i in range(1, 13)], "article_id int")


def test_last_interactions(spark):
    tx = purchases(spark, [("a", i) for i in range(60)] + [("b", 1), ("b", 1), (None, 5)])
    got = tr.last_interactions(tx)
    assert got.where("customer_id = 'a'").count() == 50
    assert got.where("customer_id = 'a'").agg(F.min("article_id")).first()[0] == 10
    assert got.where("customer_id = 'b'").count() == 2 and got.count() == 52
    assert tr.last_interactions(tx, n=1, min_per_customer=3).select("customer_id", "recency").collect() == [("a", 1)]


def test_equal_dates_are_cut_by_the_tie_columns(spark):
    tx = spark.createDataFrame([(D(2023, 1, 1), "a", i, 1.0) for i in range(10)],
                               "t_dat date, customer_id string, article_id int, price double")
    assert rows(tr.last_interactions(tx, n=3).select("article_id"), "article_id") == [(7,), (8,), (9,)]


def test_split_keeps_every_row_and_the_position(transactions):
    train, validation = tr.temporal_split(transactions)
    assert rows(train.select("customer_id", "article_id"), "t_dat") == [("c1", 1), ("c2", 2), ("c1", 3), ("c3", 1)]
    assert rows(validation.select("customer_id", "article_id")) == [("c2", 3)]


@pytest.mark.parametrize("validation", [0.0, 0.1, 0.35, 0.5, 0.9, 1.0])
def test_split_inside_one_day_and_among_copies(spark, validation):
    data = [(D(2023, 1, 1), i % 7) for i in range(20)] + [(D(2023, 1, 2), 3)] * 30 + [(D(2023, 1, 3), 1), (None, 5)]
    tx = spark.createDataFrame(data, "t_dat date, article_id int").repartition(4)
    train, rest = tr.temporal_split(tx, validation=validation)
    left, right = Counter(map(tuple, train.collect())), Counter(map(tuple, rest.collect()))
    assert left + right == Counter(data)
    assert sum(left.values()) == int(len(data) * (1 - validation))
    late = [d or D.max for d, _ in left.elements()], [d or D.max for d, _ in right.elements()]
    assert not late[0] or not late[1] or max(late[0]) <= min(late[1])


def test_copies_are_made_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(tr, "COPIES_PER_TASK", 4)
    one = spark.createDataFrame([("x", 11), ("y", 0), ("z", 4)], "k string, n int")
    assert Counter(r[0] for r in tr._copies(one, "n").collect()) == {"x": 11, "z": 4}


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("unit", ["hours", "minutes", "seconds", "microseconds"])
def test_split_by_timestamps(spark, kind, unit):
    start = datetime.datetime(2023, 1, 1, 1, 1, 1)
    data = [(start + datetime.timedelta(**{unit: n}), n) for n in range(10)]
    tx = spark.createDataFrame(data, f"t_dat {kind}, article_id int")
    train, rest = tr.temporal_split(tx, validation=0.3)
    assert rows(train.select("article_id"), "article_id") == [(i,) for i in range(7)] and rest.count() == 3


def test_split_by_date(transactions):
    train, rest = tr.split_by_date(transactions, "2023-01-02", validation_days=2)
    assert (train.count(), rest.count()) == (2, 2)


def check_negatives(negatives, positives, articles, k):
    got = [tuple(r) for r in negatives.select("customer_id", "article_id").collect()]
    known = {tuple(r) for r in positives.select("customer_id", "article_id").collect()}
    customers = {c for c, _ in known}
    catalogue = {r[0] for r in articles.collect()}
    assert len(got) == positives.count() * k == len(set(got))
    assert not set(got) & known
    assert {c for c, _ in got} <= customers and {a for _, a in got} <= catalogue


@pytest.mark.parametrize("k", [1, 2, 4, 6])
def test_negatives_of_a_small_grid(transactions, articles, k):
    positives = tr.last_interactions(transactions)
    check_negatives(tr.negative_samples(positives, articles, per_positive=k), positives, articles, k)


def test_negatives_at_exact_capacity_and_below(spark):
    positives = tr.last_interactions(purchases(spark, [("a", 1), ("b", 2)]))
    articles = spark.createDataFrame([(1,), (2,)], "article_id int")
    got = tr.negative_samples(positives, articles, per_positive=1)
    assert rows(got, "customer_id") == [("a", 2, 0), ("b", 1, 0)]
    with pytest.raises(ValueError, match="unknown pairs"):
        tr.negative_samples(positives, articles, per_positive=2)


def test_sparse_negatives_of_a_hot_customer(spark):
    pairs = [("hot", i) for i in range(300)] + [(f"c{i}", i % 50) for i in range(200)]
    tx = purchases(spark, pairs)
    articles = spark.range(3000).select(F.col("id").cast("int").alias("article_id"))
    positives = tr.last_interactions(tx, n=1000)
    negatives = tr.negative_samples(positives, articles)
    check_negatives(negatives, positives, articles, 4)
    again = tr.negative_samples(positives.repartition(13), articles)
    assert Counter(map(tuple, negatives.collect())) == Counter(map(tuple, again.collect()))
    share = negatives.where("customer_id = 'hot'").count() / negatives.count()
    assert share < 0.02  # customers are drawn evenly, not by activity


def test_samples_and_statistics(transactions, articles):
    train, validation = tr.train_validation_samples(transactions, articles, per_positive=1)
    assert (train.count(), validation.count()) == (8, 2)
    assert train.select("shuffle_key").distinct().count() == 8
    got = tr.label_statistics(train, batch_size=3).first()
    assert tuple(got) == (8, 4, 4, 0.5, 0.5, 3)
    assert tr.label_statistics(train, batch_size=3, drop_last=True).first()["num_batches"] == 2


def test_shards(transactions, articles, tmp_path):
    samples = tr.training_samples(transactions, articles, per_positive=2)
    shards = tr.training_shards(samples, rows_per_shard=5, batch_size=2)
    assert shards.count() == 15 and shards.agg(F.max("shard")).first()[0] <= 2
    sizes = shards.groupBy("shard", "batch_no").count()
    assert sizes.agg(F.max("count")).first()[0] <= 2
    tr.export_shards(shards, str(tmp_path / "shards"))
    stored = samples.sparkSession.read.parquet(str(tmp_path / "shards"))
    assert stored.count() == 15 and set(stored.columns) == set(shards.columns)


def test_attach_features_and_missing_keys(spark, transactions, articles):
    samples = transactions.select("customer_id", "article_id")
    customers = spark.createDataFrame([("c1", 5), ("c2", 6), ("c3", 7)], "customer_id string, age int")
    joined = tr.attach_features(samples, customers, articles.withColumn("size", F.lit(1)))
    assert joined.count() == 5 and {"customer_age", "article_size"} <= set(joined.columns)
    with pytest.raises(PySparkException, match="no features for customer_id c3"):
        tr.attach_features(samples, customers.where("age < 7"), articles).collect()


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, v int")
    assert rows(tr.first_per_key(df, "k"), "k") == [("a", 1), ("b", 5)]


def test_sample_and_preview(spark):
    df = spark.range(100).select(F.col("id"))
    sample = rows(tr.hashed_sample(df, 10, key_cols=["id"]))
    assert len(sample) == 10 and sample == rows(tr.hashed_sample(df.repartition(7), 10, key_cols=["id"]))
    assert len(rows(tr.hashed_sample(df, 1000, key_cols=["id"]))) == 100
    assert rows(tr.preview(df, 2, order_by=[F.col("id").desc()])) == [(99,), (98,)]


def test_z_scores(spark):
    df = spark.createDataFrame([(1.0, 7.0, 1.0), (2.0, 7.0, 2.0), (3.0, 7.0, 3.0)], "a double, b double, c double")
    got = rows(vec.z_scores(df, ["a", "b", "c", "absent"], given={"c": (1.0, 2.0)}), "a")
    assert [r[0] for r in got] == pytest.approx([-1.224745, 0, 1.224745], abs=1e-6)
    assert [r[1] for r in got] == [7.0] * 3 and [r[2] for r in got] == [0.0, 0.5, 1.0]


def test_codes_and_vectors(spark):
    df = spark.createDataFrame([(1, "b", 2, 0.5), (2, "a", 3, 1.5), (3, None, 4, 2.5)], "id int, t string, n int, x double")
    coded = vec.with_category_codes(df, ["t", "n", "absent"])
    assert rows(coded, "id") == [(1, 1, 2, 0.5), (2, 0, 3, 1.5), (3, -1, 4, 2.5)]
    vectors = rows(vec.stacked(coded, ["n", "absent", "t"], ["x"], keep=["id"]), "id")
    assert vectors == [(1, [2, 1], [0.5]), (2, [3, 0], [1.5]), (3, [4, -1], [2.5])]
    assert vec.stacked(coded, [], [], keep=["id"]).first()["categorical"] == []
    hashed = rows(vec.with_hashed_codes(df, ["t", "n"]), "id")
    assert hashed[2][1] is None and all(0 <= r[1] < 10_000 for r in hashed[:2]) and hashed[0][2] == 2


@pytest.mark.parametrize("size", [(1, 1), (1, 9), (7, 3), (40, 25)])
def test_scrambled_cells_visit_each_cell_once(spark, size):
    cells = tr.scrambled_cells(spark.range(size[0] * size[1]).withColumnRenamed("id", "_j"), *size, seed=5)
    got = sorted((r["_c"], r["_a"]) for r in cells.collect())
    assert got == [(c, a) for c in range(size[0]) for a in range(size[1])]


def test_repeated_feature_rows_do_not_multiply_samples(spark):
    samples = spark.createDataFrame([("c", "a")], "customer_id string, article_id string")
    customers = spark.createDataFrame([("c", 9), ("c", 4), (None, 1)], "customer_id string, age int")
    articles = spark.createDataFrame([("a", 1)], "article_id string, size int")
    assert [tuple(r) for r in tr.attach_features(samples, customers, articles).collect()] == [("a", "c", 4, 1)]


@pytest.mark.parametrize("size", [(7, 5), (1, 9), (40, 13)])
def test_numbers_of_cells_undo_the_scrambling(spark, size):
    cells = tr.scrambled_cells(spark.range(size[0] * size[1]).selectExpr("id AS _j", "id AS was"), *size, seed=5)
    back = tr.numbers_of_cells(cells.select("_c", "_a"), *size, seed=5)
    assert sorted(x._j for x in back.collect()) == list(range(size[0] * size[1]))
    one = cells.where("was = 3").select("_c", "_a")
    assert [x._j for x in tr.numbers_of_cells(one, *size, seed=5).collect()] == [3]


def test_end_of_free_numbers(spark):
    far = (1 << 26) + 5
    for taken, target in (([], 4), ([0, 1, 2], 1), ([0, 2, 4, 6], 3), ([5], 5), ([5], 6), ([8191, 8192, far], far),
                          ([far, far + 1], far), ([far, far + 1], far + 1), (list(range(10)), 9000)):
        end, left = 0, target
        for stop in [*taken, None]:  # walk the stretches of free numbers
            free = left if stop is None else min(left, stop - end)
            end, left = end + free, left - free
            if not left:
                break
            end = stop + 1
        frame = spark.createDataFrame([(t,) for t in taken], "_j long")
        assert tr.end_of_free(frame, target) == end, (taken, target)


def test_draws_are_not_shuffled_to_leave_known_pairs_out(spark, transactions, articles):
    plan = tr.negative_samples(tr.last_interactions(transactions), articles)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "SortMergeJoin [_j" not in plan and "unknown-cells" not in plan


def test_pairs_outside_the_catalogue_leave_the_grid_free(spark):
    positives = spark.createDataFrame([("c1", 99)], "customer_id string, article_id int")
    listed = spark.createDataFrame([(i,) for i in range(4)], "article_id int")
    got = tr.negative_samples(positives, listed, per_positive=4)
    assert rows(got, "article_id") == [("c1", i, 0) for i in range(4)]
    with pytest.raises(ValueError, match="5 negatives wanted, but only 4 unknown"):
        tr.negative_samples(positives, listed, per_positive=5)


def test_negatives_leave_little_on_disk(spark, monkeypatch):
    """Only numbers that may be drawn are stored, draws travel as one number, and shuffles go with each stored table."""
    pairs = [(f"c{i % 40}", i * 7 % 1000) for i in range(200)]
    positives = spark.createDataFrame(pairs, "customer_id string, article_id int")
    listed = spark.range(1000).select(F.col("id").cast("int").alias("article_id"))
    statuses = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    seen, keep = {}, tr.stored

    def store(df, label, *given, **options):
        before = {int(x) for x in statuses.keysIterator().mkString(",").split(",") if x}
        seen[label] = keep(df, label, *given, **options)
        assert {int(x) for x in statuses.keysIterator().mkString(",").split(",") if x} <= before, label
        return seen[label]

    monkeypatch.setattr(tr, "stored", store)
    negatives = tr.negative_samples(tr.stored_positives(purchases(spark, pairs)), listed)
    assert negatives.count() == 800 and negatives.join(positives, ["customer_id", "article_id"]).count() == 0
    known = seen["known-pairs"].count()
    assert known == len(set(pairs)) and seen["known-numbers"].count() < known / 4
    assert "[coalesce((_cell#" in negatives._jdf.queryExecution().executedPlan().toString()
