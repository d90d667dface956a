"""The daily state against features of the whole history."""

from __future__ import annotations

import datetime
import os
import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.operators import interactions, temporal
from tallyloom.plans import daily_queries
from tallyloom.streaming import daily

REF = "2024-03-01"
SCHEMA = "customer_id long, article_id string, t_dat date, price double"


def history(seed, n=900):
    """A hot customer, rows without key, other or price, and a gap of days."""
    rng = random.Random(seed)
    start = datetime.date(2023, 1, 5)
    out = []
    for _ in range(n):
        day = start + datetime.timedelta(days=rng.choice([rng.randrange(300), 300 + rng.randrange(120)]))
        out.append((rng.choice([1, 1, None, *range(2, 30)]), rng.choice([None, "a", "b", "c", "d"]), day, rng.choice([None, 1.5, 2.25, 100.0])))
    return out


def merged(spark, path, table, days, key="customer_id", other="article_id"):
    """The state after one merge per stretch of days."""
    state = daily.open_state(spark, path, table, key=key, other=other)
    for a, b in zip([None, *days], [*days, None]):
        part = table
        part = part.where(F.col("t_dat") >= F.lit(a)) if a else part
        part = part.where(F.col("t_dat") < F.lit(b)) if b else part
        state = daily.merge(state, part, other=other)
    return state


def same(got, want, key):
    assert got.columns == want.columns
    a, b = rows(got, key), rows(want, key)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all(p == (pytest.approx(q) if isinstance(q, float) else q) for p, q in zip(x, y)), (x, y)


DAYS = [datetime.date(2023, 6, 1), datetime.date(2023, 6, 2), datetime.date(2024, 2, 20), datetime.date(2024, 2, 27)]


def test_merged_days_equal_the_whole_history(spark, tmp_path):
    table = spark.createDataFrame(history(1), SCHEMA).cache()
    state = merged(spark, f"{tmp_path}/c", table, DAYS)
    same(daily.customer_temporal(state, reference_date=REF), temporal.customer_temporal(table, reference_date=REF), "customer_id")
    state = merged(spark, f"{tmp_path}/a", table, DAYS, "article_id", "customer_id")
    same(daily.article_temporal(state, reference_date=REF), temporal.article_temporal(table, reference_date=REF), "article_id")
    same(daily.article_popularity(state), interactions.article_popularity(table), "article_id")
    # the state is what the folder holds, whoever opens it
    again = daily.open_state(spark, f"{tmp_path}/a", table, key="article_id", other="customer_id")
    assert (again.batches, again.last_day) == (state.batches, state.last_day) and state.batches >= 4


def test_windows_are_differences_of_running_sums(spark, tmp_path):
    table = spark.createDataFrame(history(2), SCHEMA).cache()
    state = merged(spark, str(tmp_path), table, DAYS)
    day = datetime.date.fromisoformat
    windows = {"late": (day("2024-02-20"), None), "between": (day("2023-05-15"), day("2023-06-02")), "none": (day("2030-01-01"), None)}
    got = daily.with_windows(state, state.totals().select("customer_id", "n"), windows)
    want = table.where("customer_id is not null").groupBy("customer_id").agg(
        F.count("*").alias("n"), F.count_if(F.expr("t_dat >= '2024-02-20'")).alias("late"),
        F.count_if(F.expr("t_dat >= '2023-05-15' and t_dat < '2023-06-02'")).alias("between"), F.lit(0).alias("none"))
    same(got, want.select(*got.columns), "customer_id")


def test_windows_read_the_months_from_the_border_on(spark, tmp_path):
    table = spark.createDataFrame(history(3), SCHEMA)
    state = merged(spark, str(tmp_path), table, DAYS[-1:])
    found = daily.with_windows(state, state.totals().select("customer_id", "n"), {"late": (datetime.date(2024, 2, 27), None)})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert any(f">= {2024 * 12 + 1}" in part.split("]")[0] for part in plan.split("PartitionFilters: ")[1:])


def test_history_is_not_written_again(spark, tmp_path):
    table = spark.createDataFrame(history(4), SCHEMA).cache()
    cut = datetime.date(2024, 2, 27)
    state = daily.open_state(spark, str(tmp_path), table, key="customer_id", other="article_id")
    state = daily.merge(state, table.where(F.col("t_dat") < F.lit(cut)), other="article_id")
    files = lambda: {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(tmp_path) for f in fs if "_SUCCESS" not in f}
    before = files()
    state = daily.merge(state, table.where(F.col("t_dat") >= F.lit(cut)), other="article_id")
    after = files()
    assert all(after[f] == t for f, t in before.items())
    added = [f for f in after if f not in before and "/daily/" in f and f.endswith(".parquet")]
    assert added and all("batch=1" in f for f in added)


def test_a_merge_that_died_can_be_repeated(spark, tmp_path, monkeypatch):
    table = spark.createDataFrame(history(5), SCHEMA).cache()
    cut = datetime.date(2024, 2, 1)
    state = merged(spark, str(tmp_path), table.where(F.col("t_dat") < F.lit(cut)), [])
    late = table.where(F.col("t_dat") >= F.lit(cut))
    with monkeypatch.context() as patch:
        patch.setattr(daily, "_month", lambda day: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            daily.merge(state, late, other="article_id")
    state = daily.open_state(spark, str(tmp_path), table, key="customer_id", other="article_id")
    assert state.batches == 1
    state = daily.merge(state, late, other="article_id")
    same(daily.customer_temporal(state, reference_date=REF), temporal.customer_temporal(table, reference_date=REF), "customer_id")


def test_late_days_and_times_are_refused_and_nothing_is_nothing(spark, tmp_path):
    table = spark.createDataFrame(history(6, 50), SCHEMA)
    state = daily.open_state(spark, str(tmp_path), table, key="customer_id", other="article_id")
    assert state.totals().collect() == [] and state.daily().collect() == []
    assert daily.merge(state, table.limit(0), other="article_id") == state
    state = daily.merge(state, table, other="article_id")
    with pytest.raises(ValueError, match="complete up to"):
        daily.merge(state, table.limit(3), other="article_id")
    with pytest.raises(TypeError, match="must be a date"):
        daily.merge(state, table.withColumn("t_dat", F.col("t_dat").cast("timestamp")), other="article_id")


def test_registered_state_merges_stored_rows(spark, monkeypatch):
    """The merges of the registered queries read rows that lie by key, not the join of the tables again."""
    seen, real = [], daily.merge
    monkeypatch.setattr(daily, "merge", lambda state, batch, **kw: seen.append(batch) or real(state, batch, **kw))
    state = daily_queries._state(spark, "/root/testdata/sf0.001", "article_id", "customer_id")
    assert len(seen) == 2 and all("Join" not in b._jdf.queryExecution().optimizedPlan().toString() for b in seen)
    files = seen[0].withColumn("file", F.input_file_name()).groupBy("article_id").agg(F.count_distinct("file").alias("n"))
    assert files.where("n > 1").count() == 0
    assert state.totals().agg(F.sum("n")).first()[0] == sum(b.count() for b in seen)
