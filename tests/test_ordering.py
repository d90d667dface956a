"""Global ranks, quantiles, cuts and count statistics against direct computation."""

from __future__ import annotations

import random

import numpy as np
import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.functions.counts import gini_of_counts, items_within_share
from tallyloom.functions.ordering import (
    before_cut, cut_point, dense_rank_of_values, exact_quantiles, named_column, with_dense_rank,
)


@pytest.mark.parametrize("splits", [1, 7, 511])
@pytest.mark.parametrize("kind", ["spread", "hot", "few"])
def test_quantiles_equal_numpy(spark, splits, kind):
    draw = random.Random(3)
    values = {
        "spread": [draw.uniform(-5, 5) for _ in range(997)],
        "hot": [1.5] * 400 + [draw.gauss(0, 3) for _ in range(600)],
        "few": [1.0, 2.0, 4.0],
    }[kind]
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 9.0), ("b", None)], "g string, v double")
    got = {
        r["g"]: list(r)[1:]
        for r in exact_quantiles(df, ["g"], "v", probabilities, [f"p{i}" for i in range(7)], splits=splits).collect()
    }
    assert got["a"] == pytest.approx(np.quantile(values, probabilities))
    assert got["b"] == [9.0] * 7


def test_quantiles_of_an_empty_column_have_no_row(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(named_column(df, "v"), ["column"], "value", [0.5], ["m"]).collect() == []


@pytest.mark.parametrize("splits", [1, 5, 511])
def test_dense_rank(spark, splits):
    draw = random.Random(5)
    values = [draw.randrange(200) for _ in range(800)]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    ordered = sorted(set(values))
    up = dict(rows(dense_rank_of_values(df, [], "v", "r", splits=splits)))
    down = dict(rows(dense_rank_of_values(df, [], "v", "r", descending=True, splits=splits)))
    assert up == {v: i + 1 for i, v in enumerate(ordered)}
    assert down == {v: len(ordered) - i for i, v in enumerate(ordered)}


def test_dense_rank_per_group_and_nulls(spark):
    df = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", "b"), ("y", "z"), ("y", None)], "g string, v string")
    assert rows(dense_rank_of_values(df, ["g"], "v", "r"), "g", "v") == [("x", "a", 1), ("x", "b", 2), ("y", "z", 1)]
    ranked = with_dense_rank(df.select("v"), "v", "r")
    assert sorted(rows(ranked), key=str) == sorted([("a", 1), ("b", 2), ("b", 2), ("z", 3), (None, None)], key=str)


def test_cut_point_finds_key_and_copies(spark):
    keys = [(1, "a")] * 3 + [(1, "b")] + [(2, "a")] * 4 + [(3, "c")]
    df = spark.createDataFrame(keys, "d int, k string")
    ordered = sorted(keys)
    for at in range(len(ordered)):
        cut = cut_point(df, [[F.col("d")], [F.col("k")]], lambda n, at=at: F.lit(at))
        key = ordered[at]
        assert (cut.before, cut.size, cut.position) == (ordered.index(key), ordered.count(key), at)
        assert cut.values == key[:len(cut.values)] and (cut.values == key or cut.size == 1)
        before, same = before_cut(cut)
        assert df.where(before).count() == cut.before and df.where(same).count() == cut.size
    assert cut_point(df, [[F.col("d")], [F.col("k")]], lambda n: n) is None


@pytest.mark.parametrize("small", [0, 3, 1000])
def test_chains_skip_levels_where_few_rows_are_left(spark, small):
    numbers = [random.Random(5).randrange(64) for _ in range(40)] + [7] * 9
    df = spark.createDataFrame([(n,) for n in numbers], "n int")
    chain = [F.shiftright("n", 4), F.shiftright("n", 2), F.col("n")]
    for at in (0, 11, 48):
        cut = cut_point(df, [chain], lambda n, at=at: F.lit(at), small=small)
        key = sorted(numbers)[at]
        assert (cut.values[-1], cut.before, cut.size) == (key, sorted(numbers).index(key), numbers.count(key))
        assert len(cut.levels) == (3 if small == 0 else 2 if small == 1000 else len(cut.levels))
        assert df.where(before_cut(cut)[0]).count() == cut.before


@pytest.mark.parametrize("seed", range(3))
def test_count_statistics_equal_direct_computation(spark, seed):
    draw = random.Random(seed)
    counts = [int(draw.paretovariate(1)) for _ in range(300)] + [0, 0, 7]
    df = spark.createDataFrame([(c,) for c in counts], "c long")
    sold = sorted((c for c in counts if c), reverse=True)
    total, cumulative = sum(sold), np.cumsum(sold)
    got = items_within_share(df, "c", [("a", 4, 5), ("b", 19, 20)]).first()
    assert got["a"] == int((5 * cumulative <= 4 * total).sum())
    assert got["b"] == int((20 * cumulative <= 19 * total).sum())
    ascending = np.sort(counts)
    n, sums = len(counts), np.cumsum(ascending)
    assert gini_of_counts(df, "c").first()[0] == pytest.approx((n + 1 - 2 * sums.sum() / sums[-1]) / n)


def test_worked_count_values(spark):
    gini = spark.createDataFrame([(0,), (1,), (3,)], "c long")
    assert gini_of_counts(gini, "c").first()[0] == pytest.approx(0.5)
    assert gini_of_counts(spark.createDataFrame([(0,), (0,)], "c long"), "c").first()[0] == 0.0
    sales = spark.createDataFrame([(5,), (3,), (1,), (1,)], "c long")
    assert tuple(items_within_share(sales, "c", [("a", 4, 5), ("b", 19, 20)]).first()) == (2, 3)
