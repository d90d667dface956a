"""Bracketed quantiles against sorting, and what they shuffle."""

from __future__ import annotations

import numpy as np
import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.functions import brackets
from tallyloom.operators import quality

P = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
NAMES = [f"q{i}" for i in range(len(P))]


def frame(spark, **columns):
    n = max(map(len, columns.values()))
    filled = [[None if v is None else float(v) for v in c] + [None] * (n - len(c)) for c in columns.values()]
    return spark.createDataFrame(list(zip(*filled)), ", ".join(f"{c} double" for c in columns)).repartition(6)


def columns(seed, n=20_000):
    rng = np.random.default_rng(seed)
    return {
        "spread": rng.normal(size=n), "steps": np.round(rng.exponential(3, n)), "hot": np.where(rng.random(n) < 0.4, 7.0, rng.random(n) * 100),
        "same": np.full(n, 3.25), "gaps": [None if x < 0.5 else float(x) for x in rng.random(n)], "few": [5.0, 1.0, float("nan")],
        "tails": np.concatenate([rng.normal(size=n - 3), [1e12, -1e12, 0.0]]), "one": [2.0], "none": [None],
    }


def expected(values):
    known = np.array([v for v in values if v is not None and v == v], float)
    return [pytest.approx(x) for x in np.quantile(known, P)]


@pytest.mark.parametrize("size", [64, brackets.SKETCH_SIZE])
def test_quantiles_equal_sorting(spark, size):
    data = columns(1)
    found = brackets.bracketed(frame(spark, **data), list(data), P, size=size)
    got = {r["column"]: [r[n] for n in NAMES] for r in found.quantiles(P, NAMES).collect()}
    assert got == {c: expected(v) for c, v in data.items() if c != "none"}


def test_only_bracketed_values_are_shuffled(spark):
    data = {c: columns(2, 100_000)[c] for c in ("spread", "tails")}
    found = brackets.bracketed(frame(spark, **data), list(data))
    inside = {r["column"]: (r["values"], r["n"]) for r in found.counts.groupBy("column").agg(
        F.count("*").alias("values"), F.sum("n").alias("n")).collect()}
    share = 3 * 4 * brackets.rank_error(brackets.SKETCH_SIZE)
    for distinct, n in inside.values():
        assert n == 100_000 and distinct <= 1.2 * share * n + 10


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    """An error bound far too small: the counts show it, and the result stays exact."""
    monkeypatch.setattr(brackets, "rank_error", lambda size: 1e-4)
    data = {"spread": columns(3, 50_000)["spread"]}
    found = brackets.bracketed(frame(spark, **data), ["spread"], P, size=16)
    assert rows(found.quantiles(P, NAMES))[0][1:] == tuple(expected(data["spread"]))


def test_approximate_quantiles_keep_their_error(spark):
    data = {"spread": columns(4, 50_000)["spread"]}
    got = brackets.approximate_quantiles(frame(spark, **data), ["spread"], (0.25, 0.5, 0.75), ["a", "b", "c"], size=256).first()
    order = np.sort(data["spread"])
    for p, value in zip((0.25, 0.5, 0.75), got[1:]):
        assert abs(np.searchsorted(order, value) / len(order) - p) <= 2 * brackets.rank_error(256)
    profile = quality.numeric_distributions(frame(spark, **data), ["spread"], approximate=True).first()
    assert profile["unique_values"] == len(set(data["spread"])) and abs(profile["median"]) < 0.05


def test_outliers_equal_plain_counting(spark):
    data = {c: v for c, v in columns(5).items() if c not in ("few", "one", "none")}
    got = {r["column"]: r for r in quality.outliers(frame(spark, **data), list(data)).collect()}
    assert set(got) == set(data)
    for c, values in data.items():
        known = np.array([v for v in values if v is not None], float)
        q1, q3 = np.quantile(known, [0.25, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert got[c].iqr_count == ((known < low) | (known > high)).sum()
        std = known.std(ddof=1)
        assert got[c].zscore_count == (0 if std == 0 else (abs(known - known.mean()) / std > 3).sum())


def test_empty_table(spark):
    nothing = frame(spark, a=[1.0]).limit(0)
    assert quality.outliers(nothing).collect() == [] and quality.numeric_distributions(nothing).collect() == []
