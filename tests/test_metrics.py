"""Recommendation metrics against worked values and a direct computation with ties."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import metrics as m

SCHEMA = "query_id int, item_id int, score double, label int"


def frame(spark, lists):
    return spark.createDataFrame(
        [(q, i, float(s), y) for q, items in lists.items() for i, (s, y) in enumerate(items)], SCHEMA
    )


def report(df):
    return {r["metric"]: r["value"] for r in df.collect()}


def direct(lists, ks):
    """Metrics of score lists, list position as item id."""
    out = defaultdict(list)
    for items in lists.values():
        order = sorted(range(len(items)), key=lambda i: (-items[i][0], -i))
        labels = [items[i][1] for i in order]
        relevant = sum(labels)
        for k in ks:
            hits = sum(labels[:k])
            out[f"precision@{k}"].append(hits / k)
            out[f"recall@{k}"].append(hits / relevant if relevant else 0)
            out[f"top_{k}_accuracy"].append(float(hits > 0))
        out["mrr"].append(1 / (labels.index(1) + 1) if relevant else 0)
        if not relevant:
            continue
        groups = defaultdict(list)
        for score, label in items:
            groups[score].append(label)
        seen = found = ap = 0
        discount = [1 / math.log2(i + 2) for i in range(len(items))]
        gains = []
        for score in sorted(groups, reverse=True):
            group = groups[score]
            seen += len(group)
            ap += sum(group) * (found + sum(group)) / seen
            found += sum(group)
            gains += [sum(group) / len(group)] * len(group)
        out["map"].append(ap / relevant)
        for k in ks:
            ideal = sum(discount[:min(k, relevant)])
            value = sum(g * d for g, d in zip(gains[:k], discount)) / ideal
            out[f"ndcg@{k}"].append(0.0 if len(items) == 1 else value)
    means = {name: sum(v) / len(v) for name, v in out.items()}
    for k in ks:
        p, r = means[f"precision@{k}"], means[f"recall@{k}"]
        means[f"f1@{k}"] = 2 * p * r / (p + r) if p + r else 0.0
    return means


def random_lists(seed, queries=12, size=25, values=6):
    draw = random.Random(seed)
    return {
        q: [(draw.randrange(values) / 7, int(draw.random() < 0.2)) for _ in range(size)] for q in range(queries)
    }


@pytest.mark.parametrize("values", [3, 10_000])
def test_all_metrics_equal_direct_computation(spark, values):
    lists = random_lists(values, values=values)
    got = report(m.all_metrics(frame(spark, lists), ks=(1, 3, 10, 25, 50), diversity=False))
    want = direct(lists, (1, 3, 10, 25))
    assert set(got) == set(want)  # 50 is beyond every list
    for name, value in want.items():
        assert got[name] == pytest.approx(value), name


def test_long_lists_are_cumulated_in_slices(spark):
    lists = random_lists(9, queries=3, size=200, values=90)
    lists[7] = [(0.5, 1)] * 4
    ties = m.tie_groups(frame(spark, lists))
    plain = sorted(map(tuple, m.ladder(ties).collect()))
    for splits in (1, 5, 64):
        assert sorted(map(tuple, m.ladder(ties, slice_rows=2, splits=splits).collect())) == plain


def test_worked_values_with_ties(spark):
    profile = m.query_profile(m.ladder(m.tie_groups(frame(spark, {1: [(0.9, 1), (0.9, 0), (0.5, 1)]}))), (1, 2)).first()
    assert profile["ap"] == pytest.approx(0.583333, abs=1e-6)
    assert profile["ndcg_2"] == pytest.approx(0.5)
    got = report(m.all_metrics(frame(spark, {1: [(0.9, 1), (0.9, 0), (0.5, 1)]}), ks=(1,), prefix="val_"))
    assert got["val_mrr"] == 0.5 and got["val_precision@1"] == 0 and got["val_coverage"] == 1.0


def test_perfect_and_empty_lists(spark):
    identity = {q: [(1.0 if i == q else 0.0, int(i == q)) for i in range(4)] for q in range(4)}
    got = report(m.all_metrics(frame(spark, identity), ks=(1, 5), diversity=False))
    assert got["precision@1"] == got["recall@1"] == got["top_1_accuracy"] == got["map"] == got["mrr"] == 1.0
    assert "precision@5" not in got
    nothing = {q: [(i / 10, 0) for i in range(10)] for q in range(4)}
    got = report(m.all_metrics(frame(spark, nothing), ks=(1, 5), diversity=False))
    assert set(got.values()) == {0.0}


def test_single_candidate(spark):
    got = report(m.all_metrics(frame(spark, {1: [(0.4, 1)]}), ks=(1,), diversity=False))
    assert got["ndcg@1"] == 0.0 and got["map"] == 1.0 and got["precision@1"] == 1.0


def test_diversity(spark):
    scored = frame(spark, {1: [(0.9, 0), (0.8, 0), (0.1, 0)], 2: [(0.9, 0)]})
    vectors = spark.createDataFrame([(0, [0.0, 0.0]), (1, [3.0, 4.0]), (2, [9.0, 9.0])], "item_id int, vector array<double>")
    catalogue = spark.createDataFrame([(i,) for i in range(5)], "item_id int")
    assert m.intra_list_diversity(scored, vectors, k=2).first()[0] == pytest.approx((5.0 + 0.0) / 2)
    got = report(m.diversity_metrics(scored, vectors, catalogue=catalogue, k=2))
    assert got["coverage"] == pytest.approx(2 / 5)
    assert got["gini_coefficient"] == pytest.approx((5 + 1 - 2 * (0 + 0 + 0 + 1 + 3) / 3) / 5)


def test_families_are_switchable(spark):
    scored = frame(spark, {1: [(0.9, 1), (0.1, 0)]})
    assert set(report(m.all_metrics(scored, ks=(1,), ranking=False, diversity=False))) == {
        "precision@1", "recall@1", "top_1_accuracy", "f1@1"}
    with pytest.raises(ValueError):
        m.all_metrics(scored, retrieval=False, ranking=False, diversity=False)


def test_a_hot_query_does_not_change_the_others(spark):
    draw = random.Random(1)
    lists = random_lists(4, queries=20, size=10)
    lists[99] = [(draw.random(), int(draw.random() < 0.1)) for _ in range(400)]
    ks = (1, 10, 100)
    got = report(m.all_metrics(frame(spark, lists).withColumn("score", F.col("score")), ks=ks, diversity=False))
    want = direct(lists, ks)
    for name in ("map", "mrr", "ndcg@10", "precision@100", "recall@10"):
        assert got[name] == pytest.approx(want[name]), name


def test_catalogue_counts_items_that_no_list_holds(spark):
    scored = spark.createDataFrame(
        [("q", "a", 0.9, 1), ("q", "b", 0.1, 0)], "query_id string, item_id string, score double, label int")
    catalogue = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "item_id string")
    report = m.all_metrics(scored, catalogue=catalogue, retrieval=False, ranking=False)
    assert {r["metric"]: r["value"] for r in report.collect()}["coverage"] == 0.5


def test_registered_rank_reads_stored_pairs(spark, monkeypatch):
    """The join of the tables is made once, not once per use of the scored pairs."""
    from tallyloom.operators import metrics
    from tallyloom.plans import evaluation_queries

    seen, real = [], metrics.first_hit_rank
    monkeypatch.setattr(metrics, "first_hit_rank", lambda *frames: seen.extend(frames) or real(*frames))
    assert evaluation_queries.m7(spark, "/root/testdata/sf0.001").count() > 0
    assert "scored-pairs" in seen[0].inputFiles()[0] and "query-profile" in seen[1].inputFiles()[0]
