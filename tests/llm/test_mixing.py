"""Systematic mixing: targets, copies and odd rows."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from fractions import Fraction

from helpers import empty_documents, odd_documents

from tallyloom.llm import mixing


def plain_targets(sizes: dict, weights=(5, 2, 1), limit=3):
    """Shares by weight, the excess over ``limit`` sizes shared again until there is none."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(limit * sizes[s] for s in full)
        among = sum(weight[s] for s in order if s not in full)
        share = {s: Fraction(limit * sizes[s]) if s in full else Fraction(weight[s] * rest, among) for s in order}
        over = {s for s in order if share[s] > limit * sizes[s]}
        if not over:
            return share
        full |= over


def check(spark, rows):
    """Rows: (doc_id, text, source)."""
    count = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += count(text)
    want = plain_targets(sizes)
    by_target = defaultdict(int)
    docs = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, source string, rate int, row string").repartition(5)
    got = mixing.mixed(docs).collect()
    texts = defaultdict(list)
    for i, text, source in rows:
        texts[i].append((count(text), sizes[source], float(want[source])))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.source_size) for r in got) == sorted(
        (i is None, i or 0, n, s) for i, own in texts.items() for n, s, _ in own)
    largest = defaultdict(int)
    for r in got:
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        assert any(abs(r.target - t) <= 1e-9 * max(t, 1) for _, s, t in texts[r.doc_id] if s == r.source_size)
        by_target[r.source_size, r.target] += r.taken
        largest[r.source_size, r.target] = max(largest[r.source_size, r.target], r.size)
    groups = defaultdict(int)
    for source, size in sizes.items():
        groups[size, float(want[source])] += 1
    for (size, target), taken in by_target.items():
        same = sum(n for (s, t), n in groups.items() if s == size and abs(t - target) <= 1e-9 * max(t, 1))
        assert abs(taken - same * target) <= 2 * same * largest[size, target] + 1
    again = mixing.mixed(docs.repartition(3)).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(got, key=key) == sorted(again, key=key)


def documents(seed, shares):
    rng, rows = random.Random(seed), []
    for source, n in shares.items():
        for _ in range(n):
            rows.append((len(rows), " ".join(["w"] * min(400, int(rng.paretovariate(0.8)) + 5)), source))
    return rows


def test_targets_and_copies(spark):
    check(spark, documents(1, {"a": 300, "b": 20, "c": 60, "d": 5, None: 40}))
    check(spark, documents(2, {"a": 4, "b": 2000, "é": 30, "😀": 30}))


def test_taken_words_come_near_the_targets(spark):
    rows = documents(3, {"a": 3000, "b": 1000, "c": 2000})
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for r in mixing.mixed(docs).groupBy("source_size", "target").sum("taken").collect():
        assert abs(r["sum(taken)"] - r["target"]) <= 0.01 * r["target"]


def test_ties_repeated_rows_and_one_source(spark):
    check(spark, [(1, "a b c", "x")] * 40 + [(None, "a b c", "y")] * 40 + [(2, None, "y"), (3, "", "z"), (4, None, None)])
    check(spark, [(i, "a b", "x") for i in range(30)])


def test_large_counts_of_words_in_one_text(spark):
    check(spark, [(1, "word " * 2_000_000, "a"), (2, "word " * 1000, "b"), (3, "w", "c")])


def test_odd_and_empty_documents(spark):
    docs = odd_documents(spark)
    assert mixing.mixed(docs).count() == docs.count()
    assert mixing.mixed(empty_documents(spark)).collect() == []
    nothing = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in mixing.mixed(nothing).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
