"""Top scores and hard negatives against plain Python on odd vectors."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import hard_negatives, tiles, topk

SCHEMA = "vec_id long, embedding array<double>, label int, row string, values int, numbers int, cell string"


def whole(vector):
    return [math.floor(256 * x) for x in vector]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def taking_part(rows):
    return [(i, whole(v), y) for i, v, y in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]


def frame(spark, rows, **types):
    return spark.createDataFrame([(*r, "clash", 1, 2, "clash") for r in rows], SCHEMA)


def odd_rows(seed, n, width=6):
    """Ties, repeated rows and ids, a hot vector, other widths, and rows that take no part."""
    rng = random.Random(seed)
    rows = [(rng.randrange(n), [rng.choice((-1.5, -0.25, 0.0, 0.3, 0.5, 1.0)) for _ in range(width)], rng.randrange(3)) for _ in range(n)]
    rows += [(n + i, [0.5] * width, i % 3) for i in range(n // 2)]
    rows += [(0, [1.0] * width, 0), (0, [1.0] * width, 0), (100, [0.5, 0.5], 1), (200, [], 1), (7, [2.0, *[0.1] * width], 2)]
    return rows + [(300, None, 1), (400, [None, 1.0], 1), (500, [float("nan"), 1.0], 1), (600, [float("inf")], 1), (None, [1.0], 1), (2, [1.0] * width, None)]


def best_scores(rows, k, every):
    rows = taking_part(rows)
    out = []
    for q, (query_id, a, _) in enumerate(rows):
        if query_id % every == 0:
            scores = sorted((-dot(a, b), i) for r, (i, b, _) in enumerate(rows) if r != q)
            out += [(query_id, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def negatives_of(rows, every, positives=5, negatives=10):
    rows = [r for r in taking_part(rows) if r[2] is not None]
    out = []
    for q, (anchor, a, label) in enumerate(rows):
        if anchor % every == 0:
            scores = sorted((-dot(a, b), i, y) for r, (i, b, y) in enumerate(rows) if r != q)
            for p, positive, _ in [s for s in scores if s[2] == label][:positives]:
                inside = [(-s, i) for s, i, y in scores if y != label and 30 * -p <= 100 * -s <= 90 * -p][:negatives]
                out += [(anchor, positive, rank, i, -p, s) for rank, (s, i) in enumerate(inside, 1)]
    return sorted(out)


@pytest.fixture
def small_tiles(monkeypatch):
    """Several tiles, query blocks and cells from few rows."""
    monkeypatch.setattr(tiles, "TILE", 16)
    for module in (topk, hard_negatives):
        monkeypatch.setattr(module, "row_tiles", lambda rows: tiles.row_tiles(rows, 16))
        monkeypatch.setattr(module, "streamed", lambda *a: tiles.streamed(*a, block=4))


def test_top_scores_of_odd_rows(spark, small_tiles):
    rows = odd_rows(1, 90)
    got = topk.highest(frame(spark, rows), k=4, every=5, gather=4)
    assert sorted(map(tuple, got.collect())) == best_scores(rows, 4, 5)


def test_top_scores_of_few_rows(spark):
    rows = [(0, [1.0]), (1, [2.0]), (50, [1.0])]
    got = topk.highest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=5)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 131072), (0, 2, 50, 65536), (50, 1, 1, 131072), (50, 2, 0, 65536)]


def test_large_components_and_repeated_ids_stay_apart(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [600000.0, 0.0], 0), (2, [700000.0, 0.0], 0), (2, [3.0, 0.0], 0)]
    got = [tuple(r) for r in topk.highest(frame(spark, rows), k=5).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 45875200000), (0, 2, 1, 39321600000), (0, 3, 2, 196608)]
    # a product of widths beyond 2^63 takes Python integers, whose scores may be small again
    rows = [(0, [1e17, 1.0], 0), (1, [1e-3, 1.0], 0), (2, [-1e17, 0.0], 0), (3, [0.0, 5.0], 0)]
    rows[2] = (2, [0.0, 1e14], 0)
    assert sorted(map(tuple, topk.highest(frame(spark, rows), k=3).collect())) == best_scores(rows, 3, 50)
    with pytest.raises(Exception, match="OverflowError|too large|int too"):
        topk.highest(frame(spark, [(0, [1e30], 0), (1, [1e30], 0)])).collect()


def test_hard_negatives_of_odd_rows(spark, small_tiles):
    rows = odd_rows(2, 90)
    got = hard_negatives.mined(frame(spark, rows), F.col("vec_id") % 10 == 0)
    want = negatives_of(rows, 10)
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want


def test_empty_vector_tables(spark):
    for rows in ([], [(1, None, 1), (None, [1.0], 1)]):
        assert topk.highest(frame(spark, rows)).collect() == []
        assert hard_negatives.mined(frame(spark, rows), F.col("vec_id") % 2 == 0).collect() == []


def test_strassen_is_exact():
    rng = np.random.default_rng(1)
    for m, k, n in ((1, 1, 1), (5, 7, 3), (64, 64, 64), (33, 40, 51), (70, 17, 130), (0, 4, 4), (4, 0, 4)):
        a, b = rng.integers(-1000, 1000, (m, k)), rng.integers(-1000, 1000, (k, n))
        assert (hard_negatives.strassen(a, b, 4) == a @ b).all()
        # sums inside pass 64 bits and wrap; the products themselves fit
        a, b = a * (1 << 41), b * (1 << 9)
        assert (hard_negatives.strassen(a, b, 4) == a @ b).all()
    big = [[rng.integers(1 << 62).item() * 5 for _ in range(9)] for _ in range(9)]
    a = np.array(big, object)
    assert (hard_negatives.strassen(a, a.T.copy(), 2) == a @ a.T).all()


def test_heaps_of_parts_merge_to_the_heap_of_all():
    rng = np.random.default_rng(4)
    scores, ids = rng.integers(0, 6, (1, 200)), rng.permutation(200)
    everything = np.ones((1, 200), bool)

    class Part:
        def __init__(self, at):
            self.ids = self.rows = ids[at]

    one, parts = tiles.Heaps(1, 7), []
    one.offer(scores, everything, Part(slice(None)), [0])
    for at in range(0, 200, 50):
        heap = tiles.Heaps(1, 7)
        heap.offer(scores[:, at:at + 50], everything[:, at:at + 50], Part(slice(at, at + 50)), [0])
        parts += list(zip((-heap.scores[0]).tolist(), heap.ids[0].tolist()))
    assert sorted(parts)[:7] == list(zip((-one.scores[0]).tolist(), one.ids[0].tolist()))
