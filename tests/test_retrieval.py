"""Similarity, exact top-k over blocks, batch loss."""

from __future__ import annotations

import numpy as np
import pytest
from frames import rows
from pyspark.sql import functions as F

from tallyloom.operators import metrics as m
from tallyloom.operators import nearest
from tallyloom.operators import retrieval as r


def table(spark, vectors, name):
    return spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(vectors)], f"{name} long, vector array<float>")


def exact(queries, items, k, metric, temperature):
    q, i = np.asarray(queries, "float32").astype(float), np.asarray(items, "float32").astype(float)
    if metric == "cosine":
        q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)
        i = i / np.maximum(np.linalg.norm(i, axis=1, keepdims=True), 1e-12)
    scores = np.round(q @ i.T / temperature, 9)
    out = {}
    for n, row in enumerate(scores):
        order = sorted(range(len(row)), key=lambda c: (-row[c], -c))[:k]
        out[n] = [(c, pytest.approx(row[c])) for c in order]
    return out


@pytest.mark.parametrize("metric,temperature", [("cosine", 1.0), ("dot", 0.1)])
@pytest.mark.parametrize("block_rows", [7, 16_384])
def test_top_k_equals_brute_force(spark, metric, temperature, block_rows):
    rng = np.random.default_rng(0)
    queries = rng.normal(size=(23, 8))
    items = np.concatenate([rng.normal(size=(40, 8)), np.tile(rng.normal(size=(1, 8)), (20, 1)), np.zeros((3, 8))])
    got = r.similar_items(table(spark, queries, "query_id"), table(spark, items, "item_id"), k=12, metric=metric,
                          temperature=temperature, block_rows=block_rows)
    lists = {}
    for q, i, score, rank in rows(got, "query_id", "rank"):
        lists.setdefault(q, []).append((i, score))
        assert len(lists[q]) == rank
    assert lists == exact(queries, items, 12, metric, temperature)


def test_k_beyond_the_items(spark):
    got = r.similar_items(table(spark, [[1, 0]], "query_id"), table(spark, [[1, 0], [0, 1]], "item_id"), k=5)
    assert rows(got, "rank") == [(0, 0, 1.0, 1), (0, 1, 0.0, 2)]


def test_best_columns_handles_ties_across_the_cut():
    scores = np.array([[1.0, 2.0, 2.0, 2.0, 0.0], [5.0, 4.0, 3.0, 2.0, 1.0], [0.0, 0.0, 0.0, 0.0, 0.0]])
    assert nearest.best_columns(scores, 2).tolist() == [[1, 2], [0, 1], [0, 1]]
    assert nearest.best_columns(scores, 9).tolist()[0] == [1, 2, 3, 0, 4]


def test_unknown_metric_and_temperature(spark):
    q, i = table(spark, [[1.0]], "query_id"), table(spark, [[1.0]], "item_id")
    with pytest.raises(ValueError, match="unsupported similarity metric"):
        r.similar_items(q, i, k=1, metric="euclid")
    with pytest.raises(ValueError, match="temperature"):
        r.similar_items(q, i, k=1, temperature=0)


def test_pairs_and_normalisation(spark):
    q, i = table(spark, [[3, 4], [0, 0]], "query_id"), table(spark, [[6, 8], [-4, 3]], "item_id")
    pairs = spark.createDataFrame([(0, 0), (0, 1), (1, 0)], "query_id long, item_id long")
    assert [x[2] for x in rows(r.pair_similarity(pairs, q, i), "query_id", "item_id")] == [1.0, 0.0, 0.0]
    scaled = r.pair_similarity(pairs, q, i, metric="dot", temperature=0.5)
    assert [x[2] for x in rows(scaled, "query_id", "item_id")] == [100.0, 0.0, 0.0]
    assert rows(q.select(r.normalised(F.col("vector"))), "query_id") == [([0.6, 0.8],), ([0.0, 0.0],)]


def test_evaluate_retrieval(spark):
    rng = np.random.default_rng(2)
    queries, items = rng.normal(size=(10, 64)), rng.normal(size=(20, 64))
    for q, i in ((0, 5), (1, 10), (2, 3)):
        items[i] = queries[q] * 3
    truth = spark.createDataFrame([(0, 5), (1, 10), (2, 3), (2, 99)], "query_id long, item_id long")
    got = {x["metric"]: x["value"] for x in r.evaluate_retrieval(
        table(spark, queries, "query_id"), table(spark, items, "item_id"), truth, ks=(1, 5, 50), prefix="val_").collect()}
    assert got["val_precision@1"] == got["val_recall@1"] == got["val_top_1_accuracy"] == pytest.approx(0.3)
    assert "val_precision@50" not in got and got["val_precision@5"] == pytest.approx(0.06)


def batches(spark, vectors_q, vectors_i, size):
    df = spark.createDataFrame(
        [(n, q, n, i) for n, (q, i) in enumerate(zip(vectors_q, vectors_i))],
        "query_id long, query_vector array<double>, item_id long, item_vector array<double>")
    return r.with_batches(df, "query_id", size)


def test_batch_loss(spark):
    eye = [[1.0, 0.0], [0.0, 1.0]]
    got = r.batch_loss(batches(spark, eye, eye, 2), metric="dot").first()
    assert got["rows"] == 2 and got["loss"] == pytest.approx(0.313262, abs=1e-6)


@pytest.mark.parametrize("tile", [1, 3, 1024])
def test_batch_loss_does_not_depend_on_tiles(spark, tile):
    rng = np.random.default_rng(8)
    q, i = rng.normal(size=(23, 6)) * 9, rng.normal(size=(23, 6)) * 9
    total = 0.0
    for at in range(0, 23, 10):
        scores = q[at:at + 10] @ i[at:at + 10].T / 0.05  # far beyond what exp holds
        total += sum(np.logaddexp.reduce(line) - line[n] for n, line in enumerate(scores))
    got = r.batch_loss(batches(spark, q.tolist(), i.tolist(), 10), metric="dot", temperature=0.05, tile=tile).first()
    assert got["rows"] == 23 and got["loss"] == pytest.approx(total / 23)
    assert tuple(r.batch_loss(batches(spark, q.tolist(), i.tolist(), 10).limit(0), tile=tile).first()) == (0, None)


def test_vectors_of_a_batch_are_sent_by_band_not_by_tile(spark, monkeypatch):
    rng = np.random.default_rng(9)
    q, i = rng.normal(size=(300, 6)), rng.normal(size=(300, 6))
    scores = q @ i.T / 0.1
    want = (np.logaddexp.reduce(scores, axis=1) - np.diagonal(scores)).mean()
    sent = []
    for rows in (1 << 14, 100):  # one band; three of 100 places
        monkeypatch.setattr(r, "BAND_ROWS", rows)
        loss = r.batch_loss(batches(spark, q.tolist(), i.tolist(), 300), metric="dot", temperature=0.1, tile=4)
        got = loss.first()
        assert got["rows"] == 300 and got["loss"] == pytest.approx(want)
        sent.append(r.batch_parts(batches(spark, q.tolist(), i.tolist(), 300), metric="dot", temperature=0.1, tile=4).count())
    assert sent == [300, 3 * 300]  # with a part per pair of tiles there were 75 * 300


def test_batch_pairs_with_a_short_last_batch(spark):
    eye = np.eye(5).tolist()
    got = r.batch_similarity(batches(spark, eye, eye, 2))
    assert got.count() == 4 + 4 + 1
    assert got.where("label = 1").count() == 5 and got.where("label = 1 and score = 1.0").count() == 5


# ---------------------------------------------------------------- blocks and bounds


def clustered(seed, n, width=8, clusters=6, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = np.random.default_rng(1).normal(size=(clusters, width))
    own = rng.integers(0, clusters, n)
    return centres[own] * rng.uniform(0.8, 1.2, (n, 1)) + rng.normal(size=(n, width)) * spread


def sides(spark, queries, items, kind="long"):
    frame = lambda key, values: spark.createDataFrame(
        [(i if kind == "long" else f"id {i:05}", None if v is None else [float(x) for x in v]) for i, v in enumerate(values)],
        f"{key} {kind}, vector array<double>")
    return frame("query_id", queries), frame("item_id", items)


def best_by_sorting(queries, items, k, metric, temperature=1.0):
    norm = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    if metric == "cosine":
        queries, items = norm(queries), norm(items)
    scores = np.round(queries @ items.T / temperature, 9) + 0.0
    out = []
    for q, line in enumerate(scores):
        order = sorted(range(len(line)), key=lambda i: (-line[i], -i))[:k]
        out += [(q, i, rank, line[i]) for rank, i in enumerate(order, 1)]
    return out


@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_bounds_lose_no_item_and_skip_far_blocks(spark, metric):
    queries, items = clustered(2, 300), clustered(3, 1500)
    items[100:500] = items[0]  # a hot vector
    items[700] = 0
    q, i = sides(spark, queries, items)
    found = nearest.search(q, i, k=7, metric=metric, temperature=0.5, block_rows=64)
    got = sorted((x.query_id, x.item_id, x.rank, x.score) for x in m.top_k(found.best, 7).collect())
    assert [x[:3] for x in got] == [x[:3] for x in sorted(best_by_sorting(queries, items, 7, metric, 0.5), key=lambda x: x[:2])]
    report = found.report().first()
    assert report.block_pairs == found.query_blocks.count() * found.item_blocks.count() > 200
    assert report.skipped_share > 0.6  # of six clusters most are too far
    entries = found.best.groupBy("query_id").count().agg({"count": "max"}).first()[0]
    assert entries <= 14


def test_sent_vectors_do_not_grow_with_the_opposite_blocks(spark):
    """More far blocks on the item side: no more blocks are sent."""
    queries, near = clustered(2, 200, clusters=1), clustered(3, 300, clusters=1)
    rng, sent = np.random.default_rng(9), []
    for far in (600, 2400):
        away = -near[rng.integers(0, 300, far)] + rng.normal(size=(far, 8)) * 0.02
        q, i = sides(spark, queries, np.vstack([near, away]))
        sent.append(nearest.search(q, i, k=5, metric="dot", temperature=1.0, block_rows=64).report().first())
    assert sent[1].block_pairs > 2 * sent[0].block_pairs
    assert sent[1].sent <= 1.5 * sent[0].sent


def test_search_with_text_ids_nulls_and_few_items(spark):
    queries, items = clustered(4, 40), clustered(5, 6)
    items[3] = items[4]
    q, i = sides(spark, [*queries, None], [*items, None], "string")
    got = sorted((x.query_id, x.rank, x.item_id) for x in r.similar_items(q, i, k=10, metric="dot").collect())
    want = sorted((f"id {a:05}", rank, f"id {b:05}") for a, b, rank, _ in best_by_sorting(queries, items, 10, "dot"))
    assert got == want


def test_search_over_empty_sides(spark):
    full, nothing = clustered(4, 5), np.zeros((0, 8))
    for queries, items in ((full, nothing), (nothing, full), (nothing, nothing)):
        q, i = sides(spark, queries, items)
        assert r.similar_items(q, i, k=3).collect() == []


def test_item_blocks_travel_once_to_a_group_of_query_blocks(spark):
    """Vectors of one length in all directions: no bound excludes a block, and many query blocks ask for each."""
    rng = np.random.default_rng(12)
    values = rng.normal(size=(3000, 16))
    queries, items = (table(spark, values, name) for name in ("query_id", "item_id"))
    found = nearest.search(queries, items, k=4, metric="dot", temperature=1.0, block_rows=64)
    report = found.report().first()
    assert report.skipped_share < 0.2 and report.block_pairs > 2000
    groups = nearest.grouped(found.query_blocks, 1000)
    assert groups.select("query_group").distinct().count() in (3, 4)
    assert groups.select("block").distinct().count() == groups.count() == found.query_blocks.count()
    # vectors are kept in their own width
    blocks = found.item_blocks.selectExpr("sum(length(parts))", "sum(n)").first()
    assert blocks[0] == 3000 * 16 * 4 and blocks[1] == 3000
    got = sorted((x.query_id, x.rank, x.item_id) for x in m.top_k(found.best, 4).collect())
    want = best_by_sorting(values.astype("float32").astype(float), values.astype("float32").astype(float), 4, "dot")
    assert got == [(q, rank, i) for q, i, rank, _ in sorted(want, key=lambda x: (x[0], x[2]))]
