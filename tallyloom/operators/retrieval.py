"""Similarity of embedding columns: pairs, batches, and exact top-k over two tables."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.ordering import with_dense_rank
from tallyloom.operators import nearest
from tallyloom.operators.metrics import K_VALUES, hits_at, retrieval_report, top_k

METRICS = ("cosine", "dot")
BAND_ROWS = 16_384  # rows of a batch that a task holds twice, about


def _check(metric: str, temperature: float) -> None:
    if metric not in METRICS:
        raise ValueError(f"unsupported similarity metric: {metric}")
    if not temperature > 0:
        raise ValueError("temperature must be positive")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def normalised(vector: Column) -> Column:
    """The vector at length 1; a zero vector stays zero."""
    values = vector.cast("array<double>")
    norm = F.greatest(F.sqrt(dot(vector, vector)), F.lit(nearest.NORM_FLOOR))
    return F.transform(values, lambda x: x / norm)


def pair_similarity(
    pairs: DataFrame, queries: DataFrame, items: DataFrame, *, metric: str = "cosine", temperature: float = 1.0
) -> DataFrame:
    """Given (query_id, item_id) pairs with their ``score``; both sides are (id, vector)."""
    _check(metric, temperature)
    ready = normalised if metric == "cosine" else (lambda v: v)
    q = queries.select("query_id", ready(F.col("vector")).alias("_q"))
    i = items.select("item_id", ready(F.col("vector")).alias("_i"))
    scored = pairs.join(q, "query_id").join(i, "item_id")
    score = F.round(dot(F.col("_q"), F.col("_i")) / F.lit(float(temperature)), nearest.SCORE_PLACES)
    return scored.withColumn("score", score).drop("_q", "_i")


# ---------------------------------------------------------------- inside tasks


def _matrix(vectors: pd.Series, metric: str) -> np.ndarray:
    matrix = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    if metric == "cosine":
        matrix /= np.maximum(np.sqrt((matrix * matrix).sum(axis=1, keepdims=True)), nearest.NORM_FLOOR)
    return matrix


# ---------------------------------------------------------------- top-k over two tables


def similar_items(
    queries: DataFrame,
    items: DataFrame,
    *,
    k: int,
    metric: str = "cosine",
    temperature: float = 1.0,
    block_rows: int = 4096,
) -> DataFrame:
    """Exact best ``k`` items per query: (query_id, item_id, score, rank).

    Both sides are (id, vector) with unique ids. Blocks of neighbouring vectors meet only where a bound on their scores
    allows a better item (see ``nearest``); the scores of all pairs never exist as rows.
    """
    _check(metric, temperature)
    found = nearest.search(queries, items, k=k, metric=metric, temperature=temperature, block_rows=block_rows)
    return top_k(found.best, k)


def mark_truth(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Pairs with ``label`` 1 where (query_id, item_id) is in ``truth``, else 0."""
    hits = truth.select("query_id", "item_id").distinct().withColumn("_hit", F.lit(1))
    return pairs.join(hits, ["query_id", "item_id"], "left").withColumn(
        "label", F.coalesce("_hit", F.lit(0))
    ).drop("_hit")


def evaluate_retrieval(
    queries: DataFrame, items: DataFrame, truth: DataFrame, *, ks: Sequence[int] = K_VALUES,
    metric: str = "dot", prefix: str = "", block_rows: int = 4096,
) -> DataFrame:
    """Retrieval metrics of two embedding tables against true (query_id, item_id) pairs."""
    best = mark_truth(similar_items(queries, items, k=max(ks), metric=metric, block_rows=block_rows), truth)
    relevant = (
        truth.select("query_id", "item_id").distinct()
        .join(items.select("item_id"), "item_id", "left_semi")
        .groupBy("query_id").agg(F.count("*").alias("rel"))
    )
    n_items = items.agg(F.count("*").alias("n")).scalar()
    per_query = (
        queries.select("query_id")
        .join(relevant, "query_id", "left")
        .join(hits_at(best, ks), "query_id", "left")
        .withColumn("rel", F.coalesce("rel", F.lit(0)))
        .withColumn("n", n_items)
    )
    report = retrieval_report(per_query, ks, F.col("n"))
    return report.withColumn("metric", F.concat(F.lit(prefix), F.col("metric")))


# ---------------------------------------------------------------- batches


def with_batches(df: DataFrame, key: str, batch_size: int) -> DataFrame:
    """Add ``batch`` and ``place``: rows in key order, ``batch_size`` to a batch; keys are unique."""
    numbered = with_dense_rank(df, key, "_at", descending=False)
    return numbered.select(
        *df.columns,
        F.floor((F.col("_at") - 1) / batch_size).alias("batch"),
        F.pmod(F.col("_at") - 1, F.lit(batch_size)).cast("int").alias("place"),
    )


def batch_similarity(batches: DataFrame, *, metric: str = "cosine", temperature: float = 1.0) -> DataFrame:
    """Scored pairs inside each batch: (batch, query_id, item_id, score, label).

    Input is (batch, place, query_id, query_vector, item_id, item_vector); label is 1 where query
    and item share their place. A batch of b rows gives b * b pairs, so the result grows with the
    table times the fixed batch size.
    """
    _check(metric, temperature)
    schema = T.StructType([
        T.StructField("batch", T.LongType()),
        T.StructField("query_id", batches.schema["query_id"].dataType),
        T.StructField("item_id", batches.schema["item_id"].dataType),
        T.StructField("score", T.DoubleType()),
        T.StructField("label", T.IntegerType()),
    ])

    def score(batch: pd.DataFrame) -> pd.DataFrame:
        n = len(batch)
        scores = _matrix(batch["query_vector"], metric) @ _matrix(batch["item_vector"], metric).T
        place = batch["place"].to_numpy()
        return pd.DataFrame({
            "batch": np.repeat(batch["batch"].to_numpy(), n),
            "query_id": np.repeat(batch["query_id"].to_numpy(), n),
            "item_id": np.tile(batch["item_id"].to_numpy(), n),
            "score": nearest.rounded(scores / temperature).ravel(),
            "label": (place[:, None] == place[None, :]).astype("int32").ravel(),
        })

    return batches.groupBy("batch").applyInPandas(score, schema)


def batch_parts(batches: DataFrame, *, metric: str, temperature: float, tile: int) -> DataFrame:
    """(batch, place, log_sum, own): per row and band of its batch, the logarithm of its sum of exponentials there.

    Rows and columns of a batch are cut into bands of about ``BAND_ROWS`` places, these into tiles of ``tile``. A task meets
    two bands, tile by tile, and holds those and the scores of two tiles, whatever the size of a batch. A vector is sent as
    often as its batch has bands.
    """
    band = tile * max(1, BAND_ROWS // tile)
    own = F.floor(F.col("place") / band).cast("int")
    last = batches.groupBy("batch").agg(F.max(own).alias("_last"))
    banded = batches.withColumn("_own", own).join(last, "batch")
    others = F.explode(F.sequence(F.lit(0), F.col("_last")))
    named = [F.col("batch").alias("batch"), F.col("place").alias("place")]  # both sides come from one table
    rows = banded.select(*named, F.col("_own").alias("row_band"), others.alias("column_band"), F.col("query_vector").alias("vector"))
    columns = banded.select(*named, others.alias("row_band"), F.col("_own").alias("column_band"), F.col("item_vector").alias("vector"))

    def part(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        places, listed = left["place"].to_numpy(), right["place"].to_numpy()
        queries, items = _matrix(left["vector"], metric) / temperature, _matrix(right["vector"], metric)
        peak, sums = np.full(len(places), -np.inf), np.zeros(len(places))
        for at in range(0, len(places), tile):
            some = slice(at, at + tile)
            for start in range(0, len(listed), tile):
                scores = queries[some] @ items[start:start + tile].T
                top = np.maximum(peak[some], scores.max(axis=1))
                scores -= top[:, None]
                sums[some] = sums[some] * np.exp(peak[some] - top) + np.exp(scores, out=scores).sum(axis=1)
                peak[some] = top
        order = np.argsort(listed, kind="stable")
        nearest_place = order[np.minimum(np.searchsorted(listed[order], places), len(listed) - 1)]
        own_score = np.where(listed[nearest_place] == places, np.einsum("ij,ij->i", queries, items[nearest_place]), np.nan)
        return pd.DataFrame({"batch": left["batch"].to_numpy(), "place": places, "log_sum": np.log(sums) + peak, "own": own_score})

    key = ["batch", "row_band", "column_band"]
    return rows.groupBy(*key).cogroup(columns.groupBy(*key)).applyInPandas(part, "batch long, place int, log_sum double, own double")


def batch_loss(
    batches: DataFrame, *, metric: str = "cosine", temperature: float = 1.0, tile: int = 1024
) -> DataFrame:
    """In-batch softmax loss: (rows, loss), the mean cross-entropy of each row against its own item.

    The sums of a row over the bands of its batch (see ``batch_parts``) are merged around their maximum.
    """
    _check(metric, temperature)
    parts = batch_parts(batches, metric=metric, temperature=temperature, tile=tile)
    merged = parts.groupBy("batch", "place").agg(  # one number per band of the batch
        F.collect_list("log_sum").alias("sums"), F.max(F.nanvl("own", F.lit(None).cast("double"))).alias("own"))
    top = F.array_max("sums")
    whole = top + F.log(F.aggregate("sums", F.lit(0.0), lambda total, x: total + F.exp(x - top)))
    return merged.agg(
        F.count("*").alias("rows"), F.try_divide(F.sum(whole - F.col("own")), F.count("*").cast("double")).alias("loss")
    )
