"""Hard negatives: rows of another label that score close to an anchor's positives.

Scores of anchors with all rows are products of int64 tiles by Strassen's recursion: blocks are halved, odd sides
filled up with zeros, seven products of sums replace eight, and all additions are exact (int64 wraps, so
intermediate sums may pass 64 bits as long as the scores don't; where scores could, the same recursion runs on
Python integers). The first pass keeps a heap of positives per anchor, the second a heap of negatives per score
window that the positives open. Heaps of different cells are merged by their order; a cell leaves at most k entries
per list, so no pair of vectors is written and a hot label or vector makes no group grow.

Defined results: rows with a null id or label, a null vector, or a null or non-finite component take no part; rows
that repeat, in id too, are rows of their own (an anchor's own row is never its positive, its repeats are); shorter
vectors count as filled up with zeros; equal scores go by the smaller id; an anchor without positives, or a
positive without a negative in its window, gives no row; columns besides the three are not read; an empty table
gives no row. Components of any finite size are exact; a returned score beyond 64 bits is an OverflowError.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import stored
from tallyloom.llm.tiles import NOTHING, Heaps, Tile, exact, filled, row_tiles, scaled, streamed, usable, whole_product

LEAF = 16


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two whole-number matrices; sides of at most ``leaf`` are multiplied directly."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return whole_product(a, b)
    if m % 2 or k % 2 or n % 2:
        a, b = filled(a, m + m % 2, k + k % 2), filled(b, k + k % 2, n + n % 2)
        return strassen(a, b, leaf)[:m, :n]
    h, i, j = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((m, n), p1.dtype)
    out[:h, :j] = p1 + p4 - p5 + p7
    out[:h, j:] = p3 + p5
    out[h:, :j] = p2 + p4
    out[h:, j:] = p1 - p2 + p3 + p6
    return out


def _scores(anchors: Tile, tile: Tile) -> np.ndarray:
    a, b = exact(anchors.values, tile.values)
    return strassen(a, np.ascontiguousarray(b.T))


class Positives:
    """Heaps of the best other rows of the anchors' own labels."""

    def __init__(self, anchors: Tile, k: int):
        self.anchors, self.heaps = anchors, Heaps(len(anchors.rows), k)

    def meet(self, tile: Tile) -> None:
        own = self.anchors
        allowed = (own.labels[:, None] == tile.labels[None, :]) & (own.rows[:, None] != tile.rows[None, :])
        self.heaps.offer(_scores(own, tile), allowed, tile, range(len(own.rows)))

    def result(self) -> tuple:
        owner, ids, rows, scores = self.heaps.entries()
        return self.anchors.rows[owner], self.anchors.ids[owner], ids, rows, scores


class Windows:
    """Heaps of the best rows of other labels inside the windows of the anchors' positive scores."""

    def __init__(self, anchors: Tile, k: int, low: int, high: int):
        self.anchors = anchors
        lists = [[int(p) for p in line if p != NOTHING] for line in anchors.numbers]
        self.owner = np.array([i for i, line in enumerate(lists) for _ in line], np.int64)
        self.opened = [p for line in lists for p in line]
        self.least = [-(-low * p // 100) for p in self.opened]
        self.most = [high * p // 100 for p in self.opened]
        self.heaps = Heaps(len(self.opened), k)

    def meet(self, tile: Tile, together: int = 512) -> None:
        scores = _scores(self.anchors, tile)
        for at in range(0, len(self.opened), together):
            some = range(at, min(at + together, len(self.opened)))
            owner = self.owner[some.start:some.stop]
            own = scores[owner]
            edge = lambda values: np.array(values[some.start:some.stop], own.dtype)[:, None]
            inside = ((own >= edge(self.least)) & (own <= edge(self.most))).astype(bool)
            self.heaps.offer(own, inside & (self.anchors.labels[owner][:, None] != tile.labels[None, :]), tile, some)

    def result(self) -> tuple:
        owner, ids, rows, scores = self.heaps.entries()
        of = self.owner[owner]
        return self.anchors.rows[of], [self.opened[i] for i in owner], ids, rows, scores


def mined(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
          scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``vectors`` (vec_id, embedding, label).

    Rows that meet ``anchor`` are anchors. Of each anchor's ``positives`` best rows of its label, the ``negatives`` best
    rows of other labels whose score is between ``low`` and ``high`` percent of the positive's.
    """
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("embedding")).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"), scaled("embedding", scale).alias("values"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = stored(rows, "labelled-vectors")
    tiles = row_tiles(rows.drop("anchor"))
    anchors = rows.where("anchor").drop("anchor")

    found = streamed(
        anchors.withColumn("numbers", F.array().cast("array<long>")), tiles, lambda own: Positives(own, positives),
        "anchor_row long, anchor_id long, id long, row long, score long")
    order = Window.partitionBy("anchor_row").orderBy(F.desc("score"), "id", "row")
    best = stored(found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= positives), "positives")

    opened = best.groupBy("anchor_row").agg(F.collect_set("score").alias("numbers"))  # at most ``positives`` each
    asked = anchors.join(opened, anchors["row"] == opened["anchor_row"]).drop("anchor_row")
    near = streamed(
        asked, tiles, lambda own: Windows(own, negatives, low, high),
        "anchor_row long, positive_score long, negative_id long, row long, negative_score long")
    order = Window.partitionBy("anchor_row", "positive_score").orderBy(F.desc("negative_score"), "negative_id", "row")
    nearest = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    pairs = best.select("anchor_row", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(nearest.drop("row"), ["anchor_row", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
