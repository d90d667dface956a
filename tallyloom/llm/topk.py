"""Exact highest inner products by the three-phase uniform threshold method.

Vectors are cut into ``SLICES`` ranges of components; each slice knows only its own share of a score.

1. Every slice gathers, per query and tile, its ``gather`` best entries. The k-th best of their whole scores is a
   score that the query's true k-th best reaches.
2. That score is the query's cutoff, sent to all cells with the query: a vector whose score reaches it has, in some
   slice, at least the cutoff divided by the number of slices. All such entries are collected.
3. An entry seen in every slice has its score. For the others an upper bound (unseen slices just below their share)
   decides; those that can still reach the cutoff are resolved exactly. A cell leaves the k best it has per query.

The queries are a stated subset, met with all rows tile by tile (see ``tiles``); both slices of a pair meet in one
task, so nothing is written for a pair that the bound excludes, and at most k entries per query and cell are.

Defined results: vectors that are null, hold null or non-finite components, or have a null id take no part; rows that
repeat, in id too, are rows of their own, and only the query's own row is no candidate; shorter vectors count as
filled up with zeros; equal scores go by the smaller id. A query with fewer than k other vectors gets all of them; an
empty table gives no row; columns besides vec_id and embedding are not read. Scores of any finite components are exact;
a returned score beyond 64 bits is an OverflowError.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import stored
from tallyloom.llm.tiles import NOTHING, Heaps, Tile, exact, multiplied, row_tiles, scaled, streamed, usable

SLICES = 2
ENTRIES = "query_row long, query_id long, id long, row long, score long"


class Cell:
    """The k best entries of each query among those that a phase lets through."""

    def __init__(self, queries: Tile, k: int):
        self.queries, self.heaps = queries, Heaps(len(queries.rows), k)

    def meet(self, tile: Tile) -> None:
        a, b = exact(self.queries.values, tile.values)
        cuts = np.linspace(0, a.shape[1], SLICES + 1).astype(int)
        parts = [multiplied(a[:, i:j], b[:, i:j].T) for i, j in zip(cuts, cuts[1:])]
        other = self.queries.rows[:, None] != tile.rows[None, :]
        self.heaps.offer(sum(parts[1:], parts[0]), other & self.passing(parts, other), tile, range(len(self.queries.rows)))

    def passing(self, parts: list[np.ndarray], other: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def result(self) -> tuple:
        owner, ids, rows, scores = self.heaps.entries()
        return self.queries.rows[owner], self.queries.ids[owner], ids, rows, scores


class Gather(Cell):
    """First phase: the best entries of every slice."""

    def __init__(self, queries: Tile, k: int, gather: int):
        super().__init__(queries, k)
        self.gather = max(gather, k) + 1  # the query's own row may be one of them

    def passing(self, parts: list[np.ndarray], other: np.ndarray) -> np.ndarray:
        n = other.shape[1]
        if n <= self.gather:
            return np.ones(other.shape, bool)
        out = np.zeros(other.shape, bool)
        for part in parts:
            np.put_along_axis(out, np.argpartition(part, n - self.gather, axis=1)[:, n - self.gather:], True, axis=1)
        return out


class Collect(Cell):
    """Second and third phase: entries that reach the cutoff's share in a slice and the cutoff by their bound."""

    def passing(self, parts: list[np.ndarray], other: np.ndarray) -> np.ndarray:
        cutoffs = [int(c) for c in self.queries.numbers[:, 0]]
        kind = parts[0].dtype
        cutoff, share = (np.array(v, kind)[:, None] for v in (cutoffs, [-(-c // SLICES) for c in cutoffs]))
        seen = [(part >= share).astype(bool) for part in parts]
        bound = sum(np.where(s, part, share - 1) for s, part in zip(seen, parts))
        return np.logical_or.reduce(seen) & (bound >= cutoff).astype(bool)


def _best(entries: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def highest(vectors: DataFrame, k: int = 5, every: int = 50, gather: int = 10, query: Column | None = None, scale: int = 256) -> DataFrame:
    """The ``k`` highest scores of each query: query_id, rank, vec_id, score.

    Queries are the vectors that meet ``query``, by default those whose id is divisible by ``every``.
    """
    asked = F.col("vec_id") % every == 0 if query is None else query
    rows = stored(vectors.where(F.col("vec_id").isNotNull() & usable("embedding")).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"), F.lit(0).cast("long").alias("label"),
        scaled("embedding", scale).alias("values"), F.coalesce(asked, F.lit(False)).alias("asked")), "scaled-vectors")
    tiles = row_tiles(rows.drop("asked"))
    queries = rows.where("asked").drop("asked")
    gathered = streamed(
        queries.withColumn("numbers", F.array().cast("array<long>")), tiles, lambda own: Gather(own, k, gather), ENTRIES)
    known = stored(_best(gathered, k).drop("rank"), "gathered")

    # a query with fewer than k gathered entries has seen every other vector: nothing to collect
    cutoffs = known.groupBy("query_row").agg(F.min("score").alias("cutoff"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") == k)
    open_queries = queries.join(cutoffs, queries["row"] == cutoffs["query_row"]).select(
        "row", "id", "label", "values", F.array("cutoff").alias("numbers"))
    collected = streamed(open_queries, tiles, lambda own: Collect(own, k), ENTRIES)
    return _best(known.unionByName(collected).distinct(), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
