"""Exact top-k inner products of two vector tables, with blocks that a score bound excludes.

1. Both sides are cut into blocks of neighbouring vectors: every row goes to the nearest of at most ``PIVOTS`` items
   drawn by hash, and rows of one pivot, in the order of their id's hash, fill blocks. A block is one stored row: ids,
   matrix, centre, radius. A pivot with a third of all rows has more blocks, not larger ones.
2. A query's score with any row of a block is at most its score with the centre plus its length times the radius.
   Each query block first meets the item blocks nearest to it, as many as ``k`` rows need. That gives every query a
   score that its k-th best reaches.
3. Only item blocks whose bound reaches that score for some query are sent to a query block, and its task takes them in
   falling order of their bounds: a block that no running k-th score leaves possible any more is skipped.

An item block travels once to each group of neighbouring query blocks, whatever number of them ask for it. Groups grow
with the queries up to ``GROUP_ROWS``, so that what is sent grows with the items, and beyond that with their product over
``GROUP_ROWS``, also where no bound excludes anything. A task holds one group, one item block and k entries per query, and k
rows per query leave it. Vectors move in their own width and are scaled where they are read; centres and radii (one per
block) are what every query block sees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyloom.session import stored

PIVOTS = 256
GROUP_ROWS = 32_768  # queries that a task holds at most
CHUNK = 4096  # centres that a query block looks at together
SALTED = 16  # query blocks that look at a chunk in one task
NORM_FLOOR = 1e-12  # fixed value
SCORE_PLACES = 9  # scores are rounded, so equal vectors tie whatever block they are scored in
SLACK = 1e-6  # bounds are computed in floats: relative room above them


def matrix_of(vectors: pa.ListArray, metric: str) -> np.ndarray:
    """Rows as float64, at length 1 for ``cosine``; a zero vector stays zero."""
    lengths = np.diff(vectors.offsets.to_numpy())
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("vectors differ in length")
    return scaled(vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(lengths), -1), metric)


def scaled(values: np.ndarray, metric: str) -> np.ndarray:
    values = values.astype(np.float64)
    if metric == "cosine":
        values = values / np.maximum(np.sqrt((values * values).sum(axis=1, keepdims=True)), NORM_FLOOR)
    return values


def rounded(scores: np.ndarray) -> np.ndarray:
    return np.round(scores, SCORE_PLACES) + 0.0  # no negative zero


@dataclass
class Block:
    """One stored block inside a task."""

    name: int
    ids: np.ndarray
    values: np.ndarray
    centre: np.ndarray
    radius: float

    @staticmethod
    def read(row: dict, metric: str) -> Block:
        ids = row["ids"]
        plain = all(isinstance(i, int) for i in ids)
        raw = np.frombuffer(row["parts"], np.float32 if row["narrow"] else np.float64)
        values = scaled(raw.reshape(len(ids), -1), metric)
        return Block(row["block"], np.array(ids, np.int64 if plain else object), values, np.array(row["centre"]), row["radius"])


def _bounds(values: np.ndarray, centres: np.ndarray, radii: np.ndarray, temperature: float) -> np.ndarray:
    """(rows x blocks) what a score can be at most."""
    lengths = np.sqrt((values * values).sum(axis=1, keepdims=True))
    top = (values @ centres.T + lengths * radii[None, :]) / temperature
    return top + SLACK * (1 + np.abs(top))


class Best:
    """The ``k`` best items of each query of a block; ties go to the larger id."""

    def __init__(self, queries: Block, k: int, temperature: float, floors: np.ndarray):
        self.queries, self.k, self.temperature, self.floors = queries, k, temperature, floors
        self.scores: np.ndarray | None = None
        self.ids: np.ndarray | None = None
        self.visited = 0

    def meet(self, items: Block) -> None:
        bound = _bounds(self.queries.values, items.centre[None, :], np.array([items.radius]), self.temperature)[:, 0]
        rows = np.flatnonzero(bound >= self.floors)
        if not len(rows):
            return
        self.visited += 1
        n, q = len(items.ids), len(self.queries.ids)
        if self.scores is None:
            self.scores = np.full((q, self.k), -np.inf)
            self.ids = np.zeros((q, self.k), items.ids.dtype)
        for at in range(0, len(rows), 512):
            some = rows[at:at + 512]
            scores = self.queries.values[some] @ items.values.T / self.temperature
            hopeful = rounded(scores.max(axis=1)) >= self.floors[some]  # the others gain nothing here
            some, scores = some[hopeful], rounded(scores[hopeful])
            if not len(some):
                continue
            ids = np.broadcast_to(items.ids, scores.shape)
            if self.k < n:  # ids of a block fall, so ties beyond the cut are the smaller ids
                kept = best_columns(scores, self.k)
                scores, ids = np.take_along_axis(scores, kept, axis=1), np.take_along_axis(ids, kept, axis=1)
            scores, ids = np.hstack([self.scores[some], scores]), np.hstack([self.ids[some], ids])
            codes = ids if ids.dtype != object else np.unique(ids.astype(str), return_inverse=True)[1].reshape(ids.shape)
            order = np.lexsort((codes, scores), axis=1)[:, :-self.k - 1:-1]
            self.scores[some], self.ids[some] = np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)
        self.floors = np.maximum(self.floors, self.scores[:, -1])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.scores is None:
            return self.queries.ids[:0], np.zeros(0, np.int64), np.zeros(0)
        there = self.scores > -np.inf
        return np.repeat(self.queries.ids, there.sum(axis=1)), self.ids[there], self.scores[there]


def best_columns(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row, the ``k`` columns of highest score in order; ties keep column order."""
    width = scores.shape[1]
    if k >= width:
        return np.argsort(-scores, axis=1, kind="stable")
    part = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    kept = np.take_along_axis(scores, part, axis=1)
    last = kept.min(axis=1)
    out = np.take_along_axis(part, np.lexsort((part, -kept), axis=1), axis=1)
    unclear = np.flatnonzero((scores >= last[:, None]).sum(axis=1) > k)  # ties across the cut
    if unclear.size:
        out[unclear] = np.argsort(-scores[unclear], axis=1, kind="stable")[:, :k]
    return out


# ---------------------------------------------------------------- blocks


def _block_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("n", T.IntegerType()), T.StructField("ids", T.ArrayType(id_type)), T.StructField("parts", T.BinaryType()),
        T.StructField("narrow", T.BooleanType()), T.StructField("centre", T.ArrayType(T.DoubleType())), T.StructField("radius", T.DoubleType()),
    ])


def blocks(side: DataFrame, key: str, pivots: np.ndarray, metric: str, rows: int, label: str) -> DataFrame:
    """Stored blocks (block, n, ids, parts, narrow, centre, radius) of (key, vector); ids of a block fall.

    ``parts`` are the vectors as given, floats where they are ``narrow``.
    """
    id_type, kind = side.schema[key].dataType, side.schema["vector"].dataType.elementType
    narrow = isinstance(kind, T.FloatType)
    arrow_id = to_arrow_type(id_type)
    half = (pivots * pivots).sum(axis=1) / 2

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix_of(batch.column(1), metric)
            near = np.argmax(values @ pivots.T - half, axis=1) if values.shape[1] == pivots.shape[1] else np.zeros(len(values), int)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], names=[key, "vector", "pivot"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def record(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks().sort_by([(key, "descending")])
            values = matrix_of(table.column("vector").combine_chunks(), metric)
            centre = values.mean(axis=0)
            radius = float(np.sqrt(((values - centre) ** 2).sum(axis=1).max()))
            ids = pa.array([table.column(key).to_pylist()], pa.list_(arrow_id))
            given = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return pa.RecordBatch.from_arrays([
                pa.array([len(values)], pa.int32()), ids, pa.array([given.tobytes()], pa.binary()), pa.array([narrow]),
                pa.array([centre.tolist()], pa.list_(pa.float64())), pa.array([radius], pa.float64()),
            ], names=["n", "ids", "parts", "narrow", "centre", "radius"])

        waiting: pa.Table | None = None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            waiting = more if waiting is None else pa.concat_tables([waiting, more])
            while waiting.num_rows:
                pivot = waiting.column("pivot").to_numpy()
                end = int(np.searchsorted(pivot, pivot[0], side="right"))
                if end < rows and end == waiting.num_rows:
                    break  # more of this pivot may follow
                yield record(waiting.slice(0, min(end, rows)))
                waiting = waiting.slice(min(end, rows))
        if waiting is not None and waiting.num_rows:
            yield record(waiting)

    vectors = side.where(F.col("vector").isNotNull() & F.col(key).isNotNull()).select(
        key, F.col("vector").cast("array<float>" if narrow else "array<double>").alias("vector"))
    placed = vectors.mapInArrow(place, T.StructType([*vectors.schema.fields, T.StructField("pivot", T.IntegerType())]))
    order = ["pivot", F.xxhash64(key)]
    packed = placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, _block_schema(id_type))
    return stored(packed.withColumn("block", F.monotonically_increasing_id()), label)


# ---------------------------------------------------------------- search


@dataclass(frozen=True)
class Search:
    """``best`` (query_id, item_id, score), up to 2 k per query; ``cells`` (query_block, item_block) that were sent."""

    best: DataFrame
    cells: DataFrame
    query_blocks: DataFrame
    item_blocks: DataFrame

    def report(self) -> DataFrame:
        """One row: pairs of blocks, how many were sent, and the share that the bounds excluded."""
        one = lambda df: df.agg(F.count("*").alias("n")).scalar()
        counts = self.cells.agg(F.count("*").alias("sent")).select(
            (one(self.query_blocks) * one(self.item_blocks)).alias("block_pairs"), "sent")
        return counts.withColumn("skipped_share", 1 - F.try_divide(F.col("sent").cast("double"), F.col("block_pairs").cast("double")))


def _looked_at(queries: DataFrame, chunks: DataFrame, choose: Callable, schema: str, metric: str) -> DataFrame:
    """Rows of ``choose(query block, floors, centres, radii, sizes)`` for every query block and chunk of centres."""
    n = chunks.agg(F.max("chunk")).scalar()
    # few chunks, many query blocks: both are dealt by a salt as well, so that no task gets all query blocks
    salts = max(1, -(-queries.count() // SALTED))
    asked = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.coalesce(n, F.lit(0))))).withColumn(
        "salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
    joined = asked.join(chunks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["chunk", "salt"])
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = Block.read(row, metric)
                floors = np.array(row["floors"]) if row["floors"] else np.full(len(block.ids), -np.inf)
                parts = row["summaries"]
                centres, radii = np.array([p["centre"] for p in parts]), np.array([p["radius"] for p in parts])
                places, *columns = choose(block, floors, centres, radii, np.array([p["n"] for p in parts]))
                if len(places):
                    item_blocks = np.array([p["block"] for p in parts], np.int64)[places]
                    arrays = [pa.array(np.full(len(places), block.name, np.int64)), pa.array(item_blocks), *(pa.array(c) for c in columns)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return joined.mapInArrow(run, schema)


def grouped(queries: DataFrame, rows: int) -> DataFrame:
    """(block, query_group): neighbouring blocks of ``queries``, ``rows`` queries to a group, give or take a block."""
    sizes = queries.select("block", "n", F.shiftright("block", 33).alias("_part"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("_part").agg(F.sum("n").alias("n"))  # one row per partition of the stored blocks
    starts = parts.select("_part", before(Window.orderBy("_part")).alias("_start"))
    own = sizes.select("block", "_part", before(Window.partitionBy("_part").orderBy("block")).alias("_before"))
    return own.join(starts, "_part").select("block", F.floor((F.col("_start") + F.col("_before")) / rows).alias("query_group"))


def _met(
    queries: DataFrame, items: DataFrame, cells: DataFrame, groups: DataFrame, k: int, metric: str, temperature: float, label: str,
) -> DataFrame:
    """(query_block, query_id, item_id, score): the best of the item blocks that ``cells`` (.., priority) name, by query block."""
    query_type, item_type = (df.schema["ids"].dataType.elementType for df in (queries, items))
    schema = T.StructType([
        T.StructField("query_block", T.LongType()), T.StructField("query_id", query_type), T.StructField("item_id", item_type),
        T.StructField("score", T.DoubleType()),
    ])
    body = ["block", "parts", "narrow", "centre", "radius"]
    none = lambda kind: F.lit(None).cast(T.ArrayType(kind))
    asked = queries.join(groups, "block").select(
        "query_group", F.lit(None).cast("double").alias("priority"), *body, F.col("ids").alias("query_ids"),
        none(item_type).alias("item_ids"), "floors", none(T.LongType()).alias("wanted_by"))
    wanted = cells.join(groups.withColumnRenamed("block", "query_block"), "query_block").groupBy("query_group", "item_block").agg(
        F.max("priority").alias("priority"), F.collect_list("query_block").alias("wanted_by"))
    sent = wanted.join(items, wanted["item_block"] == items["block"]).select(
        "query_group", "priority", *body, none(query_type).alias("query_ids"), F.col("ids").alias("item_ids"),
        F.lit(None).cast("array<double>").alias("floors"), "wanted_by")
    mine = asked.join(cells.select(F.col("query_block").alias("block")).distinct(), "block", "left_semi").select(*sent.columns)
    order = [F.col("query_group"), F.col("priority").desc_nulls_first(), F.col("block")]
    # groups are few and heavy: more partitions than groups, so that few share one
    n = 4 * (1 + (groups.agg(F.max("query_group")).first()[0] or 0))
    stream = mine.unionByName(sent).repartition(n, "query_group").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(best: Best) -> pa.RecordBatch:
            query_ids, item_ids, scores = best.rows()
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(len(scores), best.queries.name, np.int64)), pa.array(query_ids.tolist(), to_arrow_type(query_type)),
                pa.array(item_ids.tolist(), to_arrow_type(item_type)), pa.array(scores)], names=schema.names)

        found: dict[int, Best] = {}
        group = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["query_group"] != group:
                    group = row["query_group"]
                    while found:
                        yield out(found.popitem()[1])
                if row["item_ids"] is None:
                    block = Block.read(row | {"ids": row["query_ids"]}, metric)
                    floors = np.array(row["floors"]) if row["floors"] else np.full(len(block.ids), -np.inf)
                    found[block.name] = Best(block, k, temperature, floors)
                else:
                    items = Block.read(row | {"ids": row["item_ids"]}, metric)
                    for name in row["wanted_by"]:
                        found[name].meet(items)
        while found:
            yield out(found.popitem()[1])

    return stored(stream.mapInArrow(run, schema), label)


def search(queries: DataFrame, items: DataFrame, *, k: int, metric: str, temperature: float, block_rows: int) -> Search:
    """The best ``k`` items of each query, among others; both sides are (id, vector), rows with a null take no part."""
    spark = queries.sparkSession
    n_queries, n_items = queries.count(), items.count()
    drawn = items.where(F.col("vector").isNotNull() & F.col("item_id").isNotNull()).orderBy(F.xxhash64("item_id"), "item_id").limit(
        max(1, min(PIVOTS, -(-n_items // block_rows)))).select(F.col("vector").cast("array<double>").alias("v")).collect()
    pivots = matrix_of(pa.array([r["v"] for r in drawn], pa.list_(pa.float64())), metric) if drawn else np.zeros((1, 0))
    # smaller query blocks where there are few queries, so that all cores have one
    share = -(-n_queries // (2 * spark.sparkContext.defaultParallelism))
    query_rows = max(64, min(block_rows, share))
    item_blocks = blocks(items, "item_id", pivots, metric, block_rows, "item-blocks")
    query_blocks = blocks(queries, "query_id", pivots, metric, query_rows, "query-blocks")
    groups = stored(grouped(query_blocks, max(query_rows, min(GROUP_ROWS, share))), "query-groups")
    start = query_blocks.withColumn("floors", F.lit(None).cast("array<double>"))

    summary = item_blocks.select("block", "n", "centre", "radius")
    count = F.ceil(summary.agg(F.count("*").alias("n")).scalar() / CHUNK)
    chunks = stored(summary.groupBy(F.pmod(F.xxhash64("block"), F.greatest(count, F.lit(1))).cast("int").alias("chunk")).agg(
        F.collect_list(F.struct("block", "n", "centre", "radius")).alias("summaries")), "block-centres")

    def nearest_first(block, floors, centres, radii, sizes):
        near = (block.values @ centres.T).max(axis=0)
        order = np.argsort(-near, kind="stable")
        before = np.cumsum(sizes[order]) - sizes[order]
        kept = order[before < k]
        return kept, near[kept], sizes[kept].astype(np.int64)

    near = _looked_at(start, chunks, nearest_first, "query_block long, item_block long, priority double, n long", metric)
    upto = Window.partitionBy("query_block").orderBy(F.desc("priority"), "item_block").rowsBetween(Window.unboundedPreceding, -1)
    seeds = stored(near.withColumn("_before", F.coalesce(F.sum("n").over(upto), F.lit(0))).where(F.col("_before") < k)
                   .select("query_block", "item_block", "priority"), "first-cells")
    first = _met(start, item_blocks, seeds, groups, k, metric, temperature, "first-scores")

    # a query's floor: its k-th best so far; those with fewer than k entries have none
    ranked = first.groupBy("query_block", "query_id").agg(F.count("*").alias("_n"), F.min("score").alias("_low"))
    floors = ranked.groupBy("query_block").agg(
        F.map_from_entries(F.collect_list(F.struct("query_id", F.when(F.col("_n") >= k, F.col("_low"))))).alias("_floors"))
    left = query_blocks.join(floors, query_blocks["block"] == floors["query_block"], "left")
    lowest = F.lit(float("-inf"))
    known = stored(left.select(*query_blocks.columns, F.transform(
        "ids", lambda i: F.coalesce(F.col("_floors")[i], lowest)).alias("floors")), "floors")

    def possible(block, floors, centres, radii, sizes):
        bounds = _bounds(block.values, centres, radii, temperature)
        kept = np.flatnonzero((bounds >= floors[:, None]).any(axis=0))
        return kept, bounds[:, kept].max(axis=0)

    wanted = _looked_at(known, chunks, possible, "query_block long, item_block long, priority double", metric)
    cells = stored(wanted.join(seeds.select("query_block", "item_block"), ["query_block", "item_block"], "left_anti"), "further-cells")
    second = _met(known, item_blocks, cells, groups, k, metric, temperature, "further-scores")
    best = first.unionByName(second).drop("query_block")
    return Search(best, seeds.drop("priority").unionByName(cells.drop("priority")), query_blocks, item_blocks)
