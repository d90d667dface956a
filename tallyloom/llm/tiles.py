"""A stated query set against all rows of a vector table, tile by tile.

Rows are packed into tiles (ids, labels and whole-number components of up to ``TILE`` rows), queries into blocks of
about ``QUERY_BLOCK``. A cell is a query block and a share of the tiles; its task takes the block first and lets the
tiles stream past, so it holds one block, one tile and what the operator keeps per query. Query blocks are copied
once per share of the rows, tiles once per query block; no pair of vectors is written.

Components are whole numbers in doubles; a cell multiplies them as doubles where sums stay below 2^53, as int64
below 2^63 and as Python integers beyond, so scores are exact at any size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import small_batches, stored

TILE = 2048
QUERY_BLOCK = 1024
NOTHING = np.iinfo(np.int64).min  # fills the numbers of a query that has fewer than others
PACKED = "n int, rows binary, ids binary, labels binary, numbers binary, parts binary"


def usable(vector: str | Column) -> Column:
    """Whether a vector takes part: neither null nor holding null or non-finite components."""
    column = F.col(vector) if isinstance(vector, str) else vector
    # after the null check: forall over a null component is null, not false
    return column.isNotNull() & F.coalesce(
        F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def scaled(vector: str | Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as a double, which holds every such number exactly."""
    product = lambda x: F.lit(scale).cast("double") * x.cast("double")
    # beyond 2^52 a double has no fraction, and floor() of Spark gives a long
    return F.transform(vector, lambda x: F.when(F.abs(product(x)) < float(1 << 52), F.floor(product(x)).cast("double")).otherwise(product(x)))


class Tile:
    """Rows of one record: row numbers, ids, labels, values (rows x width, float64) and further numbers per row."""

    def __init__(self, record: dict):
        read = lambda name, kind=np.int64: np.frombuffer(record[name], kind)
        n = record["n"]
        self.rows, self.ids, self.labels = read("rows"), read("ids"), read("labels")
        self.values = read("parts", np.float64).reshape(n, -1) if n else np.zeros((0, 0))
        self.numbers = read("numbers").reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Records of ``rows`` (row, id, label, values array<double>, numbers array<long>), one per Arrow batch."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def even(lists: pa.Array, kind: type, rest: float) -> bytes:
            lengths = np.diff(lists.offsets.to_numpy())
            out = np.full((len(lengths), int(lengths.max(initial=0))), rest, kind)
            inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            out[np.repeat(np.arange(len(lengths)), lengths), inside] = lists.flatten().to_numpy(zero_copy_only=False)
            return out.tobytes()

        for batch in batches:
            if batch.num_rows:
                row, ids, labels = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64).tobytes() for i in range(3))
                record = row, ids, labels, even(batch.column(4), np.int64, NOTHING), even(batch.column(3), np.float64, 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.num_rows], pa.int32()), *(pa.array([x], pa.binary()) for x in record)],
                    names=["n", "rows", "ids", "labels", "numbers", "parts"])

    small_batches(rows.sparkSession, size, 1 << 30)
    return rows.select("row", "id", "label", "values", "numbers").mapInArrow(pack, PACKED)


def row_tiles(rows: DataFrame, size: int = TILE) -> DataFrame:
    """Stored tiles of ``rows`` (row, id, label, values)."""
    tiles = packed(rows.withColumn("numbers", F.array().cast("array<long>")), size)
    out = stored(tiles.withColumn("tile", F.monotonically_increasing_id()), "row-tiles")
    small_batches(rows.sparkSession)
    return out


def streamed(queries: DataFrame, tiles: DataFrame, start: Callable[[Tile], object], schema: str, block: int = QUERY_BLOCK) -> DataFrame:
    """Per cell what ``start(query tile)`` gives: an object with ``meet(tile)`` and ``result()`` (arrays in the order of ``schema``)."""
    spark = queries.sparkSession
    blocks = max(1, -(-queries.count() // block))
    here = packed(queries.repartition(blocks), 2 * block).withColumn("block", F.spark_partition_id())
    here = stored(here, "query-tiles")
    count = max(1, tiles.count())
    shares = min(count, max(-(-count // 64), -(-2 * spark.sparkContext.defaultParallelism // blocks)))
    share = F.pmod(F.shiftright("tile", 33) + F.col("tile").bitwiseAND(F.lit((1 << 33) - 1)), F.lit(shares).cast("long"))
    cell = lambda own: (F.col("block").cast("long") * shares + own).alias("cell")
    columns = [c.split()[0] for c in PACKED.split(", ")]
    asked = here.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).select(
        cell(F.col("share")), F.lit(0).alias("kind"), *columns)
    passing = tiles.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        cell(share), F.lit(1).alias("kind"), *columns)
    cells = asked.unionByName(passing).repartitionById(blocks * shares, F.col("cell").cast("int")).sortWithinPartitions("cell", "kind")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = cell = None
        for batch in batches:
            for record in batch.to_pylist():
                if record["kind"] == 0:
                    if state is not None:
                        yield from _batches(state)
                    state, cell = start(Tile(record)), record["cell"]
                elif record["cell"] == cell:  # a cell may have no queries
                    state.meet(Tile(record))
        if state is not None:
            yield from _batches(state)

    names = [c.split()[0] for c in schema.split(", ")]

    def _batches(state) -> Iterator[pa.RecordBatch]:
        arrays = [pa.array(column, pa.int64()) for column in state.result()]
        if len(arrays[0]):
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    small_batches(spark, 2, 1 << 30)
    out = stored(cells.mapInArrow(meet, schema), "cell-results")
    small_batches(spark)
    return out


def filled(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """``a`` with zeros below and to the right."""
    if a.shape == (height, width):
        return a
    out = np.zeros((height, width), a.dtype)
    out[:a.shape[0], :a.shape[1]] = a
    return out


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices (rows x width) with one width and as int64, or as Python integers where a score could leave int64."""
    width = max(a.shape[1], b.shape[1])
    a, b = (filled(x, len(x), width) for x in (a, b))
    tops = [int(np.abs(x).max(initial=0)) for x in (a, b)]
    if tops[0] * tops[1] * max(width, 1) < 1 << 63 and max(tops) < 1 << 62:
        return a.astype(np.int64), b.astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return whole(a).astype(object), whole(b).astype(object)


def multiplied(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact product of whole-number matrices, in doubles where all sums stay below 2^53."""
    if a.dtype != object and int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1) < 1 << 53:
        return (a.astype(float) @ b.astype(float)).astype(np.int64)
    return whole_product(a, b)


def whole_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product in the numbers' own type; an empty inner dimension gives zeros."""
    return a @ b if a.shape[1] else np.zeros((a.shape[0], b.shape[1]), a.dtype)


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    return np.lexsort((ids, ~scores))[:k]


class Heaps:
    """The ``k`` best (score, id, row) entries of each of ``n`` lists; heaps of several cells merge by the same order."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = [np.zeros(0, np.int64)] * n
        self.ids = [np.zeros(0, np.int64)] * n
        self.rows = [np.zeros(0, np.int64)] * n
        self.floors: list[int | None] = [None] * n  # the k-th best so far

    def offer(self, scores: np.ndarray, allowed: np.ndarray, tile: Tile, at: Sequence[int]) -> None:
        """Scores of one tile for the lists ``at`` (a row of ``scores`` each), where ``allowed``."""
        floors = [self.floors[i] for i in at]
        low = np.array([NOTHING if f is None else f for f in floors], scores.dtype)
        better = allowed & (scores >= low[:, None]) if scores.dtype != object else allowed & np.array(
            [[f is None or s >= f for s in line] for f, line in zip(floors, scores)], bool).reshape(scores.shape)
        for line in np.flatnonzero(better.any(axis=1)).tolist():
            i, places = at[line], np.flatnonzero(better[line])
            values = np.concatenate([self.scores[i], scores[line, places]])
            ids = np.concatenate([self.ids[i], tile.ids[places]])
            rows = np.concatenate([self.rows[i], tile.rows[places]])
            kept = first(values, ids, self.k)
            self.scores[i], self.ids[i], self.rows[i] = values[kept], ids[kept], rows[kept]
            if len(kept) == self.k:
                self.floors[i] = values[kept[-1]]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """(number of the list, id, row, score) of all entries; scores beyond 64 bits can't be returned: OverflowError."""
        owner = np.repeat(np.arange(len(self.ids)), [len(x) for x in self.ids])
        flat = lambda lists: np.concatenate(lists) if lists else np.zeros(0, np.int64)
        return owner, flat(self.ids), flat(self.rows), [int(s) for x in self.scores for s in x]
