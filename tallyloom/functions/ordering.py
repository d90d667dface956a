"""Global order without a global sort in one task.

A rank, quantile or positional cut over a whole table needs the table's total order, and a window
without ``partitionBy`` would move every row into one task. The helpers here work in two levels:

1. ``SPLITS`` split points per group are drawn from the distinct values themselves, by smallest hash.
   That is a uniform sample and, being a function of the data only, the same on every evaluation
   (a retried stage can never disagree with its first run).
2. Counts per (group, slice) are cumulated. That table has at most ``SPLITS + 1`` rows per group.
3. Exact work happens inside one slice at a time, about ``distinct values / SPLITS`` rows.

Equal values are always pre-aggregated to (value, count), so a value that holds a third of all rows
is one row from the first shuffle on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import stored

SPLITS = 511


def points_below(points: str, col: str, splits: int) -> Column:
    """How many entries of the sorted array are below the value, by binary search."""
    step = 1
    while step * 2 <= splits:
        step *= 2
    steps = []
    while step:
        steps.append(F.lit(step))
        step //= 2
    found = F.aggregate(
        F.array(*steps),
        F.lit(0),
        lambda at, step: F.when(F.get(F.col(points), at + step - 1) < F.col(col), at + step).otherwise(at),
    )
    # never NULL, and said so: a join on the slice then needs no extra IS NOT NULL search
    return F.coalesce(found, F.lit(0))


def split_points(values: DataFrame, group: Sequence[str], col: str, splits: int = SPLITS) -> DataFrame:
    """Per group, the sorted array of the ``splits`` distinct values with the smallest hash."""
    by_hash = Window.partitionBy(*group).orderBy(F.xxhash64(col), F.col(col))
    return (
        values.select(*group, col)
        .withColumn("_draw", F.row_number().over(by_hash))
        .where(F.col("_draw") <= splits)
        .groupBy(*group)
        .agg(F.array_sort(F.collect_list(col)).alias("_splits"))
    )


def with_slice(
    values: DataFrame, group: Sequence[str], col: str, splits: int = SPLITS, *, where: Column | None = None
) -> DataFrame:
    """Add ``_slice``, the number of split points of the group below the value.

    ``values`` must hold distinct (group, value) rows. ``group`` must have few distinct values
    (column names, metric names); the split points are then a small table and are broadcast. They
    are drawn from the rows that meet ``where``.
    """
    if group:
        drawn = values if where is None else values.where(where)
        joined = values.join(F.broadcast(split_points(drawn, group, col, splits)), list(group))
    else:
        points = (
            values.select(col)
            .orderBy(F.xxhash64(col), F.col(col))
            .limit(splits)
            .agg(F.array_sort(F.collect_list(col)).alias("_splits"))
        )
        joined = values.withColumn("_splits", points.scalar())
    return joined.withColumn("_slice", points_below("_splits", col, splits)).drop("_splits")


def slice_offsets(sliced: DataFrame, group: Sequence[str], weight: Column) -> DataFrame:
    """(group, _slice, _weight, _before, _total): weight of the slice, before it, of the group."""
    sizes = sliced.groupBy(*group, "_slice").agg(F.sum(weight).alias("_weight"))
    # at most SPLITS + 1 rows per group
    whole = Window.partitionBy(*group)
    upto = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *group,
        "_slice",
        "_weight",
        F.coalesce(F.sum("_weight").over(upto), F.lit(0)).alias("_before"),
        F.sum("_weight").over(whole).alias("_total"),
    )


def dense_rank_of_values(
    values: DataFrame,
    group: Sequence[str],
    col: str,
    out: str,
    *,
    descending: bool = False,
    splits: int = SPLITS,
) -> DataFrame:
    """Distinct non-NULL (group, value) rows with their 1-based dense rank inside the group."""
    distinct = values.select(*group, col).where(F.col(col).isNotNull()).distinct()
    sliced = with_slice(distinct, group, col, splits)
    offsets = F.broadcast(slice_offsets(sliced, group, F.lit(1)).drop("_weight"))
    inside = Window.partitionBy(*group, "_slice").orderBy(col)
    ranked = sliced.join(offsets, [*group, "_slice"]).withColumn(
        "_position", F.col("_before") + F.row_number().over(inside)
    )
    rank = F.col("_total") - F.col("_position") + 1 if descending else F.col("_position")
    return ranked.select(*group, col, rank.cast("long").alias(out))


def with_dense_rank(df: DataFrame, col: str, out: str, *, descending: bool = False) -> DataFrame:
    """``df`` plus the dense rank of ``col`` over the whole table (NULL stays NULL)."""
    ranks = dense_rank_of_values(df, [], col, out, descending=descending)
    return df.join(ranks, col, "left")


def with_place(df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """``df``, stored, plus the 1-based place of each row in its group by ``order``.

    Rows are sorted by range, one partition a task; places inside a partition follow from the row numbers stored with
    the rows, and offsets are cumulated over one row per group and partition.
    """
    keys = [F.col(c) for c in group]
    sorted_rows = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = stored(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "places").withColumn(
        "_part", F.shiftright("_at", 33))
    spans = placed.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    upto = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)) + 1 - F.col("_first"))
    return placed.join(offsets.drop("_first", "_n"), [*group, "_part"]).withColumn(
        out, F.col("_at") + F.col("_before")).drop("_at", "_part", "_before")


def value_counts(long: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """(group, value, n) over the non-NULL values."""
    return long.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"))


def quantiles_of_counts(
    counts: DataFrame,
    group: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    names: Sequence[str],
    *,
    weight: str = "n",
    splits: int = SPLITS,
) -> DataFrame:
    """Exact quantiles (linear interpolation) of a (group, value, n) table, one row per group.

    ``group`` is not empty and has few distinct values; name a single column with ``named_column``.
    The result equals an exact percentile, but no aggregation buffer ever holds the value map of a
    column: only the slices that contain a wanted order statistic are sorted.
    """
    key = list(group)
    # the split points come from rows with weight, so they share the aggregate that counts them
    sliced = with_slice(counts, key, value, splits, where=F.col(weight) > 0)
    offsets = slice_offsets(sliced, key, F.col(weight))
    ranks = []
    for p in probabilities:
        at = (F.col("_total") - 1) * F.lit(float(p))
        ranks += [F.floor(at), F.ceil(at)]
    # the slices that hold a wanted rank: at most two per group and probability
    located = F.broadcast(
        offsets.withColumn(
            "_ranks",
            F.filter(
                F.array_distinct(F.array(*ranks)),
                lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_weight")),
            ),
        )
        .where(F.size("_ranks") > 0)
        .drop("_weight")
    )
    inside = (
        Window.partitionBy(*key, "_slice")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ends = sliced.join(located, [*key, "_slice"]).withColumn(
        "_end", F.col("_before") + F.sum(weight).over(inside)
    )
    reached = F.filter("_ranks", lambda r: (r >= F.col("_end") - F.col(weight)) & (r < F.col("_end")))
    hits = ends.withColumn("_rank", F.explode(reached))
    quantiles = []
    for p, name in zip(probabilities, names):
        at = (F.col("_total") - 1) * F.lit(float(p))
        low = F.max(F.when(F.col("_rank") == F.floor(at), F.col(value).cast("double")))
        high = F.max(F.when(F.col("_rank") == F.ceil(at), F.col(value).cast("double")))
        part = F.max(at - F.floor(at))
        quantiles.append((low + (high - low) * part).alias(name))
    return hits.groupBy(*key).agg(*quantiles)


def exact_quantiles(
    long: DataFrame,
    group: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    names: Sequence[str],
    *,
    splits: int = SPLITS,
) -> DataFrame:
    """Exact quantiles of ``value`` per group, NULLs left out."""
    return quantiles_of_counts(
        value_counts(long, group, value), group, value, probabilities, names, splits=splits
    )


def named_column(df: DataFrame, *columns: str) -> DataFrame:
    """Long form (column, value) of numeric columns, values as double; NaN counts as missing."""
    doubles = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns]
    return df.select(*doubles).unpivot([], list(columns), "column", "value")


SMALL_STEP = 1_000_000  # rows below one boundary whose keys a single task may put in order


@dataclass(frozen=True)
class Cut:
    """A key of an ordered table: its levels, their literals, the rows before it, and its own rows."""

    levels: tuple[Column, ...]
    keys: tuple[Column, ...]
    values: tuple
    position: int
    before: int
    size: int


def cut_point(
    df: DataFrame, chains: Sequence[Sequence[Column]], position: Callable[[Column], Column], *, small: int = SMALL_STEP
) -> Cut | None:
    """The key at a 0-based position of a table ordered by the last level of each chain, found without sorting it.

    In a chain each level refines the one before (day, hour, moment; key prefix, key); none is
    NULL. Level by level the rows of the boundary key are counted per next key and the counts
    cumulated, so a window only ever sees the distinct keys of one level below one boundary. Each
    level is one job that returns one row, and filters the next one by a literal, which prunes the
    scan. Where at most ``small`` rows are left, a chain goes to its last level at once; a single row needs no further
    level. ``position`` maps the row count
    to the wanted position; None if that is past the end.
    """
    rows, levels, keys, values = df, [], [], []
    at, before, size = None, 0, 0
    for chain in chains:
        for place, level in enumerate(chain):
            if at is not None and (size == 1 or size <= small and place < len(chain) - 1):
                continue
            counts = rows.groupBy(level.alias("_key")).agg(F.count("*").alias("_n"))
            upto = Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
            wanted = position(F.sum("_n").over(Window.partitionBy())).cast("long") if at is None else F.lit(at)
            placed = counts.select(
                "_key", "_n",
                (F.lit(before) + F.coalesce(F.sum("_n").over(upto), F.lit(0))).alias("_before"),
                wanted.alias("_at"),
            )
            found = placed.where(
                (F.col("_before") <= F.col("_at")) & (F.col("_at") < F.col("_before") + F.col("_n"))
            ).withColumn("_text", F.col("_key").cast("string")).first()
            if found is None:
                return None
            at, before, size = found["_at"], found["_before"], found["_n"]
            # as text, so that no date or time passes through the time zone of this machine
            key = F.lit(found["_text"]).cast(counts.schema["_key"].dataType)
            levels.append(level)
            keys.append(key)
            values.append(found["_key"])
            rows = rows.where(level == key)
    return Cut(tuple(levels), tuple(keys), tuple(values), at, before, size)


def before_cut(cut: Cut) -> tuple[Column, Column]:
    """(key is before the cut, key is the cut), compared level by level: a later level is only
    evaluated where all earlier ones are equal."""
    before, same = F.lit(False), F.lit(True)
    for level, at in reversed(list(zip(cut.levels, cut.keys))):
        before = (level < at) | ((level == at) & before)
        same = (level == at) & same
    return before, same
