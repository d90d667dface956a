"""Helpers that several operators share: text access, row batches, stored numbering, query paths."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import scratch_path, stored

#: White space of the word definition `[^\x20\x09-\x0D]+`.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; a name inside a lambda would be computed per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def lines_with_words(text: Column) -> Column:
    """Lines (split at \\n) that hold a word, in their order."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def small_batches(spark: SparkSession, rows: int = 512, size: int = 16 << 20) -> None:
    """Rows and bytes of one Arrow batch: bounds what a Python worker holds when texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def numbered(df: DataFrame, order: Sequence[str], sums: Sequence[str] = (), label: str = "numbered") -> DataFrame:
    """``df`` stored in the order of ``order``, with ``position`` (from 0) and ``<sum>_before`` per column of ``sums``.

    A range partitioning sorts slice by slice; the row ids that Spark counts inside each partition are
    stored with the rows, so a retried reader sees the numbers of the first run. Offsets are cumulated
    over one row per partition. ``order`` should be nearly a key, else equal rows share a partition.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_last() for c in order]
    placed = stored(
        df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()),
        label,
    ).withColumns({"_part": F.shiftright("_at", 33), "_in": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    aggregates = [F.count(F.lit(1)).alias("_rows"), *(F.sum(c).alias(f"_sum_{c}") for c in sums)]
    per_part = placed.groupBy("_part").agg(*aggregates)
    upto = _window_over_partitions()  # one row per partition of the shuffle
    offsets = per_part.select(
        "_part",
        F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_before"),
        *(F.coalesce(F.sum(f"_sum_{c}").over(upto), F.lit(0)).alias(f"_before_{c}") for c in sums),
    )
    out = placed.join(offsets, "_part")
    if sums:
        inside = _inside_partition()
        out = out.withColumns({
            f"{c}_before": F.col(f"_before_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums
        })
    return out.withColumn("position", F.col("_before") + F.col("_in")).drop(
        "_part", "_in", "_at", "_before", *(f"_before_{c}" for c in sums)
    )


def _window_over_partitions():
    from pyspark.sql import Window

    return Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)


def _inside_partition():
    from pyspark.sql import Window

    return Window.partitionBy("_part").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)


__all__ = [
    "SPACE_CHARS", "SPACE_CLASS", "let", "lines_with_words", "numbered", "scratch_path", "small_batches", "stored",
    "table", "text_or_empty", "words_of",
]
