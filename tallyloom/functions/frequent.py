"""Most frequent values without counting all values: a summary names candidates, an exact recount decides.

1. Values are hashed into ``BUCKETS`` buckets, whose totals are counted. Totals of parts of the table add up, and no
   value occurs more often than its bucket: that is its bound.
2. The values of the fullest buckets are counted exactly. The count of the k-th best of them is reached by the true
   k-th best.
3. A value that can reach it lies in a bucket whose total does. What of these buckets is not counted yet is counted now;
   ties are among them.

The shuffles carry bucket totals and the values of candidate buckets. Where values are so even that all buckets stay
candidates, that is all values, as a plain count would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import stored

BUCKETS = 1 << 16
FULLEST = 4  # buckets counted first, per wanted value


def frequent_values(df: DataFrame, columns: Sequence[str], top: int, *, buckets: int = BUCKETS) -> DataFrame:
    """(column, rank, value, n) of the ``top`` most frequent known values per column, as text; ties alphabetically."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    long = df.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull()).withColumn(
        "bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int"))
    totals = stored(long.groupBy("column", "bucket").agg(F.count("*").alias("total")), "bucket-totals")  # at most ``buckets`` per column

    def counted(chosen: DataFrame, label: str) -> DataFrame:
        # a bounded table: a row per column and bucket
        rows = long.join(F.broadcast(chosen.select("column", "bucket")), ["column", "bucket"], "left_semi")
        return stored(rows.groupBy("column", "value").agg(F.count("*").alias("n")), label)

    fullest = Window.partitionBy("column").orderBy(F.desc("total"), "bucket")
    placed = stored(totals.withColumn("_place", F.row_number().over(fullest)), "bucket-places")
    first = counted(placed.where(F.col("_place") <= FULLEST * top), "first-candidates")
    best = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    reached = first.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") == top).select(
        "column", F.col("n").alias("least"))  # none for columns with fewer candidates: all buckets stay
    open_buckets = placed.where(F.col("_place") > FULLEST * top).join(F.broadcast(reached), "column", "left").where(
        F.col("least").isNull() | (F.col("total") >= F.col("least")))
    found = first.unionByName(counted(open_buckets, "further-candidates"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("column", "rank", "value", "n")
