"""Feature tables written bucketed and sorted by their key, read back through the catalogue.

A join on the key then shuffles and sorts the other side only: the feature side is read bucket by bucket. Keys are
unique in a written table, so lookups need no search for a first row per key.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import scratch_path

BUCKETS = 64


@dataclass(frozen=True)
class FeatureTable:
    """A bucketed table of the catalogue with one row per ``key``."""

    spark: SparkSession
    name: str
    key: str
    buckets: int

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def write_bucketed(df: DataFrame, name: str, key: str, *, buckets: int = BUCKETS, path: str | None = None) -> FeatureTable:
    """Write ``df``, of which ``key`` is unique and known, as a table with a new name that starts with ``name``.

    One shuffle by the key before the write gives one file per bucket. A repeated or missing key is an error.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    df.repartition(buckets, key).write.format("parquet").option("path", path or scratch_path(spark, table)).bucketBy(
        buckets, key).sortBy(key).saveAsTable(table)
    stored = FeatureTable(spark, table, key, buckets)
    # the keys lie bucket by bucket, so this needs no shuffle
    counts = stored.read().groupBy(key).agg(F.count("*").alias("n"))
    wrong = counts.agg(F.count_if((F.col("n") > 1) | F.col(key).isNull()).alias("wrong")).first()["wrong"]
    if wrong:
        stored.drop()
        raise ValueError(f"{wrong} values of {key} are repeated or missing")
    return stored
