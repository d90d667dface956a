"""Typed readers and the feature-table writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources import schemas


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str, sample_size: int | None,
          multi_line: bool) -> DataFrame:
    if fmt == "parquet":
        return _head(spark.read.parquet(path), sample_size)
    if fmt != "csv":
        raise ValueError(f"unsupported format: {fmt}")
    # The header decides which field is which column, so inputs may hold their columns in any order or
    # lack some; every field is read as text first and then cast to its declared type. All files of an
    # input must have the same header: one that differs fails the read, or its fields would be mixed up.
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    columns = reader.csv(path).columns
    texts = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    raw = _head(reader.option("enforceSchema", False).schema(texts).csv(path), sample_size)
    return raw.select(
        *[_typed(name, schema[name].dataType if name in schema.names else T.StringType()) for name in columns]
    )


def _head(df: DataFrame, rows: int | None) -> DataFrame:
    """The first ``rows`` rows, files in the order of their paths.

    Row ids grow inside each split of a file, so path, split and id give the order of the rows; every
    task keeps ``rows`` of its own at most.
    """
    if rows is None:
        return df
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    columns = [F.col(f"`{name}`") for name in df.columns]
    return df.select(*columns, place.alias("_place")).orderBy("_place").limit(rows).drop("_place")


def _typed(name: str, kind: T.DataType):
    text = F.col(f"`{name}`")
    present = F.when(~text.isin(*schemas.MISSING_TEXTS), text)
    return (present if isinstance(kind, T.StringType) else present.cast(kind)).alias(name)


def load_customers(spark: SparkSession, path: str, *, fmt: str = "csv",
                   sample_size: int | None = None, multi_line: bool = False) -> DataFrame:
    """Customers with declared types; ``sample_size`` keeps the first rows, files in the order of their paths."""
    return _read(spark, path, schemas.CUSTOMERS, fmt, sample_size, multi_line)


def load_articles(spark: SparkSession, path: str, *, fmt: str = "csv",
                  sample_size: int | None = None, multi_line: bool = False) -> DataFrame:
    """Articles with declared types; ``sample_size`` keeps the first rows, files in the order of their paths."""
    return _read(spark, path, schemas.ARTICLES, fmt, sample_size, multi_line)


def load_transactions(spark: SparkSession, path: str, *, fmt: str = "csv",
                      sample_size: int | None = None,
                      date_range: tuple[str, str] | None = None) -> DataFrame:
    """Transactions with ``t_dat`` as a date.

    ``sample_size`` (first rows, files in the order of their paths) applies before ``date_range``, which keeps both ends.
    """
    df = _read(spark, path, schemas.TRANSACTIONS, fmt, sample_size, False)
    return between_dates(df.withColumn("t_dat", F.col("t_dat").cast("date")), date_range)


def between_dates(transactions: DataFrame, date_range: tuple[str, str] | None,
                  date_col: str = "t_dat") -> DataFrame:
    """Rows with ``start <= date <= end``; on parquet the filter reaches the scan."""
    if date_range is None:
        return transactions
    kind = transactions.schema[date_col].dataType
    start, end = (F.lit(edge).cast(kind) for edge in date_range)
    return transactions.where(F.col(date_col).between(start, end))


def load_all(spark: SparkSession, customers: str, articles: str, transactions: str, *,
             fmt: str = "csv", sample_sizes: dict[str, int] | None = None,
             date_range: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables; ``sample_sizes`` may name customers, articles and transactions."""
    sizes = sample_sizes or {}
    unknown = set(sizes) - {"customers", "articles", "transactions"}
    if unknown:
        raise ValueError(f"unknown tables in sample_sizes: {sorted(unknown)}")
    return (
        load_customers(spark, customers, fmt=fmt, sample_size=sizes.get("customers")),
        load_articles(spark, articles, fmt=fmt, sample_size=sizes.get("articles")),
        load_transactions(spark, transactions, fmt=fmt, sample_size=sizes.get("transactions"),
                          date_range=date_range),
    )


def write_features(df: DataFrame, path: str, *, month_of: str | None = None) -> None:
    """Write a feature table as parquet, optionally partitioned by the month of a date column.

    Rows are not shuffled by month: a month that holds a third of the rows is still written by many
    tasks, each with its own file.
    """
    if month_of is None:
        df.write.mode("overwrite").parquet(path)
    else:
        stamped = df.withColumn("year_month", F.date_format(month_of, "yyyy-MM"))
        stamped.write.mode("overwrite").partitionBy("year_month").parquet(path)
