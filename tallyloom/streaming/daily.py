"""Feature state that grows by days: partial aggregates are merged, the history is not read again.

A state is a folder of tables about one key (customers or articles), written batch by batch:

* ``daily``: one row per key and day with its partial aggregates and ``n_before``, the key's rows before that day. The
  rows of a window are the difference of two such running sums, so a window reads one row per key and border, in the
  months from the border on. Batches append to it, by month.
* ``totals``: one row per key, the merged partials of all its days. A batch merges its own rows into the last ones.
* ``pairs``: every (key, other) pair once, in the batch that saw it first; new ones are those that no batch before has.
* ``manifest``: one row per committed batch. It is written last, and readers go by it, so a merge that dies half way has
  changed nothing and is written over by its repetition.

Days of a batch come after those of the batches before. Aggregates by key, by (key, day) and by pair start inside the
tasks that read the rows, so a key with a third of all rows is a row per task, or as many rows as it has days. Where a
batch lies by key (``by_key``), what leaves these tasks is about one wide row per key, and narrow rows per day and pair.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators import interactions, temporal
from tallyloom.session import stored

DAYS = "daily"
#: partial aggregate -> how two of them merge; spread of prices by the sum of squared distances from the mean
SUMS = ("n", "known", "weekend", "prices", "price_sum", *(f"month_{m}" for m in range(1, 13)))


@dataclass(frozen=True)
class State:
    """A committed state: ``batches`` of them, up to ``last_day``; empty before the first merge."""

    spark: SparkSession
    path: str
    key: str
    key_type: T.DataType
    other_type: T.DataType
    batches: int = 0
    last_day: datetime.date | None = None

    def _read(self, name: str, schema: T.StructType, batch: Column) -> DataFrame:
        whole = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
        if not self.batches:
            return self.spark.createDataFrame([], whole).drop("batch")
        return self.spark.read.schema(whole).option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}").where(batch).drop("batch")

    def totals(self) -> DataFrame:
        return self._read("totals", self._totals_schema(), F.col("batch") == self.batches - 1)

    def daily(self) -> DataFrame:
        schema = T.StructType([
            T.StructField(self.key, self.key_type), T.StructField("day", T.DateType()), T.StructField("n", T.LongType()),
            T.StructField("n_before", T.LongType()), T.StructField("month", T.IntegerType())])
        return self._read(DAYS, schema, F.col("batch") < self.batches)

    def pairs(self) -> DataFrame:
        schema = T.StructType([T.StructField(self.key, self.key_type), T.StructField("other", self.other_type)])
        return self._read("pairs", schema, F.col("batch") < self.batches)

    def _totals_schema(self) -> T.StructType:
        long, double = T.LongType(), T.DoubleType()
        return T.StructType([
            T.StructField(self.key, self.key_type), *(T.StructField(c, double if c == "price_sum" else long) for c in SUMS),
            T.StructField("first", T.DateType()), T.StructField("last", T.DateType()), T.StructField("price_min", double),
            T.StructField("price_max", double), T.StructField("squares", double), T.StructField("others", long)])


def _month(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day) - 1).cast("int")


def open_state(spark: SparkSession, path: str, transactions: DataFrame, *, key: str, other: str) -> State:
    """The state at ``path`` as its manifest has it; types are those of ``transactions``."""
    state = State(spark, path, key, transactions.schema[key].dataType, transactions.schema[other].dataType)
    try:
        last = spark.read.schema("batch int, last_day date").parquet(f"{path}/manifest").orderBy(F.desc("batch")).first()
    except AnalysisException:  # nothing committed yet
        return state
    return replace(state, batches=last["batch"] + 1, last_day=last["last_day"]) if last else state


def _partials(rows: DataFrame, key: str, date: str, price: str) -> DataFrame:
    """One row per key with the partial aggregates of its rows; ``others`` is still missing."""
    day = F.col(date)
    return rows.groupBy(key).agg(
        F.count("*").alias("n"), F.count("_other").alias("known"), F.count_if(F.weekday(day).isin(5, 6)).alias("weekend"),
        F.count(price).alias("prices"), F.coalesce(F.sum(price), F.lit(0.0)).alias("price_sum"),
        *(F.count_if(F.month(day) == m).alias(f"month_{m}") for m in range(1, 13)),
        F.min(day).alias("first"), F.max(day).alias("last"), F.min(price).alias("price_min"), F.max(price).alias("price_max"),
        F.coalesce(F.var_pop(price) * F.count(price), F.lit(0.0)).alias("squares"),
    )


def _merged(parts: DataFrame, key: str) -> DataFrame:
    """One row per key from partial rows; squared distances are taken from the common mean."""
    aggregates = [F.sum(c).alias(c) for c in SUMS]
    shift = F.when(F.col("prices") > 0, F.col("price_sum") * F.col("price_sum") / F.col("prices")).otherwise(0.0)
    merged = parts.groupBy(key).agg(
        *aggregates, F.min("first").alias("first"), F.max("last").alias("last"), F.min("price_min").alias("price_min"),
        F.max("price_max").alias("price_max"), F.sum(F.col("squares") + shift).alias("_raw"), F.sum("others").alias("others"))
    return merged.withColumn("squares", F.greatest(F.col("_raw") - F.when(
        F.col("prices") > 0, F.col("price_sum") * F.col("price_sum") / F.col("prices")).otherwise(0.0), F.lit(0.0))).drop("_raw")


def by_key(transactions: DataFrame, key: str) -> DataFrame:
    """``transactions``, stored with the rows of a key side by side; a key of very many rows is split over several files."""
    return stored(transactions.hint("rebalance", F.col(key)), "rows-by-key")


def merge(state: State, batch: DataFrame, *, other: str, date: str = "t_dat", price: str = "price") -> State:
    """The state with the days of ``batch``, all of them after its last day; rows without key or date are left out.

    ``batch`` is read four times, a few columns each: give a stored one (``by_key``) if it is the result of joins.
    """
    if batch.schema[date].dataType != T.DateType():
        raise TypeError(f"{date} must be a date: days are the unit of the state")
    key, spark, number = state.key, state.spark, state.batches
    rows = batch.where(F.col(key).isNotNull() & F.col(date).isNotNull()).select(key, F.col(other).alias("_other"), date, F.col(price).cast("double").alias(price))
    first, last = rows.agg(F.min(date), F.max(date)).first()
    if first is None:
        return state
    if state.last_day is not None and first <= state.last_day:
        raise ValueError(f"the batch has {first}, but the state is complete up to {state.last_day}")

    day = F.col("day")
    seen = rows.where(F.col("_other").isNotNull()).select(key, F.col("_other").alias("other")).distinct()
    new_pairs = seen.join(state.pairs(), [key, "other"], "left_anti") if number else seen
    new_pairs.write.mode("overwrite").parquet(f"{state.path}/pairs/batch={number}")
    new_pairs = spark.read.schema(new_pairs.schema).parquet(f"{state.path}/pairs/batch={number}")

    # pairs are counted for themselves: their rows carry a key and a number, not the width of the totals
    zero = F.lit(0).cast("long")
    counted = new_pairs.groupBy(key).agg(F.count("*").alias("others"))
    names = state._totals_schema().fieldNames()
    parts = _partials(rows, key, date, price).join(counted, key, "left").withColumn("others", F.coalesce("others", zero)).select(*names)
    before = state.totals()
    totals = _merged(parts.unionByName(before), key).select(*names) if number else parts
    totals.write.mode("overwrite").parquet(f"{state.path}/totals/batch={number}")

    days = rows.groupBy(key, F.col(date).alias("day")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)  # the days of a key in one batch
    running = days.withColumn("n_before", F.coalesce(F.sum("n").over(upto), zero))
    if number:
        running = running.join(before.select(key, F.col("n").alias("_earlier")), key, "left").withColumn(
            "n_before", F.col("n_before") + F.coalesce("_earlier", zero)).drop("_earlier")
    running.withColumn("month", _month(day)).repartition("month").write.mode("overwrite").partitionBy("month").parquet(
        f"{state.path}/{DAYS}/batch={number}")

    manifest = spark.createDataFrame([(number, last)], "batch int, last_day date").coalesce(1)
    manifest.write.mode("append").parquet(f"{state.path}/manifest")
    return replace(state, batches=number + 1, last_day=last)


# ---------------------------------------------------------------- features


def with_windows(state: State, keys: DataFrame, windows: Mapping[str, tuple[datetime.date, datetime.date | None]]) -> DataFrame:
    """``keys`` (key, n) and per window the key's rows from its first day on, before its second (None: to the end).

    Rows from a day on are the key's rows less the running sum at its first own day from there. Only months from the
    earliest border on are read.
    """
    borders = sorted({b for pair in windows.values() for b in pair if b is not None})
    day = F.col("day")
    at_border = lambda b: F.min_by(F.when(day >= F.lit(b), F.col("n_before")), F.when(day >= F.lit(b), day))
    recent = state.daily().where((F.col("month") >= _month(F.lit(borders[0]))) & (day >= F.lit(borders[0])))
    sums = recent.groupBy(state.key).agg(*(at_border(b).alias(f"_before_{i}") for i, b in enumerate(borders)))
    n = F.col("n")
    since = {b: F.coalesce(n - F.col(f"_before_{i}"), F.lit(0)) for i, b in enumerate(borders)}
    found = keys.join(sums, state.key, "left").withColumns({
        name: since[a] - (since[b] if b is not None else F.lit(0)) for name, (a, b) in windows.items()})
    return found.drop(*(f"_before_{i}" for i in range(len(borders))))


def _lookbacks(name: str, days: Sequence[int], reference: str) -> dict:
    end = datetime.date.fromisoformat(reference)
    return {f"{name}_last_{d}_days": (end - datetime.timedelta(days=d), None) for d in days}


def customer_temporal(state: State, *, reference_date: str = temporal.REFERENCE_DATE, lookbacks: Sequence[int] = (30, 90)) -> DataFrame:
    """The columns of ``temporal.customer_temporal`` from the state of customers."""
    clock = temporal.Clock(state.daily(), "day", reference_date)
    n = F.col("n")
    known = with_windows(state, state.totals(), _lookbacks("purchases", lookbacks, reference_date)).withColumns({
        "_first": F.col("first"), "_last": F.col("last"), "total_transactions": n, "weekend_purchase_ratio": F.col("weekend") / n,
        **{f"_month_{m}": F.col(f"month_{m}") for m in range(1, 13)}})
    return known.select(state.key, *temporal.customer_columns(clock, lookbacks))


def article_temporal(state: State, *, reference_date: str = temporal.REFERENCE_DATE, lookbacks: Sequence[int] = (7, 30)) -> DataFrame:
    """The columns of ``temporal.article_temporal`` from the state of articles, distinct customers counted exactly."""
    clock = temporal.Clock(state.daily(), "day", reference_date)
    known = with_windows(state, state.totals(), _lookbacks("sales", lookbacks, reference_date)).withColumns({
        "_first": F.col("first"), "_last": F.col("last"), "total_sales": F.col("n"), "unique_customers": F.col("others")})
    return known.select(state.key, *temporal.article_columns(clock, lookbacks))


def article_popularity(state: State) -> DataFrame:
    """The columns of ``interactions.article_popularity`` from the state of articles."""
    grouped = state.totals().select(
        state.key, F.col("known").alias("total_purchases"), F.col("others").alias("unique_customers"),
        F.try_divide("price_sum", F.col("prices").cast("double")).alias("avg_selling_price"),
        F.sqrt(F.try_divide("squares", (F.when(F.col("prices") > 1, F.col("prices") - 1)).cast("double"))).alias("price_volatility"),
        F.col("first").alias("first_purchase_date"), F.col("last").alias("last_purchase_date"))
    return interactions.with_popularity(grouped).select(state.key, *interactions.POPULARITY)
