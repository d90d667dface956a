"""Data quality of any table: missing values, outliers, distributions, consistency, grades.

Numeric columns are profiled together: one aggregate for moments and sketches, one count inside the brackets that
the sketches give, which serves exact quantiles and outlier counts.
Per-column results have one row per schema column, so they are small and may be broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import brackets
from tallyloom.functions.expressions import missing, numeric_columns, safe_ratio, text_columns
from tallyloom.functions.ordering import named_column, value_counts
from tallyloom.session import stored

# Fixed values
MAX_MISSING_RATE = 0.5
OUTLIER_STD = 3.0
MIN_VALUES = 10
IQR_FACTOR = 1.5
DUPLICATE_RATE = 0.01
GRADES = ((0.9, "A"), (0.7, "B"), (0.5, "C"))
LAST_GRADE = "D"

NUMBER_TEXT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}.*)?$"


# ---------------------------------------------------------------- missing values


def missing_by_column(df: DataFrame, *, max_missing_rate: float = MAX_MISSING_RATE) -> DataFrame:
    """(column, total, missing_count, missing_rate, quality_flag), all columns in one pass."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(missing(df, c)).alias(f"_m{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col("_rows").alias("total"), F.col(f"_m{i}").alias("missing_count"))
        for i, c in enumerate(df.columns)
    ]
    rate = safe_ratio(F.col("missing_count"), F.col("total"))
    return counts.select(F.inline(F.array(*rows))).withColumn("missing_rate", rate).withColumn(
        "quality_flag", F.when(F.col("missing_rate") <= max_missing_rate, "good").otherwise("poor")
    )


def missing_overall(by_column: DataFrame) -> DataFrame:
    """One row: total_missing, total_values, missing_rate, quality_score."""
    sums = by_column.agg(
        F.sum("missing_count").alias("total_missing"), F.sum("total").alias("total_values")
    )
    rated = sums.withColumn("missing_rate", safe_ratio(F.col("total_missing"), F.col("total_values")))
    return rated.withColumn("quality_score", F.greatest(F.lit(0.0), 1 - F.col("missing_rate")))


def missing_summary(by_column: DataFrame) -> DataFrame:
    """One row: columns with missing values, with many, the worst and the average rate."""
    poor = F.col("quality_flag") == "poor"
    return by_column.agg(
        F.count_if(F.col("missing_count") > 0).alias("columns_with_missing"),
        F.count_if(poor).alias("columns_with_high_missing"),
        F.max("missing_rate").alias("worst_missing_rate"),
        F.avg("missing_rate").alias("avg_missing_rate"),
        F.array_join(F.array_sort(F.collect_list(F.when(poor, F.col("column")))), ", ").alias(
            "high_missing_columns"
        ),
    )


# ---------------------------------------------------------------- numeric columns


def moments(long: DataFrame) -> DataFrame:
    """(column, count, mean, std, min, max, skewness, kurtosis), the last two bias-corrected."""
    value = F.col("value")
    return corrected(long.where(value.isNotNull()).groupBy("column").agg(
        F.count("*").alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.skewness(value).alias("_g1"),
        F.kurtosis(value).alias("_g2"),
    ))


def corrected(sums: DataFrame) -> DataFrame:
    """``sums`` with the population's skewness ``_g1`` and kurtosis ``_g2`` corrected for the sample."""
    n = F.col("count").cast("double")
    skew = F.col("_g1") * F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    kurt = F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.col("_g2") + 6)
    constant = F.col("min") == F.col("max")
    return sums.select(
        "column", "count", "mean", "std", "min", "max",
        F.when(n < 3, None).when(constant, 0.0).otherwise(skew).alias("skewness"),
        F.when(n < 4, None).when(constant, 0.0).otherwise(kurt).alias("kurtosis"),
    )


def moments_of(found: brackets.Bracketed) -> DataFrame:
    """(column, count, mean, std, min, max, _g1, _g2) of the sketched columns, one row each."""
    schema = "column string, count long, mean double, std double, min double, max double, _g1 double, _g2 double"
    return found.df.sparkSession.createDataFrame([tuple(r) for r in found.moments], schema)


def outliers(
    df: DataFrame, columns: Sequence[str] | None = None, *, std_threshold: float = OUTLIER_STD,
    min_values: int = MIN_VALUES,
) -> DataFrame:
    """IQR and z-score outliers per numeric column; columns with few values are left out.

    Two scans: moments and sketches, then the counts inside the brackets of the quartiles and of the outlier bounds,
    whatever lies outside in one group per side (see ``brackets``).
    """
    found = brackets.bracketed(df, columns or numeric_columns(df), spread=IQR_FACTOR, mark_beyond=std_threshold)
    quartiles = found.quantiles(brackets.QUARTILES, ["q25", "median", "q75"])
    stats = (
        moments_of(found).where(F.col("count") >= min_values).join(quartiles, "column")
        .withColumn("lower_bound", F.col("q25") - IQR_FACTOR * (F.col("q75") - F.col("q25")))
        .withColumn("upper_bound", F.col("q75") + IQR_FACTOR * (F.col("q75") - F.col("q25")))
    )
    value = F.col("value")
    outside = (value < F.col("lower_bound")) | (value > F.col("upper_bound"))
    carried = ("count", "lower_bound", "upper_bound", "mean", "std", "min", "max", "median")
    counts = found.counts.select("column", "value", "marked", "n")
    tails = counts.join(F.broadcast(stats), "column").groupBy("column", *carried).agg(
        F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("iqr_count"),
        F.coalesce(F.sum(F.when(F.col("marked"), F.col("n"))), F.lit(0)).alias("zscore_count"),
    )
    return tails.select(
        "column",
        "iqr_count",
        (F.col("iqr_count") / F.col("count")).alias("iqr_rate"),
        "lower_bound",
        "upper_bound",
        "zscore_count",
        (F.col("zscore_count") / F.col("count")).alias("zscore_rate"),
        F.lit(float(std_threshold)).alias("threshold"),
        "mean", "std", "min", "max", "median",
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, unique_values) of numeric columns, NULL and NaN left out.

    Columns of one type are counted together in long form: a row per distinct value is shuffled, no row is copied
    per column beside it.
    """
    kinds = dict(df.dtypes)
    families: dict[str, list[str]] = {}
    for c in columns:
        kind = kinds[c]
        families.setdefault("double" if kind in ("float", "double") else kind if "decimal" in kind else "bigint", []).append(c)
    out = None
    for kind, names in families.items():
        values = [F.col(f"`{c}`").cast(kind) for c in names]
        if kind == "double":
            values = [F.nanvl(v, F.lit(None).cast("double")) for v in values]
        entries = [F.struct(F.lit(c).alias("column"), v.alias("v")) for c, v in zip(names, values)]
        each = df.select(F.inline(F.array(*entries))).where(F.col("v").isNotNull()).distinct()
        counted = each.groupBy("column").agg(F.count("*").alias("unique_values"))
        out = counted if out is None else out.unionByName(counted)
    return out


def numeric_distributions(
    df: DataFrame, columns: Sequence[str] | None = None, *, approximate: bool = False
) -> DataFrame:
    """Count, distinct values, moments and quartiles per numeric column with at least two values.

    Distinct values are counted in the column's own type: as doubles, large integers would fall together.
    ``approximate`` takes the quartiles from the sketches alone. The columns are stored: several scans read them.
    """
    names = list(columns or numeric_columns(df))
    if names:
        df = stored(df.select(*(F.col(f"`{n}`") for n in names)), "numeric-columns")
    q_names = ["q25", "median", "q75"]
    if approximate:
        sketches = brackets.sketched(df, names)
        at = [F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(n) for p, n in zip(brackets.QUARTILES, q_names)]
        joined = corrected(sketches).join(sketches.select("column", *at), "column")
    else:
        found = brackets.bracketed(df, names)
        joined = corrected(moments_of(found)).join(found.quantiles(brackets.QUARTILES, q_names), "column")
    return (
        joined.where(F.col("count") >= 2).join(distinct_values(df, names), "column")
        .select("column", "count", "unique_values", "mean", "std", "min", "max", "median", "skewness",
                "kurtosis", "q25", "q75")
    )


def value_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Signs, span and coefficient of variation (infinite at mean 0) per numeric column."""
    long = named_column(df, *(columns or numeric_columns(df))).where(F.col("value").isNotNull())
    value = F.col("value")
    return long.groupBy("column").agg(
        F.bool_or(value < 0).alias("has_negative"),
        F.bool_or(value == 0).alias("has_zero"),
        F.bool_or(value > 0).alias("has_positive"),
        (F.max(value) - F.min(value)).alias("range_span"),
        F.when(F.avg(value) == 0, F.lit(float("inf")))
        .otherwise(F.try_divide(F.stddev_samp(value), F.avg(value)))
        .alias("coefficient_of_variation"),
    )


# ---------------------------------------------------------------- text columns


def text_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n) over the non-NULL values of the text columns."""
    names = list(columns or text_columns(df))
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names])
    return value_counts(texts.unpivot([], names, "column", "value"), ["column"], "value")


def ranked_values(counts: DataFrame, top: int) -> DataFrame:
    """The ``top`` most frequent values per column with their ``rank``, ties alphabetically."""
    order = Window.partitionBy("column").orderBy(F.col("n").desc(), "value")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def categorical_distributions(df: DataFrame, columns: Sequence[str] | None = None, *, top: int = 5) -> DataFrame:
    """Counts, cardinality, most and least frequent value and a top-value map per text column."""
    counts = text_counts(df, columns)
    order = F.struct(-F.col("n"), F.col("value"))
    sums = counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count("*").alias("unique_values"),
        F.min_by("value", order).alias("most_frequent"),
        F.max("n").alias("most_frequent_count"),
        F.max_by("value", order).alias("least_frequent"),
        F.min("n").alias("least_frequent_count"),
    )
    best = ranked_values(counts, top).groupBy("column").agg(
        F.map_from_entries(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", "value", "n"))),
                lambda entry: F.struct(entry["value"], entry["n"]),
            )
        ).alias("top_values")
    )
    listed = missing_by_column(df.select(*(columns or text_columns(df)))).select("column")
    rate = F.coalesce(safe_ratio(F.col("unique_values"), F.col("count")), F.lit(0.0))
    zeros = ["count", "unique_values", "most_frequent_count", "least_frequent_count"]
    return (
        listed.join(sums, "column", "left").fillna(0, zeros)
        .withColumn("cardinality_rate", rate).join(best, "column", "left")
    )


# ---------------------------------------------------------------- consistency


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows beyond the first of each group of equal rows, and their share.

    Equal rows are merged before the shuffle, so any number of copies of one row is cheap.
    """
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_n"))
    sums = groups.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_count"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
    )
    rate = F.coalesce(safe_ratio(F.col("duplicate_count"), F.col("_rows")), F.lit(0.0))
    return sums.select("duplicate_count", rate.alias("duplicate_rate"))


def type_profile(df: DataFrame) -> DataFrame:
    """(column, type, null_count, non_null_count, kind shares, type_consistency) per column.

    A text column is consistent if all its values are numbers, all are dates, or none is either.
    """
    texts = set(text_columns(df))
    aggregates = [F.count("*").alias("_rows")]
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        aggregates.append(F.count_if(missing(df, c)).alias(f"_null{i}"))
        if c in texts:
            number = col.rlike(NUMBER_TEXT)
            aggregates.append(F.count_if(number).alias(f"_number{i}"))
            aggregates.append(F.count_if(col.rlike(DATE_TEXT) & ~number).alias(f"_date{i}"))
    rows = []
    for i, field in enumerate(df.schema.fields):
        known = F.col("_rows") - F.col(f"_null{i}")
        if field.name in texts:
            number, date = F.col(f"_number{i}"), F.col(f"_date{i}")
            shares = [safe_ratio(number, known), safe_ratio(date, known), safe_ratio(known - number - date, known)]
            kinds = (number > 0).cast("int") + (date > 0).cast("int") + (known > number + date).cast("int")
            consistent = kinds <= 1
        else:
            shares, consistent = [F.lit(None).cast("double")] * 3, F.lit(True)
        rows.append(F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col(f"_null{i}").alias("null_count"),
            known.alias("non_null_count"),
            *[s.alias(n) for s, n in zip(shares, ("number_share", "date_share", "text_share"))],
            consistent.alias("type_consistency"),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- report


def grade(score: Column, *, last: str = LAST_GRADE, steps: Sequence[tuple[float, str]] = GRADES) -> Column:
    out = None
    for least, letter in steps:
        out = F.when(score >= least, letter) if out is None else out.when(score >= least, letter)
    return out.otherwise(last)


def quality_report(df: DataFrame, name: str = "dataset") -> DataFrame:
    """One row: size, missing rate, duplicate rate, overall score and grade."""
    repeated = duplicate_rows(df).select(F.struct("duplicate_count", "duplicate_rate").alias("d")).scalar()
    overall = missing_overall(missing_by_column(df)).withColumn("_d", repeated).select("*", "_d.*")
    score = (F.col("quality_score") + 1 - F.col("duplicate_rate")) / 2
    return overall.select(
        F.lit(name).alias("dataset"),
        (F.col("total_values") / len(df.columns)).cast("long").alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        "missing_rate",
        "quality_score",
        "duplicate_count",
        "duplicate_rate",
        score.alias("score"),
        grade(score).alias("grade"),
    )


def recommendations(df: DataFrame, *, max_missing_rate: float = MAX_MISSING_RATE) -> DataFrame:
    """(code, columns): what to look at, one row per finding."""
    high = missing_summary(missing_by_column(df, max_missing_rate=max_missing_rate)).where(
        F.col("columns_with_high_missing") > 0
    ).select(F.lit("high_missing").alias("code"), F.col("high_missing_columns").alias("columns"))
    repeated = duplicate_rows(df).where(F.col("duplicate_rate") > DUPLICATE_RATE).select(
        F.lit("duplicate_rows").alias("code"), F.lit("").alias("columns")
    )
    mixed = (
        type_profile(df).where(~F.col("type_consistency"))
        .agg(F.array_join(F.array_sort(F.collect_list("column")), ", ").alias("columns"))
        .where(F.col("columns") != "")
        .select(F.lit("mixed_types").alias("code"), "columns")
    )
    return high.unionByName(repeated).unionByName(mixed)


def quality_scores(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, score, grade) per table and their mean; the mean is graded A, B or C."""
    out = None
    for name, df in tables.items():
        row = quality_report(df, name).select("dataset", "score", "grade")
        out = row if out is None else out.unionByName(row)
    mean = out.agg(F.avg("score").alias("score")).select(
        F.lit("average").alias("dataset"), "score", grade(F.col("score"), last="C", steps=GRADES[:2]).alias("grade")
    )
    return out.unionByName(mean)
