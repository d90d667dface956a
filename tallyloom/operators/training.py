"""Training sets: recent positives, negative sampling, temporal split, shuffling, shards."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.hashing import key_modulo, key_number, text_key
from tallyloom.functions.ordering import before_cut, cut_point, dense_rank_of_values
from tallyloom.session import stored
from tallyloom.sources.feature_store import FeatureTable

# Fixed values
MAX_INTERACTIONS = 50
NEGATIVES_PER_POSITIVE = 4
VALIDATION_FRACTION = 0.2
SEED = 42

COPIES_PER_TASK = 1_000_000
DRAWS_PER_TASK = 4_000_000
LAST_DATE = "9999-12-31"


def last_interactions(
    transactions: DataFrame,
    *,
    n: int = MAX_INTERACTIONS,
    tie_cols: Sequence[str] = ("article_id", "price"),
    min_per_customer: int = 1,
    min_per_article: int = 1,
) -> DataFrame:
    """The ``n`` latest purchases per customer, repeats kept; ``recency`` 1 is the latest.

    The rank is limited before the shuffle too, so each input split sends at most ``n`` rows of a
    customer on, however many it has.
    """
    known = transactions.where(F.col("customer_id").isNotNull())
    for key, least in (("customer_id", min_per_customer), ("article_id", min_per_article)):
        if least > 1:
            often = known.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
            known = known.join(often, key, "left_semi")
    latest = Window.partitionBy("customer_id").orderBy(
        F.col("t_dat").desc(), *[F.col(c).desc() for c in tie_cols]
    )
    return (
        known.withColumn("recency", F.row_number().over(latest))
        .where(F.col("recency") <= n)
        .select("customer_id", "article_id", F.col("t_dat").alias("interaction_date"), "price", "recency")
    )


def _copies(row: DataFrame, count_col: str) -> DataFrame:
    """Each row as often as ``count_col`` says, made in many tasks if that is many."""
    columns = [c for c in row.columns if c != count_col]
    chunks = F.ceil(F.col(count_col) / COPIES_PER_TASK).cast("int")
    parts = (
        row.where(F.col(count_col) > 0)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(1), chunks)))
        .repartition("_chunk")
    )
    size = F.least(
        F.lit(COPIES_PER_TASK), F.col(count_col) - (F.col("_chunk") - 1) * COPIES_PER_TASK
    ).cast("int")
    return parts.withColumn("_copy", F.explode(F.sequence(F.lit(1), size))).select(*columns)


def temporal_split(
    transactions: DataFrame,
    *,
    validation: float = VALIDATION_FRACTION,
    date_col: str = "t_dat",
    tie_cols: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(train, validation): the first ``floor(rows * (1 - validation))`` rows by date, and the rest.

    Rows without a date come last, rows of one date are ordered by the md5 of ``tie_cols`` (default: all columns), rows
    equal in those by the md5 of all columns. The cut is located first, by counting (day, of timestamps also hour, minute
    and second, then key prefixes, then key, then the same of the row), and both halves are plain filters on the table.
    It is stored first, so that a table made by joins is not made again for each of these steps.
    If the cut falls among equal rows, their copies are divided by number.
    """
    transactions = stored(transactions, "split-rows")
    ties = list(tie_cols or transactions.columns)
    key = text_key(*[F.col(c) for c in ties])
    moment = F.coalesce(date_col, F.lit(LAST_DATE).cast(transactions.schema[date_col].dataType))
    kind = transactions.schema[date_col].dataType.typeName()
    times: list[Column] = []
    if kind == "timestamp":
        times = [F.to_date(moment), *(F.date_trunc(unit, moment) for unit in ("hour", "minute", "second"))]
    elif kind == "timestamp_ntz":  # without a zone: date_trunc would shift hours that a zone skips
        times = [F.to_date(moment), F.hour(moment), F.minute(moment), F.second(moment)]
    elif kind != "date":
        times = [F.to_date(moment)]
    prefixes = lambda text: [F.substring(text, 1, 4), F.substring(text, 1, 8), text]
    chains = [[*times, moment], prefixes(key)]
    if set(ties) != set(transactions.columns):  # rows may be equal in the tie columns and differ elsewhere
        chains.append(prefixes(text_key(*[F.col(c) for c in transactions.columns])))
    cut = cut_point(transactions, chains, lambda rows: F.floor(rows * F.lit(1.0 - validation)))
    if cut is None:  # nothing to validate on
        return transactions, transactions.where(F.lit(False))
    before, same = before_cut(cut)
    copies = cut.position - cut.before
    if copies == 0:
        return transactions.where(before), transactions.where(~before)
    # The cut falls among equal rows: count them out. They are one row, or a few whose text form is the same.
    columns = transactions.columns
    ordered = Window.orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    equal = (
        transactions.where(same).groupBy(*columns).agg(F.count("*").alias("_n"))
        .withColumn("_done", F.coalesce(F.sum("_n").over(ordered), F.lit(0)))
        .withColumn("_train", F.least(F.greatest(F.lit(copies) - F.col("_done"), F.lit(0)), F.col("_n")))
        .withColumn("_rest", F.col("_n") - F.col("_train"))
    )
    return (
        transactions.where(before).unionByName(_copies(equal.select(*columns, "_train"), "_train")),
        transactions.where(~before & ~same).unionByName(_copies(equal.select(*columns, "_rest"), "_rest")),
    )


def split_by_date(
    transactions: DataFrame, train_end: str, *, validation_days: int | None = None,
    date_col: str = "t_dat",
) -> tuple[DataFrame, DataFrame]:
    """(train, validation) by calendar: up to and including ``train_end``, and the days after it."""
    kind = transactions.schema[date_col].dataType
    last = F.lit(train_end).cast(kind)
    later = F.col(date_col) > last
    if validation_days is not None:
        later = later & (F.to_date(date_col) <= F.date_add(F.to_date(F.lit(train_end)), validation_days))
    return transactions.where(F.col(date_col) <= last), transactions.where(later)


def scrambled_cells(draws: DataFrame, n_customers: int, n_articles: int, seed: int) -> DataFrame:
    """``draws`` (``_j``) with the cell (``_c``, ``_a``) of each: a keyed bijection of the grid's numbers.

    Each round shifts one coordinate by a hash of the other, which can be undone, so different
    ``_j`` below ``n_customers * n_articles`` give different cells.
    """
    customers, articles = F.lit(max(n_customers, 1)).cast("long"), F.lit(max(n_articles, 1)).cast("long")
    cells = draws.withColumn("_c", F.expr(f"_j DIV {max(n_articles, 1)}")).withColumn("_a", F.pmod("_j", articles))
    for moved, size, shift in _rounds(customers, articles, seed):
        cells = cells.withColumn(moved, F.pmod(F.col(moved) + shift, size))
    # never NULL, and said so: a join on them would look for NULLs first and hash everything once more
    return cells.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("_c", "_a")})


def _rounds(customers: Column, articles: Column, seed: int) -> list[tuple[str, Column, Column]]:
    """(coordinate that moves, its size, by how much) of each round."""
    turns = (("_c", "_a", customers), ("_a", "_c", articles)) * 2
    return [(moved, size, key_number(text_key(seed, turn, F.col(by)), 15)) for turn, (moved, by, size) in enumerate(turns)]


def numbers_of_cells(cells: DataFrame, n_customers: int, n_articles: int, seed: int) -> DataFrame:
    """The number ``_j`` of each cell (``_c``, ``_a``): the rounds of ``scrambled_cells`` undone."""
    customers, articles = F.lit(max(n_customers, 1)).cast("long"), F.lit(max(n_articles, 1)).cast("long")
    for moved, size, shift in reversed(_rounds(customers, articles, seed)):
        cells = cells.withColumn(moved, F.pmod(F.col(moved) - shift, size))
    return cells.select((F.col("_c") * articles + F.col("_a")).alias("_j"))


def end_of_free(taken: DataFrame, target: int) -> int:
    """The number below which ``target`` numbers from 0 are not among the distinct ``_j`` of ``taken``.

    Located by counting ranges of numbers, then parts of the one range where the count is reached.
    """
    rows, known = taken, 0
    for width in (26, 13, 0):
        counts = rows.groupBy(F.shiftright("_j", width).alias("_key")).agg(F.count("*").alias("_n"))
        upto = Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)  # ranges, not numbers
        placed = counts.withColumn("_before", F.lit(known) + F.coalesce(F.sum("_n").over(upto), F.lit(0)))
        begun = placed.where(F.shiftleft("_key", width) - F.col("_before") < target)
        last = begun.agg(F.max_by(F.struct("_key", "_n", "_before"), "_key").alias("last")).first()["last"]
        if last is None:
            break
        known = last["_before"]
        if ((last["_key"] + 1) << width) - known - last["_n"] < target:
            known += last["_n"]
            break
        rows = rows.where(F.shiftright("_j", width) == last["_key"])
    return target + known


def negative_samples(
    positives: DataFrame,
    articles: DataFrame,
    *,
    per_positive: int = NEGATIVES_PER_POSITIVE,
    seed: int = SEED,
) -> DataFrame:
    """``rows(positives) * per_positive`` distinct unknown pairs, drawn uniformly and repeatably.

    Customers are drawn from the positive ones, articles from the whole catalogue. The known pairs
    are counted first, which sizes the draw and fails at once if too few unknown pairs exist. Draws
    are the first cells of the customer x article grid in scrambled order: none comes twice, however dense
    the draw. The scrambling is undone for the known pairs, which gives the numbers to leave out and where the draw ends;
    so draws are made in place, and only travel, as one number each, to get their two ids. Known pairs, those of their
    numbers that may be drawn and the indexes are stored, since several steps read each; shuffles go with each step.
    """
    keep = partial(stored, compression="zstd", drop_shuffles=True)
    known = keep(positives.groupBy("customer_id", "article_id").agg(F.count("*").alias("_rows")), "known-pairs")
    catalogue = articles.select("article_id").where(F.col("article_id").isNotNull()).distinct()
    customer_index = keep(
        dense_rank_of_values(known, [], "customer_id", "_c").select("customer_id", (F.col("_c") - 1).alias("_c")),
        "customer-index",
    )
    article_index = keep(
        dense_rank_of_values(catalogue, [], "article_id", "_a").select("article_id", (F.col("_a") - 1).alias("_a")),
        "article-index",
    )
    size = known.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), F.count("*").alias("pairs")).first()
    n_customers, n_articles = customer_index.count(), article_index.count()
    cells = n_customers * n_articles
    target = size["rows"] * per_positive
    if target > cells - size["pairs"]:  # only then it matters which articles of the known pairs are in the catalogue
        free = cells - known.join(article_index, "article_id").count()
        if target > free:
            raise ValueError(f"{target} negatives wanted, but only {free} unknown pairs exist")

    pairs = known.join(customer_index, "customer_id").join(article_index, "article_id").select("_c", "_a")
    numbers = numbers_of_cells(pairs, n_customers, n_articles, seed)
    # compared inside an array: a filter would hash everything once more
    drawable = F.filter(F.array("_j"), lambda j: j < target + size["pairs"])
    numbers = keep(numbers.select(F.explode_outer(drawable).alias("_j")).where(F.col("_j").isNotNull()), "known-numbers")
    end = end_of_free(numbers, target) if target else 0
    # of a large grid few known pairs are among the draws: a small table, joined where the draws are made
    left_out = keep(numbers.where(F.col("_j") < end), "known-draws")
    spark = positives.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-end // DRAWS_PER_TASK))
    free_draws = spark.range(0, end, 1, tasks).withColumnRenamed("id", "_j").join(left_out, "_j", "left_anti")
    width, zero = max(n_articles, 1), F.lit(0).cast("long")
    kept = scrambled_cells(free_draws, n_customers, n_articles, seed).select(
        F.coalesce(F.col("_c") * F.lit(width).cast("long") + F.col("_a"), zero).alias("_cell"))
    kept = kept.join(customer_index, F.coalesce(F.expr(f"_cell DIV {width}"), zero) == F.col("_c")).select(
        "customer_id", F.coalesce(F.pmod("_cell", F.lit(width).cast("long")), zero).alias("_a"))
    return kept.join(article_index, "_a").select("customer_id", "article_id", F.lit(0).alias("label"))


def labelled_samples(positives: DataFrame, negatives: DataFrame) -> DataFrame:
    """Positives with label 1 and negatives with label 0; ``occurrence`` tells repeats apart."""
    wanted = ("customer_id", "article_id", "label", "occurrence")
    marked = positives.withColumn("label", F.lit(1)).withColumn("occurrence", F.col("recency"))
    return marked.select(*wanted).unionByName(
        negatives.withColumn("label", F.lit(0)).withColumn("occurrence", F.lit(0)).select(*wanted)
    )


def shuffle_key(seed: int = SEED) -> Column:
    """A repeatable random order of labelled samples."""
    return text_key(seed, F.col("customer_id"), F.col("article_id"), F.col("label"), F.col("occurrence"))


def shuffled(samples: DataFrame, *, seed: int = SEED) -> DataFrame:
    """Samples with their ``shuffle_key``; the order itself is made per shard when writing."""
    return samples.withColumn("shuffle_key", shuffle_key(seed))


def training_samples(
    transactions: DataFrame, articles: DataFrame, *, per_positive: int = NEGATIVES_PER_POSITIVE,
    n: int = MAX_INTERACTIONS, tie_cols: Sequence[str] = ("article_id", "price"), seed: int = SEED,
) -> DataFrame:
    """Shuffled, labelled samples of a transaction table."""
    positives = stored_positives(transactions, n=n, tie_cols=tie_cols)
    return samples_of(positives, articles, per_positive=per_positive, seed=seed)


def stored_positives(
    transactions: DataFrame, *, n: int = MAX_INTERACTIONS, tie_cols: Sequence[str] = ("article_id", "price")
) -> DataFrame:
    """(customer_id, article_id, recency) of ``last_interactions``, stored: negatives and samples read them."""
    latest = last_interactions(transactions, n=n, tie_cols=tie_cols).select("customer_id", "article_id", "recency")
    return stored(latest, "positives", "zstd", drop_shuffles=True)


def samples_of(
    positives: DataFrame, articles: DataFrame, *, per_positive: int = NEGATIVES_PER_POSITIVE, seed: int = SEED
) -> DataFrame:
    """Shuffled, labelled samples: every positive and ``per_positive`` negatives for each."""
    negatives = negative_samples(positives, articles, per_positive=per_positive, seed=seed)
    return shuffled(labelled_samples(positives, negatives), seed=seed)


def train_validation_samples(
    transactions: DataFrame, articles: DataFrame, *, validation: float = VALIDATION_FRACTION,
    split_ties: Sequence[str] | None = None, tie_cols: Sequence[str] = ("article_id", "price"),
    per_positive: int = NEGATIVES_PER_POSITIVE, n: int = MAX_INTERACTIONS, seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Samples of both halves; validation draws with ``seed + 1``."""
    halves = temporal_split(transactions, validation=validation, tie_cols=split_ties)
    return tuple(
        training_samples(half, articles, per_positive=per_positive, n=n, tie_cols=tie_cols, seed=seed + i)
        for i, half in enumerate(halves)
    )


def label_statistics(samples: DataFrame, *, batch_size: int, drop_last: bool = False) -> DataFrame:
    """One row: size, positives, negatives, their shares and the number of batches."""
    size, positive = F.count("*"), F.coalesce(F.sum("label"), F.lit(0))
    sums = samples.agg(size.alias("dataset_size"), positive.cast("long").alias("positive_samples"))
    rows = F.col("dataset_size")
    batches = F.floor(rows / batch_size) if drop_last else F.ceil(rows / batch_size)
    return sums.select(
        rows,
        "positive_samples",
        (rows - F.col("positive_samples")).alias("negative_samples"),
        F.try_divide(F.col("positive_samples").cast("double"), rows).alias("positive_ratio"),
        F.try_divide((rows - F.col("positive_samples")).cast("double"), rows).alias("negative_ratio"),
        batches.cast("long").alias("num_batches"),
    )


def training_shards(samples: DataFrame, *, rows_per_shard: int, batch_size: int, rows: int | None = None) -> DataFrame:
    """Shuffled samples with ``shard`` and ``batch_no``; shards are even, being cut by hash.

    ``rows`` is the number of samples, where it is known; else they are counted, which makes them once more.
    """
    shards = samples.agg(F.greatest(F.ceil(F.count("*") / rows_per_shard), F.lit(1)).alias("n")).scalar()
    if rows is not None:
        shards = F.lit(max(-(-rows // rows_per_shard), 1)).cast("long")
    inside = Window.partitionBy("shard").orderBy("shuffle_key")
    return samples.withColumn("shard", key_modulo(F.col("shuffle_key"), shards, 8)).withColumn(
        "batch_no", F.floor((F.row_number().over(inside) - 1) / batch_size).cast("long")
    )


def export_shards(shards: DataFrame, path: str) -> None:
    """Write one folder per shard, rows in shuffled order, one task per shard."""
    ordered = shards.repartition("shard").sortWithinPartitions("shard", "batch_no", "shuffle_key")
    ordered.write.mode("overwrite").partitionBy("shard").parquet(path)


def hashed_sample(df: DataFrame, n: int, *, key_cols: Sequence[str], seed: int = SEED) -> DataFrame:
    """``min(n, rows)`` random rows, the same on every run."""
    key = text_key(seed, *[F.col(c) for c in key_cols])
    return df.orderBy(key, *key_cols).limit(n)


def preview(df: DataFrame, n: int, *, order_by: Sequence[Column | str]) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def unseen_pairs(later: DataFrame, earlier: DataFrame) -> DataFrame:
    """Distinct (customer_id, article_id) of ``later`` that do not occur in ``earlier``."""
    key = ["customer_id", "article_id"]
    return later.select(*key).distinct().join(earlier.select(*key), key, "left_anti")


def first_per_key(df: DataFrame, key: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order_by`` (default: all other columns)."""
    order = list(order_by or [c for c in df.columns if c != key]) or [key]
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == 1).drop("_rn")


def attach_features(
    samples: DataFrame, customer_features: DataFrame | FeatureTable, article_features: DataFrame | FeatureTable
) -> DataFrame:
    """Samples with the features of their customer and article; an unknown key is an error.

    Customer columns get the prefix ``customer_``, article columns ``article_``. Of several feature
    rows of a key the first by its other columns counts, so samples are never multiplied. Tables of the feature
    store have one row per key and are joined bucket by bucket.
    """
    out = samples
    for key, features in (("customer_id", customer_features), ("article_id", article_features)):
        prefix = key.removesuffix("id")
        if isinstance(features, FeatureTable):
            side = features.read()
        else:
            known = features.where(F.col(key).isNotNull())
            repeated = known.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
            side = known if repeated.isEmpty() else first_per_key(known, key)
        renamed = side.select(
            key, *[F.col(c).alias(c if c.startswith(prefix) else prefix + c) for c in side.columns if c != key],
            F.lit(True).alias("_found"),
        )
        message = F.concat(F.lit(f"no features for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
        out = out.join(renamed, key, "left")
        out = out.where(
            F.coalesce(F.col("_found"), F.raise_error(message).cast("boolean"))
        ).drop("_found")
    return out
