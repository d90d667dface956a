"""Registered queries: training sets, set operations, key joins and feature vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions.hashing import key_number
from tallyloom.operators import customers as cust
from tallyloom.operators import articles as art
from tallyloom.operators import retrieval
from tallyloom.operators import training as tr
from tallyloom.operators import vectorize as vec
from tallyloom.plans import features
from tallyloom.plans.feature_queries import (
    ARTICLE_SQL, CUSTOMER_SQL, POPULARITY_DOUBLES, POPULARITY_SQL, article_popularity, customer_table,
)
from tallyloom.plans.registry import query
from tallyloom.session import stored
from tallyloom.sources import retail
from tallyloom.sources.feature_store import write_bucketed

# together unique per transaction, all integers
TIES = ("order_id", "line_no", "supplier_id", "amount_cents")

# ---------------------------------------------------------------- positives


def _positives_sql(name: str, source: str) -> str:
    return f"""
, {name} AS (
SELECT customer_id, article_id, t_dat AS interaction_date, price,
  row_number() OVER (PARTITION BY customer_id ORDER BY t_dat DESC, article_id DESC, price DESC) AS recency
FROM {source} QUALIFY recency <= 50)
"""


POSITIVES_SQL = _positives_sql("positives", "tx")


def positives(spark, sf_dir):
    return tr.last_interactions(retail.transactions(spark, sf_dir))


query("d1_last_interactions", f"{POSITIVES_SQL} SELECT * FROM positives", doubles=("price",))(positives)


@query("d1_active_interactions", """
, often_c AS (SELECT customer_id FROM tx GROUP BY 1 HAVING count(*) >= 30)
, often_a AS (SELECT article_id FROM tx WHERE customer_id IN (SELECT * FROM often_c) GROUP BY 1 HAVING count(*) >= 20)
SELECT customer_id, article_id, t_dat AS interaction_date, price,
  row_number() OVER (PARTITION BY customer_id ORDER BY t_dat DESC, article_id DESC, price DESC) AS recency
FROM tx WHERE customer_id IN (SELECT * FROM often_c) AND article_id IN (SELECT * FROM often_a) QUALIFY recency <= 10""",
       doubles=("price",))
def d1_active(spark, sf_dir):
    return tr.last_interactions(
        retail.transactions(spark, sf_dir), n=10, min_per_customer=30, min_per_article=20
    )


# ---------------------------------------------------------------- negatives


def _key(seed: int, turn: int, column: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}|{turn}|' || {column}), 1, 15) AS BIGINT)"


def _negatives_sql(name: str, source: str, seed: int, k: int = 4) -> str:
    n = name
    return f"""
, {n}_known AS (SELECT DISTINCT customer_id, article_id FROM {source})
, {n}_c AS (SELECT customer_id, row_number() OVER (ORDER BY customer_id) - 1 AS i
  FROM (SELECT DISTINCT customer_id FROM {source}))
, {n}_a AS (SELECT article_id, row_number() OVER (ORDER BY article_id) - 1 AS i FROM articles)
, {n}_size AS (SELECT (SELECT count(*) FROM {source}) * {k} AS target, (SELECT count(*) FROM {n}_c) AS c,
  (SELECT count(*) FROM {n}_a) AS a, (SELECT count(*) FROM {n}_known) AS known)
, {n}_free AS (SELECT *, CAST(c AS HUGEINT) * a - known AS free FROM {n}_size)
, {n}_draw AS (SELECT c, a, unnest(range(CAST(target + known AS BIGINT))) AS j FROM {n}_free)
, {n}_0 AS (SELECT c, a, j, j // a AS x, j % a AS y FROM {n}_draw)
, {n}_1 AS (SELECT * REPLACE ((x + {_key(seed, 0, 'y')}) % c AS x) FROM {n}_0)
, {n}_2 AS (SELECT * REPLACE ((y + {_key(seed, 1, 'x')}) % a AS y) FROM {n}_1)
, {n}_3 AS (SELECT * REPLACE ((x + {_key(seed, 2, 'y')}) % c AS x) FROM {n}_2)
, {n}_4 AS (SELECT * REPLACE ((y + {_key(seed, 3, 'x')}) % a AS y) FROM {n}_3)
, {name} AS (
SELECT customer_id, article_id, 0 AS label FROM {n}_4 JOIN {n}_c ON x = {n}_c.i JOIN {n}_a ON y = {n}_a.i
WHERE (customer_id, article_id) NOT IN (SELECT (customer_id, article_id) FROM {n}_known)
QUALIFY row_number() OVER (ORDER BY j) <= (SELECT target FROM {n}_size))
"""


def _samples_sql(name: str, pos: str, neg: str, seed: int) -> str:
    return f"""
, {name} AS (
SELECT *, md5('{seed}|' || customer_id || '|' || article_id || '|' || label || '|' || occurrence) AS shuffle_key FROM (
  SELECT customer_id, article_id, 1 AS label, recency AS occurrence FROM {pos}
  UNION ALL SELECT customer_id, article_id, 0, 0 FROM {neg}))
"""


NEGATIVES_SQL = POSITIVES_SQL + _negatives_sql("negatives", "positives", 42)
SAMPLES_SQL = NEGATIVES_SQL + _samples_sql("samples", "positives", "negatives", 42)


@query("d2_negative_samples", f"{NEGATIVES_SQL} SELECT * FROM negatives")
def d2(spark, sf_dir):
    return tr.negative_samples(positives(spark, sf_dir), retail.articles(spark, sf_dir))


@query("d3_labelled_samples", f"{SAMPLES_SQL} SELECT customer_id, article_id, label FROM samples")
def d3(spark, sf_dir):
    known = tr.stored_positives(retail.transactions(spark, sf_dir))
    return tr.labelled_samples(known, tr.negative_samples(known, retail.articles(spark, sf_dir))).drop("occurrence")


def _samples(spark, sf_dir):
    return tr.training_samples(retail.transactions(spark, sf_dir), retail.articles(spark, sf_dir))


query("d4_shuffle_key", f"{SAMPLES_SQL} SELECT * FROM samples")(_samples)

# ---------------------------------------------------------------- split

SPLIT_SQL = f"""
, numbered AS (SELECT *, row_number() OVER (ORDER BY t_dat, md5({" || '|' || ".join(TIES)})) AS place,
  count(*) OVER () AS n FROM tx)
, split AS (SELECT *, CASE WHEN place <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'validation' END AS part
  FROM numbered)
"""


def _halves(spark, sf_dir):
    return tr.temporal_split(retail.transactions(spark, sf_dir).select(*TIES, "customer_id", "article_id", "t_dat"), tie_cols=TIES)


@query("d5_temporal_split", f"""{SPLIT_SQL}
SELECT {', '.join(TIES)}, customer_id, article_id, t_dat, part FROM split""")
def d5(spark, sf_dir):
    train, validation = _halves(spark, sf_dir)
    both = train.withColumn("part", F.lit("train")).unionByName(
        validation.withColumn("part", F.lit("validation"))
    )
    return both.select(*TIES, "customer_id", "article_id", "t_dat", "part")


HOT_COLUMNS = ("t_dat", "hot", "customer_id", "order_id", "line_no")


@query("d5_split_among_ties", f"""
, rows_ AS (SELECT t_dat, article_id % 2 AS hot, customer_id, order_id, line_no FROM tx WHERE t_dat >= DATE '1996-01-01')
, numbered AS (SELECT *, row_number() OVER (ORDER BY date_trunc('year', t_dat), md5(CAST(hot AS VARCHAR)),
  md5({" || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in ("year", *HOT_COLUMNS[1:]))})) AS place, count(*) OVER () AS n
  FROM (SELECT *, CAST(date_trunc('year', t_dat) AS DATE) AS year FROM rows_))
SELECT year, hot, customer_id, order_id, line_no, CASE WHEN place <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'validation' END AS part
FROM numbered""")
def d5_ties(spark, sf_dir):
    """By year, ties by one of two values: the cut falls among rows that only their other columns tell apart."""
    tx = retail.transactions(spark, sf_dir).where("t_dat >= '1996-01-01'").select(
        F.trunc("t_dat", "year").alias("year"), (F.col("article_id") % 2).alias("hot"), "customer_id", "order_id", "line_no")
    halves = tr.temporal_split(tx, date_col="year", tie_cols=["hot"])
    return halves[0].withColumn("part", F.lit("train")).unionByName(halves[1].withColumn("part", F.lit("validation")))


@query("d5_events_by_time", """
SELECT event_id, user_id, event_type, CASE WHEN row_number() OVER (ORDER BY ts, md5(CAST(user_id AS VARCHAR)),
  md5(event_id || '|' || user_id || '|' || event_type)) <= floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) THEN 'train'
  ELSE 'validation' END AS part FROM events""", views=False)
def d5_events(spark, sf_dir):
    events = retail.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    halves = tr.temporal_split(events, date_col="ts", tie_cols=["user_id"])
    both = halves[0].withColumn("part", F.lit("train")).unionByName(halves[1].withColumn("part", F.lit("validation")))
    return both.drop("ts")


@query("d5_split_by_date", """
SELECT CASE WHEN t_dat <= DATE '2000-12-31' THEN 'train' ELSE 'validation' END AS part, count(*) AS n,
  min(t_dat) AS first_date, max(t_dat) AS last_date
FROM tx WHERE t_dat <= DATE '2001-01-07' GROUP BY 1""")
def d5_by_date(spark, sf_dir):
    halves = tr.split_by_date(retail.transactions(spark, sf_dir), "2000-12-31", validation_days=7)
    rows = [
        half.groupBy(F.lit(part).alias("part")).agg(
            F.count("*").alias("n"), F.min("t_dat").alias("first_date"), F.max("t_dat").alias("last_date")
        )
        for part, half in zip(("train", "validation"), halves)
    ]
    return rows[0].unionByName(rows[1])


def _digest(samples, part):
    return samples.groupBy(F.lit(part).alias("part"), "label").agg(
        F.count("*").alias("n"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("article_id").alias("articles"),
        F.sum(key_number(F.col("shuffle_key"), 6)).alias("key_sum"),
    )


D6_SQL = (
    SPLIT_SQL
    + ", tr_tx AS (SELECT * FROM split WHERE part = 'train'), va_tx AS (SELECT * FROM split WHERE part <> 'train')\n"
    + _positives_sql("tr_pos", "tr_tx") + _positives_sql("va_pos", "va_tx")
    + _negatives_sql("tr_neg", "tr_pos", 42) + _negatives_sql("va_neg", "va_pos", 43)
    + _samples_sql("tr_s", "tr_pos", "tr_neg", 42) + _samples_sql("va_s", "va_pos", "va_neg", 43)
    + """
SELECT part, label, count(*) AS n, count(DISTINCT customer_id) AS customers, count(DISTINCT article_id) AS articles,
  CAST(sum(CAST('0x' || substr(shuffle_key, 1, 6) AS BIGINT)) AS BIGINT) AS key_sum
FROM (SELECT 'train' AS part, * FROM tr_s UNION ALL SELECT 'validation', * FROM va_s) GROUP BY part, label"""
)


@query("d6_train_validation_samples", D6_SQL)
def d6(spark, sf_dir):
    train, validation = tr.train_validation_samples(
        retail.transactions(spark, sf_dir).select(*TIES, "customer_id", "article_id", "t_dat", "price"),
        retail.articles(spark, sf_dir), split_ties=TIES,
    )
    return _digest(train, "train").unionByName(_digest(validation, "validation"))


@query("d7_label_statistics", f"""{SAMPLES_SQL}
SELECT count(*) AS dataset_size, CAST(sum(label) AS BIGINT) AS positive_samples,
  CAST(count(*) - sum(label) AS BIGINT) AS negative_samples, avg(label) AS positive_ratio, 1 - avg(label) AS negative_ratio,
  CAST(ceil(count(*) / 256.0) AS BIGINT) AS num_batches FROM samples""", doubles=("positive_ratio", "negative_ratio"))
def d7(spark, sf_dir):
    return tr.label_statistics(_samples(spark, sf_dir), batch_size=256)


@query("d8_training_shards", f"""{SAMPLES_SQL}
, shards AS (SELECT *, CAST('0x' || substr(shuffle_key, 1, 8) AS BIGINT)
  % (SELECT CAST(ceil(count(*) / 20000.0) AS BIGINT) FROM samples) AS shard FROM samples)
, batches AS (SELECT *, (row_number() OVER (PARTITION BY shard ORDER BY shuffle_key) - 1) // 256 AS batch_no FROM shards)
SELECT shard, batch_no, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, min(shuffle_key) AS first_key,
  max(shuffle_key) AS last_key FROM batches GROUP BY shard, batch_no""")
def d8(spark, sf_dir):
    known = tr.stored_positives(retail.transactions(spark, sf_dir))
    rows = known.count() * (1 + tr.NEGATIVES_PER_POSITIVE)
    shards = tr.training_shards(
        tr.samples_of(known, retail.articles(spark, sf_dir)), rows_per_shard=20_000, batch_size=256, rows=rows)
    return shards.groupBy("shard", "batch_no").agg(
        F.count("*").alias("n"), F.sum("label").alias("positives"),
        F.min("shuffle_key").alias("first_key"), F.max("shuffle_key").alias("last_key"),
    )


@query("d9_hashed_sample", f"""{POPULARITY_SQL}
SELECT article_id, total_purchases, avg_selling_price FROM article_popularity
ORDER BY md5('42|' || article_id), article_id LIMIT 1000""", doubles=("avg_selling_price",))
def d9(spark, sf_dir):
    popular = article_popularity(spark, sf_dir).select("article_id", "total_purchases", "avg_selling_price")
    return tr.hashed_sample(popular, 1000, key_cols=("article_id",))


@query("d10_preview", """
SELECT t_dat, customer_id, article_id, price, sales_channel_id FROM tx
ORDER BY t_dat, customer_id, article_id, price LIMIT 5""", doubles=("price",))
def d10(spark, sf_dir):
    columns = ("t_dat", "customer_id", "article_id", "price", "sales_channel_id")
    return tr.preview(retail.transactions(spark, sf_dir).select(*columns), 5, order_by=columns[:4])


# ---------------------------------------------------------------- key joins


@query("j6_unseen_pairs", f"""{SPLIT_SQL}
SELECT DISTINCT customer_id, article_id FROM split WHERE part = 'validation'
EXCEPT SELECT customer_id, article_id FROM split WHERE part = 'train'""")
def j6(spark, sf_dir):
    train, validation = _halves(spark, sf_dir)
    return tr.unseen_pairs(validation, train)


CF = ("age_group", "lifecycle_stage", "age_filled")
AF = ("department_name", "is_black", "description_length")


@query("j7_attach_features", f"""{POSITIVES_SQL}{CUSTOMER_SQL}{ARTICLE_SQL}
SELECT customer_id, article_id, recency, age_group AS customer_age_group, lifecycle_stage AS customer_lifecycle_stage,
  age_filled AS customer_age_filled, department_name AS article_department_name, is_black AS article_is_black,
  description_length AS article_description_length
FROM positives JOIN customer_basic USING (customer_id) JOIN article_basic USING (article_id)""",
       doubles=("customer_age_filled",))
def j7(spark, sf_dir):
    customers = cust.customer_features(retail.customers(spark, sf_dir)).select("customer_id", *CF)
    articles = retail.articles(spark, sf_dir)
    styled = articles.select("*", *art.style_columns()).select("article_id", *AF)
    samples = positives(spark, sf_dir).select("customer_id", "article_id", "recency")
    return tr.attach_features(samples, customers, styled)


@query("j7_bucketed_features", f"""{POSITIVES_SQL}{CUSTOMER_SQL}{ARTICLE_SQL}
SELECT customer_id, article_id, recency, age_group AS customer_age_group, lifecycle_stage AS customer_lifecycle_stage,
  age_filled AS customer_age_filled, department_name AS article_department_name, is_black AS article_is_black,
  description_length AS article_description_length
FROM positives JOIN customer_basic USING (customer_id) JOIN article_basic USING (article_id)""",
       doubles=("customer_age_filled",))
def j7_bucketed(spark, sf_dir):
    """As j7, from feature tables that are written bucketed by their key."""
    customers = cust.customer_features(retail.customers(spark, sf_dir)).select("customer_id", *CF)
    articles = retail.articles(spark, sf_dir)
    styled = articles.select("*", *art.style_columns()).select("article_id", *AF)
    samples = positives(spark, sf_dir).select("customer_id", "article_id", "recency")
    return tr.attach_features(
        samples, write_bucketed(customers, "customer_features", "customer_id", buckets=8),
        write_bucketed(styled, "article_features", "article_id", buckets=8))


@query("j8_first_match_lookup", f"""{POSITIVES_SQL}
, first_sale AS (SELECT article_id, t_dat AS article_first_sold, customer_id AS article_first_buyer FROM tx
  QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY t_dat, {', '.join(TIES)}) = 1)
SELECT customer_id, article_id, recency, article_first_sold, article_first_buyer
FROM positives JOIN first_sale USING (article_id)""")
def j8(spark, sf_dir):
    # read for the samples and for the first sales, which are looked at twice
    tx = stored(retail.transactions(spark, sf_dir).select(*TIES, "customer_id", "article_id", "t_dat", "price"), "transactions")
    first = stored(tr.first_per_key(tx, "article_id", ["t_dat", *TIES]).select(
        "article_id", F.col("t_dat").alias("first_sold"), F.col("customer_id").alias("first_buyer")
    ), "first-sales")
    customers = retail.customers(spark, sf_dir).select("customer_id")
    samples = tr.last_interactions(tx).select("customer_id", "article_id", "recency")
    return tr.attach_features(samples, customers, first)


@query("j9_mark_truth", f"""{SPLIT_SQL}
SELECT DISTINCT customer_id, article_id, (customer_id, article_id) IN (
  SELECT (customer_id, article_id) FROM split WHERE part = 'train') AS bought_before
FROM split WHERE part = 'validation'""")
def j9(spark, sf_dir):
    train, validation = (half.select("customer_id", "article_id").distinct() for half in _halves(spark, sf_dir))
    names = {"customer_id": "query_id", "article_id": "item_id"}
    marked = retrieval.mark_truth(validation.withColumnsRenamed(names), train.withColumnsRenamed(names))
    return marked.select(
        F.col("query_id").alias("customer_id"), F.col("item_id").alias("article_id"), (F.col("label") == 1).alias("bought_before"))


@query("j10_scalar_fill", """
SELECT customer_id, coalesce(age, (SELECT median(age) FROM customers)) AS age_filled,
  coalesce(age, (SELECT median(age) FROM customers)) - (SELECT avg(age) FROM customers) AS age_from_mean
FROM customers""", doubles=("age_filled", "age_from_mean"))
def j10(spark, sf_dir):
    customers = retail.customers(spark, sf_dir).select("customer_id", "age")
    mean = customers.agg(F.avg("age").alias("mean")).scalar()
    filled = customers.withColumn("age_filled", F.coalesce("age", cust.median(customers, "age")))
    return filled.select("customer_id", "age_filled", (F.col("age_filled") - mean).alias("age_from_mean"))


# ---------------------------------------------------------------- set operations


@query("u1_union_all", """
SELECT customer_id AS key_value, 'customer' AS side FROM customers
UNION ALL SELECT customer_id, 'transaction' FROM tx""")
def u1(spark, sf_dir):
    left = retail.customers(spark, sf_dir).select(F.col("customer_id").alias("key_value"), F.lit("customer").alias("side"))
    right = retail.transactions(spark, sf_dir).select(
        F.col("customer_id").alias("key_value"), F.lit("transaction").alias("side")
    )
    return left.unionByName(right)


@query("u2_intersection", "SELECT customer_id FROM tx INTERSECT SELECT customer_id FROM customers")
def u2(spark, sf_dir):
    return retail.transactions(spark, sf_dir).select("customer_id").intersect(
        retail.customers(spark, sf_dir).select("customer_id")
    )


@query("u3_difference", """
SELECT customer_id, article_id FROM tx WHERE sales_channel_id = 1
EXCEPT SELECT customer_id, article_id FROM tx WHERE sales_channel_id <> 1""")
def u3(spark, sf_dir):
    # pairs bought through the first channel alone
    pairs = retail.transactions(spark, sf_dir).select("customer_id", "article_id", "sales_channel_id")
    first = F.col("sales_channel_id") == 1
    return pairs.where(first).drop("sales_channel_id").subtract(pairs.where(~first).drop("sales_channel_id"))


@query("u4_distinct_pairs", "SELECT DISTINCT customer_id, article_id FROM tx")
def u4(spark, sf_dir):
    return retail.transactions(spark, sf_dir).select("customer_id", "article_id").distinct()


# ---------------------------------------------------------------- vectors

CODED = ("department_name", "product_group_name", "colour_group_name", "index_name")
CODE_SQL = ", ".join(
    f"CAST(CASE WHEN {c} IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY {c} NULLS LAST) - 1 END AS BIGINT) AS {c}"
    for c in CODED
)


@query("v1_category_codes", f"SELECT article_id, {CODE_SQL} FROM articles")
def v1(spark, sf_dir):
    return vec.with_category_codes(retail.articles(spark, sf_dir).select("article_id", *CODED), CODED)


@query("v2_z_scores", f"""{POPULARITY_SQL}
SELECT article_id,
  (avg_selling_price - (SELECT avg(avg_selling_price) FROM pop)) / (SELECT stddev_pop(avg_selling_price) FROM pop)
    AS avg_selling_price,
  (total_purchases - (SELECT avg(total_purchases) FROM pop)) / (SELECT stddev_pop(total_purchases) FROM pop)
    AS total_purchases,
  (popularity_score - 20) / CAST(5 AS DOUBLE) AS popularity_score
FROM article_popularity""", doubles=("avg_selling_price", "total_purchases", "popularity_score"))
def v2(spark, sf_dir):
    popular = article_popularity(spark, sf_dir).select(
        "article_id", "avg_selling_price", "total_purchases", "popularity_score"
    )
    return vec.z_scores(
        popular, ("avg_selling_price", "total_purchases", "popularity_score", "absent_column"),
        given={"popularity_score": (20.0, 5.0)},
    )


def _hash_sql(column: str) -> str:
    return f"CAST('0x' || substr(md5({column}), 1, 8) AS BIGINT) % 10000"


@query("v3_hashed_codes", f"""
SELECT article_id, {', '.join(f'{_hash_sql(c)} AS {c}' for c in CODED)}, CAST(size_no AS BIGINT) AS size_no
FROM articles""")
def v3(spark, sf_dir):
    articles = retail.articles(spark, sf_dir).select("article_id", *CODED, "size_no")
    return vec.with_hashed_codes(articles, (*CODED, "size_no"))


@query("v4_stacked_vectors", f"""
, coded AS (SELECT article_id, {CODE_SQL}, list_price, CAST(size_no AS DOUBLE) AS size_no FROM articles)
SELECT article_id, concat_ws(',', {', '.join(CODED)}) AS categorical, 2 AS numerical_size,
  list_price + 2 * size_no AS numerical_sum FROM coded""", doubles=("numerical_sum",))
def v4(spark, sf_dir):
    articles = retail.articles(spark, sf_dir).select("article_id", *CODED, "list_price", "size_no")
    coded = vec.with_category_codes(articles, CODED)
    vectors = vec.stacked(coded, (*CODED, "absent_column"), ("list_price", "absent_column", "size_no"),
                          keep=("article_id",))
    return vectors.select(
        "article_id",
        F.array_join("categorical", ",").alias("categorical"),
        F.size("numerical").alias("numerical_size"),
        (F.get("numerical", F.lit(0)) + 2 * F.get("numerical", F.lit(1))).alias("numerical_sum"),
    )


@query("v5_declared_fills", f"""{CUSTOMER_SQL}
, history AS (SELECT customer_id, avg(price) AS p, count(*) AS n, DATE '2001-08-01' - max(t_dat) AS d FROM tx
  GROUP BY customer_id)
SELECT customer_id, coalesce(d, 365) AS days_since_last_purchase, coalesce(p, 0.05) AS avg_purchase_price,
  coalesce(n, 0) AS total_transactions FROM customer_basic LEFT JOIN history USING (customer_id)""",
       doubles=("avg_purchase_price",))
def v5(spark, sf_dir):
    # a third of the customers never bought anything: their gaps are filled
    table = features.customer_table(
        retail.customers(spark, sf_dir), retail.transactions(spark, sf_dir), retail.articles(spark, sf_dir),
        reference_date="2001-08-01",
    )
    return features.fill_declared(table).select(
        "customer_id", "days_since_last_purchase", "avg_purchase_price", "total_transactions"
    )
