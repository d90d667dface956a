"""Registered queries: similarity, top-k retrieval and recommendation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import metrics as m
from tallyloom.operators import nearest
from tallyloom.operators import retrieval as r
from tallyloom.plans.registry import query
from tallyloom.session import stored
from tallyloom.sources import retail

BATCH = 32
HALF = 32

# ---------------------------------------------------------------- vectors


def _vectors(spark, sf_dir, id_name, vector_name="vector"):
    """Whole embeddings as (id, vector)."""
    return retail.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias(id_name), F.col("embedding").alias(vector_name)
    )


def _towers(spark, sf_dir):
    """Each embedding as a query vector (first half) and an item vector (second half)."""
    return retail.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.slice("embedding", 1, HALF).alias("query_vector"),
        F.col("vec_id").alias("item_id"), F.slice("embedding", HALF + 1, HALF).alias("item_vector"),
    )


def _truth(spark, sf_dir):
    """Each query's own item, and the one with the next id."""
    ids = retail.table(spark, sf_dir, "embeddings").select("vec_id")
    own = ids.select(F.col("vec_id").alias("query_id"), F.col("vec_id").alias("item_id"))
    following = ids.select((F.col("vec_id") - 1).alias("query_id"), F.col("vec_id").alias("item_id"))
    return own.unionByName(following.where(F.col("query_id") >= 0))


VECTOR_SQL = f"""WITH vecs AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(embedding[1:{HALF}] AS DOUBLE[]) AS q,
  CAST(embedding[{HALF + 1}:{2 * HALF}] AS DOUBLE[]) AS i, (row_number() OVER (ORDER BY vec_id) - 1) // {BATCH} AS batch
  FROM embeddings)
, truth AS (SELECT vec_id AS query_id, vec_id AS item_id FROM vecs UNION ALL
  SELECT vec_id - 1, vec_id FROM vecs WHERE vec_id >= 1)
"""


def _cosine_sql(a: str, b: str) -> str:
    return (f"list_dot_product({a}, {b}) / (greatest(sqrt(list_dot_product({a}, {a})), 1e-12)"
            f" * greatest(sqrt(list_dot_product({b}, {b})), 1e-12))")


BATCH_SQL = VECTOR_SQL + f"""
, pairs AS (SELECT a.batch, a.vec_id AS query_id, b.vec_id AS item_id,
  round({_cosine_sql('a.q', 'b.i')} / 0.1, 9) + 0 AS score, CAST(a.vec_id = b.vec_id AS INT) AS label
  FROM vecs a JOIN vecs b ON a.batch = b.batch)
"""


def _batches(spark, sf_dir):
    towers = _towers(spark, sf_dir)
    return r.with_batches(towers, "query_id", BATCH)


def _batch_pairs(spark, sf_dir):
    return r.batch_similarity(_batches(spark, sf_dir), temperature=0.1)


query("r1_batch_similarity", f"{BATCH_SQL} SELECT * FROM pairs", views=False, rounded=False)(_batch_pairs)


@query("r1_pair_similarity", f"""{VECTOR_SQL}
SELECT query_id, item_id, round({_cosine_sql('a.q', 'b.i')}, 9) + 0 AS cosine,
  round(list_dot_product(a.q, b.i) / 0.5, 9) + 0 AS scaled_dot
FROM truth JOIN vecs a ON a.vec_id = query_id JOIN vecs b ON b.vec_id = item_id""",
       views=False, rounded=False)
def r1_pairs(spark, sf_dir):
    towers = _towers(spark, sf_dir)
    sides = (towers.select("query_id", F.col("query_vector").alias("vector")),
             towers.select("item_id", F.col("item_vector").alias("vector")))
    cosine = r.pair_similarity(_truth(spark, sf_dir), *sides).withColumnRenamed("score", "cosine")
    return r.pair_similarity(cosine, *sides, metric="dot", temperature=0.5).withColumnRenamed(
        "score", "scaled_dot"
    )


@query("r2_normalised_vectors", f"""{VECTOR_SQL}
, normed AS (SELECT vec_id, v, greatest(sqrt(list_dot_product(v, v)), 1e-12) AS norm FROM vecs)
, unit AS (SELECT vec_id, [x / norm for x in v] AS u FROM normed)
SELECT vec_id, list_dot_product(u, u) AS squared_length, u[1] AS first_value, u[64] AS last_value, list_sum(u) AS total
FROM unit""", doubles=("squared_length", "first_value", "last_value", "total"), views=False)
def r2(spark, sf_dir):
    unit = _vectors(spark, sf_dir, "vec_id").select("vec_id", r.normalised(F.col("vector")).alias("u"))
    return unit.select(
        "vec_id",
        r.dot(F.col("u"), F.col("u")).alias("squared_length"),
        F.get("u", F.lit(0)).alias("first_value"),
        F.get("u", F.lit(63)).alias("last_value"),
        F.aggregate("u", F.lit(0.0), lambda total, x: total + x).alias("total"),
    )


def _top_sql(score: str, k: int) -> str:
    return f"""{VECTOR_SQL}
, scored AS (SELECT a.vec_id AS query_id, b.vec_id AS item_id, round({score}, 9) + 0 AS score FROM vecs a, vecs b)
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id DESC) AS rank FROM scored
QUALIFY rank <= {k}"""


@query("r3_block_scores", _top_sql("list_dot_product(a.q, b.i) / 0.05", 5), views=False, rounded=False)
def r3(spark, sf_dir):
    towers = _towers(spark, sf_dir)
    return r.similar_items(
        towers.select("query_id", F.col("query_vector").alias("vector")),
        towers.select("item_id", F.col("item_vector").alias("vector")),
        k=5, metric="dot", temperature=0.05, block_rows=500,
    )


@query("r4_top_candidates", _top_sql(_cosine_sql("a.v", "b.v"), 20), views=False, rounded=False)
def r4(spark, sf_dir):
    return r.similar_items(_vectors(spark, sf_dir, "query_id"), _vectors(spark, sf_dir, "item_id"), k=20)


@query("r4_skipped_blocks", rounded=False)
def r4_skipped(spark, sf_dir):
    """How many pairs of blocks of the whole table a search for the best 20 leaves out."""
    sides = _vectors(spark, sf_dir, "query_id"), _vectors(spark, sf_dir, "item_id")
    return nearest.search(*sides, k=20, metric="cosine", temperature=1.0, block_rows=256).report()


def _retrieval_sql(n_items: str = "(SELECT max(n) FROM totals)", prefix: str = "") -> str:
    """Needs ranked(query_id, label, rnk) and totals(query_id, n, rel)."""
    return f"""
, ks AS (SELECT unnest([1, 5, 10, 20, 50, 100]) AS k)
, at_k AS (SELECT k, query_id, any_value(rel) AS rel, sum(CASE WHEN rnk <= k THEN label ELSE 0 END) AS hits
  FROM ranked JOIN totals USING (query_id) CROSS JOIN ks GROUP BY k, query_id)
, means AS (SELECT k, avg(hits / CAST(k AS DOUBLE)) AS p,
  avg(CASE WHEN rel > 0 THEN hits / CAST(rel AS DOUBLE) ELSE 0 END) AS r,
  avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END) AS a FROM at_k WHERE k <= {n_items} GROUP BY k)
, retrieval AS (
SELECT '{prefix}precision@' || k AS metric, k, p AS value FROM means
UNION ALL SELECT '{prefix}recall@' || k, k, r FROM means
UNION ALL SELECT '{prefix}top_' || k || '_accuracy', k, a FROM means
UNION ALL SELECT '{prefix}f1@' || k, k, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END FROM means)
"""


RANKED_SQL = """
, ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id DESC) AS rnk FROM scored)
, totals AS (SELECT query_id, count(*) AS n, CAST(sum(label) AS BIGINT) AS rel FROM scored GROUP BY query_id)
"""


@query("r5_retrieval_evaluation", f"""{VECTOR_SQL}
, scored AS (SELECT a.vec_id AS query_id, b.vec_id AS item_id, round(list_dot_product(a.q, b.i), 9) AS score,
  CAST((a.vec_id, b.vec_id) IN (SELECT (query_id, item_id) FROM truth) AS INT) AS label FROM vecs a, vecs b)
{RANKED_SQL}{_retrieval_sql(prefix='test_')} SELECT * FROM retrieval""", doubles=("value",), views=False)
def r5(spark, sf_dir):
    towers = _towers(spark, sf_dir)
    return r.evaluate_retrieval(
        towers.select("query_id", F.col("query_vector").alias("vector")),
        towers.select("item_id", F.col("item_vector").alias("vector")),
        _truth(spark, sf_dir), prefix="test_",
    )


@query("r6_batch_loss", f"""{VECTOR_SQL}
, s AS (SELECT a.vec_id AS i, b.vec_id AS j, {_cosine_sql('a.q', 'b.i')} / 0.1 AS x
  FROM vecs a JOIN vecs b ON a.batch = b.batch)
, per_row AS (SELECT i, ln(sum(exp(x))) - max(x) FILTER (i = j) AS l FROM s GROUP BY i)
SELECT count(*) AS "rows", avg(l) AS loss FROM per_row""", doubles=("loss",), views=False)
def r6(spark, sf_dir):
    return r.batch_loss(_batches(spark, sf_dir), temperature=0.1)


@query("r6_whole_batch_loss", f"""{VECTOR_SQL}
, s AS (SELECT a.vec_id AS i, b.vec_id AS j, {_cosine_sql('a.q', 'b.i')} / 0.1 AS x FROM vecs a, vecs b)
, per_row AS (SELECT i, ln(sum(exp(x))) - max(x) FILTER (i = j) AS l FROM s GROUP BY i)
SELECT count(*) AS "rows", avg(l) AS loss FROM per_row""", doubles=("loss",), views=False)
def r6_whole(spark, sf_dir):
    """The whole table as one batch, in tiles."""
    batches = r.with_batches(_towers(spark, sf_dir), "query_id", 1 << 30)
    return r.batch_loss(batches, temperature=0.1, tile=256)


# ---------------------------------------------------------------- ranking metrics in SQL

RANKING_SQL = """
, steps AS (SELECT query_id, score, count(*) AS n, sum(label) AS rel,
  sum(count(*)) OVER (PARTITION BY query_id ORDER BY score DESC) AS n_upto,
  sum(sum(label)) OVER (PARTITION BY query_id ORDER BY score DESC) AS rel_upto FROM scored GROUP BY query_id, score)
, ap AS (SELECT query_id, sum(rel * rel_upto / CAST(n_upto AS DOUBLE)) / sum(rel) AS ap FROM steps
  GROUP BY query_id HAVING sum(rel) > 0)
, mrr AS (SELECT query_id, coalesce(1 / CAST(min(rnk) FILTER (label = 1) AS DOUBLE), 0) AS rr FROM ranked GROUP BY query_id)
, disc AS (SELECT m, coalesce((SELECT sum(1 / log2(i + 1)) FROM range(1, 101) t(i) WHERE i <= m), 0) AS d
  FROM range(0, 101) u(m))
, dcg AS (SELECT k, query_id, sum(rel / CAST(s.n AS DOUBLE) * (hi.d - lo.d)) AS dcg
  FROM steps s CROSS JOIN (SELECT unnest([1, 5, 10, 20, 50, 100]) AS k) JOIN disc hi ON hi.m = least(k, n_upto)
  JOIN disc lo ON lo.m = least(k, n_upto - s.n) GROUP BY k, query_id)
, ndcg AS (SELECT k, query_id, CASE WHEN n = 1 THEN 0 ELSE dcg / ideal.d END AS v FROM dcg JOIN totals USING (query_id)
  JOIN disc ideal ON ideal.m = least(k, rel) WHERE rel > 0)
, ranking AS (
SELECT 'map' AS metric, CAST(NULL AS INT) AS k, (SELECT avg(ap) FROM ap) AS value
UNION ALL SELECT 'mrr', NULL, (SELECT avg(rr) FROM mrr)
UNION ALL SELECT 'ndcg@' || k, k, avg(v) FROM ndcg WHERE k <= (SELECT max(n) FROM totals) GROUP BY k)
"""


@query("r7_diagonal_evaluation", f"""{BATCH_SQL}
, scored AS (SELECT * FROM pairs) {RANKED_SQL}{_retrieval_sql()}{RANKING_SQL}
SELECT * FROM retrieval UNION ALL SELECT * FROM ranking""", doubles=("value",), views=False)
def r7(spark, sf_dir):
    return m.all_metrics(_batch_pairs(spark, sf_dir), diversity=False)


# ---------------------------------------------------------------- metrics over purchases

SCORED_SQL = """
, scored AS (SELECT customer_id AS query_id, article_id AS item_id, sum(quantity) AS score, max(returned) AS label
  FROM tx GROUP BY customer_id, article_id)
""" + RANKED_SQL
REPORT_SQL = SCORED_SQL + _retrieval_sql()


def scored(spark, sf_dir):
    """Customers as queries, their articles scored by quantity (many ties), relevant if returned."""
    tx = retail.transactions(spark, sf_dir)
    return tx.groupBy(F.col("customer_id").alias("query_id"), F.col("article_id").alias("item_id")).agg(
        F.sum("quantity").alias("score"), F.max("returned").alias("label")
    )


def _profile(spark, sf_dir):
    return m.query_profile(m.ladder(m.tie_groups(scored(spark, sf_dir))))


def _retrieval_query(name: str, pattern: str):
    @query(name, f"{REPORT_SQL} SELECT * FROM retrieval WHERE metric LIKE '{pattern}'", doubles=("value",))
    def build(spark, sf_dir):
        return m.retrieval_metrics(scored(spark, sf_dir)).where(F.col("metric").like(pattern))

    return build


_retrieval_query("m1_precision", "precision@%")
_retrieval_query("m2_recall", "recall@%")
_retrieval_query("m3_hit_rate", "top_%")
_retrieval_query("m4_f1", "f1@%")


@query("m5_average_precision", f"{SCORED_SQL}{RANKING_SQL} SELECT query_id, ap FROM ap", doubles=("ap",))
def m5(spark, sf_dir):
    return _profile(spark, sf_dir).where(F.col("rel") > 0).select("query_id", "ap")


@query("m6_ndcg", f"""{SCORED_SQL}{RANKING_SQL}
SELECT query_id, max(v) FILTER (k = 1) AS ndcg_1, max(v) FILTER (k = 5) AS ndcg_5, max(v) FILTER (k = 10) AS ndcg_10,
  max(v) FILTER (k = 20) AS ndcg_20, max(v) FILTER (k = 50) AS ndcg_50, max(v) FILTER (k = 100) AS ndcg_100
FROM ndcg GROUP BY query_id""", doubles=tuple(f"ndcg_{k}" for k in m.K_VALUES))
def m6(spark, sf_dir):
    return _profile(spark, sf_dir).where(F.col("rel") > 0).select("query_id", *[f"ndcg_{k}" for k in m.K_VALUES])


@query("m7_reciprocal_rank", f"""{SCORED_SQL}
SELECT query_id, min(rnk) FILTER (label = 1) AS first_rank FROM ranked GROUP BY query_id HAVING max(label) = 1""")
def m7(spark, sf_dir):
    pairs = stored(scored(spark, sf_dir), "scored-pairs")  # the ladder and the tie groups read them
    return m.first_hit_rank(pairs, stored(m.query_profile(m.ladder(m.tie_groups(pairs))), "query-profile"))


@query("m5_m7_ranking_report", f"{SCORED_SQL}{RANKING_SQL} SELECT * FROM ranking", doubles=("value",))
def ranking(spark, sf_dir):
    return m.ranking_metrics(stored(scored(spark, sf_dir), "scored-pairs"))


def _item_vectors(spark, sf_dir):
    return retail.articles(spark, sf_dir).select(
        F.col("article_id").alias("item_id"),
        F.array(F.col("size_no").cast("double"), F.col("list_price") / 100, F.length("prod_name").cast("double"))
        .alias("vector"),
    )


DIVERSITY_SQL = SCORED_SQL + """
, best AS (SELECT query_id, item_id, rnk, [CAST(size_no AS DOUBLE), list_price / 100, CAST(length(prod_name) AS DOUBLE)] AS v
  FROM ranked JOIN articles ON article_id = item_id WHERE rnk <= 10)
, distances AS (SELECT a.query_id, avg(list_distance(a.v, b.v)) AS d FROM best a JOIN best b
  ON a.query_id = b.query_id AND a.rnk < b.rnk GROUP BY a.query_id)
, lists AS (SELECT DISTINCT query_id FROM best)
, counts AS (SELECT article_id AS item_id, count(query_id) AS c FROM articles LEFT JOIN best ON article_id = item_id
  GROUP BY article_id)
, placed AS (SELECT c, sum(c) OVER (ORDER BY c, item_id) AS cum FROM counts)
, spread AS (
SELECT 'intra_list_diversity' AS metric, CAST(NULL AS INT) AS k,
  (SELECT avg(coalesce(d, 0)) FROM lists LEFT JOIN distances USING (query_id)) AS value
UNION ALL SELECT 'coverage', NULL, (SELECT avg(CASE WHEN c > 0 THEN 1.0 ELSE 0.0 END) FROM counts)
UNION ALL SELECT 'gini_coefficient', NULL,
  (SELECT (count(*) + 1 - 2 * sum(cum) / max(cum)) / CAST(count(*) AS DOUBLE) FROM placed))
"""


@query("m8_intra_list_diversity", f"{DIVERSITY_SQL} SELECT value FROM spread WHERE metric = 'intra_list_diversity'",
       doubles=("value",))
def m8(spark, sf_dir):
    return m.intra_list_diversity(scored(spark, sf_dir), _item_vectors(spark, sf_dir))


def _catalogue(spark, sf_dir):
    return retail.articles(spark, sf_dir).select(F.col("article_id").alias("item_id"))


@query("m9_coverage", f"{DIVERSITY_SQL} SELECT value FROM spread WHERE metric = 'coverage'", doubles=("value",))
def m9(spark, sf_dir):
    return m.coverage(m.recommendation_counts(scored(spark, sf_dir), _catalogue(spark, sf_dir)))


@query("m10_gini", f"""{DIVERSITY_SQL} SELECT 'gini_coefficient' AS metric, CAST(NULL AS INT) AS k, value FROM spread
WHERE metric = 'gini_coefficient'""", doubles=("value",))
def m10(spark, sf_dir):
    spread = m.diversity_metrics(scored(spark, sf_dir), catalogue=_catalogue(spark, sf_dir))
    return spread.where(F.col("metric") == "gini_coefficient")


@query("m10_recommendation_counts", f"{DIVERSITY_SQL} SELECT item_id, c AS recommended FROM counts")
def m10_counts(spark, sf_dir):
    return m.recommendation_counts(scored(spark, sf_dir), _catalogue(spark, sf_dir))


@query("m11_all_metrics", f"""{DIVERSITY_SQL}{_retrieval_sql()}{RANKING_SQL}
SELECT 'val_' || metric AS metric, k, value FROM (
  SELECT * FROM retrieval UNION ALL SELECT * FROM ranking UNION ALL SELECT * FROM spread)""", doubles=("value",))
def m11(spark, sf_dir):
    # every article is bought by someone, so all scored items are the whole catalogue
    return m.all_metrics(scored(spark, sf_dir), item_vectors=_item_vectors(spark, sf_dir), prefix="val_")
