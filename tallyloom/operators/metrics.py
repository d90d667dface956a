"""Recommendation metrics over scored pairs ``(query_id, item_id, score, label)``.

A list is ranked by score, equal scores by item id descending. A cut-off ``k`` beyond the longest
list is left out of the report. Labels are 0 or 1.

Skew: one query may own any share of the rows. Top-k ranks are limited before the shuffle, tie
groups are counted before it, and running counts are made in score slices (see ``ladder``), so no
task needs a whole list.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.counts import gini_of_counts
from tallyloom.functions.ordering import points_below
from tallyloom.session import stored

K_VALUES = (1, 5, 10, 20, 50, 100)  # fixed values
DIVERSITY_K = 10  # fixed value
SLICE_ROWS = 1_000_000
LIST_SPLITS = 16_383


def top_k(scored: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows per query with their 1-based ``rank``."""
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("item_id").desc())
    known = scored.where(F.col("query_id").isNotNull())
    return known.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def list_totals(scored: DataFrame) -> DataFrame:
    """(query_id, n, rel): list length and number of relevant items."""
    return scored.where(F.col("query_id").isNotNull()).groupBy("query_id").agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.col("label").cast("long")), F.lit(0)).alias("rel"))


def tie_groups(scored: DataFrame) -> DataFrame:
    """(query_id, score, n, rel): rows of equal score, counted."""
    return scored.where(F.col("query_id").isNotNull()).groupBy("query_id", "score").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.col("label").cast("long")), F.lit(0)).alias("rel"),
    )


def ladder(ties: DataFrame, *, slice_rows: int = SLICE_ROWS, splits: int = LIST_SPLITS) -> DataFrame:
    """Tie groups, stored, with ``n_before`` and ``rel_before``, the counts at higher scores of the query.

    Scores are cut into slices at points drawn from all tie groups, one point per ``slice_rows`` of them. Totals per query
    and slice are cumulated first, then each (query, slice) is a window of its own, however long the list.
    """
    ties = stored(ties, "tie-groups")
    wanted = min(splits, ties.count() // slice_rows)
    points = (
        ties.where(F.col("score").isNotNull()).select("query_id", "score").orderBy(F.xxhash64("query_id", "score"), "query_id", "score")
        .limit(wanted).agg(F.array_sort(F.collect_list("score")).alias("points"))
    )
    # without points all scores are one slice; a missing score is the lowest
    cut = F.lit(0) if not wanted else F.when(F.col("score").isNull(), -1).otherwise(points_below("_points", "score", wanted))
    sliced = ties.withColumn("_points", points.scalar()) if wanted else ties
    sliced = sliced.withColumn("_slice", cut).drop("_points")
    higher = (
        Window.partitionBy("query_id").orderBy(F.col("_slice").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        sliced.groupBy("query_id", "_slice").agg(F.sum("n").alias("_n"), F.sum("rel").alias("_rel"))
        .select(
            "query_id",
            "_slice",
            F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_n_off"),
            F.coalesce(F.sum("_rel").over(higher), F.lit(0)).alias("_rel_off"),
        )
    )
    above = (
        Window.partitionBy("query_id", "_slice").orderBy(F.col("score").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = sliced.select(
        "*",
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("rel").over(above), F.lit(0)).alias("rel_before"),
    )
    if not wanted:
        return inside.drop("_slice")
    return inside.join(offsets, ["query_id", "_slice"]).select(
        "query_id", "score", "n", "rel",
        (F.col("n_before") + F.col("_n_off")).alias("n_before"),
        (F.col("rel_before") + F.col("_rel_off")).alias("rel_before"),
    )


# ---------------------------------------------------------------- per query


def hits_at(ranked: DataFrame, ks: Sequence[int]) -> DataFrame:
    """(query_id, hits_k ..): relevant rows among the first k."""
    return ranked.groupBy("query_id").agg(
        *[F.coalesce(F.sum(F.when(F.col("rank") <= k, F.col("label").cast("long"))), F.lit(0)).alias(f"hits_{k}")
          for k in ks]
    )


def discounts(k: int) -> list[float]:
    """Sums of the first 0 .. k logarithmic discounts."""
    sums = [0.0]
    for place in range(1, k + 1):
        sums.append(sums[-1] + 1.0 / math.log2(place + 1))
    return sums


def query_profile(steps: DataFrame, ks: Sequence[int] = K_VALUES) -> DataFrame:
    """Everything the ranking metrics need of a query, in one aggregate over its ``ladder``.

    ``n`` and ``rel`` of the list; ``ap``, where a tie group is one step; ``ndcg_k``, where equal
    scores share their mean gain (a list of one item has no order to judge and counts 0); and the
    first tie group with a relevant item: its score, the rows before it, its end, its relevant rows.
    Without a relevant item, all but ``n`` and ``rel`` are NULL.
    """
    deepest = max(ks)
    table = F.array(*[F.lit(x) for x in discounts(deepest)])

    def discount(places: Column, k: int) -> Column:
        return F.get(table, F.least(places, F.lit(k)).cast("int"))

    n, rel, before = F.col("n"), F.col("rel"), F.col("n_before")
    hit = rel > 0
    precision = (F.col("rel_before") + rel) / (before + n)
    gains = [
        F.sum(F.when(hit & (before < k), rel / n * (discount(before + n, k) - discount(before, k)))).alias(f"_dcg_{k}")
        for k in ks
    ]
    sums = steps.groupBy("query_id").agg(
        F.sum(n).alias("_n"),
        F.sum(rel).alias("_rel"),
        F.sum(F.when(hit, rel * precision)).alias("_ap"),
        F.max(F.when(hit, F.col("score"))).alias("first_score"),
        F.min(F.when(hit, before)).alias("first_before"),
        F.min(F.when(hit, before + n)).alias("first_end"),
        F.min(F.when(hit, F.col("rel_before") + rel)).alias("first_rel"),
        *gains,
    )
    judged = F.col("_rel") > 0
    ndcg = [
        F.when(judged & (F.col("_n") == 1), 0.0)
        .when(judged, F.coalesce(F.col(f"_dcg_{k}"), F.lit(0.0)) / discount(F.col("_rel"), k))
        .alias(f"ndcg_{k}")
        for k in ks
    ]
    return sums.select(
        "query_id", F.col("_n").alias("n"), F.col("_rel").alias("rel"),
        F.when(judged, F.col("_ap") / F.col("_rel")).alias("ap"), *ndcg,
        "first_score", "first_before", "first_end", "first_rel",
    )


def first_hit_rank(scored: DataFrame, profile: DataFrame) -> DataFrame:
    """(query_id, first_rank) of queries with a relevant item."""
    first = profile.where(F.col("rel") > 0)
    # inside the tie group the item id decides: count the items above its best relevant item
    tied = first.where(F.col("first_end") - F.col("first_before") > F.col("first_rel")).select(
        "query_id", F.col("first_score").alias("score")
    )
    members = scored.join(tied, ["query_id", "score"]).select("query_id", "item_id", "label")
    best = members.where(F.col("label") == 1).groupBy("query_id").agg(F.max("item_id").alias("_best"))
    above = (
        members.join(best, "query_id").where(F.col("item_id") > F.col("_best"))
        .groupBy("query_id").agg(F.count("*").alias("_above"))
    )
    return first.join(above, "query_id", "left").select(
        "query_id", (F.col("first_before") + F.coalesce(F.col("_above"), F.lit(0)) + 1).alias("first_rank")
    )


# ---------------------------------------------------------------- reports


def report(row: DataFrame, entries: Sequence[tuple[str, int | None, Column]], longest: Column) -> DataFrame:
    """One-row table to (metric, k, value); cut-offs beyond the longest list are left out."""
    rows = [
        F.struct(
            F.lit(name).alias("metric"), F.lit(k).cast("int").alias("k"), value.cast("double").alias("value")
        )
        for name, k, value in entries
    ]
    listed = row.select(longest.alias("_longest"), F.explode(F.array(*rows)).alias("r"))
    return listed.where(F.col("r.k").isNull() | (F.col("r.k") <= F.col("_longest"))).select("r.*")


def retrieval_report(hits: DataFrame, ks: Sequence[int], longest: Column) -> DataFrame:
    """Precision, recall, hit rate and F1 from (query_id, n, rel, hits_k ..) of every query."""
    means = [F.max("n").alias("n")]
    for k in ks:
        hit = F.coalesce(F.col(f"hits_{k}"), F.lit(0))
        means += [
            F.avg(hit / F.lit(float(k))).alias(f"p_{k}"),
            F.avg(F.when(F.col("rel") > 0, hit / F.col("rel")).otherwise(0.0)).alias(f"r_{k}"),
            F.avg(F.when(hit > 0, 1.0).otherwise(0.0)).alias(f"a_{k}"),
        ]
    entries = []
    for k in ks:
        p, r = F.col(f"p_{k}"), F.col(f"r_{k}")
        f1 = F.when(p + r > 0, 2 * (p * r) / (p + r)).otherwise(0.0)
        entries += [
            (f"precision@{k}", k, p), (f"recall@{k}", k, r),
            (f"top_{k}_accuracy", k, F.col(f"a_{k}")), (f"f1@{k}", k, f1),
        ]
    return report(hits.agg(*means), entries, longest)


def retrieval_metrics(scored: DataFrame, ks: Sequence[int] = K_VALUES) -> DataFrame:
    """Precision, recall, hit rate and F1 at every k, averaged over all queries."""
    hits = list_totals(scored).join(hits_at(top_k(scored, max(ks)), ks), "query_id", "left")
    return retrieval_report(hits, ks, F.col("n"))


def ranking_metrics(scored: DataFrame, ks: Sequence[int] = K_VALUES) -> DataFrame:
    """MAP and NDCG over queries with a relevant item, MRR over all queries.

    The per-query profile is stored: it is small, and the scored pairs are then ranked only once.
    """
    profile = stored(query_profile(ladder(tie_groups(scored)), ks), "query-profile")
    per_query = profile.join(first_hit_rank(scored, profile), "query_id", "left")
    means = per_query.agg(
        F.max("n").alias("n"),
        F.coalesce(F.avg("ap"), F.lit(0.0)).alias("map"),
        F.avg(F.coalesce(F.lit(1.0) / F.col("first_rank"), F.lit(0.0))).alias("mrr"),
        *[F.coalesce(F.avg(f"ndcg_{k}"), F.lit(0.0)).alias(f"ndcg_{k}") for k in ks],
    )
    entries = [("map", None, F.col("map")), *[(f"ndcg@{k}", k, F.col(f"ndcg_{k}")) for k in ks],
               ("mrr", None, F.col("mrr"))]
    return report(means, entries, F.col("n"))


PAIRWISE_DISTANCE = """
aggregate(
  transform(vectors, (a, i) -> aggregate(
    slice(vectors, i + 2, size(vectors)), 0D,
    (total, b) -> total + sqrt(aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), 0D, (s, d) -> s + d)))),
  0D, (s, d) -> s + d)
"""


def intra_list_diversity(scored: DataFrame, item_vectors: DataFrame, *, k: int = DIVERSITY_K) -> DataFrame:
    """Mean over queries of the mean pairwise Euclidean distance of their top items' vectors.

    ``item_vectors`` is (item_id, vector). The at most ``k`` vectors of a list are one array; no
    pairs of rows are made.
    """
    vectors = item_vectors.select("item_id", F.col("vector").cast("array<double>").alias("vector"))
    lists = (
        top_k(scored, k).select("query_id", "item_id").join(vectors, "item_id")
        .groupBy("query_id").agg(F.collect_list("vector").alias("vectors"))
    )
    size = F.size("vectors")
    mean = F.when(size > 1, F.expr(PAIRWISE_DISTANCE) / (size * (size - 1) / 2)).otherwise(0.0)
    return lists.agg(F.avg(mean).alias("value"))


def recommendation_counts(scored: DataFrame, catalogue: DataFrame, *, k: int = DIVERSITY_K) -> DataFrame:
    """(item_id, recommended): in how many top-k lists each catalogue item is, 0 included."""
    counts = top_k(scored, k).groupBy("item_id").agg(F.count("*").alias("recommended"))
    items = catalogue.select("item_id").distinct()
    return items.join(counts, "item_id", "left").fillna(0, ["recommended"])


def coverage(counts: DataFrame) -> DataFrame:
    """Share of the catalogue that is recommended at least once."""
    return counts.agg(F.avg(F.when(F.col("recommended") > 0, 1.0).otherwise(0.0)).alias("value"))


def diversity_metrics(
    scored: DataFrame, item_vectors: DataFrame | None = None, *, catalogue: DataFrame | None = None,
    k: int = DIVERSITY_K,
) -> DataFrame:
    """Diversity (with item vectors), coverage and Gini; the catalogue defaults to all scored items."""
    counts = recommendation_counts(scored, scored if catalogue is None else catalogue, k=k)
    parts = [("coverage", coverage(counts)), ("gini_coefficient", gini_of_counts(counts, "recommended", "value"))]
    if item_vectors is not None:
        parts.insert(0, ("intra_list_diversity", intra_list_diversity(scored, item_vectors, k=k)))
    out = None
    for name, value in parts:
        row = value.select(F.lit(name).alias("metric"), F.lit(None).cast("int").alias("k"), "value")
        out = row if out is None else out.unionByName(row)
    return out


def all_metrics(
    scored: DataFrame,
    *,
    item_vectors: DataFrame | None = None,
    catalogue: DataFrame | None = None,
    ks: Sequence[int] = K_VALUES,
    prefix: str = "",
    retrieval: bool = True,
    ranking: bool = True,
    diversity: bool = True,
) -> DataFrame:
    """The chosen families as one (metric, k, value) report; ``prefix`` goes before each name.

    ``catalogue`` (item_id) holds all items that could be recommended, for coverage and Gini; by default
    the scored ones. The scored pairs are stored first, since every family reads them.
    """
    if not (retrieval or ranking or diversity):
        raise ValueError("choose at least one metric family")
    scored = stored(scored.select("query_id", "item_id", "score", "label"), "scored-pairs")
    parts = []
    if retrieval:
        parts.append(retrieval_metrics(scored, ks))
    if ranking:
        parts.append(ranking_metrics(scored, ks))
    if diversity:
        parts.append(diversity_metrics(scored, item_vectors, catalogue=catalogue))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("metric", F.concat(F.lit(prefix), F.col("metric")))
