"""Mixing sources to target weights by systematic sampling.

Sources get word targets by weight, none above ``limit`` times its own size; what a full source leaves is shared
among the others by weight. With the sources in the order of the ratio of limit and weight, the full ones come
first, so prefix sums over that order find where filling up ends.

Every document of a source is expected as often as the target exceeds the source's size, its rate. A hash parts the
documents into two halves: the first lies in rising, the second in falling order of size, so that neighbours are
alike and both ends are small. A document's expected copies reach from rank * rate to (rank + 1) * rate, moved by one
random offset per source, and it is taken once per whole number passed. So the words taken differ from the target
by less than twice the largest document of the source (mostly far less), and no document is taken more often than its
rate rounded up. Ranks, prefix sums and rates are exact numbers (rates in units of 2^-40).

Ranks come from a range partitioning by all keys down to the stored row's number, so a source with a third of all
rows, or one row repeated that often, spreads over tasks; the driver sees a few totals only.

Defined results: null text has size 0 and is taken 0 words; a null source is a source of its own, the last; a null
doc_id sorts like an empty one; repeated rows are taken separately; documents of one half, size and hash are ordered by
id; columns besides doc_id, text and source are not read; texts of any length count whole; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import numbered, stored, text_or_empty

WEIGHTS = (5, 2, 1)
UNIT = 1 << 40


def _exact(value) -> F.Column:
    return (F.col(value) if isinstance(value, str) else F.lit(value)).cast("decimal(38,0)")


def _divided(a, b) -> F.Column:
    """The whole part of a quotient of exact, non-negative numbers."""
    return F.floor((a - a % b) / b).cast("decimal(38,0)")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, hash, row) of ``docs``, stored; size is the number of words."""
    words = F.regexp_count(text_or_empty(), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words.alias("size"),
        F.unhex(F.md5(F.concat(F.lit("mix|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    ), "mix-sizes")


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = 3) -> DataFrame:
    """Per source: source, source_size, target, rate (in units of 2^-40), first (rank of its first document).

    ``rows`` need source and size. All sizes together are shared; weights repeat in the order of the sources.
    """
    common = lcm(*weights)
    weight = F.get(F.array(*(F.lit(w) for w in weights)), (F.col("position") % len(weights)).cast("int"))
    sources = rows.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("size").alias("source_size"))
    placed = numbered(sources, ["source"], ["documents"], "mix-sources").withColumn("weight", weight.cast("long")).select(
        "source", "source_size", "weight", F.col("documents_before").alias("first"), (F.col("source_size") * limit).alias("cap"))
    fullness = (F.col("cap") * (F.lit(common) / F.col("weight")).cast("long")).alias("fullness")
    ranked = stored(numbered(placed.select("*", fullness), ["fullness", "source"], ["cap", "weight"], "mix-ranks"), "mix-order")
    total, weight_sum = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weight_sum = total or 0, weight_sum or 1
    left, open_weight = F.lit(total) - F.col("cap_before"), F.lit(weight_sum) - F.col("weight_before")
    fits = _exact(common) * left.cast("decimal(38,0)") <= _exact("fullness") * open_weight.cast("decimal(38,0)")
    # the first source in this order that its share does not fill: one row
    border = ranked.where(fits).select("position", left.alias("left"), open_weight.alias("weights")).orderBy("position").limit(1).collect()
    at, rest, among = border[0] if border else (0, 0, 1)
    full = F.col("position") < at
    share = _divided(_exact("weight") * _exact(rest) * _exact(UNIT), _exact(F.col("source_size")) * _exact(among))
    return ranked.select(
        "source", "source_size", "first",
        F.when(full, F.col("cap").cast("double")).otherwise(F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(among))).alias("target"),
        F.when(full, _exact(limit * UNIT)).when(F.col("source_size") == 0, _exact(0)).otherwise(share).alias("rate"),
    )


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = 3, seed: str = "mix") -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, copies, taken (copies times size)."""
    rows = sizes(docs)
    per_source = stored(targets(rows, weights, limit), "mix-targets")
    half = F.conv(F.substring(F.hex("hash"), 1, 1), 16, 10).cast("int") % 2
    piled = rows.withColumn("half", half).withColumn("height", F.when(F.col("half") == 0, F.col("size")).otherwise(-F.col("size")))
    ranked = numbered(piled, ["source", "half", "height", "hash", "doc_id", "row"], label="mix-documents")
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce("source", F.lit("")))), 1, 10), 16, 10)
    right = per_source.withColumn("offset", drawn.cast("decimal(38,0)")).withColumnRenamed("source", "_source")
    rank = (F.col("position") - F.col("first")).cast("decimal(38,0)")
    upto = lambda n: _divided(n * F.col("rate") + F.col("offset"), _exact(UNIT))
    copies = (upto(rank + 1) - upto(rank)).cast("long")
    joined = ranked.join(right, F.col("source").eqNullSafe(F.col("_source")))
    return joined.select("doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
