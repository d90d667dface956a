"""Repeatable pseudo-random keys.

``rand(seed)`` depends on the partitioning, so a retried or re-planned stage could draw other
numbers. These keys depend on the row only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_536  # many for each partition


def text_key(*parts: Column | str | int) -> Column:
    """md5 (hex) of the parts joined by '|'; NULL parts read as empty text."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def key_number(key: Column, digits: int = 8) -> Column:
    """The first ``digits`` (at most 15) hex digits of a key as a long."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("long")


def key_modulo(key: Column, modulus: Column | int, digits: int = 15) -> Column:
    """``key`` mapped to 0 .. modulus-1."""
    divisor = modulus if isinstance(modulus, Column) else F.lit(modulus)
    return F.pmod(key_number(key, digits), divisor.cast("long"))


def slot(key: str) -> Column:
    """The number, of ``SLOTS``, that a key is dealt to."""
    return F.pmod(F.hash(key), F.lit(SLOTS))


def together(df: DataFrame, key: str) -> DataFrame:
    """``df`` with the rows of a key side by side, for an aggregate by ``key`` that collapses them.

    Where a key's rows lie anywhere, the map side of an aggregate holds as many groups as rows. Rows meet by the slot of the
    key, so the aggregate keeps its own exchange and a key with very many rows may be split before it (AQE's rebalance).
    """
    return df.withColumn("_slot", slot(key)).hint("rebalance", F.col("_slot")).drop("_slot")


def crowded_slots(df: DataFrame, key: str, most: int) -> tuple[int, list[int]]:
    """(rows, slots of more than ``most`` rows), from a scan that counts ``SLOTS`` slots: at most one in ``most`` rows is listed."""
    counts = df.groupBy(slot(key).alias("slot")).agg(F.count("*").alias("n"))
    found = counts.agg(F.sum("n"), F.sort_array(F.collect_list(F.when(F.col("n") > most, F.col("slot"))))).first()
    return found[0] or 0, found[1]
