"""Exact quantiles of wide tables by bracketing: a sketch finds where to look, a count decides.

1. One scan aggregates the moments and one KLL sketch per column. The sketch gives, for every wanted rank, a value
   surely below and one surely above it, by twice its rank error.
2. A second scan counts. Inside the brackets every value is a group; whatever lies between two brackets is one group.
   So only bracketed values are shuffled, a few thousandths of the rows at the default size.

The counts say exactly which ranks a bracket holds. Should one miss its rank (the error of a sketch is a probability),
the brackets are widened and counted again, at last to the whole range. Ranks inside a bracket are found slice by slice
(``ordering.quantiles_of_counts``), so no task holds a bracket as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallyloom.functions.ordering import quantiles_of_counts
from tallyloom.session import stored

SKETCH_SIZE = 4096
QUARTILES = (0.25, 0.5, 0.75)


def rank_error(size: int) -> float:
    """Normalised rank error of a KLL sketch of this size (fixed values of the published fit)."""
    return 2.296 / size**0.9021


def as_double(name: str) -> Column:
    """The column as double; NaN counts as missing."""
    return F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None).cast("double"))


def sketched(df: DataFrame, columns: Sequence[str], size: int = SKETCH_SIZE) -> DataFrame:
    """(column, count, mean, std, min, max, skewness and kurtosis of the population, sketch) in one scan."""
    values = df.select(*(as_double(c).alias(f"_v{i}") for i, c in enumerate(columns)))
    kinds = {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "_g1": F.skewness, "_g2": F.kurtosis,
        "sketch": lambda v: F.kll_sketch_agg_double(v, size),
    }
    whole = values.agg(*(f(F.col(f"_v{i}")).alias(f"{name}{i}") for i in range(len(columns)) for name, f in kinds.items()))
    rows = [F.struct(F.lit(c).alias("column"), *(F.col(f"{name}{i}").alias(name) for name in kinds)) for i, c in enumerate(columns)]
    return whole.select(F.inline(F.array(*rows))).where(F.col("count") > 0)


def approximate_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], names: Sequence[str],
                          size: int = SKETCH_SIZE) -> DataFrame:
    """(column, quantiles by ``names``) from one scan; ranks are off by ``rank_error(size)`` of the count, mostly."""
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(n) for p, n in zip(probabilities, names)]
    return sketched(df, columns, size).select("column", *found)


def _merged(intervals: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Overlapping intervals as one, ascending."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(i for i in intervals if i[0] <= i[1]):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


@dataclass(frozen=True)
class Bracketed:
    """``moments``: one row per column with values, on the driver; ``counts``: (column, zone, value, marked, n), stored.

    Odd zones are brackets, with a row per value; an even zone is one row whose value is its smallest.
    """

    df: DataFrame
    moments: list[Row]
    counts: DataFrame

    def quantiles(self, probabilities: Sequence[float], names: Sequence[str]) -> DataFrame:
        """(column, exact quantiles by ``names``) of probabilities that were bracketed."""
        return quantiles_of_counts(self.counts, ["column"], "value", probabilities, names)


def _ranks(count: int, probabilities: Sequence[float]) -> list[int]:
    return sorted({f(p * (count - 1)) for p in probabilities for f in (math.floor, math.ceil)})


def bracketed(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = QUARTILES, *, size: int = SKETCH_SIZE,
              spread: float | None = None, mark_beyond: float | None = None) -> Bracketed:
    """Brackets of the ``probabilities`` of every column, counted.

    With ``spread``, the distances ``spread`` times the quartile range outside the quartiles are bracketed too.
    ``mark_beyond`` marks values farther from the mean than that many standard deviations.
    """
    error = 2 * rank_error(size)
    sketches = stored(sketched(df, columns, size), "column-sketches")  # one row per column
    moments = [Row(**{k: v for k, v in r.asDict().items() if k != "sketch"}) for r in sketches.collect()]
    while True:
        at = lambda p: F.kll_sketch_get_quantile_double("sketch", F.lit(float(min(max(p, 0.0), 1.0))))
        looked = sketches.select("column", "count", "min", "max", *(at(p + e).alias(f"q{i}{s}") for i, p in enumerate(probabilities)
                                                                    for s, e in (("a", -error), ("b", error)))).collect()
        zones: dict[str, list[tuple[float, float]]] = {}
        for r in looked:
            few = error * r["count"] < 2 or error >= 1  # ranks of a few rows: everything is bracketed
            pairs = [(r["min"], r["max"]) if few else (r[f"q{i}a"], r[f"q{i}b"]) for i in range(len(probabilities))]
            own = list(pairs)
            if spread is not None:
                (a1, b1), (a3, b3) = (pairs[list(probabilities).index(p)] for p in (0.25, 0.75))
                for low, high in ((a1 - spread * (b3 - a1), b1 - spread * (a3 - b1)), (a3 + spread * (a3 - b1), b3 + spread * (b3 - a1))):
                    room = 1e-9 * (abs(low) + abs(high)) if math.isfinite(low + high) else 0.0
                    own.append((low - room, high + room))
            zones[r["column"]] = _merged([(a, b) for a, b in own if not (math.isnan(a) or math.isnan(b))])
        counts = _counted(df, moments, zones, mark_beyond)
        sizes: dict[str, list[tuple[int, int]]] = {}
        for r in counts.groupBy("column", "zone").agg(F.sum("n").alias("n")).collect():  # a few rows per column
            sizes.setdefault(r["column"], []).append((r["zone"], r["n"]))
        if error >= 1 or all(_inside(sizes[r["column"]], _ranks(r["count"], probabilities)) for r in moments):
            return Bracketed(df, moments, counts)
        error *= 8


def _inside(sizes: list[tuple[int, int]], ranks: list[int]) -> bool:
    """Whether all ranks lie in odd zones."""
    before = 0
    held = set()
    for zone, n in sorted(sizes):
        if zone % 2:
            held |= {r for r in ranks if before <= r < before + n}
        before += n
    return held == set(ranks)


def _counted(df: DataFrame, moments: list[Row], zones: dict[str, list[tuple[float, float]]], mark_beyond: float | None) -> DataFrame:
    entries = []
    for r in moments:
        value = as_double(r["column"])
        zone = F.lit(0)
        for low, high in zones[r["column"]]:
            zone = zone + (value >= F.lit(low)).cast("int") + (value > F.lit(high)).cast("int")
        far = F.lit(False)
        if mark_beyond is not None:
            far = F.coalesce(F.abs(F.try_divide(value - F.lit(r["mean"]), F.lit(r["std"]).cast("double"))) > mark_beyond, F.lit(False))
        entries.append(F.struct(F.lit(r["column"]).alias("column"), zone.alias("zone"), value.alias("v"), far.alias("marked")))
    if not entries:
        empty = "column string, zone int, value double, marked boolean, n long"
        return df.sparkSession.createDataFrame([], empty)
    rows = df.select(F.inline(F.array(*entries))).where(F.col("v").isNotNull())
    key = F.when(F.col("zone") % 2 == 1, F.col("v"))
    grouped = rows.groupBy("column", "zone", key.alias("_key"), "marked").agg(F.min("v").alias("value"), F.count("*").alias("n"))
    return stored(grouped.drop("_key"), "bracket-counts")
