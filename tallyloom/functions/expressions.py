"""Column expressions shared by the feature operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown (NULL) condition is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def bin_index(value: Column, edges: Sequence[float], *, lowest: bool = True) -> Column:
    """Position of the right-closed bin ``(edge[i], edge[i+1]]`` that holds the value, else NULL.

    With ``lowest`` the first bin also holds its left edge.
    """
    above = value >= F.lit(edges[0]) if lowest else value > F.lit(edges[0])
    out = F.when(~above, F.lit(None).cast("int"))
    for i, edge in enumerate(edges[1:]):
        out = out.when(value <= F.lit(edge), F.lit(i))
    return out


def bin_label(
    value: Column, edges: Sequence[float], labels: Sequence[str], *, lowest: bool = True
) -> Column:
    """Like ``bin_index``, but the label of the bin."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    above = value >= F.lit(edges[0]) if lowest else value > F.lit(edges[0])
    out = F.when(~above, F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels):
        out = out.when(value <= F.lit(edge), F.lit(label))
    return out


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division as double, NULL where the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def days_between(later: Column, earlier: Column, *, timestamps: bool) -> Column:
    """Whole days from ``earlier`` to ``later``; for times of day the fraction is floored."""
    if not timestamps:
        return F.datediff(later, earlier)
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return F.floor(micros / F.lit(86_400_000_000.0)).cast("int")


def has_time(df: DataFrame, col: str) -> bool:
    """Whether the column carries a time of day."""
    return df.schema[col].dataType.typeName() in ("timestamp", "timestamp_ntz")


def missing(df: DataFrame, col: str) -> Column:
    """NULL, or NaN in a floating column."""
    c = F.col(f"`{col}`")
    if df.schema[col].dataType.typeName() in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = {"byte", "short", "integer", "long", "float", "double", "decimal"}
    return [f.name for f in df.schema.fields if f.dataType.typeName() in kinds]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Every floating column rounded, for reports and comparisons."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`").cast("double"), places).alias(f.name)
            if f.dataType.typeName() in ("double", "float")
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
