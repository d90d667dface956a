"""Feature columns to a categorical and a numerical vector per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.hashing import key_modulo, text_key
from tallyloom.operators.articles import category_codes

HASH_SIZE = 10_000  # fixed value


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The configured columns the table has, in the configured order."""
    return [name for name in names if name in df.columns]


def with_category_codes(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Text columns replaced by their code among the sorted values (NULL is -1); others as long."""
    texts = [n for n in present(df, names) if df.schema[n].dataType.typeName() == "string"]
    coded = category_codes(df, {f"_code_{n}": n for n in texts})
    return coded.select(
        *[F.col(f"_code_{c}").cast("long").alias(c) if c in texts else F.col(c) for c in df.columns]
    )


def z_scores(
    df: DataFrame, names: Sequence[str], *, given: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Numerical columns scaled by (mean, population std), configured or of the table itself.

    A column whose std is 0 stays as it is.
    """
    given = given or {}
    columns = present(df, names)
    own = [c for c in columns if c not in given]
    out = df
    if own:
        moments = df.agg(
            F.struct(
                *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in own],
                *[F.stddev_pop(F.col(c).cast("double")).alias(f"std_{c}") for c in own],
            ).alias("m")
        )
        out = out.withColumn("_m", moments.scalar())
    scaled = []
    for name in columns:
        if name in given:
            mean, std = (F.lit(float(x)) for x in given[name])
        else:
            mean, std = F.col(f"_m.mean_{name}"), F.col(f"_m.std_{name}")
        value = F.col(name).cast("double")
        scaled.append(F.when(std > 0, (value - mean) / std).otherwise(value).alias(name))
    rest = {c: i for i, c in enumerate(columns)}
    return out.select(*[scaled[rest[c]] if c in rest else F.col(c) for c in df.columns])


def hashed_code(value: Column, size: int = HASH_SIZE) -> Column:
    """A text as a number below ``size``, the same in every process."""
    return F.when(value.isNotNull(), key_modulo(text_key(value), size, 8))


def with_hashed_codes(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Text columns hashed, other categorical columns as long."""
    wanted = set(present(df, names))
    return df.select(
        *[
            F.col(f.name) if f.name not in wanted
            else (hashed_code(F.col(f.name)) if f.dataType.typeName() == "string"
                  else F.col(f.name).cast("long")).alias(f.name)
            for f in df.schema.fields
        ]
    )


def stacked(
    df: DataFrame, categorical: Sequence[str], numerical: Sequence[str], *, keep: Sequence[str] = ()
) -> DataFrame:
    """``keep`` columns plus ``categorical`` (array of long) and ``numerical`` (array of double)."""
    codes = [F.col(c).cast("long") for c in present(df, categorical)]
    values = [F.col(c).cast("double") for c in present(df, numerical)]
    return df.select(
        *keep,
        (F.array(*codes) if codes else F.array().cast("array<bigint>")).alias("categorical"),
        (F.array(*values) if values else F.array().cast("array<double>")).alias("numerical"),
    )
