"""Named queries over the given tables, each with the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyloom.functions.expressions import round_doubles
from tallyloom.sources import retail

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def retail_sql(body: str) -> str:
    """``body`` with the retail views in front; a body may start with ``, name AS (...)``."""
    views = ",\n".join(f"{name} AS ({text})" for name, text in retail.view_sql().items())
    return f"WITH {views}\n{body}"


def rounded_sql(body: str, columns: Sequence[str]) -> str:
    if not columns:
        return body
    replaced = ", ".join(f"round({c}, 6) + 0 AS {c}" for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM (\n{body}\n)"


def query(
    name: str, sql: str | None = None, *, doubles: Sequence[str] = (), views: bool = True, rounded: bool = True
):
    """Register a query. Doubles are rounded to 6 places; ``doubles`` names them for the SQL.

    ``rounded=False`` is for queries whose doubles are rounded by definition: rounding twice would
    make the last place depend on how halves are rounded.
    """

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = (lambda spark, sf_dir: round_doubles(build(spark, sf_dir))) if rounded else build
        if sql is not None:
            ORACLES[name] = rounded_sql(retail_sql(sql) if views else sql, doubles)
        return build

    return register
