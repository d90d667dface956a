"""Query plans composed of the operators, and the registry of named queries."""

from __future__ import annotations

from importlib import import_module

from tallyloom.plans.registry import ORACLES, QUERIES, Query

_MODULES = (
    "feature_queries",
    "training_queries",
    "evaluation_queries",
    "quality_queries",
    "explore_queries",
    "daily_queries",
)


def _load() -> None:
    for name in _MODULES:
        import_module(f"tallyloom.plans.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
