"""Registered queries: each is a function (spark, sf_dir) -> DataFrame over
the given tables, and most have an equivalent DuckDB SQL text (the oracle).

Conventions shared by both sides: every computed column is aliased; doubles
are rounded to 6 digits (+0.0 folds -0.0); integer sums are BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ids: str  # SURVEY §2 operator ids covered


REGISTRY: dict[str, Query] = {}


def register(name: str, ids: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ids)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    """Import every module that registers queries."""
    from . import (q_graph, q_models, q_monitor, q_positions, q_profile,  # noqa: F401
                   q_sampling, q_scores, q_streaming)
    return REGISTRY


def R(expr: str, digits: int = 6) -> str:
    """SQL rounding matching ``functions.columns.rounded``."""
    return f"(round({expr}, {digits}) + 0.0)"
