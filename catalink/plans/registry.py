"""Registry of named queries: a Spark builder and (optionally) the equivalent
DuckDB SQL over the same parquet tables.

Values compared across engines are rounded to ``DIGITS`` decimals on both
sides; presentation rounding stays in the library functions' callers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIGITS = 6

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query builder (and its SQL twin when one exists)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c: Column | str, alias: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col.cast("double"), DIGITS)
    name = alias or (c if isinstance(c, str) else None)
    return out.alias(name) if name else out


def load_all() -> None:
    """Import every plan module so their queries register."""
    from catalink.plans import (  # noqa: F401
        q_cleaning,
        q_divergence,
        q_matching,
        q_quality,
        q_reports,
        q_stats,
    )
    q_reports._late_sql()
