"""Equality joins, membership flags and the size-checked broadcast.

Joins are plain DataFrame joins: Catalyst/AQE pick broadcast or sort-merge
from runtime sizes.  ``broadcast_if_small`` adds an explicit hint only when the
optimizer's size estimate of the side is below a bound; beyond it the join is
left to the shuffle strategies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 64 MiB: a lookup table that fits comfortably in every executor.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of a plan (no job is run)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate unavailable (e.g. Spark Connect)
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise leave it to AQE."""
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def left_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left equi-join on same-named keys; unmatched right columns are null."""
    return left.join(right, on=on, how="left")


def left_join_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join with different key names; both key columns are kept."""
    return left.join(right, left[left_key] == right[right_key], "left")


def semi_join(df: DataFrame, ids: DataFrame, key: str, ids_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``ids`` (no duplication, no ids columns)."""
    ids_key = ids_key or key
    return df.join(ids.select(F.col(ids_key).alias(key)), on=key, how="left_semi")


def existence_flag(df: DataFrame, ids: DataFrame, key: str, flag: str,
                   ids_key: str | None = None) -> DataFrame:
    """Add a boolean membership column; every row of ``df`` is kept."""
    ids_key = ids_key or key
    marks = (ids.select(F.col(ids_key).alias(key)).where(F.col(key).isNotNull())
                .distinct().withColumn(flag, F.lit(True)))
    return (df.join(marks, on=key, how="left")
              .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def full_outer_fill(a: DataFrame, b: DataFrame, key: str, fill: dict) -> DataFrame:
    """Full outer join of two keyed tables with gaps filled."""
    return a.join(b, on=key, how="full").na.fill(fill)
