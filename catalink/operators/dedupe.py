"""Deduplication and duplicate counts.

``keep_first`` keeps the first row per key in a given order with one
``groupBy`` + ``min_by`` (partial aggregation, no global sort), unlike
``dropDuplicates`` which keeps an arbitrary row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               drop_null_key: bool = True) -> DataFrame:
    """First row per key by ``order`` (e.g. the file-order column ``_seq``).

    Null keys: dropped by default; otherwise rows with a null key form one
    group, as pandas' ``drop_duplicates`` treats NaN keys as equal.
    """
    cols = df.columns
    payload = F.struct(*[F.col(c) for c in cols])
    ordering = F.struct(*[F.col(c) for c in order])
    first = df.groupBy(*keys).agg(F.min_by(payload, ordering).alias("_row"))
    if drop_null_key:
        # Filter on the aggregate's payload, not on the grouping key: a key
        # filter would be pushed below the aggregate and re-expand the
        # key's whole derivation (e.g. staged parsing) inside the Filter.
        cond = None
        for k in keys:
            c = F.col("_row")[k].isNotNull()
            cond = c if cond is None else cond & c
        first = first.where(cond)
    return first.select(*[F.col("_row")[c].alias(c) for c in cols])


def distinct_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct combinations (every column is part of the key, so exact)."""
    return df.select(*cols).dropDuplicates()


def count_full_duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row (nulls compare equal)."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return per_row.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def count_key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key already occurred (all but the first per key)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_keys"))


def one_row_per_value(df: DataFrame, col: str, order: Sequence[str], n: int | None = None) -> DataFrame:
    """One sample row per distinct value (the first by ``order``), optionally the first n values."""
    first = keep_first(df, [col], order, drop_null_key=False)
    first = first.orderBy(*[F.col(c) for c in order])
    return first.limit(n) if n else first


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence, k: int,
                    salt_buckets: int | None = None, salt_key: str | None = None) -> DataFrame:
    """The first ``k`` rows per group by ``order`` without sending a whole hot
    group to one task: rows are first cut to ``k`` per (group, salt) and only
    the survivors (at most ``k * salt_buckets`` per group) are ranked again.

    ``order`` must be a total order (end it with a unique column); there are as many
    salts as shuffle partitions unless ``salt_buckets`` says otherwise."""
    salt_buckets = salt_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt_src = F.col(salt_key) if salt_key else F.struct(*[F.col(c) for c in df.columns])
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_src), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    stage1 = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k)
    w2 = Window.partitionBy(*group).orderBy(*order)
    return (stage1.withColumn("_r", F.row_number().over(w2)).where(F.col("_r") <= k)
                  .drop("_salt").withColumnRenamed("_r", "rank_in_group"))
