"""Bucketed profiles: fixed-width bins, labelled buckets, cross-tabulation,
ordered-category profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalink.functions.expressions import label_rank, width_bin
from catalink.operators.quantiles import exact_median


def binned_mean(df: DataFrame, x: str, y: str, lo: float = 0, hi: float = 100, width: float = 5,
                min_count: int = 5) -> DataFrame:
    """Right-closed bins of ``x`` (first bin includes ``lo``): mean of ``y``,
    count, bin midpoint; bins with fewer than ``min_count`` rows dropped."""
    b = width_bin(x, lo, hi, width)
    return (df.select(b.alias("bin"), F.col(y)).where(F.col("bin").isNotNull())
              .groupBy("bin").agg(F.avg(y).alias("mean"), F.count(y).alias("count"))
              .where(F.col("count") >= min_count)
              .withColumn("mid", F.lit(lo) + F.col("bin") * width - width / 2.0)
              .orderBy("bin"))


def bucket_profile(df: DataFrame, label: Column, labels: Sequence[str], metric: str,
                   label_name: str = "bucket", median: bool = True) -> DataFrame:
    """Count, mean (and median) of ``metric`` per bucket label, in label order.

    Rows whose label is null are dropped (pandas' observed groups)."""
    rows = df.select(label.alias(label_name), F.col(metric)).where(F.col(label_name).isNotNull())
    out = rows.groupBy(label_name).agg(F.count(metric).alias("n_games"), F.avg(metric).alias("mean"))
    if median:
        out = out.join(exact_median(rows, metric, [label_name], "median"), on=label_name, how="left")
    return out.withColumn("rank", label_rank(label_name, labels)).orderBy("rank")


def crosstab(df: DataFrame, row: str, row_order: Sequence[str], col: Column,
             col_labels: Sequence[str], col_names: Sequence[str]) -> DataFrame:
    """Counts of (row, col label) pairs with a fixed column list (missing cells
    0) and rows restricted to ``row_order``, ranked in that order."""
    pivoted = (df.select(F.col(row), col.alias("_col")).where(F.col(row).isin(*row_order))
                 .groupBy(row).pivot("_col", list(col_labels)).count()
                 .na.fill(0, subset=list(col_labels)))
    renamed = pivoted.select(row, *[F.col(f"`{lbl}`").cast("bigint").alias(name)
                                    for lbl, name in zip(col_labels, col_names)])
    return renamed.withColumn("rank", label_rank(row, row_order)).orderBy("rank")


def ordered_profile(df: DataFrame, col: str, order: Sequence[str], metric: str) -> DataFrame:
    """Count and mean per ordered category; values outside the order are dropped."""
    return (df.where(F.col(col).isin(*order)).groupBy(col)
              .agg(F.count(metric).alias("n_games"), F.avg(metric).alias("mean_div"))
              .withColumn("rank", label_rank(col, order)).orderBy("rank"))
