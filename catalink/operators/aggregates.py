"""Counts, profiles and statistics as DataFrames.

Report-style operators compute every metric of a table in ONE aggregate pass
and then turn the single wide row into long rows with ``stack``/``explode``;
no job per metric, no driver loop over data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalink import config as C
from catalink.functions.expressions import strip
from catalink.operators.quantiles import exact_percentiles, percentile_map
from catalink.session import cut_lineage


def _rows_from_struct_array(row_df: DataFrame, items: Sequence[Column]) -> DataFrame:
    """Explode an array of structs built from a one-row aggregate."""
    return row_df.select(F.inline(F.array(*items)))


# --- frequencies ------------------------------------------------------------

def value_counts(df: DataFrame, col: str, top_n: int | None = None) -> DataFrame:
    """Non-null value frequency, most frequent first (ties by value)."""
    out = (df.where(F.col(col).isNotNull()).groupBy(col)
             .agg(F.count(F.lit(1)).alias("count"))
             .orderBy(F.desc("count"), F.asc(col)))
    return out.limit(top_n) if top_n else out


def value_counts_by_value(df: DataFrame, col: str) -> DataFrame:
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("count")).orderBy(col))


def label_counts(df: DataFrame, col: str, labels: Sequence[str]) -> DataFrame:
    """Counts of a fixed, ordered label list (absent label: 0) and percent share.

    One aggregate pass; the share is over the listed labels only.
    """
    counts = [F.count_if(F.col(col) == F.lit(lbl)).alias(f"_c{i}") for i, lbl in enumerate(labels)]
    row = df.agg(*counts)
    total = sum((F.col(f"_c{i}") for i in range(len(labels))), F.lit(0))
    items = [F.struct(F.lit(i + 1).alias("rank"), F.lit(lbl).alias(col),
                      F.col(f"_c{i}").alias("count"),
                      F.try_divide(F.col(f"_c{i}") * 100.0, total).alias("pct"))
             for i, lbl in enumerate(labels)]
    return _rows_from_struct_array(row, items)


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Named counts of rows meeting each condition (null is false), as rows."""
    row = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"_c{i}")
                   for i, c in enumerate(conditions.values())])
    items = [F.struct(F.lit(name).alias("metric"), F.col(f"_c{i}").alias("value"))
             for i, name in enumerate(conditions)]
    return _rows_from_struct_array(row, items)


def count_true_by_group(df: DataFrame, group: str, flag: str) -> DataFrame:
    """Per group: rows with the flag true, all rows, percent."""
    return (df.where(F.col(group).isNotNull()).groupBy(group)
              .agg(F.count_if(F.col(flag)).alias("count"), F.count(F.lit(1)).alias("total"))
              .withColumn("pct", F.col("count") / F.col("total") * 100)
              .orderBy(group))


def grouped_sum(df: DataFrame, group: str, measure: str, alias: str | None = None) -> DataFrame:
    return (df.where(F.col(group).isNotNull()).groupBy(group)
              .agg(F.coalesce(F.sum(measure), F.lit(0)).alias(alias or f"sum_{measure}")))


# --- table profiles ---------------------------------------------------------

def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and percent for every column, one pass."""
    cols = list(columns or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_c{i}") for i, c in enumerate(cols)])
    items = [F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column"),
                      F.col(f"_c{i}").alias("nulls"),
                      F.try_divide(F.col(f"_c{i}") * 100.0, F.col("_n")).alias("pct"))
             for i, c in enumerate(cols)]
    return _rows_from_struct_array(row, items)


def token_profile(df: DataFrame, columns: Sequence[str] | None = None,
                  tokens: Sequence[str] = C.MISSING_TOKENS) -> DataFrame:
    """Per column: real nulls and placeholder tokens (after stripping), two counts."""
    cols = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"_z{i}"))
        aggs.append(F.count_if(strip(F.col(c).cast("string")).isin(*tokens)).alias(f"_t{i}"))
    row = df.agg(*aggs)
    items = [F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column"),
                      F.col(f"_z{i}").alias("nulls"), F.col(f"_t{i}").alias("tokens"),
                      F.try_divide(F.col(f"_t{i}") * 100.0, F.col("_n")).alias("token_pct"))
             for i, c in enumerate(cols)]
    return _rows_from_struct_array(row, items)


def numeric_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min / median / max per numeric column, nulls skipped (min/max in one pass, all
    medians in another)."""
    df = cut_lineage(df.select(*columns), "ranges")
    q = percentile_map(df, columns, (0.5,))
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
    row = df.agg(*aggs).withColumn("_q", q)
    items = [F.struct(F.lit(c).alias("column"), F.col(f"_lo{i}").alias("min"),
                      F.get(F.col("_q")[c], 0).alias("median"), F.col(f"_hi{i}").alias("max"))
             for i, c in enumerate(columns)]
    return _rows_from_struct_array(row, items)


def per_key_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Values per key (non-null count), then mean / max / min over keys."""
    per_key = (df.where(F.col(key).isNotNull()).groupBy(key)
                 .agg(F.count(value).alias("n")))
    return per_key.agg(F.avg("n").alias("mean"), F.max("n").alias("max"), F.min("n").alias("min"))


def integrity_checks(df: DataFrame, positive: str = "positive", negative: str = "negative",
                     total: str = "total", bounds: dict | None = None) -> DataFrame:
    """Rows where positive + negative <> total (only when all present) and
    out-of-range counts per bounded column (null read as 0), one pass."""
    bounds = bounds or {}
    checks = {"sum_mismatch": (F.col(positive) + F.col(negative)) != F.col(total)}
    for c, (lo, hi) in bounds.items():
        v = F.coalesce(F.col(c), F.lit(0))
        checks[f"{c}_out_of_range"] = (v < lo) | (v > hi)
    return conditional_counts(df, checks)


# --- statistics -------------------------------------------------------------

def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles (linear), max per column as rows."""
    df = cut_lineage(df.select(*columns), "describe")
    q = percentile_map(df, columns, (0.25, 0.5, 0.75))
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"_n{i}"), F.avg(x).alias(f"_m{i}"),
                 F.stddev_samp(x).alias(f"_s{i}"), F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
    row = df.agg(*aggs).withColumn("_q", q)
    items = [F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("count"),
                      F.col(f"_m{i}").alias("mean"), F.col(f"_s{i}").alias("std"),
                      F.col(f"_lo{i}").alias("min"), F.get(F.col("_q")[c], 0).alias("p25"),
                      F.get(F.col("_q")[c], 1).alias("p50"), F.get(F.col("_q")[c], 2).alias("p75"),
                      F.col(f"_hi{i}").alias("max"))
             for i, c in enumerate(columns)]
    return _rows_from_struct_array(row, items)


def quantiles(df: DataFrame, col: str, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per probability."""
    return exact_percentiles(df, col, probs).select("prob", "value")


def safe_corr(x: str, y: str) -> Column:
    """Pearson over pairwise-complete rows; null (not an error) when a side is constant."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xs, ys = F.when(both, F.col(x).cast("double")), F.when(both, F.col(y).cast("double"))
    # ``corr`` itself raises DIVIDE_BY_ZERO under ANSI on a constant column,
    # even behind a ``when``; the moment form divides with try_divide.
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def pearson(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    row = df.agg(*[safe_corr(a, b).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    items = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"_r{i}").alias("pearson"))
             for i, (a, b) in enumerate(pairs)]
    return _rows_from_struct_array(row, items)


def year_trend(df: DataFrame, year_col: str, metric: str, min_n: int = 5,
               z: float = C.CI_Z) -> DataFrame:
    """Per year: n, mean, standard error (null for n = 1), CI band; years with n >= min_n."""
    sem = F.when(F.count(metric) > 1, F.stddev_samp(metric) / F.sqrt(F.count(F.lit(1))))
    return (df.where(F.col(year_col).isNotNull())
              .groupBy(F.col(year_col).cast("int").alias(year_col))
              .agg(F.count(F.lit(1)).alias("n_games"), F.avg(metric).alias("mean_div"),
                   sem.alias("sem"))
              .where(F.col("n_games") >= min_n)
              .withColumn("ci95", F.col("sem") * z)
              .withColumn("lower", F.col("mean_div") - F.col("ci95"))
              .withColumn("upper", F.col("mean_div") + F.col("ci95"))
              .orderBy(year_col))


def extreme_rows(df: DataFrame, key: str, metric: str, cols: Sequence[str]) -> DataFrame:
    """Row of the largest and of the smallest metric; the smallest key wins ties."""
    payload = F.struct(*[F.col(c) for c in cols])
    row = df.agg(F.max_by(payload, F.struct(F.col(metric), -F.col(key))).alias("_hi"),
                 F.min_by(payload, F.struct(F.col(metric), F.col(key))).alias("_lo"))
    items = [F.struct(F.lit("max").alias("extreme"), F.col("_hi").alias("row")),
             F.struct(F.lit("min").alias("extreme"), F.col("_lo").alias("row"))]
    return _rows_from_struct_array(row, items).select("extreme", "row.*")
