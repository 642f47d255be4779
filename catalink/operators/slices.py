"""Slices of an entity table: by a long attribute table, by an entity column,
and the signature values that separate two label groups."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalink import config as C
from catalink.operators.quantiles import exact_median as median_of


def label_column_name(prefix: str, label: str) -> str:
    """``pct_`` + label turned into a plain identifier (``Q1 Both Loved`` -> ``pct_q1_both_loved``)."""
    return prefix + re.sub(r"[^0-9a-z]+", "_", label.lower()).strip("_")


def _with_median(agg: DataFrame, rows: DataFrame, key: str, metric: str, name: str,
                 exact: bool) -> DataFrame:
    """Attach a per-key median of ``metric`` over ``rows`` (exact by default,
    with bounded per-task memory; approximate on request)."""
    if exact:
        med = median_of(rows, metric, [key], name)
    else:
        med = rows.where(F.col(key).isNotNull()).groupBy(key).agg(
            F.percentile_approx(metric, 0.5, 10000).alias(name))
    return agg.join(med, on=key, how="left")


def slice_by_long_table(long_df: DataFrame, entities: DataFrame, key_col: str, min_games: int,
                        id_col: str = "app_id", metric: str = "divergence_ratio",
                        label_col: str = "quadrant", labels: Sequence[str] = C.QUADRANTS,
                        exact_median: bool = True) -> DataFrame:
    """Profile an entity metric per value of a long (id, value) table.

    Per value: distinct entities, mean and median of the metric over the
    joined rows, and the share (percent of the value's distinct entities) of
    each label.  Values with fewer than ``min_games`` entities are dropped.

    Two aggregation levels keep it exact when the long table repeats a pair:
    level 1 groups by (id, value) and sums and counts the metric over all joined
    rows (entities may have several rows for an id), level 2 groups by value; the
    median runs over the joined rows with bounded per-task memory.  After a sort-merge join on the id,
    level 1 needs no extra shuffle; a hot value is reduced map-side.
    """
    joined = (long_df.select(id_col, key_col).where(F.col(key_col).isNotNull())
              .join(entities.select(id_col, metric, label_col), on=id_col, how="inner"))
    per_pair = (joined.groupBy(id_col, key_col)
                .agg(F.sum(metric).alias("_sum"), F.count(metric).alias("_rows"),
                     F.min(label_col).alias(label_col)))
    label_counts = [F.count_if(F.col(label_col) == F.lit(lbl)).alias(label_column_name("_n_", lbl))
                    for lbl in labels]
    agg = (per_pair.groupBy(key_col)
           .agg(F.count(F.lit(1)).alias("n_games"),
                F.try_divide(F.sum("_sum"), F.sum("_rows")).alias("mean_div"), *label_counts))
    agg = _with_median(agg, joined, key_col, metric, "median_div", exact_median)
    pct_cols = [(F.col(label_column_name("_n_", lbl)) / F.col("n_games") * 100)
                .alias(label_column_name("pct_", lbl)) for lbl in labels]
    return (agg.where(F.col("n_games") >= min_games)
               .select(key_col, F.col("n_games").cast("bigint").alias("n_games"),
                       "mean_div", "median_div", *pct_cols)
               .orderBy(F.desc_nulls_last("mean_div"), F.asc(key_col)))


def entity_stats(entities: DataFrame, col: str, min_games: int, id_col: str = "app_id",
                 metric: str = "divergence_ratio", player: str = "player_ratio_100",
                 critic: str = "critic_norm", exact_median: bool = True) -> DataFrame:
    """Per entity value: distinct ids, mean/median metric, mean of both yardsticks."""
    rows = entities.where(F.col(col).isNotNull())
    agg = (rows.groupBy(col)
               .agg(F.count_distinct(id_col).alias("n_games"),
                    F.avg(metric).alias("mean_div"),
                    F.avg(player).alias("mean_player"),
                    F.avg(critic).alias("mean_critic"))
               .where(F.col("n_games") >= min_games))
    out = _with_median(agg, rows, col, metric, "median_div", exact_median)
    return out.select(col, "n_games", "mean_div", "median_div", "mean_player", "mean_critic")


def signature_values(long_df: DataFrame, entities: DataFrame, value_col: str,
                     group_a: str = C.QUADRANTS[1], group_b: str = C.QUADRANTS[2],
                     min_support: int = 10, n_each: int = 15, id_col: str = "app_id",
                     label_col: str = "quadrant") -> DataFrame:
    """Values whose frequency differs most between two label groups.

    Frequency of a value in a group = rows of the long table for the group's
    ids / number of ids in the group * 100.  Values with fewer than
    ``min_support`` rows in the two groups together are dropped; the ``n_each``
    largest and smallest differences are returned (ties by value).
    """
    groups = entities.where(F.col(label_col).isin(group_a, group_b)).select(id_col, label_col)
    sizes = groups.agg(F.count_distinct(F.when(F.col(label_col) == group_a, F.col(id_col))).alias("n_a"),
                       F.count_distinct(F.when(F.col(label_col) == group_b, F.col(id_col))).alias("n_b"))
    n_a = sizes.select("n_a").scalar()
    n_b = sizes.select("n_b").scalar()
    counts = (long_df.select(id_col, value_col).where(F.col(value_col).isNotNull())
              .join(groups, on=id_col, how="inner")
              .groupBy(value_col)
              .agg(F.count_if(F.col(label_col) == group_a).alias("c_a"),
                   F.count_if(F.col(label_col) == group_b).alias("c_b")))
    pct_a = F.try_divide(F.col("c_a"), n_a) * 100
    pct_b = F.try_divide(F.col("c_b"), n_b) * 100
    scored = (counts.select(value_col, pct_a.alias("a_pct"), pct_b.alias("b_pct"))
              .withColumn("support", F.col("a_pct") / 100 * n_a + F.col("b_pct") / 100 * n_b)
              .where(F.col("support") >= min_support)
              .withColumn("diff", F.col("a_pct") - F.col("b_pct")))
    top = (scored.orderBy(F.desc("diff"), F.asc(value_col)).limit(n_each)
           .withColumn("side", F.lit(group_a)))
    bottom = (scored.orderBy(F.asc("diff"), F.asc(value_col)).limit(n_each)
              .withColumn("side", F.lit(group_b)))
    return top.unionByName(bottom)
