"""Average ranks (ties share the mean position) of any number of series in one pass.

Exact, without a window over all rows or values and without range bounds in the plan:

1. equal values are counted per series, with map-side combine;
2. the distinct (series, value) rows are range-partitioned by Spark and written once, each with
   the number of its range;
3. the rows before a range are a prefix sum over one total per range (as many as there are
   shuffle partitions);
4. within a range a window gives the rows before a value, so no task holds more than a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalink.session import cut_lineage


def _before(key: str, n: str) -> Column:
    """Sum of ``n`` over the rows before this one; only for tables of one row a range or series."""
    return F.coalesce(F.sum(n).over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def rank_series(values: DataFrame, ranges: int | None = None) -> DataFrame:
    """(series, value, rank) for each distinct value of (series, value, n) rows, ``n`` being how
    often the row counts; values are not null.  ``ranges``: number of ranges (default: Spark's
    shuffle partitions, coalesced by size)."""
    counts = values.groupBy("series", "value").agg(F.sum("n").alias("n"))
    ranged = counts.repartitionByRange(ranges, "series", "value") if ranges else counts.repartitionByRange("series", "value")
    placed = cut_lineage(ranged.withColumn("_range", F.spark_partition_id()), "ranks")
    ahead = placed.groupBy("_range").agg(F.sum("n").alias("_n")).select("_range", _before("_range", "_n").alias("_ahead"))
    first = placed.groupBy("series").agg(F.sum("n").alias("_n")).select("series", _before("series", "_n").alias("_first"))
    inside = Window.partitionBy("_range").orderBy("series", "value").rowsBetween(Window.unboundedPreceding, -1)
    # one row a range and one a series
    rows = (placed.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
                  .join(F.broadcast(ahead), "_range").join(F.broadcast(first), "series"))
    return rows.select("series", "value", (F.col("_ahead") + F.col("_inside") - F.col("_first") + (F.col("n") + 1) / 2.0).alias("rank"))


def average_rank(df: DataFrame, col: str, rank_col: str, ranges: int | None = None) -> DataFrame:
    """Attach the average rank of a column; null values have none."""
    values = df.where(F.col(col).isNotNull()).select(F.lit(0).alias("series"), F.col(col).alias("value"), F.lit(1).cast("bigint").alias("n"))
    ranks = rank_series(values, ranges).select(F.col("value").alias(col), F.col("rank").alias(rank_col))
    return df.join(ranks, on=col, how="left")


def spearman_frame(df: DataFrame, pairs: Sequence[tuple[str, str]], ranges: int | None = None) -> DataFrame:
    """(x, y, spearman) for each pair of columns: Pearson of average ranks over the rows where
    both are set; null without such rows or where a side is constant.

    Both sides of all pairs are ranked in one pass.  Equal (pair, x, y) rows are counted first,
    so a value that fills a third of the rows meets its rank once for each partner value.  The
    mean rank of N rows is (N + 1) / 2, so the moments are taken around it.
    """
    labels = [F.struct(F.lit(i).alias("pair"), F.lit(a).alias("x"), F.lit(b).alias("y")) for i, (a, b) in enumerate(pairs)]
    both = [F.struct(F.lit(i).alias("pair"), F.col(a).cast("double").alias("vx"), F.col(b).cast("double").alias("vy"))
            for i, (a, b) in enumerate(pairs)]
    rows = cut_lineage(df.select(F.inline(F.array(*both))).where(F.col("vx").isNotNull() & F.col("vy").isNotNull())
                         .groupBy("pair", "vx", "vy").agg(F.count(F.lit(1)).alias("n")), "spearman")
    sides = F.array(F.struct((F.col("pair") * 2).alias("series"), F.col("vx").alias("value"), "n"),
                    F.struct((F.col("pair") * 2 + 1).alias("series"), F.col("vy").alias("value"), "n"))
    ranks = cut_lineage(rank_series(rows.select(F.inline(sides)), ranges), "ranked")

    def side(number: int, value: str, name: str) -> DataFrame:
        return ranks.where(F.col("series") % 2 == number).select((F.col("series") / 2).cast("int").alias("pair"), F.col("value").alias(value),
                                                                F.col("rank").alias(name))

    middle = rows.groupBy("pair").agg(((F.sum("n") + 1) / 2.0).alias("_mid"))  # one row a pair
    ranked = (rows.join(side(0, "vx", "rx"), ["pair", "vx"]).join(side(1, "vy", "ry"), ["pair", "vy"]).join(F.broadcast(middle), "pair"))
    dx, dy, n = F.col("rx") - F.col("_mid"), F.col("ry") - F.col("_mid"), F.col("n")
    found = ranked.groupBy("pair").agg(F.try_divide(F.sum(n * dx * dy), F.sqrt(F.sum(n * dx * dx)) * F.sqrt(F.sum(n * dy * dy))).alias("spearman"))
    return (df.sparkSession.range(1).select(F.inline(F.array(*labels))).join(F.broadcast(found), "pair", "left")
              .select("x", "y", "spearman"))
