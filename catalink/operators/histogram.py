"""Distribution tables behind the charts: equal-width histograms (plain, on
log10, density) and box statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalink.operators.quantiles import exact_percentile_columns


def _range_stats(df: DataFrame, x: Column) -> DataFrame:
    """One-row (lo, hi, n): min and max, widened by 0.5 for a constant column."""
    stats = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx"), F.count(x).alias("n"))
    same = F.col("mn") == F.col("mx")
    return stats.select(F.when(same, F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                        F.when(same, F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"),
                        "n")


def histogram(df: DataFrame, value: Column | str, bins: int, value_name: str = "value",
              density: bool = False) -> DataFrame:
    """Equal-width histogram with ``bins`` bins between the min and max;
    a value on an edge is counted in the bin that the edge begins, and the
    last bin is closed.  Every bin is listed (empty bins count 0).

    The range and the row count come from one aggregate, which serves both as
    the scalar used to bin each row and as the one-row frame of all bins."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    vals = df.select(x.alias(value_name)).where(F.col(value_name).isNotNull())
    stats = _range_stats(vals, F.col(value_name))
    rng = stats.select(F.struct("lo", "hi").alias("r")).scalar()
    lo, hi = rng.getField("lo"), rng.getField("hi")
    width = (hi - lo) / F.lit(float(bins))
    near = F.least(F.floor((F.col(value_name) - lo) * (F.lit(float(bins)) / (hi - lo))), F.lit(bins - 1)).cast("int")
    # rounding may put a value beside its bin: the edges that are reported decide
    x, at = F.col("_x"), F.col("_near")
    idx = (F.when(x < F.col("_lo") + at * F.col("_w"), at - 1)
           .when((at < bins - 1) & (x >= F.col("_lo") + (at + 1) * F.col("_w")), at + 1).otherwise(at))
    vals = vals.select(F.col(value_name).alias("_x"), near.alias("_near"), lo.alias("_lo"), width.alias("_w"))
    counts = vals.select(idx.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    frame = (stats.where(F.col("n") > 0)
                  .select("lo", "hi", "n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    out = (frame.join(counts, on="bin", how="left")
                .select("bin", (F.col("lo") + F.col("bin") * width).alias("lo"),
                        (F.col("lo") + (F.col("bin") + 1) * width).alias("hi"),
                        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
                        "n", width.alias("_w")))
    if density:
        out = out.withColumn("density", F.col("count") / (F.col("n") * F.col("_w")))
    return out.drop("n", "_w").orderBy("bin")


def log_histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Histogram of log10(value) with 0 read as 1."""
    v = F.col(value)
    x = F.log10(F.when(v == 0, F.lit(1)).otherwise(v))
    return histogram(df.where(v >= 0), x, bins, value_name="log10_value")


def box_stats(df: DataFrame, group: str, value: str, whis: float = 1.5) -> DataFrame:
    """Quartiles (linear), whiskers at the last point within ``whis`` IQR, outliers."""
    data = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()) \
             .select(group, F.col(value).cast("double").alias("_v"))
    q = exact_percentile_columns(data, "_v", (0.25, 0.5, 0.75), ("q1", "median", "q3"), [group])
    fences = q.withColumn("_lo", F.col("q1") - whis * (F.col("q3") - F.col("q1"))) \
              .withColumn("_hi", F.col("q3") + whis * (F.col("q3") - F.col("q1")))
    inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    return (data.join(fences, on=group, how="inner")
                .groupBy(group, "q1", "median", "q3")
                .agg(F.count(F.lit(1)).alias("n"),
                     F.min(F.when(inside, F.col("_v"))).alias("whisker_lo"),
                     F.max(F.when(inside, F.col("_v"))).alias("whisker_hi"),
                     F.count_if(~inside).alias("n_outliers")))
