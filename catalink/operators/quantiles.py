"""Exact percentiles (linear interpolation) by distributed radix selection.

Spark's exact ``percentile``/``median`` keeps every distinct value of a group in one task's
hash map.  Here a value becomes a 64-bit number of the same order (its IEEE bits), and the
wanted ranks of all groups and probabilities are found digit by digit, 16 bits a round:

1. count the rows of each (group, digits so far, next digit): partial aggregation, at most
   65,536 counts for each (group, digits so far) whatever the number of rows;
2. walk those counts to the digit that holds each wanted rank; the rows before it are taken
   off the rank, and only rows with the digits so far take part in the next round.

After four rounds a rank's value is known exactly.  No task holds or ranks a group's rows; the
largest piece of work is one group's counts.  The rounds are one plan without driver steps.
The narrow input (groups and value) is written once and read in each round.  Several columns
are one call: they become (column, value) rows, grouped by column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalink.session import cut_lineage

#: Bits of a digit; 64 is a multiple.
DIGIT = 16
#: Groups whose wanted digits are broadcast (some 100 bytes each); beyond, rows meet them by
#: a join in which each group is dealt over ``SLICES`` parts.
BROADCAST_GROUPS = 100_000
SLICES = 16


def order_bits(x: Column) -> Column:
    """A bigint with the order of the doubles (not NaN): the IEEE bits, negated below zero."""
    size = F.abs(x)
    guess = F.floor(F.log2(size)).cast("int")
    part = size / F.pow(F.lit(2.0), guess)  # exact: a power of two; the guess may be off by one
    e = F.when(part < 1, guess - 1).when(part >= 2, guess + 1).otherwise(guess)
    fraction = (size / F.pow(F.lit(2.0), e) - 1) * F.lit(2.0 ** 52)
    tiny = size * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)
    bits = (F.when(size == F.lit(float("inf")), F.lit(2047 << 52))
            .when(size < F.lit(2.0 ** -1022), tiny.cast("bigint"))
            .otherwise(F.shiftleft((e + 1023).cast("bigint"), 52) + fraction.cast("bigint")))
    return F.when(x < 0, -bits).otherwise(bits)


def exact_percentiles(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """Long result: ``*groups, prob_index, prob, value`` (nulls skipped; a
    group with no values gets no rows)."""
    if not groups:
        return column_percentiles(df, [value], probs).drop("column")
    g = list(groups)
    base = df.select(*g, F.col(value).cast("double").alias("_v"))
    base = base.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    for c in g:  # pandas-style grouping drops null keys
        base = base.where(F.col(c).isNotNull())
    base = cut_lineage(base.select(*g, "_v", order_bits(F.col("_v")).alias("_k")), "percentiles")
    few = base.select(*g).distinct().limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS

    def walk(counts: Column, rank: Column) -> Column:
        """(rows before, digit, its value) of the count in which the rank falls."""
        none = F.struct(F.lit(0).cast("bigint").alias("before"), F.lit(0).cast("bigint").alias("digit"),
                        F.lit(None).cast("double").alias("v"), F.lit(False).alias("done"))

        def step(acc: Column, c: Column) -> Column:
            here = rank < acc["before"] + c["n"]
            return F.when(acc["done"], acc).otherwise(F.struct(
                (acc["before"] + F.when(here, 0).otherwise(c["n"])).alias("before"), c["digit"].alias("digit"), c["v"].alias("v"), here.alias("done")))

        return F.aggregate(counts, none, step)

    wanted = None  # by (group, digits so far): the ranks asked there
    for shift in range(64 - DIGIT, -1, -DIGIT):
        last = shift == 0
        rows = base.select(*g, F.shiftright("_k", shift + DIGIT).alias("_so_far") if wanted is not None else F.lit(0).cast("bigint").alias("_so_far"),
                           (F.shiftright("_k", shift) if wanted is None else F.shiftright("_k", shift).bitwiseAND(F.lit((1 << DIGIT) - 1))).alias("_digit"), "_v")
        if wanted is None:
            counts = rows.groupBy(*g, "_so_far", "_digit").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("v"))
            counts = counts.withColumn("_asked", F.lit(None).cast("array<struct<i:int,side:int,rank:bigint>>"))
        else:
            key = [*g, "_so_far"]
            if few:
                rows = rows.join(F.broadcast(wanted), key)
            else:
                dealt = wanted.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
                rows = rows.withColumn("_slice", F.pmod(F.xxhash64("_v", "_digit", F.monotonically_increasing_id()), F.lit(SLICES)).cast("int"))
                rows = rows.join(dealt, [*key, "_slice"])
            counts = rows.groupBy(*g, "_so_far", "_digit").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("v"), F.first("_asked").alias("_asked"))
        table = counts.groupBy(*g, "_so_far").agg(
            F.array_sort(F.collect_list(F.struct(F.col("_digit").alias("digit"), "n", "v"))).alias("_counts"),
            F.first("_asked").alias("_asked"))
        if wanted is None:  # ranks from the number of rows
            n = F.aggregate("_counts", F.lit(0).cast("bigint"), lambda acc, c: acc + c["n"])
            at = lambda p: (F.col("_n") - 1) * F.lit(float(p))
            table = table.withColumn("_n", n).withColumn("_asked", F.array(*[
                F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), f(at(p)).cast("bigint").alias("rank"))
                for i, p in enumerate(probs) for side, f in enumerate((F.floor, F.ceil))]))
            table = table.withColumn("_asked", F.transform("_asked", lambda a: F.struct(a["i"].alias("i"), a["side"].alias("side"), a["rank"].alias("rank"), F.col("_n").alias("n"))))
        found = table.select(*g, "_so_far", F.transform("_asked", lambda a: F.struct(a.alias("a"), walk(F.col("_counts"), a["rank"]).alias("f"))).alias("_found"))
        found = found.select(*g, "_so_far", F.explode("_found").alias("_f"))
        if not last:
            so_far = F.col("_f.f.digit") if wanted is None else F.shiftleft("_so_far", DIGIT) + F.col("_f.f.digit")
            one = F.struct(F.col("_f.a.i").alias("i"), F.col("_f.a.side").alias("side"), (F.col("_f.a.rank") - F.col("_f.f.before")).alias("rank"), F.col("_f.a.n").alias("n"))
            wanted = found.select(*g, so_far.alias("_so_far"), one.alias("_one")).groupBy(*g, "_so_far").agg(F.collect_list("_one").alias("_asked"))

    picked = found.groupBy(*g, F.col("_f.a.i").alias("prob_index"), F.col("_f.a.n").alias("_n")).agg(
        F.max(F.when(F.col("_f.a.side") == 0, F.col("_f.f.v"))).alias("_v1"), F.max(F.when(F.col("_f.a.side") == 1, F.col("_f.f.v"))).alias("_v2"))
    prob = F.get(F.array(*[F.lit(float(p)) for p in probs]), F.col("prob_index"))
    position = (F.col("_n") - 1) * prob
    between = F.col("_v1") + (F.col("_v2") - F.col("_v1")) * (position - F.floor(position))
    return picked.select(*g, "prob_index", prob.alias("prob"), F.when(F.col("_v1") == F.col("_v2"), F.col("_v1")).otherwise(between).alias("value"))


def column_percentiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``column, prob_index, prob, value`` of several columns in one pass."""
    rows = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_value"))
                                        for c in columns])))
    return exact_percentiles(rows, "_value", probs, ["column"])


def percentile_map(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> Column:
    """Scalar: a map from column to the array of its percentiles (one row per column in all)."""
    per = column_percentiles(df, columns, probs).groupBy("column").agg(
        F.array(*[F.max(F.when(F.col("prob_index") == i, F.col("value"))) for i in range(len(probs))]).alias("q"))
    return per.agg(F.map_from_entries(F.collect_list(F.struct("column", "q")))).scalar()


def exact_percentile_columns(df: DataFrame, value: str, probs: Sequence[float],
                             names: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Wide result: ``*groups`` plus one column per probability."""
    long = exact_percentiles(df, value, probs, groups)
    aggs = [F.max(F.when(F.col("prob_index") == i, F.col("value"))).alias(n) for i, n in enumerate(names)]
    if groups:
        return long.groupBy(*groups).agg(*aggs)
    return long.agg(*aggs)


def exact_median(df: DataFrame, value: str, groups: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_percentile_columns(df, value, [0.5], [name], groups)
