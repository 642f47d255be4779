"""Data-quality reports as long tables ``(item, section, metric, value)``.

Each report runs a handful of one-pass aggregates (partial aggregation, no
driver loop); their scalars are combined as scalar subqueries into one
narrow result that can be written with any sink.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalink import config as C
from catalink.functions.expressions import is_non_ascii, strip
from catalink.operators.quantiles import percentile_map
from catalink.session import cut_lineage


def report(base: DataFrame, items: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Rows (item, section, metric, value) from one-row ``base`` plus scalars."""
    structs = [F.struct(F.lit(i + 1).alias("item"), F.lit(sec).alias("section"),
                        F.lit(metric).alias("metric"), v.cast("double").alias("value"))
               for i, (sec, metric, v) in enumerate(items)]
    return base.select(F.inline(F.array(*structs)))


def _scalar(df: DataFrame, expr: Column) -> Column:
    return df.agg(expr.alias("v")).scalar()


def one_pass(df: DataFrame, metrics: dict[str, Column]) -> Column:
    """All ``metrics`` (aggregate expressions) of ``df`` in ONE aggregate pass,
    as one struct-valued scalar subquery; read fields with ``getField``."""
    return df.agg(F.struct(*[e.alias(n) for n, e in metrics.items()]).alias("v")).scalar()


def _dup_rows(df: DataFrame, cols: Sequence[str]) -> Column:
    per = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return _scalar(per, F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)))


def long_table_report(raw: DataFrame, clean: DataFrame, key: str, value: str,
                      vocab_size: int | None, unmapped: DataFrame | None) -> DataFrame:
    """Raw stats, values per key, language check, cleaning result, unmapped count.

    The raw table is read once for its counts: each row gives a (key) and a (value) row, equal
    ones are counted with map-side combine, and all distinct counts and the values per key are
    counts over those groups; non-ASCII texts are looked for among distinct values only.
    """
    side = lambda which, k, v, has: F.struct(F.lit(which).alias("side"), k.alias("k"), v.alias("v"), has.alias("has"))
    types = {f.name: f.dataType for f in raw.schema.fields}
    has = F.col(value).isNotNull().cast("bigint")
    groups = (raw.select(F.inline(F.array(side("key", F.col(key), F.lit(None).cast(types[value]), has),
                                          side("value", F.lit(None).cast(types[key]), F.col(value), has))))
                 .groupBy("side", "k", "v").agg(F.count(F.lit(1)).alias("n"), F.sum("has").alias("has")))
    of_key, of_value = F.col("side") == "key", F.col("side") == "value"
    a_key, a_value = of_key & F.col("k").isNotNull(), of_value & F.col("v").isNotNull()
    per_key = F.when(a_key, F.col("has"))
    base = groups.agg(F.coalesce(F.sum(F.when(of_key, F.col("n"))), F.lit(0)).alias("rows"),
                      F.count_if(a_key).alias("keys"),
                      F.coalesce(F.sum(F.when(of_value & F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
                      F.count_if(a_value).alias("distinct_values"),
                      F.count_if(a_value & is_non_ascii(F.col("v"))).alias("non_ascii"),
                      F.avg(per_key).alias("mean"), F.max(per_key).alias("max"), F.min(per_key).alias("min"))
    cl = one_pass(clean.groupBy(value).agg(F.count(F.lit(1)).alias("n")),
                  {"rows": F.coalesce(F.sum("n"), F.lit(0)), "distinct": F.count(value)})
    clean_rows = cl.getField("rows")
    dup_pairs = _dup_rows(raw, [key, value])
    dup_rows = dup_pairs if sorted(raw.columns) == sorted([key, value]) else _dup_rows(raw, raw.columns)
    items = [
        ("raw", "total_rows", F.col("rows")),
        ("raw", "unique_keys", F.col("keys")),
        ("raw", "missing_values", F.col("missing")),
        ("raw", "duplicate_rows", dup_rows),
        ("raw", "duplicate_pairs", dup_pairs),
        ("per_key", "mean", F.col("mean")),
        ("per_key", "max", F.col("max")),
        ("per_key", "min", F.col("min")),
        ("language", "raw_distinct", F.col("distinct_values")),
        ("language", "non_ascii_values", F.col("non_ascii")),
        ("language", "clean_distinct", cl.getField("distinct")),
        ("language", "vocabulary_size", F.lit(vocab_size)),
        ("cleaning", "rows_before", F.col("rows")),
        ("cleaning", "rows_after", clean_rows),
        ("cleaning", "rows_removed", F.col("rows") - clean_rows),
    ]
    if unmapped is not None:
        items.append(("warnings", "unmapped_values", _scalar(unmapped, F.count(F.lit(1)))))
    return report(base, items)


def wide_source_report(raw: DataFrame, clean: DataFrame, key: str) -> DataFrame:
    """Rows, columns, duplicate rows / keys of a source and what cleaning kept."""
    base = raw.agg(F.count(F.lit(1)).alias("rows"))
    clean_rows = _scalar(clean, F.count(F.lit(1)))
    return report(base, [
        ("raw", "total_rows", F.col("rows")),
        ("raw", "total_columns", F.lit(len(raw.columns))),
        ("raw", "duplicate_rows", _dup_rows(raw, raw.columns)),
        ("raw", "duplicate_keys", _dup_rows(raw, [key]) if key in raw.columns else F.lit(None)),
        ("cleaning", "columns_retained", F.lit(len(clean.columns))),
        ("cleaning", "rows_retained", clean_rows),
        ("cleaning", "rows_removed", F.col("rows") - clean_rows),
    ])


def merged_report(df: DataFrame, price: str = "price", is_free: str = "is_free",
                  owners: str = "owners_range", top: int = 10) -> DataFrame:
    """Nulls per column, price range, free/paid shares, top owners ranges."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_n")] + \
           [F.count_if(F.col(c).isNull()).alias(f"_z{i}") for i, c in enumerate(cols)]
    p = F.col(price).cast("double") if price in cols else None
    if p is not None:
        aggs += [F.min(p).alias("_pmin"), F.get(percentile_map(df, [price], (0.5,))[price], 0).alias("_pmed"),
                 F.max(p).alias("_pmax"),
                 F.count_if(F.coalesce(p, F.lit(-1.0)) > 0).alias("_ppaid"),
                 F.count_if(F.coalesce(p, F.lit(-1.0)) == 0).alias("_pfree"),
                 F.count_if(p.isNull()).alias("_pmiss")]
    if is_free in cols:
        f = F.coalesce(F.col(is_free), F.lit(-1))
        aggs += [F.count_if(f == 0).alias("_paid"), F.count_if(f == 1).alias("_free")]
    base = df.agg(*aggs)
    n = F.col("_n")
    items: list = [("overview", "total_rows", n), ("overview", "total_columns", F.lit(len(cols)))]
    for i, c in enumerate(cols):
        items.append(("nulls", c, F.col(f"_z{i}")))
        items.append(("null_pct", c, F.try_divide(F.col(f"_z{i}") * 100.0, n)))
    if p is not None:
        items += [("price", "min", F.col("_pmin")), ("price", "median", F.col("_pmed")),
                  ("price", "max", F.col("_pmax")), ("price", "paid", F.col("_ppaid")),
                  ("price", "free", F.col("_pfree")), ("price", "missing", F.col("_pmiss"))]
    if is_free in cols:
        items += [("is_free", "paid", F.col("_paid")), ("is_free", "free", F.col("_free")),
                  ("is_free", "paid_pct", F.try_divide(F.col("_paid") * 100.0, n)),
                  ("is_free", "free_pct", F.try_divide(F.col("_free") * 100.0, n))]
    out = report(base, items)
    if owners in cols:
        top_owners = (df.where(F.col(owners).isNotNull()).groupBy(owners)
                        .agg(F.count(F.lit(1)).alias("value"))
                        .orderBy(F.desc("value"), F.asc(owners)).limit(top))
        out = out.unionByName(top_owners.select(
            (F.lit(len(items)) + F.row_number().over(
                Window.orderBy(F.desc("value"), F.asc(owners)))).alias("item"),
            F.lit("owners_top").alias("section"), F.col(owners).alias("metric"),
            F.col("value").cast("double").alias("value")))
    return out


def review_report(raw: DataFrame, clean: DataFrame, numeric: Sequence[str],
                  description: str = "review_score_description",
                  drop_columns: Sequence[str] = C.REVIEW_DROP_COLUMNS,
                  tokens: Sequence[str] = C.MISSING_TOKENS, top: int = 15) -> DataFrame:
    """Placeholder tokens per raw column (nulls separately), kept columns,
    integrity and range checks, numeric ranges, top descriptions."""
    rcols = raw.columns
    base = raw.agg(F.count(F.lit(1)).alias("_n"),
                   *[F.count_if(strip(F.col(c).cast("string")).isin(*tokens)).alias(f"_t{i}")
                     for i, c in enumerate(rcols)],
                   *[F.count_if(F.col(c).isNull()).alias(f"_z{i}") for i, c in enumerate(rcols)])
    ccols = clean.columns
    clean = cut_lineage(clean, "review-clean")
    # every clean-side metric in one aggregate pass, all medians in another
    numeric = [c for c in numeric if c in ccols]
    medians = percentile_map(clean, numeric, (0.5,)) if numeric else None
    metrics: dict[str, Column] = {"rows": F.count(F.lit(1))}
    if {"positive", "negative", "total"}.issubset(ccols):
        metrics["mismatch"] = F.count_if((F.col("positive") + F.col("negative")) != F.col("total"))
    bounds = {"review_score": (0, 9), "metacritic_score": (0, 100)}
    for c, (lo, hi) in bounds.items():
        if c in ccols:
            v = F.coalesce(F.col(c), F.lit(0))
            metrics[f"{c}_oor"] = F.count_if((v < lo) | (v > hi))
    for c in numeric:
        if c in ccols:
            metrics[f"{c}_min"] = F.min(c)
            metrics[f"{c}_max"] = F.max(c)
    cm = one_pass(clean, metrics)
    clean_rows = cm.getField("rows")
    items: list = [("raw", "total_rows", F.col("_n")), ("raw", "total_columns", F.lit(len(rcols))),
                   ("raw", "duplicate_rows", _dup_rows(raw, rcols))]
    if "app_id" in rcols:
        items.append(("raw", "duplicate_keys", _dup_rows(raw, ["app_id"])))
    for i, c in enumerate(rcols):
        items.append(("tokens", c, F.col(f"_t{i}")))
        items.append(("nulls", c, F.col(f"_z{i}")))
    retained = [c for c in rcols if c not in drop_columns]
    items += [("cleaning", "columns_retained", F.lit(len(retained))),
              ("cleaning", "rows_before", F.col("_n")), ("cleaning", "rows_after", clean_rows),
              ("cleaning", "rows_removed", F.col("_n") - clean_rows)]
    if "mismatch" in metrics:
        items.append(("integrity", "sum_mismatch", cm.getField("mismatch")))
    for c in bounds:
        if c in ccols:
            items.append(("integrity", f"{c}_out_of_range", cm.getField(f"{c}_oor")))
    for c in numeric:
        if c in ccols:
            items += [("ranges", f"{c}_min", cm.getField(f"{c}_min")),
                      ("ranges", f"{c}_median", F.get(medians[c], 0)),
                      ("ranges", f"{c}_max", cm.getField(f"{c}_max"))]
    out = report(base, items)
    if description in ccols:
        top_desc = (clean.where(F.col(description).isNotNull()).groupBy(description)
                         .agg(F.count(F.lit(1)).alias("value"))
                         .orderBy(F.desc("value"), F.asc(description)).limit(top))
        out = out.unionByName(top_desc.select(
            (F.lit(len(items)) + F.row_number().over(
                Window.orderBy(F.desc("value"), F.asc(description)))).alias("item"),
            F.lit("descriptions").alias("section"), F.col(description).alias("metric"),
            F.col("value").cast("double").alias("value")))
    return out
