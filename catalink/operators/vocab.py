"""Controlled vocabularies: variant -> canonical mapping, membership filter
and the list of values left outside the vocabulary.

Mapping and vocabulary are tables, not code: ``(variant, canonical)`` and
``(value)``.  They are joined with a size-checked broadcast hint (a small
lookup table goes to every executor; a large one falls back to a shuffle
join).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalink.operators.joins import broadcast_if_small


def mapping_frame(spark: SparkSession, mapping: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame(sorted(mapping.items()), "variant string, canonical string")


def vocabulary_frame(spark: SparkSession, values: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(v,) for v in sorted(set(values))], "value string")


def apply_mapping(df: DataFrame, col: str, mapping: DataFrame, out: str | None = None) -> DataFrame:
    """Single-pass lookup: mapped value if the variant is known, else unchanged."""
    m = broadcast_if_small(mapping.select(F.col("variant").alias("_variant"),
                                          F.col("canonical").alias("_canonical")))
    joined = df.join(m, df[col] == m["_variant"], "left")
    return (joined.withColumn(out or col, F.coalesce(F.col("_canonical"), F.col(col)))
                  .drop("_variant", "_canonical"))


def vocab_filter(df: DataFrame, col: str, vocab: DataFrame | None) -> DataFrame:
    """Rows whose value is in the vocabulary; no vocabulary keeps every row."""
    if vocab is None:
        return df
    v = broadcast_if_small(vocab.select(F.col("value").alias("_value")))
    return df.join(v, df[col] == v["_value"], "left_semi")


def unmapped_values(df: DataFrame, col: str, vocab: DataFrame | None) -> DataFrame:
    """Distinct non-null values outside the vocabulary, sorted."""
    vals = df.select(F.col(col).alias("value")).where(F.col("value").isNotNull())
    if vocab is None:
        return vals.limit(0)
    v = broadcast_if_small(vocab.select("value"))
    return vals.join(v, "value", "left_anti").distinct().orderBy("value")
