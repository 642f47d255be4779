"""Column expressions against the micro-fixtures (reference doctests and our
additions for behaviour it does not test)."""

import math

import pytest
from pyspark.sql import functions as F

from catalink import config as C
from catalink.functions import expressions as X


def col_values(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("v")).alias("o")).collect()]


def test_cents_to_price(spark):
    assert col_values(spark, ["999", "0", "N", "1499"], X.cents_to_price) == [9.99, 0.0, None, 14.99]


def test_missing_tokens(spark):
    assert col_values(spark, ["N", "\\N", "", "123", " nan ", None], X.missing_to_null) == \
        [None, None, None, "123", None, None]


def test_nullable_integer(spark):
    assert col_values(spark, ["1", "N", " 3 "], X.nullable_long) == [1, None, 3]


def test_safe_numbers(spark):
    assert col_values(spark, ["12d", "1e3", "1,000", "5."], X.safe_double) == [None, 1000.0, None, 5.0]
    assert col_values(spark, ["9.5", "1e3", "3.0", "x"], X.safe_long) == [None, 1000, 3, None]


def test_normalize_whitespace(spark):
    nb = "\u00a0"
    out = col_values(spark, [f"Remote{nb}Play{nb}Together", "Single-player", f"\u3000{nb}x {nb}"],
                     X.normalize_whitespace)
    assert out == ["Remote Play Together", "Single-player", "x"]


def test_strip_matches_python(spark):
    samples = [" a b ", "\x1c\x85z\x0b", "plain", " "]
    assert col_values(spark, samples, X.strip) == [s.strip() for s in samples]


def test_owners_bounds(spark):
    df = spark.createDataFrame([("500,000 .. 1,000,000",), ("0 .. 20,000",), (None,)], "r string")
    rows = df.select(X.owners_bounds("r").alias("b")).select("b.*").collect()
    assert [tuple(r) for r in rows] == [(500000, 1000000, 750000), (0, 20000, 10000), (0, 0, 0)]


def test_price_fill_and_label(spark):
    df = spark.createDataFrame([(1, None), (0, None), (0, 5.0)], "is_free long, price double")
    out = df.select(X.fill_free_price("price", "is_free").alias("p")) \
            .withColumn("unknown", F.col("p").isNull()).collect()
    assert [(r.p, r.unknown) for r in out] == [(0.0, False), (None, True), (5.0, False)]
    labels = df.withColumn("p", X.fill_free_price("price", "is_free")) \
               .select(X.monetization_label("is_free", F.col("p").isNull())).collect()
    assert [r[0] for r in labels] == ["Free to Play", "Price Unknown", "Paid"]


def test_quadrant(spark):
    df = spark.createDataFrame([(0.80, 75.0), (0.80, 74.0), (0.79, 75.0), (None, 74.0)], "p double, c double")
    out = [r[0] for r in df.select(X.quadrant("p", "c", 0.80, 75)).collect()]
    assert out == list(C.QUADRANTS)


def test_score_bucket(spark):
    out = col_values(spark, [95.0, 94.7, 89.9, 83.0, 82.9, 10.0], X.score_bucket, "v double")
    assert out == ["95-100", "90-94", "85-89", "83-84", "70-82 (below threshold)", "<70 (below threshold)"]


def test_critic_price_volume_labels(spark):
    assert col_values(spark, [0.0, 49.0, 49.5, 74.0, 89.0, 100.0], X.critic_label, "v double") == \
        ["0-49 (bad)", "0-49 (bad)", "50-74 (mid)", "50-74 (mid)", "75-89 (good)", "90-100 (masterpiece)"]
    assert col_values(spark, [0.0, 0.5, 5.0, 5.01, 60.0, 61.0, None], X.price_bucket, "v double") == \
        ["0 (free)", "(0, 5]", "(0, 5]", "(5, 15]", "(30, 60]", "60+", None]
    assert col_values(spark, [10.0, 49.0, 50.0, 100000.0, 9.0], X.volume_bucket, "v double") == \
        ["10-49", "10-49", "50-199", "100k+", None]


def test_edition_flags(spark):
    df = spark.createDataFrame([("Game HD", "Game"), ("Shade", "Shade"), ("GOTY Edition", "goty edition"),
                                ("Hidden", "Hide")], "a string, b string")
    out = df.select(X.edition_mismatch("a", "b").alias("sub"), X.keyword_on_one_side("a", "b").alias("word")) \
            .collect()
    # substring test, one keyword at a time
    assert [r.sub for r in out] == [True, False, False, False]
    # whole word, case-insensitive: "GOTY" matches both sides -> no flag; "Hidden" has no whole word HD
    assert [r.word for r in out] == [True, False, False, False]


def test_width_bin(spark):
    out = col_values(spark, [0.0, 5.0, 5.1, 100.0, 101.0], lambda c: X.width_bin(c, 0, 100, 5), "v double")
    assert out == [1, 1, 2, 20, None]


def test_safe_log10(spark):
    out = col_values(spark, [100.0, 0.0, -1.0], X.safe_log10, "v double")
    assert out[0] == pytest.approx(2.0) and out[1] is None and out[2] is None
    assert not any(isinstance(v, float) and math.isnan(v) for v in out if v is not None)


def test_presented_rounds_halves_to_even(spark):
    from catalink.functions.expressions import presented
    values = [0.25, 0.35, 2.5, 3.5, -0.25, 66.66, None]
    rows = spark.createDataFrame([(x,) for x in values], "x double").select(presented("x").alias("one"), presented("x", 0).alias("none")).collect()
    assert [r.one for r in rows] == [0.2, 0.4, 2.5, 3.5, -0.2, 66.7, None]
    assert [r.none for r in rows] == [0, 0, 2, 4, 0, 67, None]
