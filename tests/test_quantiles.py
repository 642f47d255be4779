"""Exact percentiles with bounded memory against Spark's in-memory percentile."""

import random

import pytest
from pyspark.sql import functions as F

from catalink.operators import quantiles
from catalink.operators.quantiles import exact_percentile_columns, exact_percentiles


@pytest.mark.parametrize("few", [quantiles.BROADCAST_GROUPS, 0])
def test_percentiles_equal_spark(spark, few, monkeypatch):
    monkeypatch.setattr(quantiles, "BROADCAST_GROUPS", few)
    rng = random.Random(11)
    rows = [(rng.choice(["a", "b"]) if i % 40 else None, float(rng.randint(0, 300)) if i % 5 else rng.random())
            for i in range(30000)]
    rows += [("hot", float(v % 9000) + 0.5) for v in range(40000)]   # ties and many distinct values
    rows += [("tiny", 3.0)] + [("odd", x) for x in (-0.0, 0.0, 5e-324, -5e-324, 1e308, -1e308, 2.0 ** -1022, 1.5, -1.5, 0.1, 1e-300)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.g, r.prob_index): r.value for r in exact_percentiles(df, "v", probs, ["g"]).collect()}
    want = {}
    for r in df.where("g is not null").groupBy("g").agg(
            F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect():
        for i, x in enumerate(r.q):
            want[(r.g, i)] = x
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-12, abs=1e-12), k


def test_global_median_and_empty(spark):
    df = spark.createDataFrame([(x,) for x in [5.0, 1.0, 3.0, None, 2.0]], "v double")
    assert exact_percentile_columns(df, "v", [0.5], ["m"]).collect()[0].m == 2.5
    assert exact_percentiles(df.where("v > 100"), "v", [0.5]).count() == 0


def test_order_bits_are_the_ieee_bits(spark):
    import struct
    rng = random.Random(4)
    values = [struct.unpack(">d", struct.pack(">Q", rng.getrandbits(64)))[0] for _ in range(5000)]
    values = [x for x in values if x == x] + [0.0, 1.0, 2.0, 0.5, 5e-324, 2.0 ** -1022, 1.7976931348623157e308, float("inf"), 3.0, 1 - 2 ** -53, 1 + 2 ** -52]
    got = spark.createDataFrame([(x,) for x in values], "x double").select("x", quantiles.order_bits(F.col("x")).alias("k")).collect()
    for r in got:
        bits = struct.unpack(">Q", struct.pack(">d", abs(r.x)))[0]
        assert r.k == (-bits if r.x < 0 else bits), r.x
