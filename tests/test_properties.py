"""Algebraic checks on the stand-in data."""

import pytest
from pyspark.sql import functions as F

from catalink import config as C
from catalink.operators import aggregates as A
from catalink.operators import dedupe as D
from catalink.operators import histogram as H
from catalink.operators import ranks as R
from catalink.operators import vocab as V
from catalink.plans import standin as S
from catalink.plans.common import core
from tests.conftest import SF_CHECK, SF_SMALL


def test_quadrant_shares_sum_to_100(spark):
    out = A.label_counts(core(spark, SF_SMALL), "quadrant", C.QUADRANTS).collect()
    assert sum(r.pct for r in out) == pytest.approx(100.0)
    assert [r.quadrant for r in out] == list(C.QUADRANTS)


def test_histogram_counts_sum_to_n(spark):
    li = S.read(spark, SF_SMALL, "lineitem")
    h = H.histogram(li, "l_quantity", 17).collect()
    assert len(h) == 17 and sum(r["count"] for r in h) == li.count()


def test_keep_first_idempotent_and_first(spark):
    ev = S.read(spark, SF_SMALL, "events")
    once = D.keep_first(ev, ["user_id", "event_type"], ["event_id"])
    twice = D.keep_first(once, ["user_id", "event_type"], ["event_id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    firsts = ev.groupBy("user_id", "event_type").agg(F.min("event_id").alias("e"))
    assert once.join(firsts, (once.event_id == firsts.e)).count() == once.count()


def test_keep_first_null_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 4)], "k long, o long")
    assert sorted(tuple(r) for r in D.keep_first(df, ["k"], ["o"]).collect()) == [(1, 1)]
    kept = {tuple(r) for r in D.keep_first(df, ["k"], ["o"], drop_null_key=False).collect()}
    assert kept == {(None, 3), (1, 1)}


def test_mapping_idempotent(spark):
    m = V.mapping_frame(spark, {"en": "English", "fr": "French"})
    docs = S.read(spark, SF_SMALL, "documents").select("doc_id", "lang")
    once = V.apply_mapping(docs, "lang", m)
    twice = V.apply_mapping(once, "lang", m)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_spearman_invariant_under_monotone_map(spark):
    c = core(spark, SF_CHECK).select("player_ratio_100", "critic_norm") \
        .withColumn("cube", F.pow("player_ratio_100", 3))
    out = R.spearman_frame(c, [("player_ratio_100", "critic_norm"), ("cube", "critic_norm")]).collect()
    assert out[0].spearman == pytest.approx(out[1].spearman, abs=1e-12)


def test_spearman_ties_equals_pearson_of_average_ranks(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (2.0, 3.0), (3.0, 1.0), (3.0, 5.0)], "x double, y double")
    got = R.spearman_frame(df, [("x", "y")]).collect()[0].spearman
    rx, ry = [1.5, 1.5, 3, 4.5, 4.5], [2, 3.5, 3.5, 1, 5]
    mx, my = sum(rx) / 5, sum(ry) / 5
    cov = sum((a - mx) * (b - my) for a, b in zip(rx, ry))
    want = cov / (sum((a - mx) ** 2 for a in rx) ** 0.5 * sum((b - my) ** 2 for b in ry) ** 0.5)
    assert got == pytest.approx(want)


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert A.pearson(df, [("x", "y")]).collect()[0].pearson is None
    assert R.spearman_frame(df, [("x", "y")]).collect()[0].spearman is None


def test_year_trend_single_row_sem_null(spark):
    df = spark.createDataFrame([(2001, 1.0), (2002, 1.0), (2002, 3.0)], "y int, m double")
    out = {r.y: r for r in A.year_trend(df, "y", "m", min_n=1).collect()}
    assert out[2001].sem is None and out[2002].sem == pytest.approx(1.0)


def test_histogram_counts_by_its_edges(spark):
    """Values on, just below and just above every reported edge, against numpy's counts by
    those edges."""
    import numpy as np

    from catalink.operators.histogram import histogram
    for lo, hi, bins in ((0.0, 0.7, 7), (0.1, 1.3, 12), (-3.0, 5.0, 9), (1995.0, 2001.0, 7)):
        width = (hi - lo) / bins
        edges = [lo + i * width for i in range(bins + 1)]
        values = [x for e in edges for x in (e, np.nextafter(e, -9), np.nextafter(e, 9e9)) if lo <= x <= hi] + [lo, hi]
        rows = histogram(spark.createDataFrame([(float(x),) for x in values], "x double"), "x", bins).collect()
        assert [r.lo for r in rows] == edges[:-1]
        want = [sum(1 for x in values if x >= edges[i] and (x < edges[i + 1] or i == bins - 1)) for i in range(bins)]
        assert [r["count"] for r in rows] == want
        assert want[:-1] == np.histogram(values, edges[:-1] + [max(hi, edges[-1])])[0].tolist()[:-1]
