"""Ranks over many ranges; distinct counts, sorted tables and footers at scale."""

import random

from catalink.operators.ranks import average_rank, spearman_frame


def test_ranks_do_not_depend_on_ranges(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(i, float(rng.randint(0, 400)) if i % 9 else None) for i in range(4000)], "k long, v double")
    one = {r.k: r.r for r in average_rank(df, "v", "r").collect()}
    many = {r.k: r.r for r in average_rank(df, "v", "r", ranges=37).collect()}
    assert one == many and len(one) == 4000


def test_spearman_of_many_pairs_equals_pandas(spark):
    import pandas as pd

    rng = random.Random(8)
    rows = [(7.0 if rng.random() < .5 else rng.gauss(0, 1), float(rng.randint(0, 5)) if rng.random() < .9 else None,
             rng.random() if rng.random() < .8 else None, None) for _ in range(3000)]
    names = ["a", "b", "c", "none"]
    pairs = [(x, y) for x in names for y in names]
    want = pd.DataFrame(rows, columns=names, dtype="float64")
    df = spark.createDataFrame(rows, "a double, b double, c double, none double")
    for ranges in (None, 23):
        got = {(r.x, r.y): r.spearman for r in spearman_frame(df, pairs, ranges).collect()}
        assert set(got) == set(pairs)
        for x, y in pairs:
            both = want[[x]].assign(other=want[y]).dropna()
            if both.empty:
                assert got[x, y] is None
            else:
                r = both.rank()
                assert abs(got[x, y] - r[x].corr(r["other"])) < 1e-12


def test_spearman_without_rows(spark):
    df = spark.createDataFrame([], "x double, y double")
    assert [tuple(r) for r in spearman_frame(df, [("x", "y")]).collect()] == [("x", "y", None)]


def test_long_report_counts_without_expand(spark):
    from catalink.operators.quality import long_table_report

    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "a", "b", "é", "", "中"])) for _ in range(400)]
    raw = spark.createDataFrame(rows, "k long, v string")
    clean = raw.where("v is not null and v <> ''").distinct()
    report = long_table_report(raw, clean, "k", "v", 3, None)
    assert "Expand" not in report._jdf.queryExecution().executedPlan().toString()
    got = {(r.section, r.metric): r.value for r in report.collect()}
    per_key = [sum(1 for a, b in rows if a == k and b is not None) for k in {a for a, _ in rows} - {None}]
    kept = {(a, b) for a, b in rows if b}
    assert got["raw", "total_rows"] == 400 and got["raw", "unique_keys"] == len(per_key)
    assert got["raw", "missing_values"] == sum(b is None for _, b in rows)
    assert got["raw", "duplicate_pairs"] == 400 - len(set(rows)) == got["raw", "duplicate_rows"]
    assert got["per_key", "max"] == max(per_key) and got["per_key", "min"] == min(per_key)
    assert abs(got["per_key", "mean"] - sum(per_key) / len(per_key)) < 1e-9
    assert got["language", "raw_distinct"] == 5 and got["language", "non_ascii_values"] == 2
    assert got["language", "clean_distinct"] == len({v for _, v in kept}) and got["cleaning", "rows_after"] == len(kept)
    empty = long_table_report(raw.limit(0), clean.limit(0), "k", "v", None, None)
    got = {(r.section, r.metric): r.value for r in empty.collect()}
    assert got["raw", "total_rows"] == 0 and got["raw", "unique_keys"] == 0 and got["per_key", "mean"] is None


def test_shapes_and_extremes_come_from_footers(spark, tmp_path):
    from catalink.sources import sinks as K

    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "if(id % 3 = 0, null, id / 4.0D) AS x", "cast(null AS double) AS none").repartition(5).write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    shapes = K.file_shapes(spark, {"t": path})
    extremes = K.column_extremes(spark, path, ["id", "x"])
    for df, wanted in ((shapes, "PushedAggregation: [COUNT(*)]"), (extremes, "MIN(id), MAX(id), MIN(x), MAX(x)")):
        assert wanted in df._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in shapes.collect()] == [("t", 1000, 3)]
    assert [tuple(r) for r in extremes.collect()] == [("id", 1000, 0.0, 999.0), ("x", 1000, 0.25, 249.5)]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_sorted_table_keeps_its_order(spark, tmp_path):
    from catalink.sources import sinks as K

    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 3]), i) for i in range(2000)]
    path = str(tmp_path / "sorted")
    K.write_sorted(spark.createDataFrame(rows, "a int, b int").repartition(7), path, [("a", True), ("b", False)])
    got = sorted((r.position, r.a, r.b) for r in K.read_sorted(spark, path).collect())
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert got == [(i + 1, a, b) for i, (a, b) in enumerate(want)]
