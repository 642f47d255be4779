"""Top-1 TF-IDF retrieval against a brute-force pure-Python computation."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalink.functions.text import counted
from catalink.operators import matching as M
from catalink.operators import title_index as TI
from catalink.plans import standin as S
from tests.conftest import SF_SMALL
from tests.test_text import py_char_wb


def brute_top1(queries, candidates):
    """Exhaustive cosine over all (query, candidate) pairs."""
    n = len(candidates)
    tfs = {c: Counter(py_char_wb(c)) for c in candidates}
    df = Counter(g for c in candidates for g in tfs[c])
    idf = {g: math.log((1 + n) / (1 + k)) + 1 for g, k in df.items()}

    def vec(text):
        tf = Counter(g for g in py_char_wb(text) if g in idf)
        w = {g: t * idf[g] for g, t in tf.items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        return {g: v / norm for g, v in w.items()} if norm else {}

    cvecs = {c: vec(c) for c in candidates}
    best = {}
    for q in queries:
        qv = vec(q)
        scores = [(round(sum(v * cvecs[c].get(g, 0.0) for g, v in qv.items()), 9), c) for c in candidates]
        top = max(s for s, _ in scores)
        best[q] = (min(c for s, c in scores if s == top), top) if top > 0 else (None, 0.0)
    return best


def test_top1_equals_brute_force(spark):
    queries = [r[0] for r in S.match_queries(spark, SF_SMALL).select("name").distinct().collect()]
    queries += ["totally unrelated zzz", "RED GEAR", "gear red large"]
    cands = [r[0] for r in M.title_rollup(S.sales_rows(spark, SF_SMALL)).select("Name").collect()]
    qdf = spark.createDataFrame([(i, q) for i, q in enumerate(queries)], "app_id long, name string")
    cdf = spark.createDataFrame([(c,) for c in cands], "Name string")
    got = {r.name: (r.matched_sales_name, 1.0 - r.cosine_distance)
           for r in M.fuzzy_match(qdf, cdf).collect()}
    want = brute_top1(queries, cands)
    assert set(got) == set(queries)
    for q in queries:
        assert got[q][0] == want[q][0], q
        assert abs(got[q][1] - want[q][1]) < 1e-9, q


def test_salting_does_not_change_results(spark):
    q = S.match_queries(spark, SF_SMALL)
    roll = M.title_rollup(S.sales_rows(spark, SF_SMALL))
    plain = {tuple(r) for r in M.fuzzy_match(q, roll).select("app_id", "matched_sales_name").collect()}
    salted = {tuple(r) for r in M.fuzzy_match(q, roll, salt_rows=2)
              .select("app_id", "matched_sales_name").collect()}
    assert plain == salted


@pytest.mark.parametrize("salt_rows", [3, 5000])
def test_pruned_pairs_keep_the_best(spark, salt_rows):
    """Random titles over few syllables (many ties, hot n-grams on each side) equal brute force."""
    rnd = random.Random(17)
    title = lambda: " ".join(rnd.choice(["aba", "abab", "baa", "Cab", "bcab", "acca", "12", "123"])
                             for _ in range(rnd.randint(1, 5)))
    queries = sorted({"common " + title() for _ in range(60)} | {title() for _ in range(60)} | {"zz", "", "common"})
    cands = sorted({title() for _ in range(150)} | {"common " + title() for _ in range(3)})
    qdf = spark.createDataFrame(list(enumerate(queries)), "app_id long, name string")
    cdf = spark.createDataFrame([(c,) for c in cands], "Name string")
    got = {r.name: (r.matched_sales_name, 1.0 - r.cosine_distance) for r in M.fuzzy_match(qdf, cdf, salt_rows=salt_rows).collect()}
    want = brute_top1(queries, cands)
    assert set(got) == set(queries)
    for q in queries:
        assert got[q][0] == want[q][0] and abs(got[q][1] - want[q][1]) < 1e-9, q


def test_few_pairs_are_scored(spark, tmp_path):
    """Titles that share a word: far fewer pairs are scored than there are."""
    titles = spark.range(600).select(F.concat(F.lit("edition "), F.col("id").cast("string"), F.lit(" of "), (F.col("id") * 7919 % 6007).cast("string")).alias("t"))
    index = TI.build_index(titles, str(tmp_path / "index"), "t")
    q = TI.query_weights(titles, index, "t")
    seeds = q.where(F.col("place") <= M.SEEDS).select("_query", F.col("best").alias("_cand")).distinct()
    arrays = q.groupBy("_query").agg(F.collect_list(F.struct("gram", "weight")).alias("_qw"))
    bounds = TI.similarities(seeds, arrays, index).groupBy("_query").agg(F.max("_sim").alias("_bound"))
    assert TI.reaching_pairs(q, bounds, index).count() < 600 * 600 / 50


def test_pairs_below_the_nearest_candidate_are_not_scored(spark, monkeypatch):
    """One pair a query is scored first; of the others those that can be better, ties included."""
    met = spark.createDataFrame([("q", "a", 0.5, 0.3), ("q", "b", 0.6, 0.1), ("q", "c", 0.4, 0.2), ("q", "d", 0.6, 0.15), ("r", "a", 0.1, 0.1)],
                                "_query string, _cand string, _part double, _rest double")
    nearest = spark.createDataFrame([("q", "d", 0.7), ("r", "a", 0.2)], "_query string, _cand string, _sim double")
    assert sorted(tuple(r) for r in TI.nearer_pairs(met, nearest).collect()) == [("q", "a"), ("q", "b")]

    asked, scored = [], TI.similarities
    monkeypatch.setattr(TI, "similarities", lambda pairs, *a: asked.append(pairs.count()) or scored(pairs, *a))
    cands, queries = [f"edition {i * 7919 % 6007} of {i}" for i in range(300)], [f"{i * 7919 % 6007} of {i} x" for i in range(0, 300, 3)]
    got = _answers(spark, queries, spark.createDataFrame([(c,) for c in cands], "Name string"))
    assert {q: got[q][0] for q in queries} == {q: v[0] for q, v in brute_top1(queries, cands).items()}
    assert asked[1] == len(queries) and len(asked) == 3


def test_postings_are_narrow_and_shuffle_files_go(spark, tmp_path, monkeypatch):
    index = TI.build_index(spark.createDataFrame([("alpha 1",), ("beta 12",)], "Name string"), str(tmp_path / "index"))
    assert dict(index.table("postings").dtypes) == {"_cand": "string", "gram": "string", "_wc": "float", "_ac": "float", "part": "bigint"}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, during, top1 = spark.conf.get(name, None), [], TI.top1
    monkeypatch.setattr(TI, "top1", lambda *a: during.append(spark.conf.get(name, None)) or top1(*a))
    assert _answers(spark, ["alpha 12"], index)["alpha 12"][0] == "alpha 1"
    assert during == ["true"] and spark.conf.get(name, None) == before


def test_one_match_writes_by_titles_and_not_by_ngrams(spark, tmp_path):
    """Some rows a title are written; the queries that need more postings have them made (brute force)."""
    cands = [f"edition {i * 7919 % 6007} of {i}" for i in range(200)]
    queries = [f"{i * 7919 % 6007} of {i} x" for i in range(0, 200, 4)] + ["edit", "ition 59 editio", "of of 7", "zz"]
    folder = tmp_path / "index"
    index = TI.build_index(spark.createDataFrame([(c,) for c in cands], "Name string"), str(folder), whole=False)
    rows = {p: spark.read.parquet(str(p)).count() for p in [folder / "names", *(folder / "v1").iterdir()] if not p.name.startswith((".", "grams", "words"))}
    assert sum(rows.values()) < 16 * len(cands) and not (folder / "counts").exists() and not (folder / "v1" / "postings").exists()
    got, want = _answers(spark, queries, index), brute_top1(queries, cands)
    assert {q: v[0] for q, v in got.items()} == {q: v[0] for q, v in want.items()}
    assert all(abs(got[q][1] - want[q][1]) < 1e-8 for q in queries)


def test_a_whole_word_gives_a_near_bound(spark, tmp_path):
    """Keys share n-grams with very many others: only pairs near the title with the same key are met."""
    cands = spark.range(1000, 5000).select(F.concat(F.lit("large ring Brand "), F.col("id").cast("string")).alias("t"))
    index = TI.build_index(cands, str(tmp_path / "index"), "t", whole=False)
    rows = TI.query_arrays(cands.where("t like '%7'").select(F.regexp_replace("t", "Brand", "hot").alias("t")), index, "t")
    assert rows.count() == 400 and TI.seeds(rows, index).count() == 400
    arrays = TI.query_weights(rows.select(F.col("_query").alias("t")), index, "t").groupBy("_query").agg(F.collect_list(F.struct("gram", "weight")).alias("_qw"))
    near = TI.similarities(TI.seeds(rows, index), arrays, index)
    assert near.where("substring_index(_query, ' ', -1) = substring_index(_cand, ' ', -1) and _sim > 0.8").count() == 400


@pytest.mark.parametrize("seed", [6, 7])
def test_sketches_bound_similarities(spark, tmp_path, seed):
    cands, queries = _random_titles(seed, 60), _random_titles(seed + 10, 40)
    frame = lambda rows: spark.createDataFrame([(c,) for c in rows], "t string")
    index = TI.build_index(frame(cands), str(tmp_path / "index"), "t")
    rows = TI.query_arrays(frame(queries), index, "t")
    arrays = TI.query_weights(frame(queries), index, "t").groupBy("_query").agg(F.collect_list(F.struct("gram", "weight")).alias("_qw"))
    pairs = rows.select("_query", F.col("_s1").alias("_q1"), F.col("_s2").alias("_q2")).crossJoin(index.table("titles").select("_cand", "_s1", "_s2"))
    most = {(r[0], r[1]): r[2] for r in pairs.select("_query", "_cand", TI._within(("_q1", "_q2"), ("_s1", "_s2"))).collect()}
    found = TI.similarities(pairs.select("_query", "_cand"), arrays, index).collect()
    assert len(found) == len(most) > 1000 and all(r["_sim"] <= most[r["_query"], r["_cand"]] + 1e-9 for r in found)


def test_counted_values(spark):
    rows = spark.createDataFrame([(1, ["b", "a", "b", "b"]), (2, ["c", "a"]), (3, []), (4, ["x"] * 3)], "i int, v array<string>")
    got = {r.i: sorted(tuple(x) for x in r.c) for r in rows.select("i", counted("v").alias("c")).collect()}
    assert got == {1: [("a", 1), ("b", 3)], 2: [("a", 1), ("c", 1)], 3: [], 4: [("x", 3)]}


def _answers(spark, queries, candidates):
    qdf = spark.createDataFrame(list(enumerate(queries)), "app_id long, name string")
    return {r.name: (r.matched_sales_name, round(1.0 - r.cosine_distance, 9)) for r in M.fuzzy_match(qdf, candidates).collect()}


def _random_titles(seed, n):
    rnd = random.Random(seed)
    return sorted({" ".join(rnd.choice(["alpha", "Beta", "gam", "dell", "x1", "omega"]) + str(rnd.randint(0, 30)) for _ in range(rnd.randint(1, 4))) for _ in range(n)})


def test_an_opened_index_builds_nothing(spark, tmp_path, monkeypatch):
    cands, queries = _random_titles(1, 150), _random_titles(2, 80) + ["zz"]
    cdf = spark.createDataFrame([(c,) for c in [*cands, cands[0], None]], "Name string")
    TI.build_index(cdf, str(tmp_path / "index"), salt_rows=7)
    monkeypatch.setattr(TI, "_write_version", None)  # nothing may be built from here on
    opened = TI.open_index(spark, str(tmp_path / "index"))
    got, want = _answers(spark, queries, opened), brute_top1(queries, cands)
    assert {q: got[q][0] for q in queries} == {q: want[q][0] for q in queries}
    assert all(abs(got[q][1] - want[q][1]) < 1e-8 for q in queries)


def test_candidates_are_not_shuffled(spark, tmp_path):
    """The side of the bucketed tables goes into the joins as it is read."""
    cdf = spark.createDataFrame([(c,) for c in _random_titles(3, 100)], "Name string")
    index = TI.build_index(cdf, str(tmp_path / "index"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name, keys in (("postings", ["gram", "part"]), ("titles", ["_cand"])):
            left = index.table(name).select(*keys).withColumn("x", F.rand()).repartition(5).where("x >= 0")
            plan = left.join(index.table(name), keys)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1, plan  # the left's
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_extended_index_equals_one_built_at_once(spark, tmp_path):
    cands, queries = _random_titles(4, 160), _random_titles(5, 60)
    frame = lambda rows: spark.createDataFrame([(c,) for c in rows], "Name string")
    first = TI.build_index(frame(cands[:100]), str(tmp_path / "a"))
    second = TI.extend(first, frame(cands[90:] + [None]))  # ten are known
    whole = TI.build_index(frame(cands), str(tmp_path / "b"))
    assert (second.version, second.n_docs, whole.n_docs) == (2, len(cands), len(cands))
    assert _answers(spark, queries, second) == _answers(spark, queries, whole)
    assert TI.open_index(spark, str(tmp_path / "a")).version == 2
    old = _answers(spark, queries, TI.open_index(spark, str(tmp_path / "a"), version=1))  # still there
    assert {q: v[0] for q, v in old.items()} == {q: v[0] for q, v in brute_top1(queries, cands[:100]).items()}
    with pytest.raises(ValueError):
        TI.open_index(spark, str(tmp_path / "a"), version=3)


def test_index_without_titles(spark, tmp_path):
    index = TI.build_index(spark.createDataFrame([], "Name string"), str(tmp_path / "index"))
    assert _answers(spark, ["abc"], index) == {"abc": (None, 0.0)}
    grown = TI.extend(index, spark.createDataFrame([("abc",), ("abd",)], "Name string"))
    assert _answers(spark, ["abc"], grown) == {"abc": ("abc", 1.0)}


def test_rollup_sums_and_platforms(spark):
    rows = [("A", "PC", "1.5", 1.0, 0.0, 0.0, 2.5), ("A", "PS4", "N/A", 2.0, 1.0, 0.0, 3.0),
            ("B", None, "2", 0.0, 0.0, 0.0, 2.0)]
    df = spark.createDataFrame(rows, "Name string, Platform string, NA_Sales string, EU_Sales double, "
                                     "JP_Sales double, Other_Sales double, Global_Sales double")
    out = {r.Name: r for r in M.title_rollup(df).collect()}
    assert out["A"].NA_Sales == 1.5 and out["A"].EU_Sales == 3.0 and out["A"].vg_platform == "PC|PS4"
    assert out["B"].vg_platform == ""
    first_only = {r.Name: r for r in M.title_rollup(df.withColumn("_o", F.monotonically_increasing_id()),
                                                    pre_dedupe_order="_o").collect()}
    assert first_only["A"].EU_Sales == 1.0
