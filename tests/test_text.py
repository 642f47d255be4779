"""Character n-grams, LCS and token-sort ratio."""

import itertools
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalink.functions.text import char_wb_ngrams, indel_ratio, lcs_length, token_sort_ratio


def py_char_wb(text, n_min=3, n_max=5):
    """Plain-Python statement of the word-bounded n-gram analyzer's rule."""
    out = []
    for w in " ".join(text.lower().split()).split():
        p = " " + w + " "
        for n in range(n_min, min(n_max, len(p)) + 1):
            out += [p[i:i + n] for i in range(len(p) - n + 1)]
    return out


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def test_ngrams_match_rule(spark):
    titles = ["a", "ab", "Half  Life 2", "  blue anvil ECONOMY ", "x y z", "Über straße"]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = [r[0] for r in df.select(char_wb_ngrams("t")).collect()]
    assert got == [py_char_wb(t) for t in titles]
    assert got[0] == [" a "]                       # a one-letter word gives one 3-gram
    assert " ab " in got[1] and len(got[1]) == 3     # 2 trigrams + the padded word


def test_lcs_equals_dynamic_program(spark):
    rng = random.Random(3)
    sizes = [0, 1, 2, 5, 20, 61, 62, 63, 64, 123, 124, 125, 130, 200, 300]
    rows = [("".join(rng.choices(letters, k=n)), "".join(rng.choices(letters, k=m)))
            for letters in ("ab", "abcde xyz", "aé😀中 ") for n, m in itertools.product(sizes, repeat=2)]
    df = spark.createDataFrame(rows, "a string, b string").repartition(4)
    for r in df.select("a", "b", lcs_length("a", "b").alias("n")).collect():
        assert r.n == lcs_dp(r.a, r.b), (r.a, r.b)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(alphabet="abcde xyz", max_size=140), st.text(alphabet="abcde xyz", max_size=140)),
                min_size=1, max_size=10))
def test_lcs_of_any_texts(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(lcs_length("a", "b")).collect()] == [lcs_dp(a, b) for a, b in rows]


def test_indel_ratio_cases(spark):
    rows = [("", ""), ("2 Half Life", "2 Episode Half-Life"), (None, "a"), ("a", None), ("", "a")]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(indel_ratio("a", "b")).collect()]
    assert got[0] == 100.0 and abs(got[1] - 66.6666666) < 1e-5
    assert got[2] is None and got[3] is None and got[4] == 0.0


def test_token_sort_ratio_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("a b", "b a")], "a string, b string").select(token_sort_ratio("a", "b"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_token_sort_ratio(spark):
    pairs = [("b a", "a b"), ("GOTY", "goty"), ("Half Life 2", "Half-Life 2 Episode"), ("", "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(token_sort_ratio("a", "b")).collect()]
    assert got[0] == 100.0 and got[1] == 0.0 and abs(got[2] - 66.6667) < 1e-3 and got[3] == 100.0
    folded = df.select(token_sort_ratio("a", "b", casefold=True)).collect()
    assert folded[1][0] == 100.0


def test_token_sort_symmetric_bounded_permutation(spark):
    rng = random.Random(7)
    words = ["red", "gear", "hot", "rod", "x", "long-word"]
    rows = []
    for _ in range(60):
        a = " ".join(rng.sample(words, rng.randint(1, 4)))
        b = " ".join(rng.sample(words, rng.randint(1, 4)))
        perm = " ".join(rng.sample(a.split(), len(a.split())))
        rows.append((a, b, perm))
    df = spark.createDataFrame(rows, "a string, b string, p string")
    out = df.select(token_sort_ratio("a", "b").alias("ab"), token_sort_ratio("b", "a").alias("ba"),
                    token_sort_ratio("a", "p").alias("ap")).collect()
    for r in out:
        assert r.ab == r.ba and 0 <= r.ab <= 100 and r.ap == 100.0
