"""Matching queries: titles ``p_name || ' ' || p_type`` (one per part) linked
to the per-title rollup of line items by ``p_name``.

Stand-in thresholds: on these titles token-sort scores fall between about 25
and 80, so the fixed 83 would accept nothing; the queries use 70 (sweep 70,
74, 77, 80; low-score flag below 74; low-pass list below 75).  The library
defaults remain the fixed values in ``catalink.config``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from catalink import config as C
from catalink.functions import expressions as X
from catalink.operators import matching as M
from catalink.operators.aggregates import quantiles
from catalink.plans import sqlfrag as Q
from catalink.plans import standin as S
from catalink.plans.common import shared, shared_get
from catalink.session import cut_lineage
from catalink.plans.registry import query, r6

THRESHOLD = 70
SWEEP = (70, 74, 77, 80)
LOW_FLAG = 74
LOW_PASS_BELOW = 75


# --- Spark pipeline -------------------------------------------------------------

def build_rollup(spark, d):
    return M.title_rollup(S.sales_rows(spark, d))


def rollup(spark, d):
    """Per-title sales rollup, written once: the matcher and the sales join both read it."""
    cached = shared_get("rollup", d)
    return cached if cached is not None else cut_lineage(build_rollup(spark, d), "rollup")


def build_scored(spark, d, roll=None):
    return M.fuzzy_match(S.match_queries(spark, d), roll if roll is not None else rollup(spark, d))


def scored(spark, d, roll=None):
    cached = shared_get("scored", d)
    return cached if cached is not None else build_scored(spark, d, roll)


@contextmanager
def one_match(spark, d):
    """Within the block, all queries share one rollup and one match."""
    with shared(spark, d, "rollup", build_rollup), shared(spark, d, "scored", build_scored, written=True):
        yield


def build_matched(spark, d):
    roll = rollup(spark, d)  # one rollup feeds both the matcher and the sales join
    return M.matched_table(scored(spark, d, roll), roll, THRESHOLD)


def matched(spark, d):
    cached = shared_get("matched", d)
    return cached if cached is not None else build_matched(spark, d)


def flagged(spark, d):
    return M.flag_matches(matched(spark, d), LOW_FLAG)


# --- SQL twin -------------------------------------------------------------------

_BL = r"[\s\p{Z}]+"
_EDGE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"
_NUM = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"


def _safe_double_sql(x: str) -> str:
    return Q.safe_double(x)


def _words_sql(x: str) -> str:
    return (f"list_filter(string_split_regex({Q.strip(x)}, '{_BL}'), "
            f"lambda w: length(w) > 0)")


def _sort_key_sql(x: str) -> str:
    return f"array_to_string(list_sort({_words_sql(x)}), ' ')"


def token_sort_sql(a: str, b: str) -> str:
    """Token-sort ratio in DuckDB: LCS by a list fold over the DP row."""
    ka, kb = _sort_key_sql(a), _sort_key_sql(b)
    lcs = (f"list_reduce(str_split({ka}, ''), lambda row_, ca: list_concat([0], "
           f"list_transform(range(1, length({kb}) + 1), lambda j: list_max(list_transform(range(1, j + 1), "
           f"lambda k: CASE WHEN ca = str_split({kb}, '')[k] THEN row_[k] + 1 ELSE row_[k + 1] END)))), "
           f"list_transform(range(0, length({kb}) + 1), lambda z: 0))[length({kb}) + 1]")
    return (f"CASE WHEN length({ka}) + length({kb}) = 0 THEN 100.0 "
            f"ELSE 200.0 * ({lcs}) / (length({ka}) + length({kb})) END")


def _grams_sql(name: str, src: str, id_col: str) -> str:
    return f"""{name}_w AS (SELECT {id_col} AS id, unnest({_words_sql(f"lower({id_col})")}) AS w FROM {src}),
{name}_p AS (SELECT id, ' ' || w || ' ' AS p FROM {name}_w),
{name}_n AS (SELECT id, p, unnest(range(3, least(5, length(p)) + 1)) AS n FROM {name}_p),
{name}_g AS (SELECT id, substr(p, i, n) AS gram FROM
             (SELECT id, p, n, unnest(range(1, length(p) - n + 2)) AS i FROM {name}_n) t),
{name}_tf AS (SELECT id, gram, COUNT(*) AS tf FROM {name}_g GROUP BY id, gram)"""


_ROLLUP_SQL = f"""vg_rollup AS (
  SELECT Name, {", ".join(f"SUM(COALESCE({_safe_double_sql(m)}, 0.0)) AS {m}" if m == "NA_Sales"
                          else f"SUM(COALESCE(CAST({m} AS DOUBLE), 0.0)) AS {m}" for m in C.SALES_COLUMNS)},
         array_to_string(list_sort(list_distinct(list(Platform))), '|') AS vg_platform
  FROM sales_rows WHERE Name IS NOT NULL GROUP BY Name
)"""

_MATCH_CTES = [S.SALES_SQL, _ROLLUP_SQL, S.MATCH_QUERIES_SQL, f"""mq AS (
  SELECT MIN(app_id) AS app_id, name FROM match_queries WHERE name IS NOT NULL GROUP BY name
)""", "cands AS (SELECT Name AS title FROM vg_rollup WHERE Name IS NOT NULL)",
    "qtitles AS (SELECT DISTINCT name AS title FROM mq)",
    _grams_sql("c", "cands", "title"), _grams_sql("q", "qtitles", "title"), """idf AS (
  SELECT gram, COUNT(*) AS df,
         ln((1.0 + CAST((SELECT COUNT(*) FROM cands) AS DOUBLE)) / (1.0 + CAST(COUNT(*) AS DOUBLE))) + 1.0 AS idf
  FROM c_tf GROUP BY gram
)""", """cw AS (
  SELECT t.id, t.gram, t.tf * i.idf / sqrt(SUM(t.tf * i.idf * t.tf * i.idf) OVER (PARTITION BY t.id)) AS weight
  FROM c_tf t JOIN idf i ON t.gram = i.gram
)""", """qw AS (
  SELECT t.id, t.gram, t.tf * i.idf / sqrt(SUM(t.tf * i.idf * t.tf * i.idf) OVER (PARTITION BY t.id)) AS weight
  FROM q_tf t JOIN idf i ON t.gram = i.gram
)""", """dots AS (
  SELECT q.id AS qid, c.id AS cid, round(SUM(q.weight * c.weight), 9) AS sim
  FROM qw q JOIN cw c ON q.gram = c.gram GROUP BY q.id, c.id
)""", """best AS (
  SELECT qid, cid, sim FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY qid ORDER BY sim DESC, cid) AS rn FROM dots) t
  WHERE rn = 1
)""", f"""scored AS (
  SELECT mq.app_id, mq.name, b.cid AS matched_sales_name, 1.0 - COALESCE(b.sim, 0.0) AS cosine_distance,
         CASE WHEN b.cid IS NULL THEN 0.0 ELSE {token_sort_sql("mq.name", "b.cid")} END AS vg_match_score
  FROM mq LEFT JOIN best b ON mq.name = b.qid
)""", f"""matched AS (
  SELECT s.app_id, s.name, s.vg_match_score, r.Name AS vg_name, r.NA_Sales AS vg_na_sales,
         r.EU_Sales AS vg_eu_sales, r.JP_Sales AS vg_jp_sales, r.Other_Sales AS vg_other_sales,
         r.Global_Sales AS vg_global_sales, r.vg_platform
  FROM scored s LEFT JOIN vg_rollup r ON s.matched_sales_name = r.Name
  WHERE s.vg_match_score >= {THRESHOLD}
)""", f"""flagged AS (
  SELECT *, ({" OR ".join(f"(contains(lower(COALESCE(name, '')), '{k}') <> contains(lower(COALESCE(vg_name, '')), '{k}'))"
                           for k in C.VERSION_KEYWORDS)}) AS flag_version_mismatch,
         COALESCE(vg_match_score < {LOW_FLAG}, false) AS flag_low_score
  FROM matched
)"""]

MATCH_WITH = S.with_ctes(*_MATCH_CTES)


# --- queries ------------------------------------------------------------------------

_ROLL_COLS = list(C.SALES_COLUMNS)


@query("title_rollup", MATCH_WITH + f"""
SELECT Name, {", ".join(f"ROUND({m}, 6) AS {m}" for m in _ROLL_COLS)}, vg_platform FROM vg_rollup""")
def title_rollup(spark, d):
    return rollup(spark, d).select("Name", *[r6(m) for m in _ROLL_COLS], "vg_platform")


@query("char_ngrams", S.with_ctes(S.MATCH_QUERIES_SQL, "titles AS (SELECT DISTINCT name AS title FROM match_queries)",
                                  _grams_sql("q", "titles", "title")) + """
SELECT id AS title, gram, tf FROM q_tf""")
def char_ngrams(spark, d):
    titles = S.match_queries(spark, d).select(F.col("name").alias("title")).distinct()
    return M.ngram_counts(titles, "title", "title").select("title", "gram", "tf")


@query("tfidf_weights", MATCH_WITH + """
SELECT id AS title, gram, ROUND(weight, 6) AS weight FROM cw""")
def tfidf_weights(spark, d):
    cands = rollup(spark, d).select(F.col("Name").alias("title"))
    counts = M.ngram_counts(cands, "title", "title")
    idf = M.idf_table(counts, cands.agg(F.count(F.lit(1))).scalar())
    return M.tfidf_weights(counts, idf, "title").select("title", "gram", r6("weight"))


@query("top1_cosine", MATCH_WITH + """
SELECT app_id, name, matched_sales_name, ROUND(cosine_distance, 6) AS cosine_distance FROM scored""")
def top1_cosine(spark, d):
    return scored(spark, d).select("app_id", "name", "matched_sales_name", r6("cosine_distance"))


#: Thousands of titles on both sides: parts with their type and key, sold parts with brand and key.
_KEYED_CTES = S.with_ctes("""mq AS (
  SELECT p_partkey AS app_id, p_name || ' ' || p_type || ' ' || p_partkey AS name FROM part
)""", """cands AS (
  SELECT DISTINCT p_name || ' ' || p_brand || ' ' || l_partkey AS title FROM lineitem JOIN part ON l_partkey = p_partkey
)""", *_MATCH_CTES[5:13])


@query("top1_keyed_titles", _KEYED_CTES + """
SELECT mq.app_id, mq.name, b.cid AS matched_sales_name, ROUND(1.0 - COALESCE(b.sim, 0.0), 6) AS cosine_distance
FROM mq LEFT JOIN best b ON mq.name = b.qid""")
def top1_keyed_titles(spark, d):
    part = S.read(spark, d, "part")
    titles = part.select(F.col("p_partkey").alias("app_id"), F.concat_ws(" ", "p_name", "p_type", "p_partkey").alias("name"))
    sold = S.read(spark, d, "lineitem").select("l_partkey").distinct()
    names = (sold.join(part, F.col("l_partkey") == F.col("p_partkey"))
             .select(F.concat_ws(" ", "p_name", "p_brand", "l_partkey").alias("Name")).distinct())
    return M.fuzzy_match(titles, names).select("app_id", "name", "matched_sales_name", r6("cosine_distance"))


@query("token_sort_ratio", MATCH_WITH + """
SELECT app_id, name, matched_sales_name, ROUND(vg_match_score, 6) AS vg_match_score FROM scored""")
def token_sort_ratio_q(spark, d):
    return scored(spark, d).select("app_id", "name", "matched_sales_name", r6("vg_match_score"))


_MATCHED_COLS = ["app_id", "name", "vg_name", "vg_platform"]
_MATCHED_NUM = ["vg_match_score", "vg_na_sales", "vg_eu_sales", "vg_jp_sales", "vg_other_sales",
                "vg_global_sales"]


@query("matched_table", MATCH_WITH + f"""
SELECT {", ".join(_MATCHED_COLS)}, {", ".join(f"ROUND({c}, 6) AS {c}" for c in _MATCHED_NUM)} FROM matched""")
def matched_table(spark, d):
    return matched(spark, d).select(*_MATCHED_COLS, *[r6(c) for c in _MATCHED_NUM])


@query("edition_mismatch", MATCH_WITH + """
SELECT app_id, name, vg_name, flag_version_mismatch, flag_low_score,
       flag_version_mismatch OR flag_low_score AS flag_any FROM flagged""")
def edition_mismatch(spark, d):
    return flagged(spark, d).select("app_id", "name", "vg_name", "flag_version_mismatch",
                                    "flag_low_score", "flag_any")


#: The stand-in's edition words: part types, which only the query's titles carry.
EDITION_WORDS = ("Promo", "Standard", "Economy")
_KW_RE = X.keyword_regex(EDITION_WORDS)


@query("edition_mismatch_words", MATCH_WITH + f"""
SELECT app_id, name, vg_name, ROUND(vg_match_score, 6) AS vg_match_score FROM matched
WHERE COALESCE(regexp_matches(name, '{_KW_RE}'), false) <> COALESCE(regexp_matches(vg_name, '{_KW_RE}'), false)
ORDER BY vg_match_score DESC, name, app_id LIMIT 15""")
def edition_mismatch_words(spark, d):
    return M.keyword_mismatches(matched(spark, d), keywords=EDITION_WORDS).select("app_id", "name", "vg_name",
                                                          r6("vg_match_score"))


@query("threshold_sweep", MATCH_WITH + " UNION ALL ".join(
    f"SELECT {t} AS threshold, COUNT(CASE WHEN vg_match_score >= {t} THEN 1 END) AS matches FROM matched"
    for t in SWEEP))
def threshold_sweep(spark, d):
    return M.threshold_sweep(matched(spark, d), SWEEP)


@query("match_multi_hits", MATCH_WITH + """
SELECT vg_name, hits, sample FROM (
  SELECT vg_name, COUNT(*) AS hits,
         array_to_string(list_slice(list(name ORDER BY vg_match_score DESC, name, app_id), 1, 5), '; ') AS sample
  FROM matched GROUP BY vg_name HAVING COUNT(*) > 1) t
ORDER BY hits DESC, vg_name LIMIT 15""")
def match_multi_hits(spark, d):
    return M.multi_hits(matched(spark, d))


@query("length_gap", MATCH_WITH + """
SELECT app_id, name, vg_name, ROUND(vg_match_score, 6) AS vg_match_score,
       CAST(abs(length(name) - length(vg_name)) AS BIGINT) AS len_diff
FROM matched ORDER BY len_diff DESC, app_id LIMIT 10""")
def length_gap(spark, d):
    return M.length_gaps(matched(spark, d)).select("app_id", "name", "vg_name", r6("vg_match_score"),
                                                   "len_diff")


@query("score_quantiles", MATCH_WITH + """
SELECT CAST(prob AS DOUBLE) AS prob, ROUND(value, 6) AS value FROM (
  SELECT 0.25 AS prob, quantile_cont(vg_match_score, 0.25) AS value FROM scored
  UNION ALL SELECT 0.5, quantile_cont(vg_match_score, 0.5) FROM scored
  UNION ALL SELECT 0.75, quantile_cont(vg_match_score, 0.75) FROM scored) t""")
def score_quantiles(spark, d):
    return quantiles(scored(spark, d), "vg_match_score", (0.25, 0.5, 0.75)).select(
        "prob", r6("value"))


def _bucket_case_sql(x: str) -> str:
    parts = " ".join(f"WHEN {x} >= {f} THEN '{lbl}'" for f, lbl in C.SCORE_BUCKETS)
    return f"CASE {parts} WHEN {x} IS NOT NULL THEN '{C.SCORE_BUCKET_FLOOR}' END"


_BUCKETS = [b for _, b in C.SCORE_BUCKETS] + [C.SCORE_BUCKET_FLOOR]
_SUMMARY_ITEMS = (
    [("coverage", "input_rows", "(SELECT COUNT(*) FROM mq)"),
     ("coverage", "candidates", "(SELECT COUNT(*) FROM vg_rollup)"),
     ("coverage", "matched_rows", "(SELECT COUNT(*) FROM matched)"),
     ("coverage", "unmatched_rows", "(SELECT COUNT(*) FROM scored) - (SELECT COUNT(*) FROM matched)"),
     ("coverage", "match_rate_pct",
      "CASE WHEN (SELECT COUNT(*) FROM mq) > 0 THEN (SELECT COUNT(*) FROM matched) / (SELECT COUNT(*) FROM mq) * 100 ELSE 0 END"),
     ("coverage", "threshold", f"{float(THRESHOLD)}"),
     ("scores", "min", "(SELECT MIN(vg_match_score) FROM scored)"),
     ("scores", "p25", "(SELECT quantile_cont(vg_match_score, 0.25) FROM scored)"),
     ("scores", "median", "(SELECT quantile_cont(vg_match_score, 0.5) FROM scored)"),
     ("scores", "p75", "(SELECT quantile_cont(vg_match_score, 0.75) FROM scored)"),
     ("scores", "max", "(SELECT MAX(vg_match_score) FROM scored)")]
    + [("buckets", b, f"(SELECT COUNT(*) FROM scored WHERE {_bucket_case_sql('vg_match_score')} = '{b}')")
       for b in _BUCKETS])


_QUEUES_SQL = f"""SELECT 'low_pass' AS queue, * FROM (
  SELECT app_id, name, vg_name AS candidate, ROUND(vg_match_score, 6) AS score,
         ROW_NUMBER() OVER (ORDER BY vg_match_score, app_id) AS rank
  FROM matched WHERE vg_match_score < {LOW_PASS_BELOW}) a WHERE rank <= 15
UNION ALL
SELECT 'high_pass', * FROM (SELECT app_id, name, vg_name, ROUND(vg_match_score, 6),
  ROW_NUMBER() OVER (ORDER BY vg_match_score DESC, app_id) AS rank FROM matched) b WHERE rank <= 10
UNION ALL
SELECT 'near_miss', * FROM (SELECT app_id, name, matched_sales_name, ROUND(vg_match_score, 6),
  ROW_NUMBER() OVER (ORDER BY vg_match_score DESC, app_id) AS rank
  FROM scored WHERE vg_match_score >= {THRESHOLD - C.NEAR_MISS_WIDTH} AND vg_match_score < {THRESHOLD}) c WHERE rank <= 15"""

_LISTED_SQL = f"""
SELECT CAST(CASE queue WHEN 'low_pass' THEN 100 WHEN 'high_pass' THEN 200 ELSE 300 END + rank AS INTEGER) AS item,
       queue AS section, CAST(app_id AS VARCHAR) || ' | ' || name || ' | ' || COALESCE(candidate, '') AS metric, score AS value
FROM ({_QUEUES_SQL}) q
UNION ALL
SELECT CAST(400 + rank AS INTEGER), 'multi_hits', vg_name || ' | ' || sample, CAST(hits AS DOUBLE) FROM (
  SELECT vg_name, COUNT(*) AS hits, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, vg_name) AS rank,
         array_to_string(list_slice(list(name ORDER BY vg_match_score DESC, name, app_id), 1, 5), '; ') AS sample
  FROM matched GROUP BY vg_name HAVING COUNT(*) > 1) m WHERE rank <= 15
UNION ALL
SELECT CAST(500 + rank AS INTEGER), 'length_gap', CAST(app_id AS VARCHAR) || ' | ' || name || ' | ' || vg_name,
       CAST(abs(length(name) - length(vg_name)) AS DOUBLE) FROM (
  SELECT *, ROW_NUMBER() OVER (ORDER BY abs(length(name) - length(vg_name)) DESC, app_id) AS rank FROM matched) g WHERE rank <= 10
UNION ALL
SELECT CAST(600 + rank AS INTEGER), 'keyword_mismatch', CAST(app_id AS VARCHAR) || ' | ' || name || ' | ' || vg_name,
       ROUND(vg_match_score, 6) FROM (
  SELECT *, ROW_NUMBER() OVER (ORDER BY vg_match_score DESC, name, app_id) AS rank FROM matched
  WHERE COALESCE(regexp_matches(name, '{_KW_RE}'), false) <> COALESCE(regexp_matches(vg_name, '{_KW_RE}'), false)) k
WHERE rank <= 15"""


@query("match_quality", MATCH_WITH + " UNION ALL ".join(
    f"SELECT CAST({i + 1} AS INTEGER) AS item, '{sec}' AS section, '{m}' AS metric, "
    f"ROUND(CAST({v} AS DOUBLE), 6) AS value"
    for i, (sec, m, v) in enumerate(_SUMMARY_ITEMS)) + " UNION ALL " + _LISTED_SQL)
def match_quality(spark, d):
    """All six sections of the match audit, from one rollup and one match."""
    from catalink.operators.dedupe import keep_first
    with one_match(spark, d), shared(spark, d, "matched", build_matched):
        q = keep_first(S.match_queries(spark, d), ["name"], ["app_id"])
        out = M.match_report(q.agg(F.count(F.lit(1))).scalar(), rollup(spark, d).agg(F.count(F.lit(1))).scalar(),
                             scored(spark, d), matched(spark, d), THRESHOLD, LOW_PASS_BELOW, EDITION_WORDS)
        return out.select("item", "section", "metric", r6("value"))


@query("match_review_queue", MATCH_WITH + f"SELECT queue, app_id, name, candidate, score FROM ({_QUEUES_SQL}) q")
def match_review_queue(spark, d):
    with one_match(spark, d), shared(spark, d, "matched", build_matched):
        queue = M.review_queue(scored(spark, d), matched(spark, d), THRESHOLD, LOW_PASS_BELOW)
        return queue.select("queue", "app_id", "name", "candidate", r6("score"))


@query("category_sales_top", MATCH_WITH + """
SELECT vg_platform, ROUND(SUM(vg_global_sales), 6) AS global_sales FROM flagged
WHERE NOT (flag_version_mismatch OR flag_low_score) AND vg_platform IS NOT NULL
GROUP BY vg_platform ORDER BY SUM(vg_global_sales) DESC, vg_platform LIMIT 15""")
def category_sales_top(spark, d):
    clean = flagged(spark, d).where(~F.col("flag_any"))
    from catalink.operators.aggregates import grouped_sum
    sums = grouped_sum(clean, "vg_platform", "vg_global_sales", "global_sales")
    return sums.orderBy(F.desc("global_sales"), "vg_platform").limit(15) \
               .select("vg_platform", r6("global_sales"))


@query("score_bucket", MATCH_WITH + f"""
SELECT app_id, ROUND(vg_match_score, 6) AS vg_match_score, {_bucket_case_sql("vg_match_score")} AS bucket
FROM scored""")
def score_bucket(spark, d):
    s = scored(spark, d)
    return s.select("app_id", r6("vg_match_score"), X.score_bucket("vg_match_score").alias("bucket"))
