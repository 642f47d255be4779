"""Quality queries: null / token profiles, ranges, frequencies, per-key
stats, integrity, non-ASCII values and the three report frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalink import config as C
from catalink.functions import expressions as X
from catalink.operators import aggregates as A
from catalink.operators import cleaning as CL
from catalink.operators import quality as QR
from catalink.operators import vocab as V
from catalink.plans import sqlfrag as Q
from catalink.plans import standin as S
from catalink.plans.common import core, with_core
from catalink.plans.q_cleaning import LANG_MAPPING, LANG_VOCAB, _MAP_SQL, left_join_merge
from catalink.plans.registry import query, r6

_MERGE_SQL = """merged AS (
  SELECT o.o_orderkey, o.o_custkey, c.c_custkey, c.c_name AS customer_name, c.c_nationkey, c.c_mktsegment
  FROM orders o LEFT JOIN (SELECT c_name, c_nationkey, c_mktsegment,
    CASE WHEN c_acctbal >= 0 THEN c_custkey END AS c_custkey FROM customer) c ON o.o_custkey = c.c_custkey
)"""
_MERGE_COLS = ["o_orderkey", "o_custkey", "c_custkey", "customer_name", "c_nationkey", "c_mktsegment"]


@query("null_profile", S.with_ctes(_MERGE_SQL) + " UNION ALL ".join(
    f"SELECT CAST({i + 1} AS INTEGER) AS position, '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS nulls, "
    f"ROUND(CAST(COUNT(*) - COUNT({c}) AS DOUBLE) * 100 / COUNT(*), 6) AS pct FROM merged"
    for i, c in enumerate(_MERGE_COLS)))
def null_profile(spark, d):
    return A.null_profile(left_join_merge(spark, d)).select("position", "column", "nulls", r6("pct"))


_TOKEN_SQL = """toks AS (
  SELECT l_returnflag, l_linestatus,
         CASE WHEN l_linenumber = 1 THEN ' ' || l_returnflag || ' ' ELSE l_returnflag END AS flag_padded,
         CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_quantity AS VARCHAR) END AS qty_text
  FROM lineitem
)"""
_TOKEN_COLS = ["l_returnflag", "l_linestatus", "flag_padded", "qty_text"]


@query("token_profile", S.with_ctes(_TOKEN_SQL) + " UNION ALL ".join(
    f"SELECT CAST({i + 1} AS INTEGER) AS position, '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS nulls, "
    f"COUNT(CASE WHEN {Q.strip(c)} IN {Q.in_list(C.MISSING_TOKENS)} THEN 1 END) AS tokens, "
    f"ROUND(CAST(COUNT(CASE WHEN {Q.strip(c)} IN {Q.in_list(C.MISSING_TOKENS)} THEN 1 END) AS DOUBLE) * 100 / COUNT(*), 6) AS token_pct "
    f"FROM toks" for i, c in enumerate(_TOKEN_COLS)))
def token_profile(spark, d):
    li = S.read(spark, d, "lineitem")
    toks = li.select("l_returnflag", "l_linestatus",
                     F.when(F.col("l_linenumber") == 1, F.concat(F.lit(" "), "l_returnflag", F.lit(" ")))
                      .otherwise(F.col("l_returnflag")).alias("flag_padded"),
                     F.when(F.col("l_linenumber") == 2, F.lit(None))
                      .otherwise(F.col("l_quantity").cast("string")).alias("qty_text"))
    return A.token_profile(toks).select("position", "column", "nulls", "tokens", r6("token_pct"))


_RANGE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("numeric_ranges", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", ROUND(MIN({c}), 6) AS min, ROUND(MEDIAN({c}), 6) AS median, "
    f"ROUND(MAX({c}), 6) AS max FROM lineitem" for c in _RANGE_COLS))
def numeric_ranges(spark, d):
    out = A.numeric_ranges(S.read(spark, d, "lineitem"), _RANGE_COLS)
    return out.select("column", r6("min"), r6("median"), r6("max"))


@query("value_freq", with_core() + """
SELECT review_score_description, COUNT(*) AS count FROM core WHERE review_score_description IS NOT NULL
GROUP BY review_score_description ORDER BY count DESC, review_score_description LIMIT 15""")
def value_freq(spark, d):
    return A.value_counts(core(spark, d), "review_score_description", 15)


@query("per_key_stats", """
SELECT ROUND(AVG(n), 6) AS mean, MAX(n) AS max, MIN(n) AS min
FROM (SELECT user_id, COUNT(event_type) AS n FROM events WHERE user_id IS NOT NULL GROUP BY user_id) t""")
def per_key_stats(spark, d):
    out = A.per_key_stats(S.read(spark, d, "events"), "user_id", "event_type")
    return out.select(r6("mean"), "max", "min")


@query("integrity_checks", S.with_ctes(*S.STAR_SQL) + """
SELECT 'sum_mismatch' AS metric, COUNT(CASE WHEN positive + negative <> total THEN 1 END) AS value FROM reviews
UNION ALL SELECT 'review_score_out_of_range',
  COUNT(CASE WHEN COALESCE(review_score, 0) < 0 OR COALESCE(review_score, 0) > 9 THEN 1 END) FROM reviews
UNION ALL SELECT 'metacritic_score_out_of_range',
  COUNT(CASE WHEN COALESCE(metacritic_score, 0) < 0 OR COALESCE(metacritic_score, 0) > 100 THEN 1 END) FROM reviews""")
def integrity_checks(spark, d):
    return A.integrity_checks(S.reviews(spark, d),
                              bounds={"review_score": (0, 9), "metacritic_score": (0, 100)})


@query("non_ascii_values", """
SELECT COUNT(DISTINCT text) AS distinct_values,
       COUNT(DISTINCT CASE WHEN regexp_matches(text, '[^\\x00-\\x7F]') THEN text END) AS non_ascii_values
FROM documents""")
def non_ascii_values(spark, d):
    docs = S.read(spark, d, "documents")
    return docs.agg(F.count_distinct("text").alias("distinct_values"),
                    F.count_distinct(F.when(X.is_non_ascii("text"), F.col("text"))).alias("non_ascii_values"))


# --- report frames ----------------------------------------------------------------

def _report_sql(items) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS INTEGER) AS item, '{sec}' AS section, {Q.q(m)} AS metric, "
        f"ROUND(CAST({v} AS DOUBLE), 6) AS value" for i, (sec, m, v) in enumerate(items))


def _dup_sql(src: str, cols) -> str:
    return f"(SELECT COALESCE(SUM(n - 1), 0) FROM (SELECT COUNT(*) AS n FROM {src} GROUP BY {', '.join(cols)}) t)"


_LONG_CTES = f"""lraw AS (SELECT source, lang FROM documents),
lclean AS (
  SELECT DISTINCT source, lang FROM (
    SELECT l.source, COALESCE(m.canonical, l.lang) AS lang FROM
      (SELECT source, {Q.normalize_ws("lang")} AS lang FROM lraw WHERE source IS NOT NULL AND lang IS NOT NULL) l
      LEFT JOIN {_MAP_SQL} ON l.lang = m.variant) t
  WHERE lang IN {Q.in_list(LANG_VOCAB)}
),
lunmapped AS (
  SELECT DISTINCT COALESCE(m.canonical, l.lang) AS value FROM
    (SELECT source, {Q.normalize_ws("lang")} AS lang FROM lraw WHERE source IS NOT NULL AND lang IS NOT NULL) l
    LEFT JOIN {_MAP_SQL} ON l.lang = m.variant
  WHERE COALESCE(m.canonical, l.lang) NOT IN {Q.in_list(LANG_VOCAB)}
),
lperkey AS (SELECT source, COUNT(lang) AS n FROM lraw WHERE source IS NOT NULL GROUP BY source)"""

_LONG_ITEMS = [
    ("raw", "total_rows", "(SELECT COUNT(*) FROM lraw)"),
    ("raw", "unique_keys", "(SELECT COUNT(DISTINCT source) FROM lraw)"),
    ("raw", "missing_values", "(SELECT COUNT(*) - COUNT(lang) FROM lraw)"),
    ("raw", "duplicate_rows", _dup_sql("lraw", ["source", "lang"])),
    ("raw", "duplicate_pairs", _dup_sql("lraw", ["source", "lang"])),
    ("per_key", "mean", "(SELECT AVG(n) FROM lperkey)"),
    ("per_key", "max", "(SELECT MAX(n) FROM lperkey)"),
    ("per_key", "min", "(SELECT MIN(n) FROM lperkey)"),
    ("language", "raw_distinct", "(SELECT COUNT(DISTINCT lang) FROM lraw)"),
    ("language", "non_ascii_values",
     "(SELECT COUNT(DISTINCT CASE WHEN regexp_matches(lang, '[^\\x00-\\x7F]') THEN lang END) FROM lraw)"),
    ("language", "clean_distinct", "(SELECT COUNT(DISTINCT lang) FROM lclean)"),
    ("language", "vocabulary_size", str(len(LANG_VOCAB))),
    ("cleaning", "rows_before", "(SELECT COUNT(*) FROM lraw)"),
    ("cleaning", "rows_after", "(SELECT COUNT(*) FROM lclean)"),
    ("cleaning", "rows_removed", "(SELECT COUNT(*) FROM lraw) - (SELECT COUNT(*) FROM lclean)"),
    ("warnings", "unmapped_values", "(SELECT COUNT(*) FROM lunmapped)"),
]


@query("quality_long", S.with_ctes(_LONG_CTES) + _report_sql(_LONG_ITEMS))
def quality_long(spark, d):
    raw = S.read(spark, d, "documents").select("source", "lang")
    mapping, vocab = V.mapping_frame(spark, LANG_MAPPING), V.vocabulary_frame(spark, LANG_VOCAB)
    clean = CL.clean_long(raw, "source", "lang", mapping, vocab)
    mapped = V.apply_mapping(raw.where(F.col("source").isNotNull() & F.col("lang").isNotNull())
                             .withColumn("lang", X.normalize_whitespace("lang")), "lang", mapping)
    unmapped = V.unmapped_values(mapped, "lang", vocab)
    out = QR.long_table_report(raw, clean, "source", "lang", len(LANG_VOCAB), unmapped)
    return out.select("item", "section", "metric", r6("value"))


# merged table: games with some prices missing (the merge leaves gaps)
_GAMES_GAPS_SQL = """gm AS (
  SELECT app_id, name, release_date, is_free, developer, publisher, owners_range,
         CASE WHEN app_id % 7 = 0 THEN NULL ELSE price END AS price FROM games
)"""
_GM_COLS = ["app_id", "name", "release_date", "is_free", "developer", "publisher", "owners_range", "price"]


def _games_gaps(spark, d):
    g = S.games(spark, d)
    return g.withColumn("price", F.when(F.col("app_id") % 7 == 0, F.lit(None)).otherwise(F.col("price"))
                        .cast("double"))


_MERGED_ITEMS = ([("overview", "total_rows", "(SELECT COUNT(*) FROM gm)"),
                  ("overview", "total_columns", str(len(_GM_COLS)))]
                 + [it for c in _GM_COLS for it in (
                     ("nulls", c, f"(SELECT COUNT(*) - COUNT({c}) FROM gm)"),
                     ("null_pct", c, f"(SELECT CAST(COUNT(*) - COUNT({c}) AS DOUBLE) * 100 / COUNT(*) FROM gm)"))]
                 + [("price", "min", "(SELECT MIN(price) FROM gm)"),
                    ("price", "median", "(SELECT MEDIAN(price) FROM gm)"),
                    ("price", "max", "(SELECT MAX(price) FROM gm)"),
                    ("price", "paid", "(SELECT COUNT(CASE WHEN COALESCE(price, -1.0) > 0 THEN 1 END) FROM gm)"),
                    ("price", "free", "(SELECT COUNT(CASE WHEN COALESCE(price, -1.0) = 0 THEN 1 END) FROM gm)"),
                    ("price", "missing", "(SELECT COUNT(*) - COUNT(price) FROM gm)"),
                    ("is_free", "paid", "(SELECT COUNT(CASE WHEN COALESCE(is_free, -1) = 0 THEN 1 END) FROM gm)"),
                    ("is_free", "free", "(SELECT COUNT(CASE WHEN COALESCE(is_free, -1) = 1 THEN 1 END) FROM gm)"),
                    ("is_free", "paid_pct",
                     "(SELECT CAST(COUNT(CASE WHEN COALESCE(is_free, -1) = 0 THEN 1 END) AS DOUBLE) * 100 / COUNT(*) FROM gm)"),
                    ("is_free", "free_pct",
                     "(SELECT CAST(COUNT(CASE WHEN COALESCE(is_free, -1) = 1 THEN 1 END) AS DOUBLE) * 100 / COUNT(*) FROM gm)")])

_SOURCE_ITEMS = [
    ("raw", "total_rows", "(SELECT COUNT(*) FROM part)"),
    ("raw", "total_columns", "6"),
    ("raw", "duplicate_rows", _dup_sql("part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])),
    ("raw", "duplicate_keys", _dup_sql("part", ["p_partkey"])),
    ("cleaning", "columns_retained", str(len(_GM_COLS))),
    ("cleaning", "rows_retained", "(SELECT COUNT(*) FROM gm)"),
    ("cleaning", "rows_removed", "(SELECT COUNT(*) FROM part) - (SELECT COUNT(*) FROM gm)"),
]


@query("quality_merged", S.with_ctes(*S.STAR_SQL, _GAMES_GAPS_SQL) + f"""
SELECT 'source' AS report, * FROM ({_report_sql(_SOURCE_ITEMS)}) a
UNION ALL SELECT 'merged', * FROM ({_report_sql(_MERGED_ITEMS)}) b
UNION ALL SELECT 'merged', CAST({len(_MERGED_ITEMS)} + ROW_NUMBER() OVER (ORDER BY cnt DESC, owners_range) AS INTEGER),
                 'owners_top', owners_range, ROUND(CAST(cnt AS DOUBLE), 6)
  FROM (SELECT owners_range, COUNT(*) AS cnt FROM gm WHERE owners_range IS NOT NULL GROUP BY owners_range
        ORDER BY cnt DESC, owners_range LIMIT 10) c""")
def quality_merged(spark, d):
    gm = _games_gaps(spark, d)
    source = QR.wide_source_report(S.read(spark, d, "part"), gm, "p_partkey")
    merged = QR.merged_report(gm)
    return (source.withColumn("report", F.lit("source"))
                  .unionByName(merged.withColumn("report", F.lit("merged")))
                  .select("report", "item", "section", "metric", r6("value")))


_RAW_REVIEW_COLS = ["app_id", "review_score", "review_score_description", "positive", "negative", "total",
                    "metacritic_score", "reviews"]


def _raw_reviews(spark, d):
    r = S.reviews(spark, d)
    text = {c: F.col(c).cast("string") for c in ["app_id", "review_score", "positive", "negative", "total"]}
    return r.select(*[v.alias(k) for k, v in text.items()], "review_score_description",
                    F.coalesce(F.col("metacritic_score").cast("string"), F.lit("\\N")).alias("metacritic_score"),
                    F.when(F.col("app_id") % 3 == 0, F.lit("N")).otherwise(F.lit("ok")).alias("reviews")) \
            .select(*_RAW_REVIEW_COLS)


_RAW_REVIEWS_SQL = """rraw AS (
  SELECT CAST(app_id AS VARCHAR) AS app_id, CAST(review_score AS VARCHAR) AS review_score,
         review_score_description, CAST(positive AS VARCHAR) AS positive, CAST(negative AS VARCHAR) AS negative,
         CAST(total AS VARCHAR) AS total, COALESCE(CAST(metacritic_score AS VARCHAR), '\\N') AS metacritic_score,
         CASE WHEN app_id % 3 = 0 THEN 'N' ELSE 'ok' END AS reviews
  FROM reviews
)"""
_CLEAN_NUM = [c for c in C.REVIEW_NUMERIC_COLUMNS if c in _RAW_REVIEW_COLS]
_RCLEAN_SQL = f"""rclean AS (
  SELECT {", ".join(Q.safe_long(Q.missing(c)) + f" AS {c}" if c in _CLEAN_NUM else Q.missing(c) + f" AS {c}"
                    for c in _RAW_REVIEW_COLS if c not in C.REVIEW_DROP_COLUMNS)}
  FROM rraw
)"""
_RANGE_NUM = ["app_id", "review_score", "positive", "negative", "total", "metacritic_score"]
_REVIEW_ITEMS = (
    [("raw", "total_rows", "(SELECT COUNT(*) FROM rraw)"),
     ("raw", "total_columns", str(len(_RAW_REVIEW_COLS))),
     ("raw", "duplicate_rows", _dup_sql("rraw", _RAW_REVIEW_COLS)),
     ("raw", "duplicate_keys", _dup_sql("rraw", ["app_id"]))]
    + [it for c in _RAW_REVIEW_COLS for it in (
        ("tokens", c, f"(SELECT COUNT(CASE WHEN {Q.strip(c)} IN {Q.in_list(C.MISSING_TOKENS)} THEN 1 END) FROM rraw)"),
        ("nulls", c, f"(SELECT COUNT(*) - COUNT({c}) FROM rraw)"))]
    + [("cleaning", "columns_retained", str(len([c for c in _RAW_REVIEW_COLS if c not in C.REVIEW_DROP_COLUMNS]))),
       ("cleaning", "rows_before", "(SELECT COUNT(*) FROM rraw)"),
       ("cleaning", "rows_after", "(SELECT COUNT(*) FROM rclean)"),
       ("cleaning", "rows_removed", "(SELECT COUNT(*) FROM rraw) - (SELECT COUNT(*) FROM rclean)"),
       ("integrity", "sum_mismatch", "(SELECT COUNT(CASE WHEN positive + negative <> total THEN 1 END) FROM rclean)"),
       ("integrity", "review_score_out_of_range",
        "(SELECT COUNT(CASE WHEN COALESCE(review_score, 0) < 0 OR COALESCE(review_score, 0) > 9 THEN 1 END) FROM rclean)"),
       ("integrity", "metacritic_score_out_of_range",
        "(SELECT COUNT(CASE WHEN COALESCE(metacritic_score, 0) < 0 OR COALESCE(metacritic_score, 0) > 100 THEN 1 END) FROM rclean)")]
    + [it for c in _RANGE_NUM for it in (
        ("ranges", f"{c}_min", f"(SELECT MIN({c}) FROM rclean)"),
        ("ranges", f"{c}_median", f"(SELECT MEDIAN({c}) FROM rclean)"),
        ("ranges", f"{c}_max", f"(SELECT MAX({c}) FROM rclean)"))])


@query("quality_reviews", with_core(_RAW_REVIEWS_SQL, _RCLEAN_SQL) + _report_sql(_REVIEW_ITEMS) + f"""
UNION ALL SELECT CAST({len(_REVIEW_ITEMS)} + ROW_NUMBER() OVER (ORDER BY cnt DESC, review_score_description) AS INTEGER),
                 'descriptions', review_score_description, ROUND(CAST(cnt AS DOUBLE), 6)
  FROM (SELECT review_score_description, COUNT(*) AS cnt FROM rclean WHERE review_score_description IS NOT NULL
        GROUP BY review_score_description ORDER BY cnt DESC, review_score_description LIMIT 15) t""")
def quality_reviews(spark, d):
    raw = _raw_reviews(spark, d)
    clean = CL.clean_reviews(raw)
    for col in ("app_id", "total"):  # the report needs these columns
        if col not in clean.columns:
            raise ValueError(f"column {col} is required")
    out = QR.review_report(raw, clean, _RANGE_NUM)
    return out.select("item", "section", "metric", r6("value"))
