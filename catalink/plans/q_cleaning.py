"""Cleaning, vocabulary, dedupe and join queries.

Inputs with dirt the driver's tables do not have are made from them by rule
(``case`` on a key): the literal ``N`` in ``l_returnflag`` is a missing token,
blank padding, junk numbers, invalid dates, non-breaking blanks woven into
whole document texts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalink import config as C
from catalink.functions import expressions as X
from catalink.operators import dedupe as D
from catalink.operators import joins as J
from catalink.operators import vocab as V
from catalink.plans import sqlfrag as Q
from catalink.plans import standin as S
from catalink.plans.common import core, with_core
from catalink.plans.registry import query, r6

# Variant -> canonical mapping and vocabulary for the document language codes
# (``es`` is deliberately left unmapped).
LANG_MAPPING = {"en": "English", "fr": "French", "de": "German"}
LANG_VOCAB = ("English", "French", "German")

_MAP_SQL = "(VALUES " + ", ".join(f"({Q.q(k)}, {Q.q(v)})" for k, v in LANG_MAPPING.items()) + \
    ") AS m(variant, canonical)"


# --- step 2: scalar cleaning ------------------------------------------------------

def _padded_flag():
    return F.when(F.col("l_linenumber") == 1, F.concat(F.lit(" "), "l_returnflag", F.lit(" "))) \
            .otherwise(F.col("l_returnflag"))


@query("missing_tokens", f"""
SELECT l_orderkey, l_linenumber, raw, {Q.missing("raw")} AS cleaned
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linenumber = 1 THEN ' ' || l_returnflag || ' ' ELSE l_returnflag END AS raw
      FROM lineitem) t""")
def missing_tokens(spark, d):
    li = S.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", _padded_flag().alias("raw"))
    return li.select("l_orderkey", "l_linenumber", "raw", X.missing_to_null("raw").alias("cleaned"))


def _junk_number():
    digits = F.regexp_extract("props", r"(\d+)", 1)
    k = F.col("event_id") % 4
    return (F.when(k == 0, F.col("value").cast("string"))
             .when(k == 1, digits)
             .when(k == 2, F.concat(digits, F.lit("d")))
             .otherwise(F.concat(F.lit(" "), digits, F.lit(" "))))


@query("safe_numeric", f"""
SELECT event_id, raw, {Q.safe_double("raw")} AS as_double, {Q.safe_long("raw")} AS as_long
FROM (SELECT event_id,
             CASE event_id % 4 WHEN 0 THEN CAST(value AS VARCHAR)
                               WHEN 1 THEN regexp_extract(props, '(\\d+)', 1)
                               WHEN 2 THEN regexp_extract(props, '(\\d+)', 1) || 'd'
                               ELSE ' ' || regexp_extract(props, '(\\d+)', 1) || ' ' END AS raw
      FROM events) t""")
def safe_numeric(spark, d):
    ev = S.read(spark, d, "events").select("event_id", _junk_number().alias("raw"))
    return ev.select("event_id", "raw", X.safe_double("raw").alias("as_double"),
                     X.safe_long("raw").alias("as_long"))


@query("cents_to_price", f"""
SELECT l_orderkey, l_linenumber, raw,
       ROUND(round({Q.safe_double(Q.missing("raw", C.PRICE_MISSING_TOKENS))} / 100.0, 2), 6) AS price
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linenumber = 3 THEN 'N'
                  ELSE CAST(CAST(FLOOR(l_extendedprice) AS BIGINT) AS VARCHAR) END AS raw
      FROM lineitem) t""")
def cents_to_price(spark, d):
    li = S.read(spark, d, "lineitem")
    raw = F.when(F.col("l_linenumber") == 3, F.lit("N")).otherwise(
        F.floor("l_extendedprice").cast("bigint").cast("string"))
    li = li.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return li.select("l_orderkey", "l_linenumber", "raw", r6(X.cents_to_price("raw"), "price"))


_LOW = ("COALESCE(TRY_CAST(trunc(" + Q.safe_double("split_part(replace(owners_range, ',', ''), '..', 1)")
        + ") AS BIGINT), 0)")
_HIGH = ("COALESCE(TRY_CAST(trunc(" + Q.safe_double("split_part(replace(owners_range, ',', ''), '..', 2)")
         + ") AS BIGINT), 0)")


@query("range_midpoint", S.with_ctes(*S.STAR_SQL) + f"""
SELECT owners_range, app_id, low, high, CAST(FLOOR((low + high) / 2) AS BIGINT) AS mid FROM (
  SELECT owners_range, MIN(app_id) AS app_id, {_LOW} AS low, {_HIGH} AS high
  FROM games GROUP BY owners_range) t
ORDER BY app_id LIMIT 6""")
def range_midpoint(spark, d):
    g = S.games(spark, d).select("app_id", "owners_range")
    first = D.one_row_per_value(g, "owners_range", ["app_id"], 6)
    b = X.owners_bounds("owners_range")
    return first.select("owners_range", "app_id", b.getField("low").alias("low"),
                        b.getField("high").alias("high"), b.getField("mid").alias("mid"))


def _nbsp_text():
    nb = "\u00a0"
    return F.concat(F.lit(nb), F.replace("text", F.lit(" "), F.lit(nb)), F.lit(nb + " "))


@query("whitespace_norm", f"""
SELECT doc_id, CAST(length(n) AS BIGINT) AS norm_len, md5(n) AS norm_md5 FROM (
  SELECT doc_id, {Q.normalize_ws("raw")} AS n FROM (
    SELECT doc_id, '{Q.NBSP}' || replace(text, ' ', '{Q.NBSP}') || '{Q.NBSP} ' AS raw FROM documents) t) u""")
def whitespace_norm(spark, d):
    docs = S.read(spark, d, "documents").select("doc_id", _nbsp_text().alias("raw"))
    n = X.normalize_whitespace("raw")
    return docs.select("doc_id", F.length(n).cast("bigint").alias("norm_len"), F.md5(n).alias("norm_md5"))


def _price_fill(spark, d):
    g = S.games(spark, d).withColumn(
        "price_raw", F.when(F.col("app_id") % 7 == 0, F.lit(None)).otherwise(F.col("price")).cast("double"))
    filled = X.fill_free_price("price_raw", "is_free")
    return (g.withColumn("price_filled", filled)
             .withColumn("price_unknown", F.col("price_filled").isNull())
             .withColumn("price_log_base", X.replace_value("price_filled", 0.0, 1.0)))


_PRICE_FILL_SQL = """pf0 AS (SELECT app_id, is_free, CASE WHEN app_id % 7 = 0 THEN NULL ELSE price END AS price_raw FROM games),
pf AS (SELECT app_id, is_free, price_raw,
              CASE WHEN is_free = 1 AND price_raw IS NULL THEN 0.0 ELSE price_raw END AS price_filled FROM pf0)"""


@query("price_fill", S.with_ctes(*S.STAR_SQL, _PRICE_FILL_SQL) + """
SELECT app_id, is_free, price_raw, price_filled, price_filled IS NULL AS price_unknown,
       CASE WHEN price_filled = 0.0 THEN 1.0 ELSE price_filled END AS price_log_base FROM pf""")
def price_fill(spark, d):
    return _price_fill(spark, d).select("app_id", "is_free", "price_raw", "price_filled",
                                        "price_unknown", "price_log_base")


@query("monetization_label", S.with_ctes(*S.STAR_SQL, _PRICE_FILL_SQL) + """
SELECT label, COUNT(*) AS count FROM (
  SELECT CASE WHEN COALESCE(is_free = 1, false) THEN 'Free to Play'
              WHEN price_filled IS NULL THEN 'Price Unknown' ELSE 'Paid' END AS label FROM pf) t
GROUP BY label""")
def monetization_label(spark, d):
    from catalink.operators.aggregates import value_counts
    g = _price_fill(spark, d).withColumn("label", X.monetization_label("is_free", "price_unknown"))
    return value_counts(g, "label")


@query("date_parse_year", S.with_ctes(*S.STAR_SQL) + """
SELECT app_id, raw, TRY_CAST(raw AS DATE) AS parsed, CAST(year(TRY_CAST(raw AS DATE)) AS INTEGER) AS year
FROM (SELECT app_id, CASE WHEN app_id % 11 = 0 THEN 'not a date' WHEN app_id % 13 = 0 THEN '2001-02-30'
                          ELSE CAST(release_date AS VARCHAR) END AS raw FROM games) t""")
def date_parse_year(spark, d):
    g = S.games(spark, d)
    raw = (F.when(F.col("app_id") % 11 == 0, F.lit("not a date"))
            .when(F.col("app_id") % 13 == 0, F.lit("2001-02-30"))
            .otherwise(F.col("release_date").cast("string")))
    g = g.select("app_id", raw.alias("raw")).withColumn("parsed", F.col("raw").try_cast("date"))
    return g.withColumn("year", F.year("parsed").cast("int"))


# --- step 3: vocabulary, dedupe, joins ---------------------------------------------------

def _mapped_docs(spark, d):
    docs = S.read(spark, d, "documents").select("doc_id", "source",
                                                X.normalize_whitespace("lang").alias("lang"))
    return V.apply_mapping(docs, "lang", V.mapping_frame(spark, LANG_MAPPING), out="lang_mapped")


_MAPPED_SQL = f"""mapped AS (
  SELECT d.doc_id, d.source, d.lang, COALESCE(m.canonical, d.lang) AS lang_mapped
  FROM (SELECT doc_id, source, {Q.normalize_ws("lang")} AS lang FROM documents) d
  LEFT JOIN {_MAP_SQL} ON d.lang = m.variant
)"""


@query("map_vocab", S.with_ctes(_MAPPED_SQL) + "SELECT doc_id, lang, lang_mapped FROM mapped")
def map_vocab(spark, d):
    return _mapped_docs(spark, d).select("doc_id", "lang", "lang_mapped")


@query("unmapped_values", S.with_ctes(_MAPPED_SQL) + f"""
SELECT DISTINCT lang_mapped AS value FROM mapped
WHERE lang_mapped IS NOT NULL AND lang_mapped NOT IN {Q.in_list(LANG_VOCAB)}""")
def unmapped_values(spark, d):
    return V.unmapped_values(_mapped_docs(spark, d), "lang_mapped", V.vocabulary_frame(spark, LANG_VOCAB))


@query("vocab_filter", S.with_ctes(_MAPPED_SQL) + f"""
SELECT doc_id, lang_mapped FROM mapped WHERE lang_mapped IN {Q.in_list(LANG_VOCAB)}""")
def vocab_filter(spark, d):
    kept = V.vocab_filter(_mapped_docs(spark, d), "lang_mapped", V.vocabulary_frame(spark, LANG_VOCAB))
    return kept.select("doc_id", "lang_mapped")


@query("dedupe_first", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE user_id IS NOT NULL AND event_type IS NOT NULL
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""")
def dedupe_first(spark, d):
    ev = S.read(spark, d, "events")
    return D.keep_first(ev, ["user_id", "event_type"], ["event_id"])


@query("dedupe_pairs", "SELECT DISTINCT user_id, event_type FROM events")
def dedupe_pairs(spark, d):
    return D.distinct_pairs(S.read(spark, d, "events"), ["user_id", "event_type"])


@query("duplicate_counts", """
SELECT 'duplicate_rows' AS metric, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS value
  FROM (SELECT COUNT(*) AS n FROM documents GROUP BY text, lang, source) a
UNION ALL
SELECT 'duplicate_texts', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT)
  FROM (SELECT COUNT(*) AS n FROM documents GROUP BY text) b
UNION ALL
SELECT 'duplicate_source_lang', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT)
  FROM (SELECT COUNT(*) AS n FROM documents GROUP BY source, lang) c""")
def duplicate_counts(spark, d):
    # 192 bits of hashes stand for a text, so that no whole text is shuffled
    docs = S.read(spark, d, "documents").select(F.xxhash64("text").alias("h"), F.md5("text").alias("text"), "lang", "source")
    full = D.count_full_duplicates(docs).select(F.lit("duplicate_rows").alias("metric"),
                                                F.col("duplicate_rows").alias("value"))
    texts = D.count_key_duplicates(docs, ["text", "h"]).select(F.lit("duplicate_texts").alias("metric"),
                                                          F.col("duplicate_keys").alias("value"))
    pairs = D.count_key_duplicates(docs, ["source", "lang"]).select(
        F.lit("duplicate_source_lang").alias("metric"), F.col("duplicate_keys").alias("value"))
    return full.unionByName(texts).unionByName(pairs)


@query("left_join_merge", """
SELECT o.o_orderkey, o.o_custkey, c.c_custkey, c.c_name AS customer_name, c.c_nationkey, c.c_mktsegment
FROM orders o LEFT JOIN (SELECT c_name, c_nationkey, c_mktsegment,
  CASE WHEN c_acctbal >= 0 THEN c_custkey END AS c_custkey FROM customer) c ON o.o_custkey = c.c_custkey""")
def left_join_merge(spark, d):
    orders = S.read(spark, d, "orders").select("o_orderkey", "o_custkey")
    # customers in debt have no usable key, so their orders stay without a partner
    cust = S.read(spark, d, "customer").withColumn("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")))
    merged = J.left_join_keys(orders, cust, "o_custkey", "c_custkey")
    return merged.withColumnsRenamed({"c_name": "customer_name"}).drop("c_acctbal")


@query("existence_flag", S.with_ctes(*S.STAR_SQL, S.GENRES_SQL, S.PROMO_SQL) + """
SELECT app_id, has_flag, flag_cheap, has_flag OR flag_cheap AS flag_any FROM (
  SELECT app_id, app_id IN (SELECT app_id FROM promo_ids) AS has_flag,
         COALESCE(price < 10, false) AS flag_cheap FROM games) t""")
def existence_flag(spark, d):
    g = J.existence_flag(S.games(spark, d), S.promo_ids(spark, d), "app_id", "has_flag")
    g = g.withColumn("flag_cheap", F.coalesce(F.col("price") < 10, F.lit(False)))
    return g.select("app_id", "has_flag", "flag_cheap",
                    (F.col("has_flag") | F.col("flag_cheap")).alias("flag_any"))


@query("semi_members", with_core(S.TAGS_SQL) + f"""
SELECT app_id, tag FROM tags_long
WHERE app_id IN (SELECT app_id FROM core WHERE quadrant = '{C.QUADRANTS[1]}')""")
def semi_members(spark, d):
    ids = core(spark, d).where(F.col("quadrant") == C.QUADRANTS[1]).select("app_id")
    return J.semi_join(S.tags_long(spark, d), ids, "app_id")


@query("clean_long", S.with_ctes(_MAPPED_SQL) + f"""
SELECT DISTINCT source, lang_mapped AS lang FROM mapped
WHERE source IS NOT NULL AND lang_mapped IN {Q.in_list(LANG_VOCAB)}""")
def clean_long(spark, d):
    from catalink.operators.ranking import sort_rows
    mapped = _mapped_docs(spark, d).where(F.col("source").isNotNull())
    kept = V.vocab_filter(mapped, "lang_mapped", V.vocabulary_frame(spark, LANG_VOCAB))
    pairs = D.distinct_pairs(kept.select("source", F.col("lang_mapped").alias("lang")), ["source", "lang"])
    return sort_rows(pairs, [("source", False), ("lang", False)])


_WIDE_TEXT = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag",
              "l_linestatus"]


@query("clean_wide", f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag, l_linestatus FROM (
  SELECT {Q.safe_long(Q.missing("l_orderkey"))} AS l_orderkey,
         {Q.safe_long(Q.missing("l_linenumber"))} AS l_linenumber,
         {Q.safe_long(Q.missing("l_quantity"))} AS l_quantity,
         {Q.safe_double(Q.missing("l_discount"))} AS l_discount,
         {Q.missing("l_returnflag")} AS l_returnflag, {Q.missing("l_linestatus")} AS l_linestatus
  FROM (SELECT {", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _WIDE_TEXT)} FROM lineitem) raw) t
WHERE l_orderkey IS NOT NULL
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber NULLS FIRST,
    l_quantity NULLS FIRST, l_discount NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) = 1""")
def clean_wide(spark, d):
    li = S.read(spark, d, "lineitem")
    raw = li.select(*[F.col(c).cast("string").alias(c) for c in _WIDE_TEXT])
    return clean_wide_frame(raw)


def clean_wide_frame(raw):
    """Wide cleaner: drop columns, tokens to null, typed numbers, keep first per key, sort."""
    from catalink.operators.cleaning import clean_wide as clean
    # (order, line) repeats in the data: order by the whole row so "first" is unique
    return clean(raw, "l_orderkey", drop=["l_tax"], longs=["l_orderkey", "l_linenumber", "l_quantity"],
                 doubles=["l_discount"],
                 order=["l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_linestatus"])
