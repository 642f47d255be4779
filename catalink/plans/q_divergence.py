"""Divergence queries: core sample, metrics, quadrants, slices, rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalink import config as C
from catalink.functions import expressions as X
from catalink.operators import aggregates as A
from catalink.operators import slices as SL
from catalink.plans import standin as S
from catalink.plans.common import CFG, core, with_core
from catalink.plans.registry import query, r6

_PCT_COLS = [SL.label_column_name("pct_", q) for q in C.QUADRANTS]


def _pct_sql(alias: str = "p") -> str:
    parts = []
    for q, name in zip(C.QUADRANTS, _PCT_COLS):
        parts.append(f"ROUND(COUNT(DISTINCT CASE WHEN quadrant = '{q}' THEN app_id END) "
                     f"/ COUNT(DISTINCT app_id) * 100, 6) AS {name}")
    return ",\n       ".join(parts)


# --- core and metrics ------------------------------------------------------------

@query("core_sample", with_core() + """
SELECT app_id, name, release_date, release_year, total, positive, negative, review_score,
       metacritic_score, developer, publisher, owners_range, price, is_free
FROM core""")
def core_sample(spark, d):
    return core(spark, d).select(
        "app_id", "name", "release_date", "release_year", "total", "positive", "negative",
        "review_score", "metacritic_score", "developer", "publisher", "owners_range", "price",
        "is_free")


@query("divergence_metrics", with_core() + """
SELECT app_id, ROUND(player_ratio, 6) AS player_ratio, ROUND(player_ratio_100, 6) AS player_ratio_100,
       ROUND(player_norm, 6) AS player_norm, ROUND(critic_norm, 6) AS critic_norm,
       ROUND(divergence_ratio, 6) AS divergence_ratio, ROUND(divergence_tier, 6) AS divergence_tier,
       ROUND(abs(divergence_ratio), 6) AS abs_div,
       ROUND(CASE WHEN total > 0 THEN log10(total) END, 6) AS log_total
FROM core""")
def divergence_metrics(spark, d):
    c = core(spark, d)
    return c.select("app_id", r6("player_ratio"), r6("player_ratio_100"), r6("player_norm"),
                    r6("critic_norm"), r6("divergence_ratio"), r6("divergence_tier"),
                    r6(F.abs("divergence_ratio"), "abs_div"),
                    r6(X.safe_log10("total"), "log_total"))


def _label_counts_sql(col: str, labels, source: str) -> str:
    rows = " UNION ALL ".join(f"SELECT {i + 1} AS rank, '{lbl}' AS lbl" for i, lbl in enumerate(labels))
    return f"""
SELECT CAST(l.rank AS INTEGER) AS rank, l.lbl AS {col}, COALESCE(c.cnt, 0) AS count,
       ROUND(CAST(COALESCE(c.cnt, 0) AS DOUBLE) * 100 / SUM(COALESCE(c.cnt, 0)) OVER (), 6) AS pct
FROM ({rows}) l
LEFT JOIN (SELECT {col} AS lbl, COUNT(*) AS cnt FROM {source} GROUP BY {col}) c ON l.lbl = c.lbl"""


@query("quadrant_summary", with_core() + _label_counts_sql("quadrant", C.QUADRANTS, "core"))
def quadrant_summary(spark, d):
    out = A.label_counts(core(spark, d), "quadrant", C.QUADRANTS)
    return out.select("rank", "quadrant", "count", r6("pct"))


# --- slices ----------------------------------------------------------------------

def _slice_sql(long_cte: str, long_name: str, key: str, min_games: int) -> str:
    return with_core(long_cte) + f"""
SELECT {key}, COUNT(DISTINCT app_id) AS n_games,
       ROUND(AVG(divergence_ratio), 6) AS mean_div,
       ROUND(MEDIAN(divergence_ratio), 6) AS median_div,
       {_pct_sql()}
FROM (SELECT l.app_id, l.{key}, c.divergence_ratio, c.quadrant
      FROM {long_name} l JOIN core c ON l.app_id = c.app_id WHERE l.{key} IS NOT NULL) j
GROUP BY {key}
HAVING COUNT(DISTINCT app_id) >= {min_games}"""


def _slice(long_df, key, min_games, spark, d):
    out = SL.slice_by_long_table(long_df, core(spark, d), key, min_games)
    return out.select(key, "n_games", r6("mean_div"), r6("median_div"), *[r6(c) for c in _PCT_COLS])


@query("slice_by_genre", _slice_sql(S.GENRES_SQL, "genres_long", "genre", CFG.min_games_per_genre))
def slice_by_genre(spark, d):
    return _slice(S.genres_long(spark, d), "genre", CFG.min_games_per_genre, spark, d)


@query("slice_by_tag", _slice_sql(S.TAGS_SQL, "tags_long", "tag", CFG.min_games_per_category))
def slice_by_tag(spark, d):
    return _slice(S.tags_long(spark, d), "tag", CFG.min_games_per_category, spark, d)


def _entity_sql(col: str, min_games: int) -> str:
    return with_core() + f"""
SELECT {col}, COUNT(DISTINCT app_id) AS n_games,
       ROUND(AVG(divergence_ratio), 6) AS mean_div, ROUND(MEDIAN(divergence_ratio), 6) AS median_div,
       ROUND(AVG(player_ratio_100), 6) AS mean_player, ROUND(AVG(critic_norm), 6) AS mean_critic
FROM core WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(DISTINCT app_id) >= {min_games}"""


def _entity(spark, d, col, min_games):
    out = SL.entity_stats(core(spark, d), col, min_games)
    return out.select(col, "n_games", r6("mean_div"), r6("median_div"), r6("mean_player"),
                      r6("mean_critic"))


@query("entity_publisher", _entity_sql("publisher", CFG.min_games_per_publisher))
def entity_publisher(spark, d):
    return _entity(spark, d, "publisher", CFG.min_games_per_publisher)


@query("entity_developer", _entity_sql("developer", CFG.min_games_per_developer))
def entity_developer(spark, d):
    return _entity(spark, d, "developer", CFG.min_games_per_developer)


# --- rankings ----------------------------------------------------------------------

_LIST_COLS = ["app_id", "name", "developer", "publisher", "release_year", "price", "owners_range",
              "total", "player_ratio_100", "critic_norm", "divergence_ratio", "quadrant"]


def _ranked_list(spark, d, descending: bool):
    from catalink.operators.ranking import top_n
    ranked = core(spark, d).where(F.col("total") >= CFG.ranked_min_total)
    out = top_n(ranked, [("divergence_ratio", descending), ("app_id", False)], CFG.top_n)
    return out.select("rank", "app_id", "name", "developer", "publisher", "release_year", "price",
                      "owners_range", "total", r6("player_ratio_100"), r6("critic_norm"),
                      r6("divergence_ratio"), "quadrant",
                      X.truncate("name", 40).alias("short_name"),
                      X.presented(r6("player_ratio_100"), 1).alias("player_shown"),
                      X.presented(r6("critic_norm"), 0).alias("critic_shown"),
                      X.presented(r6("divergence_ratio"), 1).alias("divergence_shown"))


def _ranked_sql(direction: str) -> str:
    return with_core() + f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY divergence_ratio {direction}, app_id) AS INTEGER) AS rank,
       app_id, name, developer, publisher, release_year, price, owners_range, total,
       ROUND(player_ratio_100, 6) AS player_ratio_100, ROUND(critic_norm, 6) AS critic_norm,
       ROUND(divergence_ratio, 6) AS divergence_ratio, quadrant, substr(name, 1, 40) AS short_name,
       round_even(ROUND(player_ratio_100, 6) * 10, 0) / 10 AS player_shown,
       CAST(round_even(ROUND(critic_norm, 6), 0) AS BIGINT) AS critic_shown,
       round_even(ROUND(divergence_ratio, 6) * 10, 0) / 10 AS divergence_shown
FROM core WHERE total >= {CFG.ranked_min_total}
ORDER BY divergence_ratio {direction}, app_id LIMIT {CFG.top_n}"""


@query("top_underrated", _ranked_sql("DESC"))
def top_underrated(spark, d):
    return _ranked_list(spark, d, True)


@query("top_overrated", _ranked_sql("ASC"))
def top_overrated(spark, d):
    return _ranked_list(spark, d, False)


# --- buckets and profiles -------------------------------------------------------

def _case_sql(cond_labels) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{lbl}'" for c, lbl in cond_labels) + " END"


def price_bucket_sql(x: str) -> str:
    e, lbl = C.PRICE_EDGES, C.PRICE_LABELS
    conds = [(f"{x} > {e[0]} AND {x} <= {e[i + 1]}", lbl[i]) for i in range(len(e) - 1)]
    conds.append((f"{x} > {e[-1]}", lbl[-1]))
    return _case_sql(conds)


def volume_bucket_sql(x: str) -> str:
    e, lbl = C.VOLUME_EDGES, C.VOLUME_LABELS
    conds = [(f"{x} >= {e[i]} AND {x} < {e[i + 1]}", lbl[i]) for i in range(len(e) - 1)]
    conds.append((f"{x} >= {e[-1]}", lbl[-1]))
    return _case_sql(conds)


def critic_label_sql(x: str) -> str:
    e, lbl = C.CRITIC_EDGES, C.CRITIC_LABELS
    return _case_sql([(f"{x} >= {e[0]} AND {x} <= {e[i + 1]}", lbl[i]) for i in range(len(lbl))])


def _rank_sql(x: str, labels) -> str:
    return "CASE " + " ".join(f"WHEN {x} = '{v}' THEN {i + 1}" for i, v in enumerate(labels)) + " END"


def _bucket_sql(source: str, bucket_expr: str, labels, metric: str, name: str) -> str:
    return f"""
SELECT {name}, n_games, ROUND(mean, 6) AS mean, ROUND(median, 6) AS median,
       CAST({_rank_sql(name, labels)} AS INTEGER) AS rank
FROM (SELECT {name}, COUNT({metric}) AS n_games, AVG({metric}) AS mean, MEDIAN({metric}) AS median
      FROM (SELECT {bucket_expr} AS {name}, {metric} FROM {source}) t
      WHERE {name} IS NOT NULL GROUP BY {name}) a"""


def _bucket_out(df):
    return df.select(df.columns[0], "n_games", r6("mean"), r6("median"), "rank")


@query("price_buckets", with_core() + _bucket_sql("core", price_bucket_sql("price"), C.PRICE_LABELS,
                                                   "divergence_ratio", "price_bucket"))
def price_buckets(spark, d):
    from catalink.operators.bins import bucket_profile
    out = bucket_profile(core(spark, d), X.price_bucket("price"), C.PRICE_LABELS,
                         "divergence_ratio", "price_bucket")
    return _bucket_out(out)


@query("volume_buckets", S.with_ctes(S.ORDER_VOLUME_SQL) + _bucket_sql(
    "order_volume", volume_bucket_sql("total"), C.VOLUME_LABELS, "abs_div", "total_bucket"))
def volume_buckets(spark, d):
    from catalink.operators.bins import bucket_profile
    out = bucket_profile(S.order_volume(spark, d), X.volume_bucket("total"), C.VOLUME_LABELS,
                         "abs_div", "total_bucket")
    return _bucket_out(out)


@query("critic_bins", with_core() + """
SELECT bin, ROUND(mean, 6) AS mean, count, ROUND(CAST(0 + bin * 5 AS DOUBLE) - 2.5, 6) AS mid
FROM (SELECT CAST(LEAST(GREATEST(CEIL((critic_norm - 0) / 5), 1), 20) AS INTEGER) AS bin,
             AVG(player_ratio_100) AS mean, COUNT(player_ratio_100) AS count
      FROM core WHERE critic_norm >= 0 AND critic_norm <= 100 GROUP BY 1) t
WHERE count >= 5""")
def critic_bins(spark, d):
    from catalink.operators.bins import binned_mean
    out = binned_mean(core(spark, d), "critic_norm", "player_ratio_100", 0, 100,
                      CFG.critic_bin_width, CFG.critic_bin_min_count)
    return out.select("bin", r6("mean"), "count", r6("mid"))


_CROSS_NAMES = [SL.label_column_name("n_", lbl) for lbl in C.CRITIC_LABELS]


@query("tier_crosstab", with_core() + f"""
SELECT review_score_description,
       {", ".join(f"COUNT(CASE WHEN lbl = '{lbl}' THEN 1 END) AS {n}"
                  for lbl, n in zip(C.CRITIC_LABELS, _CROSS_NAMES))},
       CAST({_rank_sql("review_score_description", C.REVIEW_DESC_ORDER)} AS INTEGER) AS rank
FROM (SELECT review_score_description, {critic_label_sql("critic_norm")} AS lbl FROM core) t
WHERE review_score_description IN ({", ".join(f"'{v}'" for v in C.REVIEW_DESC_ORDER)})
GROUP BY review_score_description""")
def tier_crosstab(spark, d):
    from catalink.operators.bins import crosstab
    return crosstab(core(spark, d), "review_score_description", C.REVIEW_DESC_ORDER,
                    X.critic_label("critic_norm"), C.CRITIC_LABELS, _CROSS_NAMES)


@query("owners_profile", with_core() + f"""
SELECT owners_range, COUNT(divergence_ratio) AS n_games, ROUND(AVG(divergence_ratio), 6) AS mean_div,
       CAST({_rank_sql("owners_range", C.OWNERS_ORDER)} AS INTEGER) AS rank
FROM core WHERE owners_range IN ({", ".join(f"'{v}'" for v in C.OWNERS_ORDER)})
GROUP BY owners_range""")
def owners_profile(spark, d):
    from catalink.operators.bins import ordered_profile
    out = ordered_profile(core(spark, d), "owners_range", C.OWNERS_ORDER, "divergence_ratio")
    return out.select("owners_range", "n_games", r6("mean_div"), "rank")


@query("free_vs_paid", with_core() + """
SELECT type, COUNT(divergence_ratio) AS count, ROUND(AVG(divergence_ratio), 6) AS mean,
       ROUND(MEDIAN(divergence_ratio), 6) AS median
FROM (SELECT CASE WHEN is_free = 0 THEN 'Paid' WHEN is_free = 1 THEN 'Free' END AS type,
             divergence_ratio FROM core WHERE is_free IS NOT NULL) t
WHERE type IS NOT NULL GROUP BY type""")
def free_vs_paid(spark, d):
    c = core(spark, d).where(F.col("is_free").isNotNull())
    typed = c.withColumn("type", X.code_label("is_free", {0: "Paid", 1: "Free"}))
    from catalink.operators.bins import bucket_profile
    out = bucket_profile(typed, F.col("type"), ["Free", "Paid"], "divergence_ratio", "type")
    return out.select("type", F.col("n_games").alias("count"), r6("mean"), r6("median"))


# --- signature values and both ends ---------------------------------------------

_Q2, _Q3 = C.QUADRANTS[1], C.QUADRANTS[2]


@query("signature_tags", with_core(S.TAGS_SQL) + f""",
grp AS (SELECT app_id, quadrant FROM core WHERE quadrant IN ('{_Q2}', '{_Q3}')),
sizes AS (SELECT COUNT(DISTINCT CASE WHEN quadrant = '{_Q2}' THEN app_id END) AS n_a,
                 COUNT(DISTINCT CASE WHEN quadrant = '{_Q3}' THEN app_id END) AS n_b FROM grp),
counts AS (SELECT t.tag, COUNT(CASE WHEN g.quadrant = '{_Q2}' THEN 1 END) AS c_a,
                  COUNT(CASE WHEN g.quadrant = '{_Q3}' THEN 1 END) AS c_b
           FROM tags_long t JOIN grp g ON t.app_id = g.app_id WHERE t.tag IS NOT NULL GROUP BY t.tag),
pcts AS (SELECT tag, c_a / n_a * 100 AS a_pct, c_b / n_b * 100 AS b_pct, n_a, n_b FROM counts, sizes),
scored AS (SELECT tag, a_pct, b_pct, a_pct / 100 * n_a + b_pct / 100 * n_b AS support,
                  a_pct - b_pct AS diff FROM pcts WHERE a_pct / 100 * n_a + b_pct / 100 * n_b >= 10),
top_ AS (SELECT *, '{_Q2}' AS side FROM scored ORDER BY diff DESC, tag LIMIT 15),
bot_ AS (SELECT *, '{_Q3}' AS side FROM scored ORDER BY diff ASC, tag LIMIT 15)
SELECT tag, ROUND(a_pct, 6) AS q2_pct, ROUND(b_pct, 6) AS q3_pct, ROUND(support, 6) AS support,
       ROUND(diff, 6) AS diff, side
FROM (SELECT * FROM top_ UNION ALL SELECT * FROM bot_) u""")
def signature_tags(spark, d):
    out = SL.signature_values(S.tags_long(spark, d), core(spark, d), "tag",
                              min_support=CFG.signature_min_support, n_each=CFG.signature_n_each)
    return out.select("tag", r6("a_pct", "q2_pct"), r6("b_pct", "q3_pct"), r6("support"),
                      r6("diff"), "side")


@query("rank_both_ends", with_core(S.CATEGORIES_SQL) + f""",
s AS (SELECT category, COUNT(DISTINCT app_id) AS n_games, AVG(divergence_ratio) AS mean_div,
             MEDIAN(divergence_ratio) AS median_div
      FROM (SELECT l.app_id, l.category, c.divergence_ratio FROM categories_long l
            JOIN core c ON l.app_id = c.app_id WHERE l.category IS NOT NULL) j
      GROUP BY category HAVING COUNT(DISTINCT app_id) >= {CFG.min_games_per_category})
SELECT category, n_games, ROUND(mean_div, 6) AS mean_div, ROUND(median_div, 6) AS median_div
FROM (SELECT * FROM (SELECT * FROM s ORDER BY mean_div DESC, category ASC LIMIT 20)
      UNION SELECT * FROM (SELECT * FROM s ORDER BY mean_div ASC, category DESC LIMIT 20)) u""")
def rank_both_ends(spark, d):
    from catalink.operators.ranking import both_ends
    stats = SL.slice_by_long_table(S.publishers_long(spark, d), core(spark, d), "category",
                                   CFG.min_games_per_category)
    ends = both_ends(stats.select("category", "n_games", "mean_div", "median_div"),
                     [("mean_div", True), ("category", False)], 20)
    return ends.select("category", "n_games", r6("mean_div"), r6("median_div"))


# --- membership and years -----------------------------------------------------------

@query("flag_share_by_year", S.with_ctes(*S.STAR_SQL, S.GENRES_SQL, S.PROMO_SQL) + """
SELECT year, COUNT(CASE WHEN has_flag THEN 1 END) AS count, COUNT(*) AS total,
       ROUND(COUNT(CASE WHEN has_flag THEN 1 END) / COUNT(*) * 100, 6) AS pct
FROM (SELECT CAST(year(g.release_date) AS INTEGER) AS year,
             g.app_id IN (SELECT app_id FROM promo_ids) AS has_flag FROM games g) t
WHERE year BETWEEN 1996 AND 2000 GROUP BY year""")
def flag_share_by_year(spark, d):
    from catalink.operators.aggregates import count_true_by_group
    from catalink.operators.joins import existence_flag
    g = existence_flag(S.games(spark, d), S.promo_ids(spark, d), "app_id", "has_flag")
    g = g.withColumn("year", F.year("release_date").cast("int")).where(F.col("year").between(1996, 2000))
    out = count_true_by_group(g, "year", "has_flag")
    return out.select("year", "count", "total", r6("pct"))


@query("year_counts", S.with_ctes(*S.STAR_SQL) + """
SELECT CAST(year(release_date) AS INTEGER) AS year, COUNT(*) AS count FROM games
WHERE release_date IS NOT NULL AND year(release_date) BETWEEN 1996 AND 2000 GROUP BY 1""")
def year_counts(spark, d):
    from catalink.operators.aggregates import value_counts_by_value
    y = S.games(spark, d).select(F.year("release_date").cast("int").alias("year"))
    return value_counts_by_value(y.where(F.col("year").between(1996, 2000)), "year")


@query("tag_frequency_pair", with_core(S.TAGS_SQL) + f""",
a AS (SELECT t.tag, COUNT(*) AS n_q2 FROM tags_long t JOIN core c ON t.app_id = c.app_id WHERE c.quadrant = '{_Q2}' GROUP BY t.tag),
b AS (SELECT t.tag, COUNT(*) AS n_q3 FROM tags_long t JOIN core c ON t.app_id = c.app_id WHERE c.quadrant = '{_Q3}' GROUP BY t.tag)
SELECT COALESCE(a.tag, b.tag) AS tag, COALESCE(n_q2, 0) AS n_q2, COALESCE(n_q3, 0) AS n_q3 FROM a FULL JOIN b ON a.tag = b.tag""")
def tag_frequency_pair(spark, d):
    """Two frequency tables side by side, gaps 0."""
    from catalink.operators.joins import full_outer_fill
    tagged = S.tags_long(spark, d).join(core(spark, d).select("app_id", "quadrant"), "app_id")
    one = lambda quadrant, name: tagged.where(F.col("quadrant") == quadrant).groupBy("tag").agg(F.count("*").alias(name))
    return full_outer_fill(one(_Q2, "n_q2"), one(_Q3, "n_q3"), "tag", {"n_q2": 0, "n_q3": 0})


@query("quadrant_report", with_core() + """
SELECT quadrant, COUNT(*) AS n, CAST(CAST(ROUND_EVEN(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM core WHERE quadrant IS NOT NULL), 1) AS DECIMAL(9, 1)) AS VARCHAR) || '%' AS share,
       ROUND(AVG(divergence_ratio), 2) AS mean_div
FROM core WHERE quadrant IS NOT NULL GROUP BY quadrant""")
def quadrant_report(spark, d):
    """Shares as percent text and a mean rounded for reading."""
    rows = core(spark, d).where(F.col("quadrant").isNotNull())
    total = rows.agg(F.count(F.lit(1)).cast("double")).scalar()
    out = rows.groupBy("quadrant").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("divergence_ratio"), 2).alias("mean_div"))
    return out.select("quadrant", "n", X.percent_text(F.col("n") * 100.0 / total, 1).alias("share"), "mean_div")


def _ends_sql(col: str, min_games: int, n: int) -> str:
    return f"""WITH s AS ({_entity_sql(col, min_games)})
SELECT * FROM (SELECT * FROM s ORDER BY mean_div DESC, {col} ASC LIMIT {n})
UNION SELECT * FROM (SELECT * FROM s ORDER BY mean_div ASC, {col} DESC LIMIT {n})"""


def _ends(spark, d, col, min_games, n):
    from catalink.operators.ranking import both_ends
    return both_ends(_entity(spark, d, col, min_games), [("mean_div", True), (col, False)], n)


@query("publisher_ends", _ends_sql("publisher", CFG.min_games_per_publisher, CFG.signature_n_each))
def publisher_ends(spark, d):
    """Publishers at both ends of the mean divergence."""
    return _ends(spark, d, "publisher", CFG.min_games_per_publisher, CFG.signature_n_each)


@query("developer_ends", _ends_sql("developer", CFG.min_games_per_developer, CFG.signature_n_each))
def developer_ends(spark, d):
    """Developers at both ends of the mean divergence."""
    return _ends(spark, d, "developer", CFG.min_games_per_developer, CFG.signature_n_each)
