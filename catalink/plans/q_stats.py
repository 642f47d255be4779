"""Statistics queries: correlations, describe, year trend, histograms, box
statistics, funnel and group sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalink import config as C
from catalink.functions import expressions as X
from catalink.operators import aggregates as A
from catalink.operators import histogram as H
from catalink.operators import ranks as R
from catalink.operators.metrics import stage_counts
from catalink.plans import standin as S
from catalink.plans.common import CFG, core, with_core
from catalink.plans.q_divergence import price_bucket_sql
from catalink.plans.registry import query, r6

_PAIRS = [("player_ratio_100", "critic_norm"), ("player_norm", "critic_norm"),
          ("abs_div", "log_total")]


def _with_volume(df):
    return df.withColumns({"abs_div": F.abs("divergence_ratio"), "log_total": X.safe_log10("total")})


_CORE_V = """corev AS (SELECT *, abs(divergence_ratio) AS abs_div,
                      CASE WHEN total > 0 THEN log10(total) END AS log_total FROM core)"""


def _pair_union(template: str) -> str:
    return " UNION ALL ".join(template.format(x=x, y=y) for x, y in _PAIRS)


@query("pearson", with_core(_CORE_V) + _pair_union("""
SELECT '{x}' AS x, '{y}' AS y,
       ROUND(CASE WHEN var_pop({x}) > 0 AND var_pop({y}) > 0 THEN corr({x}, {y}) END, 6) AS pearson
FROM corev WHERE {x} IS NOT NULL AND {y} IS NOT NULL"""))
def pearson(spark, d):
    return A.pearson(_with_volume(core(spark, d)), _PAIRS).select("x", "y", r6("pearson"))


@query("spearman", with_core(_CORE_V) + _pair_union("""
SELECT '{x}' AS x, '{y}' AS y,
       ROUND(CASE WHEN var_pop(rx) > 0 AND var_pop(ry) > 0 THEN corr(rx, ry) END, 6) AS spearman
FROM (SELECT RANK() OVER (ORDER BY {x}) + (COUNT(*) OVER (PARTITION BY {x}) - 1) / 2.0 AS rx,
             RANK() OVER (ORDER BY {y}) + (COUNT(*) OVER (PARTITION BY {y}) - 1) / 2.0 AS ry
      FROM corev WHERE {x} IS NOT NULL AND {y} IS NOT NULL) t"""))
def spearman(spark, d):
    c = _with_volume(core(spark, d))
    return R.spearman_frame(c, _PAIRS).select("x", "y", r6("spearman"))


_DESC_COLS = ["player_ratio_100", "player_norm", "critic_norm", "divergence_ratio", "divergence_tier"]


@query("describe_metrics", with_core() + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean,
       ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(MIN({c}), 6) AS min,
       ROUND(quantile_cont({c}, 0.25), 6) AS p25, ROUND(quantile_cont({c}, 0.5), 6) AS p50,
       ROUND(quantile_cont({c}, 0.75), 6) AS p75, ROUND(MAX({c}), 6) AS max FROM core"""
                                                             for c in _DESC_COLS))
def describe_metrics(spark, d):
    out = A.describe(core(spark, d), _DESC_COLS)
    return out.select("column", "count", *[r6(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


_YEAR_SQL = f"""yt AS (
  SELECT release_year, COUNT(*) AS n_games, AVG(divergence_ratio) AS mean_div,
         CASE WHEN COUNT(divergence_ratio) > 1 THEN STDDEV_SAMP(divergence_ratio) / SQRT(COUNT(*)) END AS sem
  FROM core WHERE release_year IS NOT NULL GROUP BY release_year HAVING COUNT(*) >= {CFG.year_min_games}
)"""


@query("year_trend_ci", with_core(_YEAR_SQL) + f"""
SELECT release_year, n_games, ROUND(mean_div, 6) AS mean_div, ROUND(sem, 6) AS sem,
       ROUND(sem * {C.CI_Z}, 6) AS ci95, ROUND(mean_div - sem * {C.CI_Z}, 6) AS lower,
       ROUND(mean_div + sem * {C.CI_Z}, 6) AS upper
FROM yt""")
def year_trend_ci(spark, d):
    out = A.year_trend(core(spark, d), "release_year", "divergence_ratio", CFG.year_min_games)
    return out.select("release_year", "n_games", *[r6(c) for c in ("mean_div", "sem", "ci95", "lower", "upper")])


@query("extreme_years", with_core(_YEAR_SQL) + """
SELECT 'max' AS extreme, release_year, n_games, ROUND(mean_div, 6) AS mean_div
FROM (SELECT * FROM yt ORDER BY mean_div DESC, release_year LIMIT 1) a
UNION ALL
SELECT 'min' AS extreme, release_year, n_games, ROUND(mean_div, 6) AS mean_div
FROM (SELECT * FROM yt ORDER BY mean_div ASC, release_year LIMIT 1) b""")
def extreme_years(spark, d):
    yt = A.year_trend(core(spark, d), "release_year", "divergence_ratio", CFG.year_min_games)
    out = A.extreme_rows(yt, "release_year", "mean_div", ["release_year", "n_games", "mean_div"])
    return out.select("extreme", "release_year", "n_games", r6("mean_div"))


# --- histograms -----------------------------------------------------------------

def _hist_sql(values_sql: str, bins: int, density: bool = False, group: str | None = None) -> str:
    """Equal-width histogram in SQL; optional population column ``group``."""
    g = f"{group}, " if group else ""
    gsel = f"r.{group}, " if group else ""
    gjoin = f" AND c.{group} = r.{group}" if group else ""
    gby = f"GROUP BY {group}" if group else ""
    dens = (f", ROUND(COALESCE(c.cnt, 0) / (r.n * ((r.hi - r.lo) / {float(bins)})), 6) AS density"
            if density else "")
    return f"""v AS ({values_sql}),
r AS (SELECT {g}CASE WHEN MIN(value) = MAX(value) THEN MIN(value) - 0.5 ELSE MIN(value) END AS lo,
             CASE WHEN MIN(value) = MAX(value) THEN MAX(value) + 0.5 ELSE MAX(value) END AS hi,
             COUNT(*) AS n FROM v {gby}),
b AS (SELECT CAST(unnest(range(0, {bins})) AS INTEGER) AS bin),
e AS (SELECT {gsel}b.bin, r.lo + b.bin * ((r.hi - r.lo) / {float(bins)}) AS at, r.lo + (b.bin + 1) * ((r.hi - r.lo) / {float(bins)}) AS below
      FROM r CROSS JOIN b),
c AS (SELECT {"e." + group + ", " if group else ""}e.bin, COUNT(*) AS cnt
      FROM v JOIN e ON v.value >= e.at AND (v.value < e.below OR e.bin = {bins - 1}){" AND v." + group + " = e." + group if group else ""} GROUP BY ALL)
SELECT {gsel}b.bin, ROUND(r.lo + b.bin * ((r.hi - r.lo) / {float(bins)}), 6) AS lo,
       ROUND(r.lo + (b.bin + 1) * ((r.hi - r.lo) / {float(bins)}), 6) AS hi,
       COALESCE(c.cnt, 0) AS count{dens}
FROM b CROSS JOIN r LEFT JOIN c ON c.bin = b.bin{gjoin}"""


def _hist_out(df, density=False):
    cols = ["bin", r6("lo"), r6("hi"), "count"] + ([r6("density")] if density else [])
    return df.select(*cols)


@query("histogram", "WITH " + _hist_sql(
    "SELECT LEAST(l_quantity, 20) AS value FROM lineitem WHERE l_quantity IS NOT NULL", 21))
def histogram(spark, d):
    li = S.read(spark, d, "lineitem")
    return _hist_out(H.histogram(li, X.cap("l_quantity", 20), 21))


_OWNERS_MID_SQL = """SELECT log10(CASE WHEN mid = 0 THEN 1 ELSE mid END) AS value
FROM (SELECT CAST(FLOOR((lo + hi) / 2) AS BIGINT) AS mid
      FROM (SELECT COALESCE(CAST(trunc(TRY_CAST(trim(split_part(replace(owners_range, ',', ''), '..', 1)) AS DOUBLE)) AS BIGINT), 0) AS lo,
                   COALESCE(CAST(trunc(TRY_CAST(trim(split_part(replace(owners_range, ',', ''), '..', 2)) AS DOUBLE)) AS BIGINT), 0) AS hi
            FROM games) o) m WHERE mid >= 0"""


@query("histogram_log", S.with_ctes(*S.STAR_SQL) + ", " + _hist_sql(_OWNERS_MID_SQL, 30))
def histogram_log(spark, d):
    g = S.games(spark, d).withColumn("owners_mid", X.owners_bounds("owners_range").getField("mid"))
    return _hist_out(H.log_histogram(g, "owners_mid", 30))


_DENSITY_VALUES = f"""SELECT 'all' AS population, CAST(year(release_date) AS DOUBLE) AS value FROM games
  WHERE year(release_date) BETWEEN 1995 AND 2001
UNION ALL
SELECT 'q1' AS population, CAST(year(release_date) AS DOUBLE) AS value FROM games
  WHERE year(release_date) BETWEEN 1995 AND 2001
    AND app_id IN (SELECT app_id FROM core WHERE quadrant = '{C.QUADRANTS[0]}')"""


@query("histogram_density", with_core() + ", " + _hist_sql(_DENSITY_VALUES, 7, density=True,
                                                            group="population"))
def histogram_density(spark, d):
    from catalink.operators.joins import semi_join
    games = S.games(spark, d).withColumn("year", F.year("release_date").cast("double")) \
                             .where(F.col("year").between(1995, 2001))
    q1 = core(spark, d).where(F.col("quadrant") == C.QUADRANTS[0]).select("app_id")
    parts = []
    for name, pop in (("all", games), ("q1", semi_join(games, q1, "app_id"))):
        h = _hist_out(H.histogram(pop, "year", 7, density=True), density=True)
        parts.append(h.withColumn("population", F.lit(name)))
    return parts[0].unionByName(parts[1])


@query("box_stats", with_core() + f""",
dd AS (SELECT {price_bucket_sql("price")} AS price_bucket, divergence_ratio AS v FROM core
       WHERE divergence_ratio IS NOT NULL),
d2 AS (SELECT * FROM dd WHERE price_bucket IS NOT NULL),
q AS (SELECT price_bucket, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM d2 GROUP BY price_bucket),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS flo, q3 + 1.5 * (q3 - q1) AS fhi FROM q)
SELECT d2.price_bucket, ROUND(f.q1, 6) AS q1, ROUND(f.median, 6) AS median, ROUND(f.q3, 6) AS q3,
       COUNT(*) AS n,
       ROUND(MIN(CASE WHEN v >= flo AND v <= fhi THEN v END), 6) AS whisker_lo,
       ROUND(MAX(CASE WHEN v >= flo AND v <= fhi THEN v END), 6) AS whisker_hi,
       COUNT(CASE WHEN NOT (v >= flo AND v <= fhi) THEN 1 END) AS n_outliers
FROM d2 JOIN f ON d2.price_bucket = f.price_bucket
GROUP BY d2.price_bucket, f.q1, f.median, f.q3""")
def box_stats(spark, d):
    c = core(spark, d).withColumn("price_bucket", X.price_bucket("price"))
    out = H.box_stats(c, "price_bucket", "divergence_ratio")
    return out.select("price_bucket", r6("q1"), r6("median"), r6("q3"), "n", r6("whisker_lo"),
                      r6("whisker_hi"), "n_outliers")


# --- funnel and group sizes ------------------------------------------------------

@query("funnel", S.with_ctes(*S.STAR_SQL) + f"""
SELECT CAST(step AS INTEGER) AS step, stage, rows, ROUND(CAST(rows AS DOUBLE) * 100 / raw, 6) AS pct_of_raw
FROM (SELECT COUNT(*) AS raw,
             COUNT(CASE WHEN metacritic_score IS NOT NULL THEN 1 END) AS has_critic,
             COUNT(CASE WHEN metacritic_score IS NOT NULL AND total >= {CFG.min_total_reviews} THEN 1 END) AS core_n
      FROM reviews r LEFT JOIN games g ON r.app_id = g.app_id) t,
     LATERAL (VALUES (1, 'Raw reviews rows', raw), (2, 'Has metacritic_score', has_critic),
                     (3, 'And total >= {CFG.min_total_reviews} (core analysis sample)', core_n)) v(step, stage, rows)""")
def funnel(spark, d):
    out = stage_counts(S.reviews(spark, d), S.games(spark, d), CFG)
    return out.select("step", "stage", "rows", r6("pct_of_raw"))


_CUTOFF = "1998-11-01"


def dlc_counts(spark, d):
    """Per part: line items with a discount of 8% or more (the add-on count)."""
    li = S.read(spark, d, "lineitem")
    return li.groupBy(F.col("l_partkey").alias("app_id")) \
             .agg(F.count_if(F.col("l_discount") >= 0.08).alias("dlc_count"))


@query("group_sizes", S.with_ctes(*S.STAR_SQL, S.GENRES_SQL, S.PROMO_SQL) + f""",
dlc AS (SELECT l_partkey AS app_id, COUNT(CASE WHEN l_discount >= 0.08 THEN 1 END) AS dlc_count
        FROM lineitem GROUP BY l_partkey),
g AS (SELECT g.*, dlc.dlc_count, g.app_id IN (SELECT app_id FROM promo_ids) AS has_flag, r.review_score
      FROM games g LEFT JOIN dlc ON g.app_id = dlc.app_id LEFT JOIN reviews r ON g.app_id = r.app_id)
SELECT metric, value FROM (
  SELECT COUNT(CASE WHEN dlc_count >= 5 THEN 1 END) AS a, COUNT(CASE WHEN dlc_count = 0 THEN 1 END) AS b,
         COUNT(CASE WHEN has_flag AND release_date IS NOT NULL AND release_date < DATE '{_CUTOFF}' THEN 1 END) AS c,
         COUNT(CASE WHEN has_flag AND release_date IS NOT NULL AND release_date >= DATE '{_CUTOFF}' THEN 1 END) AS d,
         COUNT(CASE WHEN review_score IS NOT NULL AND is_free = 0 THEN 1 END) AS e,
         COUNT(CASE WHEN review_score IS NOT NULL AND is_free = 1 THEN 1 END) AS f
  FROM g) t,
  LATERAL (VALUES ('h1_heavy', a), ('h1_none', b), ('h2_pre', c), ('h2_post', d),
                  ('h3_paid', e), ('h3_free', f)) v(metric, value)""")
def group_sizes(spark, d):
    from catalink.operators.joins import existence_flag
    g = S.games(spark, d).join(dlc_counts(spark, d), "app_id", "left") \
                         .join(S.reviews(spark, d).select("app_id", "review_score"), "app_id", "left")
    g = existence_flag(g, S.promo_ids(spark, d), "app_id", "has_flag")
    for col in ("dlc_count", "review_score"):  # the checks need these columns
        if col not in g.columns:
            raise ValueError(f"column {col} is required")
    dated = F.col("has_flag") & F.col("release_date").isNotNull()
    cutoff = F.lit(_CUTOFF).cast("date")
    scored = F.col("review_score").isNotNull()
    return A.conditional_counts(g, {
        "h1_heavy": F.col("dlc_count") >= 5,
        "h1_none": F.col("dlc_count") == 0,
        "h2_pre": dated & (F.col("release_date") < cutoff),
        "h2_post": dated & (F.col("release_date") >= cutoff),
        "h3_paid": scored & (F.col("is_free") == 0),
        "h3_free": scored & (F.col("is_free") == 1),
    })
