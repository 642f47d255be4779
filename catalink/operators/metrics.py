"""Two-yardstick divergence: core sample, derived metrics, quadrant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalink.config import DivergenceConfig
from catalink.functions.expressions import quadrant


def core_sample(reviews: DataFrame, games: DataFrame, cfg: DivergenceConfig,
                key: str = "app_id", critic: str = "metacritic_score",
                total: str = "total") -> DataFrame:
    """reviews LEFT JOIN games on the key, keep rows with a critic score and
    at least ``min_total_reviews`` player reviews, add the release year."""
    merged = reviews.join(games, on=key, how="left")
    core = merged.where(F.col(critic).isNotNull() & (F.col(total) >= cfg.min_total_reviews))
    if "release_date" in games.columns:
        core = core.withColumn("release_year", F.year(F.col("release_date").try_cast("date")).cast("int"))
    return core


def add_divergence_metrics(core: DataFrame, cfg: DivergenceConfig, positive: str = "positive",
                           total: str = "total", tier: str = "review_score",
                           critic: str = "metacritic_score") -> DataFrame:
    """player_ratio, player_ratio_100, player_norm, critic_norm, the two
    divergences and the quadrant label (division by zero gives null)."""
    ratio = F.try_divide(F.col(positive).cast("double"), F.col(total))
    return (core.withColumns({
        "player_ratio": ratio,
        "player_ratio_100": ratio * 100,
        "player_norm": F.col(tier).cast("double") / 9 * 100,
        "critic_norm": F.col(critic).cast("double"),
    }).withColumns({
        "divergence_ratio": F.col("player_ratio_100") - F.col("critic_norm"),
        "divergence_tier": F.col("player_norm") - F.col("critic_norm"),
        "quadrant": quadrant("player_ratio", "critic_norm", cfg.player_love_threshold,
                             cfg.critic_love_threshold),
    }))


def divergence_core(reviews: DataFrame, games: DataFrame, cfg: DivergenceConfig) -> DataFrame:
    return add_divergence_metrics(core_sample(reviews, games, cfg), cfg)


def stage_counts(reviews: DataFrame, games: DataFrame, cfg: DivergenceConfig,
                 key: str = "app_id", critic: str = "metacritic_score",
                 total: str = "total") -> DataFrame:
    """Funnel: raw rows, rows with a critic score, core rows, and percent of raw."""
    merged = reviews.join(games, on=key, how="left")
    has_critic = F.col(critic).isNotNull()
    row = merged.agg(F.count(F.lit(1)).alias("_raw"),
                     F.count_if(has_critic).alias("_critic"),
                     F.count_if(has_critic & (F.col(total) >= cfg.min_total_reviews)).alias("_core"))
    stages = [("Raw reviews rows", "_raw"), ("Has metacritic_score", "_critic"),
              (f"And total >= {cfg.min_total_reviews} (core analysis sample)", "_core")]
    items = [F.struct(F.lit(i + 1).alias("step"), F.lit(name).alias("stage"),
                      F.col(c).alias("rows"),
                      F.try_divide(F.col(c) * 100.0, F.col("_raw")).alias("pct_of_raw"))
             for i, (name, c) in enumerate(stages)]
    return row.select(F.inline(F.array(*items)))
