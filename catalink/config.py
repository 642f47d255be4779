"""Thresholds, labels and token lists.

FIXED VALUES: the constants below must equal the analysed project's values so
that labels, buckets and filters give the same results.  They are stated
plainly and in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------

# Placeholder tokens read as missing (after stripping blanks).
MISSING_TOKENS = ("\\N", "N", "", "nan", "NaN", "None", "<NA>")
# The price column uses the same list without "<NA>".
PRICE_MISSING_TOKENS = ("N", "\\N", "", "nan", "NaN", "None")

# Ordered ownership ranges.
OWNERS_ORDER = (
    "0 .. 20,000",
    "20,000 .. 50,000",
    "50,000 .. 100,000",
    "100,000 .. 200,000",
    "200,000 .. 500,000",
    "500,000 .. 1,000,000",
    "1,000,000 .. 2,000,000",
    "2,000,000 .. 5,000,000",
    "5,000,000 .. 10,000,000",
    "10,000,000 .. 20,000,000",
    "20,000,000 .. 50,000,000",
    "50,000,000 .. 100,000,000",
    "100,000,000 .. 200,000,000",
)

# Ordered review tier descriptions, most negative first.
REVIEW_DESC_ORDER = (
    "Overwhelmingly Negative", "Very Negative", "Mostly Negative", "Negative",
    "Mixed",
    "Positive", "Mostly Positive", "Very Positive", "Overwhelmingly Positive",
)

QUADRANTS = ("Q1 Both Loved", "Q2 Player-Favored", "Q3 Critic-Favored", "Q4 Both Disliked")

# Critic score labels: [0,49] (49,74] (74,89] (89,100]
CRITIC_EDGES = (0, 49, 74, 89, 100)
CRITIC_LABELS = ("0-49 (bad)", "50-74 (mid)", "75-89 (good)", "90-100 (masterpiece)")

# Price buckets, right-closed: (-0.01,0.001] (0.001,5] (5,15] (15,30] (30,60] (60,inf)
PRICE_EDGES = (-0.01, 0.001, 5, 15, 30, 60)
PRICE_LABELS = ("0 (free)", "(0, 5]", "(5, 15]", "(15, 30]", "(30, 60]", "60+")

# Review-volume buckets, left-closed: [10,50) [50,200) ... [100000,inf)
VOLUME_EDGES = (10, 50, 200, 1000, 10_000, 100_000)
VOLUME_LABELS = ("10-49", "50-199", "200-999", "1k-9.9k", "10k-99k", "100k+")

# Match score buckets, descending cut-offs.
SCORE_BUCKETS = (
    (95, "95-100"),
    (90, "90-94"),
    (85, "85-89"),
    (83, "83-84"),
    (70, "70-82 (below threshold)"),
)
SCORE_BUCKET_FLOOR = "<70 (below threshold)"

# Edition keywords: whole-word, case-insensitive alternation (audit report).
RISK_KEYWORDS = (
    "GOTY", "Remastered", "Remaster", "Bundle", "Collection",
    "Definitive", "Complete", "Anthology", "Trilogy", "HD",
)
# Edition keywords: lower-case substring test, one keyword at a time (notebook flag).
VERSION_KEYWORDS = ("remastered", "hd", "goty", "definitive", "complete",
                    "collection", "anthology", "trilogy", "bundle")

# Sales measures summed per title, and their output names.
SALES_COLUMNS = ("NA_Sales", "EU_Sales", "JP_Sales", "Other_Sales", "Global_Sales")
SALES_RENAME = {
    "NA_Sales": "vg_na_sales",
    "EU_Sales": "vg_eu_sales",
    "JP_Sales": "vg_jp_sales",
    "Other_Sales": "vg_other_sales",
    "Global_Sales": "vg_global_sales",
}

# Review columns dropped by the review cleaner, and the numeric ones.
REVIEW_DROP_COLUMNS = ("steamspy_user_score", "reviews", "steamspy_score_rank")
REVIEW_NUMERIC_COLUMNS = (
    "app_id", "review_score", "positive", "negative", "total",
    "metacritic_score", "recommendations", "steamspy_positive", "steamspy_negative",
)

# Match thresholds.
SIMILARITY_THRESHOLD = 83
LOW_SCORE_FLAG = 87
SWEEP_THRESHOLDS = (83, 87, 90, 95)
LOW_PASS_BELOW = 88
NEAR_MISS_WIDTH = 8
LOW_PASS_ROWS = 15
HIGH_PASS_ROWS = 10
NEAR_MISS_ROWS = 15

# Year-trend confidence factor.
CI_Z = 1.96


@dataclass(frozen=True)
class DivergenceConfig:
    """Thresholds of the divergence analysis (defaults are the fixed values)."""

    min_total_reviews: int = 10
    player_love_threshold: float = 0.80
    critic_love_threshold: float = 75
    min_games_per_genre: int = 20
    min_games_per_category: int = 20
    min_games_per_publisher: int = 5
    min_games_per_developer: int = 5
    top_n: int = 15
    ranked_min_total: int = 200
    signature_min_support: int = 10
    signature_n_each: int = 15
    year_min_games: int = 5
    critic_bin_width: int = 5
    critic_bin_min_count: int = 5
