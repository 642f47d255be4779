"""Shared builders for the registered queries: the divergence core on the
stand-in star, in Spark and as SQL."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from catalink import config as C
from catalink.operators.metrics import divergence_core
from catalink.plans import standin as S
from catalink.session import cut_lineage

CFG = S.STANDIN_CONFIG


# Inputs shared by the parts of a composite query: built once, written as a
# table under the cluster's checkpoint folder (lineage cut), read many times.
_SHARED: dict[tuple[str, str], DataFrame] = {}


@contextmanager
def shared(spark: SparkSession, sf_dir: str, name: str, builder, written: bool = False):
    """Within the block, ``shared_get(name, sf_dir)`` returns the one materialised copy
    (``written``: what ``builder`` returns is a written table already)."""
    key = (name, sf_dir)
    if key in _SHARED:  # already shared by an enclosing composite
        yield _SHARED[key]
        return
    # composites read the input many times: always write it once
    built = builder(spark, sf_dir)
    _SHARED[key] = built if written else cut_lineage(built, name)
    try:
        yield _SHARED[key]
    finally:
        _SHARED.pop(key, None)


def shared_get(name: str, sf_dir: str) -> DataFrame | None:
    return _SHARED.get((name, sf_dir))


def build_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_core(S.reviews(spark, sf_dir), S.games(spark, sf_dir), CFG)


def core(spark: SparkSession, sf_dir: str) -> DataFrame:
    cached = shared_get("core", sf_dir)
    return cached if cached is not None else build_core(spark, sf_dir)


def _quadrant_sql(pr: str, cn: str) -> str:
    p_ok = f"COALESCE({pr} >= {CFG.player_love_threshold}, false)"
    c_ok = f"COALESCE({cn} >= {CFG.critic_love_threshold}, false)"
    q = C.QUADRANTS
    return (f"CASE WHEN {p_ok} AND {c_ok} THEN '{q[0]}' WHEN {p_ok} THEN '{q[1]}' "
            f"WHEN {c_ok} THEN '{q[2]}' ELSE '{q[3]}' END")


CORE_SQL = f"""core0 AS (
  SELECT r.app_id, r.review_score, r.review_score_description, r.positive, r.negative, r.total,
         r.metacritic_score, g.name, g.release_date, g.is_free, g.developer, g.publisher,
         g.owners_range, g.price,
         CAST(year(g.release_date) AS INTEGER) AS release_year,
         r.positive / r.total AS player_ratio,
         r.positive / r.total * 100 AS player_ratio_100,
         CAST(r.review_score AS DOUBLE) / 9 * 100 AS player_norm,
         CAST(r.metacritic_score AS DOUBLE) AS critic_norm
  FROM reviews r LEFT JOIN games g ON r.app_id = g.app_id
  WHERE r.metacritic_score IS NOT NULL AND r.total >= {CFG.min_total_reviews}
),
core AS (
  SELECT *, player_ratio_100 - critic_norm AS divergence_ratio,
         player_norm - critic_norm AS divergence_tier,
         {_quadrant_sql('player_ratio', 'critic_norm')} AS quadrant
  FROM core0
)"""

# WITH prefix giving reviews, games and core.
CORE_WITH = S.with_ctes(*S.STAR_SQL, CORE_SQL)


def with_core(*extra: str) -> str:
    return S.with_ctes(*S.STAR_SQL, CORE_SQL, *extra)
