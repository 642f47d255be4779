"""Stand-in star: the driver's TPC-H-like tables in the roles of the catalogue.

| role                         | expression                                                |
|------------------------------|-----------------------------------------------------------|
| entity key, title            | ``p_partkey``, ``p_name``                                 |
| total / positive / negative  | ``sum(l_quantity)``: all / not returned / returned        |
| critic score (nullable)      | ``p_size * 2`` unless ``p_size % 5 = 0``                  |
| review tier 0-9              | ``floor(positive * 9 / total)``                           |
| publisher / developer        | ``p_brand`` / ``p_brand || ' ' || p_type``                |
| genre / tag long tables      | ``(p_partkey, p_type)`` / words of ``p_name``             |
| price, is_free               | ``floor(p_retailprice) % 80``, ``price = 0``              |
| owners range                 | band of ``p_size`` in the ordered range list              |
| release date                 | ship date of the part's first line (by order, line)       |
| sales rows                   | line items: title ``p_name``, platform flag+status        |

Each builder has an SQL twin (``*_SQL``) used by the DuckDB oracle.  The
line-item aggregate is one ``groupBy(l_partkey)`` that reviews and games build on; where a
query needs columns of both it is planned for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalink import config as C
from catalink.config import DivergenceConfig
from catalink.session import table_path

# Thresholds for the stand-in data: on part/lineitem the positive ratio sits
# around 0.67, so the player threshold 0.80 would leave Q1 nearly empty.
STANDIN_CONFIG = DivergenceConfig(player_love_threshold=0.67, critic_love_threshold=75)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# --- line-item aggregate per part -------------------------------------------

def part_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    returned = F.col("l_returnflag") == "R"
    return (li.groupBy(F.col("l_partkey").alias("app_id"))
              .agg(F.sum("l_quantity").cast("bigint").alias("total"),
                   F.sum(F.when(~returned, F.col("l_quantity")).otherwise(0.0)).cast("bigint").alias("positive"),
                   F.sum(F.when(returned, F.col("l_quantity")).otherwise(0.0)).cast("bigint").alias("negative"),
                   F.min_by("l_shipdate", _line_order()).cast("date").alias("release_date")))


def _line_order():
    """The order (order key, line number, ship day) as one decimal of 36 digits: 19 for any
    bigint, 10 for any integer, 7 for any date.  Its buffer has a fixed width, so the
    first-line aggregate stays a hash aggregate (a struct-ordered ``min_by`` falls back to a
    sort aggregate)."""
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")) + 1_000_000
    line = F.col("l_linenumber").cast("decimal(10,0)")
    return (F.col("l_orderkey").cast("decimal(19,0)") * F.expr("10000000000BD") + line) * F.expr("10000000BD") + days.cast("decimal(7,0)")


PART_STATS_SQL = """part_stats AS (
  SELECT l_partkey AS app_id,
         CAST(SUM(l_quantity) AS BIGINT) AS total,
         CAST(SUM(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0.0 END) AS BIGINT) AS positive,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS BIGINT) AS negative,
         CAST(arg_min(l_shipdate, {'o': l_orderkey, 'l': l_linenumber, 's': l_shipdate}) AS DATE) AS release_date
  FROM lineitem GROUP BY l_partkey
)"""


# --- reviews ------------------------------------------------------------------

def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """app_id, review_score, review_score_description, positive, negative, total, metacritic_score."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_size")
    tier = F.floor(F.try_divide(F.col("positive") * 9.0, F.col("total"))).cast("bigint")
    desc = F.element_at(F.array(*[F.lit(d) for d in C.REVIEW_DESC_ORDER]),
                        F.least(F.greatest(tier, F.lit(1)), F.lit(9)).cast("int"))
    critic = F.when(F.col("p_size") % 5 != 0, F.col("p_size") * 2).cast("bigint")
    return (part_stats(spark, sf_dir)
            .join(part, F.col("app_id") == F.col("p_partkey"), "inner")
            .select("app_id", tier.alias("review_score"), desc.alias("review_score_description"),
                    "positive", "negative", "total", critic.alias("metacritic_score")))


REVIEWS_SQL = f"""reviews AS (
  SELECT s.app_id,
         CAST(FLOOR(s.positive * 9.0 / s.total) AS BIGINT) AS review_score,
         {_sql_list(C.REVIEW_DESC_ORDER)}[CAST(LEAST(GREATEST(FLOOR(s.positive * 9.0 / s.total), 1), 9) AS INTEGER)]
             AS review_score_description,
         s.positive, s.negative, s.total,
         CAST(CASE WHEN p.p_size % 5 <> 0 THEN p.p_size * 2 END AS BIGINT) AS metacritic_score
  FROM part_stats s JOIN part p ON s.app_id = p.p_partkey
)"""


# --- games --------------------------------------------------------------------

def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """app_id, name, release_date, is_free, developer, publisher, owners_range, price."""
    part = read(spark, sf_dir, "part")
    stats = part_stats(spark, sf_dir).select("app_id", "release_date")
    price = (F.floor("p_retailprice").cast("bigint") % 80)
    band = F.least(F.floor((F.col("p_size") - 1) / 4.0) + 1, F.lit(len(C.OWNERS_ORDER))).cast("int")
    owners = F.element_at(F.array(*[F.lit(o) for o in C.OWNERS_ORDER]), band)
    return (part.join(stats, F.col("p_partkey") == F.col("app_id"), "left")
                .select(F.col("p_partkey").alias("app_id"), F.col("p_name").alias("name"),
                        "release_date",
                        F.when(price == 0, 1).otherwise(0).cast("bigint").alias("is_free"),
                        F.concat_ws(" ", "p_brand", "p_type").alias("developer"),
                        F.col("p_brand").alias("publisher"),
                        owners.alias("owners_range"),
                        price.cast("double").alias("price")))


GAMES_SQL = f"""games AS (
  SELECT p.p_partkey AS app_id, p.p_name AS name, s.release_date,
         CAST(CASE WHEN CAST(FLOOR(p.p_retailprice) AS BIGINT) % 80 = 0 THEN 1 ELSE 0 END AS BIGINT) AS is_free,
         p.p_brand || ' ' || p.p_type AS developer,
         p.p_brand AS publisher,
         {_sql_list(C.OWNERS_ORDER)}[CAST(LEAST(FLOOR((p.p_size - 1) / 4.0) + 1, {len(C.OWNERS_ORDER)}) AS INTEGER)]
             AS owners_range,
         CAST(CAST(FLOOR(p.p_retailprice) AS BIGINT) % 80 AS DOUBLE) AS price
  FROM part p LEFT JOIN (SELECT app_id, release_date FROM part_stats) s ON p.p_partkey = s.app_id
)"""


# --- long tables ----------------------------------------------------------------

def genres_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("app_id"),
                                              F.col("p_type").alias("genre"))


GENRES_SQL = """genres_long AS (SELECT p_partkey AS app_id, p_type AS genre FROM part)"""


def tags_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("app_id"),
                       F.explode(F.split("p_name", " ")).alias("tag"))


TAGS_SQL = """tags_long AS (
  SELECT p_partkey AS app_id, unnest(string_split(p_name, ' ')) AS tag FROM part
)"""


def publishers_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(app_id, category): the brand as a second long attribute."""
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("app_id"),
                                              F.col("p_brand").alias("category"))


CATEGORIES_SQL = """categories_long AS (SELECT p_partkey AS app_id, p_brand AS category FROM part)"""


# --- sales rows -----------------------------------------------------------------

def sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name, Platform and five sales measures (NA_Sales as text with a junk token)."""
    li = read(spark, sf_dir, "lineitem")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    na_text = F.when(F.col("l_linenumber") == 7, F.lit("N/A")).otherwise(
        F.col("l_quantity").cast("string"))
    return (li.join(part, F.col("l_partkey") == F.col("p_partkey"), "inner")
              .select(F.col("p_name").alias("Name"),
                      F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("Platform"),
                      na_text.alias("NA_Sales"),
                      F.col("l_extendedprice").alias("EU_Sales"),
                      F.col("l_discount").alias("JP_Sales"),
                      F.col("l_tax").alias("Other_Sales"),
                      (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("Global_Sales")))


SALES_SQL = """sales_rows AS (
  SELECT p.p_name AS Name, l.l_returnflag || l.l_linestatus AS Platform,
         CASE WHEN l.l_linenumber = 7 THEN 'N/A' ELSE CAST(l.l_quantity AS VARCHAR) END AS NA_Sales,
         l.l_extendedprice AS EU_Sales, l.l_discount AS JP_Sales, l.l_tax AS Other_Sales,
         l.l_extendedprice * (1 - l.l_discount) AS Global_Sales
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""


def match_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles to be matched: ``p_name || ' ' || p_type`` per part (app_id, name)."""
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("app_id"),
        F.concat_ws(" ", "p_name", "p_type").alias("name"))


MATCH_QUERIES_SQL = """match_queries AS (
  SELECT p_partkey AS app_id, p_name || ' ' || p_type AS name FROM part
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


STAR_SQL = (PART_STATS_SQL, REVIEWS_SQL, GAMES_SQL)


# --- orders as review-volume entities -----------------------------------------------

def order_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: total quantity, player ratio, a critic-like score from the
    order price, and the absolute divergence between them."""
    li = read(spark, sf_dir, "lineitem")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    per_order = (li.groupBy("l_orderkey")
                   .agg(F.sum("l_quantity").cast("bigint").alias("total"),
                        F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))
                              .otherwise(0.0)).cast("bigint").alias("positive")))
    critic = (F.floor("o_totalprice").cast("bigint") % 101).cast("double")
    return (per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
                     .select(F.col("l_orderkey").alias("order_id"), "total",
                             F.abs(F.try_divide(F.col("positive").cast("double"), F.col("total")) * 100
                                   - critic).alias("abs_div")))


ORDER_VOLUME_SQL = """order_volume AS (
  SELECT l.l_orderkey AS order_id, l.total,
         abs(l.positive / l.total * 100 - CAST(CAST(FLOOR(o.o_totalprice) AS BIGINT) % 101 AS DOUBLE)) AS abs_div
  FROM (SELECT l_orderkey, CAST(SUM(l_quantity) AS BIGINT) AS total,
               CAST(SUM(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0.0 END) AS BIGINT) AS positive
        FROM lineitem GROUP BY l_orderkey) l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""


def promo_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids carrying the flagged attribute (genre PROMO): the membership set."""
    return genres_long(spark, sf_dir).where(F.col("genre") == "PROMO").select("app_id")


PROMO_SQL = """promo_ids AS (SELECT app_id FROM genres_long WHERE genre = 'PROMO')"""
