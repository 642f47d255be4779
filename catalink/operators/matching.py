"""Title linking: per-title sales rollup, TF-IDF character n-gram top-1
retrieval, token-sort scoring, acceptance and the match audit.

Top-1 retrieval is an inverted-index equi-join, never an N x M cross product:

1. explode each title into word-bounded char n-grams; term counts per
   (title, n-gram) with partial aggregation;
2. document frequency per n-gram on the candidate side only; idf is
   ``ln((1 + n) / (1 + df)) + 1`` with ``n`` a scalar subquery;
3. weights ``tf * idf``, L2-normalised per title (query n-grams outside the
   candidate vocabulary drop out in the inner join with the idf table);
4. a lower bound of each query's best similarity: the shortest candidate that has its rarest
   shared word, or one of its rarest n-grams where these are rarer, is scored exactly;
5. n-grams have one order, rarest first.  What a pair shares from an n-gram on is at most the
   product of both titles' remaining norms, so the postings are joined only where that
   product reaches the bound; a pair goes on only if the products summed there plus what can
   remain behind them reach it, and if the products of the titles' norms within blocks of
   n-grams do.  The best candidate always does, by its first shared n-gram;
6. the pairs left are scored exactly, and the best per query is
   ``min(struct(-round(sim, 9), title))``: highest similarity, then the smallest title.

The candidates' side is an index of bucketed tables (``title_index``), which further matches
join without a shuffle.  A frequent n-gram would put |Q_g| x |C_g| pairs in one task, so its
postings are split on both sides into parts of about ``salt_rows``, and each part meets each
of the other side.

Exact: no n-gram or candidate cap.  Queries that share no n-gram with any
candidate get no candidate (similarity 0, distance 1).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalink import config as C
from catalink.functions.expressions import (
    edition_mismatch,
    keyword_on_one_side,
    length_gap,
    safe_double,
    score_bucket,
    sorted_set_joined,
)
from catalink.functions.text import char_wb_ngrams, counted, token_sort_ratio
from catalink.operators.dedupe import keep_first, top_k_per_group
from catalink.operators.quantiles import percentile_map
from catalink.operators.ranking import top_n

if TYPE_CHECKING:
    from catalink.operators.title_index import TitleIndex

SIM_DIGITS = 9
#: Rarest n-grams of a query whose best candidates give the lower bound.
SEEDS = 4
#: What the bound gives way for rounding to ``SIM_DIGITS``, for sums in another order and for
#: the single precision of the index's postings (6e-8 of a factor; no sum is above 1).
SLACK = 1e-6


# --- sales rollup -------------------------------------------------------------

def title_rollup(sales: DataFrame, name: str = "Name", platform: str = "Platform",
                 measures: Sequence[str] = C.SALES_COLUMNS, pre_dedupe_order: str | None = None
                 ) -> DataFrame:
    """One row per title: measures coerced to numbers (unparsable = 0) and
    summed, distinct platforms sorted and joined by ``|``.

    ``pre_dedupe_order`` reproduces the as-written variant that keeps only the
    first row per title (in that order) before aggregating.
    """
    rows = sales.where(F.col(name).isNotNull())
    if pre_dedupe_order:
        rows = keep_first(rows, [name], [pre_dedupe_order])
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
               T.DecimalType)
    types = {f.name: f.dataType for f in rows.schema.fields}

    def as_number(m: str) -> Column:
        x = F.col(m).cast("double") if isinstance(types[m], numeric) else safe_double(m)
        return F.coalesce(x, F.lit(0.0))

    return rows.groupBy(name).agg(*[F.sum(as_number(m)).alias(m) for m in measures],
                                  sorted_set_joined(platform).alias("vg_platform"))


# --- TF-IDF ---------------------------------------------------------------------

def ngram_counts(docs: DataFrame, id_col: str, text_col: str, n_min: int = 3,
                 n_max: int = 5, distinct: bool = False) -> DataFrame:
    """(id, gram, tf): raw term counts of word-bounded char n-grams.  ``distinct``: no id comes
    twice, so that each row's n-grams are counted where they are made."""
    if distinct:
        return docs.where(F.col(text_col).isNotNull()).select(id_col, F.inline(counted(char_wb_ngrams(text_col, n_min, n_max))))
    grams = docs.where(F.col(text_col).isNotNull()) \
                .select(id_col, F.explode(char_wb_ngrams(text_col, n_min, n_max)).alias("gram"))
    return grams.groupBy(id_col, "gram").agg(F.count(F.lit(1)).alias("tf"))


def idf_table(cand_counts: DataFrame, n_docs: Column) -> DataFrame:
    """(gram, df, idf) fitted on the candidate side (smoothed idf); ``n_docs``
    is the number of candidate documents (a scalar column)."""
    return (cand_counts.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
                       .withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df")))
                                   + F.lit(1.0)))


def tfidf_weights(counts: DataFrame, idf: DataFrame, id_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """(id, gram, weight, df): L2-normalised tf-idf; out-of-vocabulary grams drop out.  ``keep``:
    more columns of ``idf``."""
    w = counts.join(idf, on="gram", how="inner").withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "gram", (F.col("_w") / norm).alias("weight"), "df", *keep)


def fuzzy_match(queries: DataFrame, candidates: DataFrame | TitleIndex, query_name: str = "name",
                cand_name: str = "Name", dedupe_key: str | None = "name",
                dedupe_order: str = "app_id", casefold: bool = False,
                salt_rows: int = 5000) -> DataFrame:
    """Every query row with its nearest candidate title, cosine distance and
    token-sort score (``vg_match_score``, 0-100).

    ``candidates``: a table, of which an index is built under the checkpoint folder, or an
    index (``title_index.build_index``, ``open_index``), with which nothing is built.
    ``dedupe_key``: keep the first query row per key first (as written the
    titles are deduplicated on the name); None keeps every row.
    The deduplicated queries and the scored rows are written once as tables under the
    checkpoint folder, so that no score is computed twice; the shuffle files of each step go when
    its table is written.
    """
    from catalink.operators import title_index
    from catalink.session import cut_lineage, ensure_checkpoint_dir, shuffles_dropped

    with shuffles_dropped(queries.sparkSession):
        if isinstance(candidates, title_index.TitleIndex):
            index = candidates
        else:
            folder = f"{ensure_checkpoint_dir(candidates.sparkSession).rstrip('/')}/catalink-titles-{uuid.uuid4().hex}"
            index = title_index.build_index(candidates, folder, cand_name, salt_rows, whole=False)
        if dedupe_key:
            queries = keep_first(queries, [dedupe_key], [dedupe_order])
        queries = cut_lineage(queries.where(F.col(query_name).isNotNull()), "queries")
        titles = queries.select(F.col(query_name).alias("_qt")).distinct()
        best = title_index.top1(titles, index, "_qt")
        queries = queries.repartition(index.buckets, query_name)  # scores take time, not bytes
        scored = queries.join(best, queries[query_name] == best["_qt"], "left").drop("_qt")
        sim = F.coalesce(F.col("similarity"), F.lit(0.0))
        score = F.when(F.col("matched_sales_name").isNull(), F.lit(0.0)).otherwise(
            token_sort_ratio(F.col(query_name), F.col("matched_sales_name"), casefold))
        scored = (scored.withColumn("cosine_distance", F.lit(1.0) - sim)
                        .withColumn("vg_match_score", score)
                        .drop("similarity"))
        return cut_lineage(scored, "scored")


# --- acceptance and audit -------------------------------------------------------

def matched_table(scored: DataFrame, rollup: DataFrame, threshold: float = C.SIMILARITY_THRESHOLD,
                  cand_name: str = "Name", query_name: str = "name") -> DataFrame:
    """Accepted matches with the sales columns attached and renamed."""
    kept = scored.where(F.col("vg_match_score") >= threshold)
    # rename before joining: column names resolve case-insensitively (Name vs name)
    sales = rollup.withColumnsRenamed({**C.SALES_RENAME, cand_name: "vg_name"})
    joined = kept.join(sales, kept["matched_sales_name"] == sales["vg_name"], "left")
    return (joined.drop("matched_sales_name", "cosine_distance")
                   .orderBy(F.desc_nulls_last("vg_match_score"), F.asc_nulls_last(query_name)))


def flag_matches(matched: DataFrame, low_score: float = C.LOW_SCORE_FLAG,
                 query_name: str = "name") -> DataFrame:
    """Edition-mismatch flag, low-score flag and their disjunction."""
    return (matched.withColumn("flag_version_mismatch", edition_mismatch(query_name, "vg_name"))
                   .withColumn("flag_low_score", F.coalesce(F.col("vg_match_score") < low_score,
                                                            F.lit(False)))
                   .withColumn("flag_any", F.col("flag_version_mismatch") | F.col("flag_low_score")))


def threshold_sweep(matched: DataFrame, thresholds: Sequence[float] = C.SWEEP_THRESHOLDS) -> DataFrame:
    row = matched.agg(*[F.count_if(F.col("vg_match_score") >= t).alias(f"_t{i}")
                        for i, t in enumerate(thresholds)])
    items = [F.struct(F.lit(int(t)).alias("threshold"), F.col(f"_t{i}").alias("matches"))
             for i, t in enumerate(thresholds)]
    return row.select(F.inline(F.array(*items)))


def multi_hits(matched: DataFrame, name: str = "name", n_samples: int = 5,
               top: int = 15) -> DataFrame:
    """Candidate titles accepted for more than one query row, with the first
    ``n_samples`` query titles in match order (score desc, name asc)."""
    hits = (matched.groupBy("vg_name").agg(F.count(F.lit(1)).alias("hits"))
                   .where(F.col("hits") > 1))
    order = [F.desc_nulls_last("vg_match_score"), F.asc_nulls_last(name), F.asc("app_id")]
    samples = (top_k_per_group(matched.select("vg_name", name, "vg_match_score", "app_id"),
                               ["vg_name"], order, n_samples, salt_key="app_id")
               .groupBy("vg_name")
               .agg(F.array_sort(F.collect_list(F.struct("rank_in_group", F.col(name))))
                    .alias("_s")))
    return (hits.join(samples, "vg_name", "inner")
                .select("vg_name", "hits",
                        F.array_join(F.transform("_s", lambda s: s.getField(name)), "; ")
                        .alias("sample"))
                .orderBy(F.desc("hits"), F.asc("vg_name")).limit(top))


def length_gaps(matched: DataFrame, name: str = "name", top: int = 10) -> DataFrame:
    return (matched.withColumn("len_diff", length_gap(name, "vg_name"))
                   .orderBy(F.desc("len_diff"), F.asc("app_id")).limit(top))


def keyword_mismatches(matched: DataFrame, name: str = "name", top: int = 15,
                       keywords: Sequence[str] = C.RISK_KEYWORDS) -> DataFrame:
    risky = matched.where(keyword_on_one_side(name, "vg_name", keywords))
    return risky.orderBy(F.desc_nulls_last("vg_match_score"), F.asc_nulls_last(name),
                         F.asc("app_id")).limit(top)


def match_summary(queries_n: Column, cand_n: Column, scored: DataFrame, matched: DataFrame,
                  threshold: float = C.SIMILARITY_THRESHOLD) -> DataFrame:
    """Coverage, score distribution and bucket counts as (section, metric, value)."""
    n_matched = matched.agg(F.count(F.lit(1))).scalar()
    s = F.col("vg_match_score")
    buckets = [b for _, b in C.SCORE_BUCKETS] + [C.SCORE_BUCKET_FLOOR]
    row = scored.select(s, score_bucket(s).alias("_b")).agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.min(s).alias("min"),
        F.max(s).alias("max"),
        *[F.count_if(F.col("_b") == b).alias(f"_b{i}") for i, b in enumerate(buckets)])
    row = row.withColumn("_q", percentile_map(scored, ["vg_match_score"], (0.25, 0.5, 0.75))["vg_match_score"])
    games = queries_n.cast("double")
    items = [
        ("coverage", "input_rows", games),
        ("coverage", "candidates", cand_n.cast("double")),
        ("coverage", "matched_rows", n_matched.cast("double")),
        ("coverage", "unmatched_rows", (F.col("n_scored") - n_matched).cast("double")),
        ("coverage", "match_rate_pct", F.when(games > 0, n_matched / games * 100).otherwise(0.0)),
        ("coverage", "threshold", F.lit(float(threshold))),
        ("scores", "min", F.col("min")), ("scores", "p25", F.get("_q", 0)),
        ("scores", "median", F.get("_q", 1)), ("scores", "p75", F.get("_q", 2)),
        ("scores", "max", F.col("max")),
    ] + [("buckets", b, F.col(f"_b{i}").cast("double")) for i, b in enumerate(buckets)]
    structs = [F.struct(F.lit(i + 1).alias("item"), F.lit(sec).alias("section"),
                        F.lit(m).alias("metric"), v.cast("double").alias("value"))
               for i, (sec, m, v) in enumerate(items)]
    return row.select(F.inline(F.array(*structs)))


def review_queue(scored: DataFrame, matched: DataFrame, threshold: float = C.SIMILARITY_THRESHOLD,
                 low_below: float = C.LOW_PASS_BELOW, name: str = "name") -> DataFrame:
    """(queue, rank, app_id, name, candidate, score): the lowest accepted scores, the highest, and
    the best of those that just missed the threshold."""
    s = F.col("vg_match_score")
    lists = [("low_pass", matched.where(s < low_below), "vg_name", False, C.LOW_PASS_ROWS),
             ("high_pass", matched, "vg_name", True, C.HIGH_PASS_ROWS),
             ("near_miss", scored.where((s >= threshold - C.NEAR_MISS_WIDTH) & (s < threshold)), "matched_sales_name", True, C.NEAR_MISS_ROWS)]
    out = None
    for queue, rows, candidate, descending, n in lists:
        part = (top_n(rows, [("vg_match_score", descending), ("app_id", False)], n)
                .select(F.lit(queue).alias("queue"), "rank", "app_id", name, F.col(candidate).alias("candidate"), s.alias("score")))
        out = part if out is None else out.unionByName(part)
    return out


def match_report(queries_n: Column, cand_n: Column, scored: DataFrame, matched: DataFrame,
                 threshold: float = C.SIMILARITY_THRESHOLD, low_below: float = C.LOW_PASS_BELOW,
                 keywords: Sequence[str] = C.RISK_KEYWORDS, name: str = "name") -> DataFrame:
    """The whole match audit as one frame (item, section, metric, value): coverage, scores and
    buckets, then the review queue and the risk signals, one row per listed match.  A listed
    row's metric names its titles (``|`` between); its value is the score, the hits or the
    difference of lengths.  Give ``scored`` and ``matched`` as written tables: each is read by
    several lists."""
    out = match_summary(queries_n, cand_n, scored, matched, threshold)

    def listed(section: str, rows: DataFrame, texts: Sequence[str], value: str) -> DataFrame:
        return rows.select(F.lit(section).alias("section"), "rank",
                           F.concat_ws(" | ", *[F.coalesce(F.col(t).cast("string"), F.lit("")) for t in texts]).alias("metric"),
                           F.col(value).cast("double").alias("value"))

    queue = review_queue(scored, matched, threshold, low_below, name)
    hits = multi_hits(matched, name)
    gaps = length_gaps(matched, name)
    words = keyword_mismatches(matched, name, keywords=keywords)
    ranked = lambda rows, *order: rows.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # noqa: E731 - at most 15 rows
    lists = [listed(q, queue.where(F.col("queue") == q), ("app_id", name, "candidate"), "score") for q in ("low_pass", "high_pass", "near_miss")]
    lists += [listed("multi_hits", ranked(hits, F.desc("hits"), F.asc("vg_name")), ("vg_name", "sample"), "hits"),
              listed("length_gap", ranked(gaps, F.desc("len_diff"), F.asc("app_id")), ("app_id", name, "vg_name"), "len_diff"),
              listed("keyword_mismatch", ranked(words, F.desc_nulls_last("vg_match_score"), F.asc_nulls_last(name), F.asc("app_id")),
                     ("app_id", name, "vg_name"), "vg_match_score")]
    for i, rows in enumerate(lists):
        # items go on behind the summary's, a hundred numbers for each list
        out = out.unionByName(rows.select((F.lit(100 * (i + 1)) + F.col("rank")).alias("item"), "section", "metric", "value"))
    return out
