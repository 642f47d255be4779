"""Sources/sinks round trip, catalogue summary, briefing, report table and
table shapes.

The briefing and the report table are compositions of other registered
queries; their SQL twins are compositions of those queries' SQL (each used
as a derived table).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from catalink import config as C
from catalink.functions import expressions as X
from catalink.plans import standin as S
from catalink.plans.common import build_core, shared
from catalink.plans.registry import ORACLE, QUERIES, query, r6
from catalink.session import cut_lineage, table_path
from catalink.sources import readers as R
from catalink.sources import sinks as K

_DOC_COLS = ["doc_id", "text", "lang", "source"]


@query("csv_roundtrip", """
SELECT doc_id, lang, source, CAST(length(text) AS BIGINT) AS text_len, md5(text) AS text_md5 FROM documents""")
def csv_roundtrip(spark, d):
    """documents -> CSV (doubled quotes, multi-line text, columns in another order and one
    more) -> text reader with required columns and keep-first -> landed as Parquet -> typed
    reload."""
    docs = S.read(spark, d, "documents").select("n_chars", *reversed(_DOC_COLS))
    csv_dir = K.scratch_path(spark, "csv")
    K.write_table(docs, csv_dir, fmt="csv")
    back = R.read_required(spark, csv_dir, _DOC_COLS, ["doc_id", "text"], escape=R.DOUBLED)
    typed = back.select(X.safe_long("doc_id").alias("doc_id"), "text", "lang", "source")
    pq_dir = K.scratch_path(spark, "landed")
    R.land_parquet(typed, pq_dir)
    out = R.read_parquet(spark, pq_dir)
    return out.select("doc_id", "lang", "source", F.length("text").cast("bigint").alias("text_len"),
                      F.md5("text").alias("text_md5"))


@query("csv_long_scan", """
SELECT c_custkey AS app_id, trim(c_mktsegment) AS genre FROM customer WHERE c_acctbal >= 0""")
def csv_long_scan(spark, d):
    """customer -> CSV with quotes, line feeds, a missing-value text and other columns first ->
    long reader (key and stripped value; rows missing either dropped)."""
    c = S.read(spark, d, "customer")
    noted = F.concat(F.lit('say "'), F.col("c_name"), F.lit('", twice\n'), F.col("c_name"))
    genre = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("  "), F.trim("c_mktsegment"), F.lit(" "))).otherwise("NA")
    path = K.scratch_path(spark, "long-csv")
    K.write_table(c.select(noted.alias("note"), genre.alias("genre"), F.col("c_custkey").alias("app_id")), path, fmt="csv")
    return R.read_long_csv(spark, path, "app_id", "genre")


@query("csv_required", """
SELECT CAST(doc_id AS VARCHAR) AS "Rank", md5(text) AS text_md5 FROM documents WHERE length(text) >= 20""")
def csv_required(spark, d):
    """documents -> CSV with line feeds in the texts, quotes doubled in one half and escaped in
    the other, and gaps (short texts) in a required column -> required columns by name."""
    docs = S.read(spark, d, "documents")
    name = F.when(F.length("text") >= 20, F.replace("text", F.lit("\\"), F.lit("\\\\")))
    docs = docs.select(F.lit('x,"y"').alias("Other"), name.alias("Name"), F.col("doc_id").alias("Rank"))
    path = K.scratch_path(spark, "required-csv")
    plain = (F.col("Rank") % 2 == 0) & ~F.coalesce(F.contains("Name", F.lit("\\")), F.lit(False))
    K.write_table(docs.where(~plain), f"{path}/doubled", fmt="csv")
    K.write_table(docs.where(plain), f"{path}/escaped", fmt="csv", escape="\\")
    back = R.read_required(spark, f"{path}/*", ["Rank", "Name"], ["Rank", "Name"])
    return back.select("Rank", F.md5("Name").alias("text_md5"))


def _summary_spark(spark, d):
    from catalink.operators.joins import existence_flag
    from catalink.operators.quality import one_pass
    from catalink.plans.q_cleaning import _price_fill
    from catalink.plans.q_matching import flagged
    g = existence_flag(_price_fill(spark, d), S.promo_ids(spark, d), "app_id", "has_flag")
    f = flagged(spark, d)
    matches = one_pass(f, {"any": F.count(F.lit(1)), "clean": F.count_if(~F.col("flag_any"))})
    free = F.col("is_free") == 1
    paid = F.col("is_free") == 0
    items = [
        ("Total games", F.count(F.lit(1))),
        ("Games with release date", F.count("release_date")),
        ("Free-to-play games", F.count_if(free)),
        ("Paid games (price known)", F.count_if(~F.col("price_unknown") & paid)),
        ("Paid games (price unknown)", F.count_if(F.col("price_unknown") & paid)),
        ("Games with flagged attribute", F.count_if(F.col("has_flag"))),
    ]
    row = g.agg(*[e.alias(f"_c{i}") for i, (_, e) in enumerate(items)])
    structs = [F.struct(F.lit(i + 1).alias("item"), F.lit(n).alias("metric"),
                        F.col(f"_c{i}").cast("bigint").alias("value")) for i, (n, _) in enumerate(items)]
    structs += [F.struct(F.lit(len(items) + 1).alias("item"), F.lit("Matched (any)").alias("metric"),
                         matches.getField("any").cast("bigint").alias("value")),
                F.struct(F.lit(len(items) + 2).alias("item"), F.lit("Matched (clean only)").alias("metric"),
                         matches.getField("clean").cast("bigint").alias("value"))]
    return row.select(F.inline(F.array(*structs)))


def _summary_sql() -> str:
    from catalink.plans.q_cleaning import _PRICE_FILL_SQL
    from catalink.plans.q_matching import _MATCH_CTES
    ctes = S.with_ctes(*_MATCH_CTES, *S.STAR_SQL, S.GENRES_SQL, S.PROMO_SQL, _PRICE_FILL_SQL,
                       """gs AS (SELECT pf.*, g.release_date, pf.app_id IN (SELECT app_id FROM promo_ids) AS has_flag,
                                 pf.price_filled IS NULL AS price_unknown
                          FROM pf JOIN games g ON pf.app_id = g.app_id)""")
    items = [
        ("Total games", "(SELECT COUNT(*) FROM gs)"),
        ("Games with release date", "(SELECT COUNT(release_date) FROM gs)"),
        ("Free-to-play games", "(SELECT COUNT(CASE WHEN is_free = 1 THEN 1 END) FROM gs)"),
        ("Paid games (price known)", "(SELECT COUNT(CASE WHEN NOT price_unknown AND is_free = 0 THEN 1 END) FROM gs)"),
        ("Paid games (price unknown)", "(SELECT COUNT(CASE WHEN price_unknown AND is_free = 0 THEN 1 END) FROM gs)"),
        ("Games with flagged attribute", "(SELECT COUNT(CASE WHEN has_flag THEN 1 END) FROM gs)"),
        ("Matched (any)", "(SELECT COUNT(*) FROM flagged)"),
        ("Matched (clean only)",
         "(SELECT COUNT(CASE WHEN NOT (flag_version_mismatch OR flag_low_score) THEN 1 END) FROM flagged)"),
    ]
    return ctes + " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS INTEGER) AS item, '{n}' AS metric, CAST({v} AS BIGINT) AS value"
        for i, (n, v) in enumerate(items))


@query("catalogue_summary", _summary_sql())
def catalogue_summary(spark, d):
    from catalink.plans.q_matching import one_match
    with one_match(spark, d):
        return _summary_spark(spark, d)


# --- briefing -------------------------------------------------------------------------

# (section, source query, rank expr, label column, metric column, filter) -- each
# row of the source becomes one briefing line per metric.
_BRIEF = [
    ("sample", "funnel", "step", "stage", ["rows"], None),
    ("correlation", "pearson", "1", "x", ["pearson"], "x = 'player_ratio_100'"),
    ("correlation", "spearman", "2", "x", ["spearman"], "x = 'player_ratio_100'"),
    ("quadrants", "quadrant_summary", "rank", "quadrant", ["count", "pct"], None),
    ("top_underrated", "top_underrated", "rank", "short_name",
     ["player_ratio_100", "critic_norm", "divergence_ratio"], "rank <= 3"),
    ("top_overrated", "top_overrated", "rank", "short_name",
     ["player_ratio_100", "critic_norm", "divergence_ratio"], "rank <= 3"),
    ("price_buckets", "price_buckets", "rank", "price_bucket", ["mean", "median", "n_games"], None),
    ("free_vs_paid", "free_vs_paid", "1", "type", ["mean"], None),
    ("peak_years", "extreme_years", "1", "extreme", ["release_year", "mean_div", "n_games"], None),
    ("volume", "pearson", "1", "x", ["pearson"], "x = 'abs_div'"),
    ("volume", "spearman", "2", "x", ["spearman"], "x = 'abs_div'"),
]
# top / bottom three of a ranked slice
_BRIEF_ENDS = [("genres", "slice_by_genre", "genre"), ("publishers", "entity_publisher", "publisher")]


def _brief_sql() -> str:
    parts = []
    for section, src, rank, label, metrics, where in _BRIEF:
        w = f" WHERE {where}" if where else ""
        for m in metrics:
            parts.append(f"SELECT '{section}' AS section, CAST({rank} AS INTEGER) AS rank, "
                         f"CAST({label} AS VARCHAR) AS label, '{m}' AS metric, "
                         f"ROUND(CAST({m} AS DOUBLE), 6) AS value FROM ({ORACLE[src]}) t{w}")
    for section, src, key in _BRIEF_ENDS:
        for side, direction in (("top", "DESC"), ("bottom", "ASC")):
            for m in ("mean_div", "n_games"):
                parts.append(
                    f"SELECT '{section}_{side}' AS section, CAST(rk AS INTEGER) AS rank, {key} AS label, "
                    f"'{m}' AS metric, ROUND(CAST({m} AS DOUBLE), 6) AS value FROM ("
                    f"SELECT *, ROW_NUMBER() OVER (ORDER BY mean_div {direction}, {key}) AS rk "
                    f"FROM ({ORACLE[src]}) s) t WHERE rk <= 3")
    parts.append(f"""SELECT 'consensus' AS section, 1 AS rank, 'Q1+Q4' AS label, 'pct' AS metric,
       ROUND(CAST(SUM(CASE WHEN quadrant IN ('{C.QUADRANTS[0]}', '{C.QUADRANTS[3]}') THEN count ELSE 0 END) AS DOUBLE)
             * 100 / SUM(count), 6) AS value FROM ({ORACLE['quadrant_summary']}) t""")
    return " UNION ALL ".join(parts)


def _brief_spark(spark, d):
    from pyspark.sql import Window
    out = None
    # each source query runs once, some side by side; its result is a small table
    names = list(dict.fromkeys([b[1] for b in _BRIEF] + [e[1] for e in _BRIEF_ENDS]))
    write = inheritable_thread_target(spark)(lambda name: cut_lineage(QUERIES[name](spark, d), f"brief-{name}"))
    with ThreadPoolExecutor(4) as pool:
        written = dict(zip(names, pool.map(write, names)))

    def lines(base, section, rank, label, metrics):
        values = F.array(*[F.struct(F.lit(m).alias("metric"), r6(F.col(m), "value").alias("value")) for m in metrics])
        return base.select(F.lit(section).alias("section"), rank.cast("int").alias("rank"),
                           F.col(label).cast("string").alias("label"), F.inline(values))

    def add(df):
        nonlocal out
        out = df if out is None else out.unionByName(df)

    for section, src, rank, label, metrics, where in _BRIEF:
        base = written[src]
        add(lines(base.where(where) if where else base, section, F.expr(rank), label, metrics))
    for section, src, key in _BRIEF_ENDS:
        for side, desc in (("top", True), ("bottom", False)):
            order = [F.desc("mean_div") if desc else F.asc("mean_div"), F.asc(key)]
            ranked = (written[src].orderBy(*order).limit(3)
                      .withColumn("rk", F.row_number().over(Window.orderBy(*order))))
            add(lines(ranked, f"{section}_{side}", F.col("rk"), key, ("mean_div", "n_games")))
    quad = written["quadrant_summary"]
    agree = F.sum(F.when(F.col("quadrant").isin(C.QUADRANTS[0], C.QUADRANTS[3]), F.col("count")).otherwise(0))
    add(quad.agg((agree.cast("double") * 100 / F.sum("count")).alias("v"))
            .select(F.lit("consensus").alias("section"), F.lit(1).alias("rank"), F.lit("Q1+Q4").alias("label"),
                    F.lit("pct").alias("metric"), r6(F.col("v"), "value")))
    return out


@query("briefing", None)
def briefing(spark, d):
    with shared(spark, d, "core", build_core):
        return _brief_spark(spark, d)


# --- report table and shapes -------------------------------------------------------------

_REPORTS = ["quality_long", "quality_reviews", "match_quality"]


@query("report_table", None)
def report_table(spark, d):
    """Several report frames as one long table, written to a sink and read back."""
    from catalink.plans.q_matching import one_match
    out = None
    with one_match(spark, d):
        for name in _REPORTS:
            part = QUERIES[name](spark, d).select(F.lit(name).alias("report"), "item", "section", "metric", "value")
            out = part if out is None else out.unionByName(part)
    path = K.scratch_path(spark, "report")
    K.write_report(out, path)
    return spark.read.parquet(path)


_TABLE_COLS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
               "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3,
               "benchmark": 2, "labels": 3, "conversations": 4}


@query("table_shapes", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", COUNT(*) AS rows, CAST({n} AS BIGINT) AS columns FROM {t}"
    for t, n in _TABLE_COLS.items()))
def table_shapes(spark, d):
    return K.file_shapes(spark, {t: table_path(d, t) for t in _TABLE_COLS})


_EXTREME_COLS = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]


@query("footer_extremes", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) AS rows, ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS min, "
    f"ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS max FROM lineitem" for c in _EXTREME_COLS))
def footer_extremes(spark, d):
    out = K.column_extremes(spark, table_path(d, "lineitem"), _EXTREME_COLS)
    return out.select("column", "rows", r6("min"), r6("max"))


@query("sorted_table", """
SELECT quantity, l_orderkey, l_linenumber,
       ROW_NUMBER() OVER (ORDER BY quantity DESC NULLS LAST, l_orderkey, l_linenumber) AS position
FROM (SELECT CASE WHEN l_linenumber <> 2 THEN l_quantity END AS quantity, l_orderkey, l_linenumber FROM lineitem) t""")
def sorted_table(spark, d):
    """Line items written in a mixed order with nulls last and read back by file order."""
    rows = S.read(spark, d, "lineitem").select(F.when(F.col("l_linenumber") != 2, F.col("l_quantity")).alias("quantity"),
                                               "l_orderkey", "l_linenumber")
    path = K.scratch_path(spark, "sorted")
    K.write_sorted(rows, path, [("quantity", True), ("l_orderkey", False), ("l_linenumber", False)])
    return K.read_sorted(spark, path)


def _late_sql():
    """Register SQL twins that compose other queries' SQL (all modules loaded)."""
    ORACLE["briefing"] = _brief_sql()
    ORACLE["report_table"] = " UNION ALL ".join(
        f"SELECT '{n}' AS report, item, section, metric, value FROM ({ORACLE[n]}) t{i}"
        for i, n in enumerate(_REPORTS))
