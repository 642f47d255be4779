"""Persisted index of candidate titles for the top-1 match.

A version of an index is a set of tables below one folder, written once and never changed:

* ``titles``: each title with its norm, its sketch and its first n-grams, bucketed by title;
* ``heads``: (gram, title) weights with the norms behind the n-gram and the title's sketch, bucketed
  by n-gram and ``part``, of the n-grams at which a title's ``tail`` is ``HEAD`` or more: a query
  whose bound is near needs no others.  The postings of a frequent n-gram are split into parts of
  about ``salt_rows``.  They only decide which pairs are scored, so they are of single precision;
* ``postings``: the same of all other n-grams, without the sketch.  An index that serves one match
  only (``whole`` false) has no such table: what a query asks of it is made from the titles;
* ``grams``: document frequency, idf, number of parts and the shortest title that has the n-gram;
* ``words``: document frequency and shortest title of each whole word.

A title's sketch is its norm within each of 16 blocks of n-grams (a byte each, rounded up): the
products of two sketches bound a similarity from above without a look at the titles.

A match joins queries with the buckets, so that no candidate is shuffled, and with a whole index
builds nothing.  Weights are not kept: a title's n-grams come from its text, their idf from
``grams``, so that what is written grows with the titles and not with their n-grams.
The titles alone are kept beside the versions.  ``extend`` writes the new titles only, and from all
titles the tables of the next version: idf and norms depend on every title, so weights are made
anew and the new version equals one built at once from all titles.  The row of ``versions`` is
written last; a version without it does not exist.

The buckets need catalogue entries: external tables named after the folder, which ``open_index``
makes again in a new session.  Two writers must not extend one index at the same time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalink.functions.text import char_wb_ngrams, words
from catalink.operators import matching as M
from catalink.session import cut_lineage

#: The least norm of an n-gram and all behind it that ``heads`` has.
HEAD = 0.7
#: Distinct n-grams up to which their document frequencies go to every task.
GRAMS_EVERYWHERE = 500_000
#: Titles a task weighs at most: their n-grams are sorted there, in memory.
TITLES_A_TASK = 20_000
BLOCKS = 16
#: Bits of a title's hash beside a length in one bigint.
_HASH = (1 << 40) - 1

_ENTRY = "array<struct<gram:string,weight:double,tail:double,after:double,place:int,df:bigint>>"
_SCHEMAS = {
    "titles": ("_cand string, _norm double, _s1 bigint, _s2 bigint, _first array<struct<gram:string,_wc:float,_ac:float,head:boolean,df:bigint>>", ("_cand",)),
    "heads": ("_cand string, gram string, _wc float, _ac float, _s1 bigint, _s2 bigint, part bigint", ("gram", "part")),
    "postings": ("_cand string, gram string, _wc float, _ac float, part bigint", ("gram", "part")),
}
_NUMBERS = ("n_docs", "buckets", "salt_rows", "n_min", "n_max", "whole")


@dataclass(frozen=True)
class TitleIndex:
    """One version of an index."""

    spark: SparkSession
    folder: str
    version: int
    n_docs: int
    buckets: int
    salt_rows: int
    n_min: int
    n_max: int
    whole: int = 1

    def path(self, table: str) -> str:
        return f"{self.folder}/v{self.version}/{table}"

    def table(self, name: str) -> DataFrame:
        """A bucketed table of this version, entered in the catalogue where it is not."""
        entry = f"catalink_{hashlib.sha256(self.path(name).encode()).hexdigest()[:24]}"
        if not self.spark.catalog.tableExists(entry):
            schema, keys = _SCHEMAS[name]
            where = self.path(name).replace("'", "\\'")
            order = dict.fromkeys((*keys, "_cand"))
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {entry} ({schema}) USING parquet OPTIONS (compression 'zstd') "
                           f"CLUSTERED BY ({', '.join(keys)}) SORTED BY ({', '.join(order)}) INTO {self.buckets} BUCKETS LOCATION '{where}'")
        return self.spark.table(entry)

    @property
    def grams(self) -> DataFrame:
        return self.spark.read.parquet(self.path("grams"))

    @property
    def words(self) -> DataFrame:
        return self.spark.read.parquet(self.path("words"))

    def idf(self, df: Column) -> Column:
        return F.log(F.lit(1.0 + self.n_docs) / (F.lit(1.0) + df)) + F.lit(1.0)

    def parts(self, df: Column) -> Column:
        return F.ceil(df / self.salt_rows).cast("bigint")

    def spread(self, titles: DataFrame, name: str) -> DataFrame:
        """Titles dealt out for work on their n-grams: few bytes, but many n-grams."""
        pieces = max(self.buckets, -(-titles.count() // TITLES_A_TASK))
        return titles.select(name).repartition(pieces, name)


def _write_bucketed(index: TitleIndex, name: str, rows: DataFrame) -> DataFrame:
    keys = _SCHEMAS[name][1]
    table = index.table(name)  # the entry first: rows go in by its buckets, a file each
    rows.repartition(index.buckets, *keys).select(*table.columns).write.insertInto(table_name(index, name), overwrite=True)
    return index.table(name)


def table_name(index: TitleIndex, name: str) -> str:
    index.table(name)
    return f"catalink_{hashlib.sha256(index.path(name).encode()).hexdigest()[:24]}"


def _hash(name: str) -> Column:
    return F.xxhash64(name).bitwiseAND(F.lit(_HASH))


def _names(index: TitleIndex) -> DataFrame:
    return index.spark.read.parquet(f"{index.folder}/names").where(F.col("version") <= index.version).select("_cand")


def _write_version(index: TitleIndex) -> TitleIndex:
    """The tables of a version from the titles below the folder, its ``versions`` row last."""
    names = _names(index)
    spread = index.spread(names, "_cand")
    # the shortest title as one number, which is aggregated without its text
    short = F.shiftleft(F.greatest(F.lit(0), F.lit(65535) - F.length("_cand")).cast("bigint"), 40) + _hash("_cand")
    seen = spread.select(short.alias("_k"), F.explode(F.array_distinct(char_wb_ngrams("_cand", index.n_min, index.n_max))).alias("gram"))
    seen = cut_lineage(seen.groupBy("gram").agg(F.count(F.lit(1)).alias("df"), F.max("_k").bitwiseAND(F.lit(_HASH)).alias("_h")), "grams")
    titled = names.groupBy(_hash("_cand").alias("_h")).agg(F.min("_cand").alias("best"))
    (seen.join(titled, "_h").select("gram", "df", index.idf(F.col("df")).alias("idf"), index.parts(F.col("df")).alias("parts"), "best")
         .write.mode("overwrite").parquet(index.path("grams")))
    word = spread.select("_cand", F.explode(F.array_distinct(words(F.lower("_cand")))).alias("word"))
    (word.groupBy("word").agg(F.count(F.lit(1)).alias("df"), F.min(F.struct(F.length("_cand").alias("n"), "_cand")).alias("_b"))
         .select("word", "df", F.col("_b._cand").alias("best")).write.mode("overwrite").option("compression", "zstd").parquet(index.path("words")))

    first = _entries(index, F.lit(0.0 if index.whole else HEAD))
    first = F.transform(first, lambda e: F.struct(e["gram"].alias("gram"), e["weight"].cast("float").alias("_wc"), e["after"].cast("float").alias("_ac"),
                                                  (e["tail"] >= HEAD).alias("head"), e["df"].alias("df")))
    titles = _write_bucketed(index, "titles", weighed(names, index, "_cand").select("_cand", F.sqrt("_total").alias("_norm"), "_s1", "_s2", first.alias("_first")))
    rows = titles.select("_cand", "_s1", "_s2", F.inline("_first")).withColumn("part", _part(index))
    _write_bucketed(index, "heads", rows.where("head"))
    if index.whole:
        _write_bucketed(index, "postings", rows.where("not head"))
    index.spark.range(1).select(*[F.lit(getattr(index, c)).cast("bigint").alias(c) for c in _NUMBERS]) \
         .coalesce(1).write.mode("overwrite").parquet(f"{index.folder}/versions/version={index.version}")
    return index


def _part(index: TitleIndex) -> Column:
    return F.pmod(F.xxhash64("_cand"), index.parts(F.col("df")))


def _titles(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.col(name).alias("_cand")).where(F.col("_cand").isNotNull())


def build_index(candidates: DataFrame, folder: str, name: str = "Name", salt_rows: int = 5000,
                n_min: int = 3, n_max: int = 5, whole: bool = True) -> TitleIndex:
    """The first version of an index of the distinct titles in ``name`` (nulls are left out;
    a title without n-grams counts as a document only).  ``folder`` must be new and shared.
    Without ``whole`` a match makes the postings that it needs beyond ``heads`` itself."""
    spark = candidates.sparkSession
    titles = cut_lineage(_titles(candidates, name).distinct(), "candidates")
    index = TitleIndex(spark, folder.rstrip("/"), 1, titles.count(), int(spark.conf.get("spark.sql.shuffle.partitions")),
                       salt_rows, n_min, n_max, int(whole))
    titles.write.mode("overwrite").parquet(f"{index.folder}/names/version=1")
    return _write_version(index)


def open_index(spark: SparkSession, folder: str, version: int | None = None) -> TitleIndex:
    """A version of a written index, the last one by default."""
    folder = folder.rstrip("/")
    found = spark.read.parquet(f"{folder}/versions")
    found = found if version is None else found.where(F.col("version") == version)
    row = found.orderBy(F.desc("version")).first()
    if row is None:
        raise ValueError(f"no version {version} below {folder}")
    return TitleIndex(spark, folder, int(row.version), row.n_docs, row.buckets, row.salt_rows, row.n_min, row.n_max, row.whole)


def extend(index: TitleIndex, candidates: DataFrame, name: str = "Name") -> TitleIndex:
    """The next version, with the titles of ``candidates`` that the index does not have."""
    spark = index.spark
    known = spark.read.parquet(f"{index.folder}/names").where(F.col("version") <= index.version).select("_cand")
    new = cut_lineage(_titles(candidates, name).distinct().join(known, "_cand", "left_anti"), "candidates")
    following = TitleIndex(spark, index.folder, index.version + 1, index.n_docs + new.count(), index.buckets,
                           index.salt_rows, index.n_min, index.n_max, index.whole)
    new.write.mode("overwrite").parquet(f"{index.folder}/names/version={following.version}")
    return _write_version(following)


# --- matching ---------------------------------------------------------------------

def _meet(left: DataFrame, right: DataFrame, keys: list[str], most: int, spread: str) -> DataFrame:
    """Inner join of written rows with a bucketed table.  Keys with more than ``most`` rows on the
    left would fill one bucket's task, so they leave the buckets: their rows are cut into parts by
    ``spread`` and the few rows of the right are repeated for each."""
    many = (left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
                .select(*keys, F.ceil(F.col("_n") / most).cast("bigint").alias("_parts")))
    many = cut_lineage(many, "hot-keys")  # at most one row for `most` rows of the left
    if many.isEmpty():
        return left.join(right, keys)
    light = left.join(many, keys, "left_anti").join(right, keys)
    one = left.join(many, keys).withColumn("_part", F.pmod(F.xxhash64(spread), F.col("_parts"))).drop("_parts")
    each = right.join(many, keys).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1))).drop("_parts")
    return light.unionByName(one.join(each, [*keys, "_part"]).drop("_part"))


def weighed(titles: DataFrame, index: TitleIndex, name: str) -> DataFrame:
    """(``name``, _total, _s1, _s2, _grams): the squared norm of each distinct title that has an
    n-gram of the index, its sketch and its n-grams (df, gram, tf) in their order, rarest first."""
    counts = M.ngram_counts(index.spread(titles, name), name, name, index.n_min, index.n_max, distinct=True)
    known = index.grams.select("gram", "df")
    known = F.broadcast(known) if known.count() <= GRAMS_EVERYWHERE else known
    sq = F.pow(F.col("tf") * index.idf(F.col("df")), F.lit(2.0))
    rows = counts.join(known, "gram").select(name, "gram", "tf", "df", sq.alias("_sq"), F.pmod(F.xxhash64("gram"), F.lit(BLOCKS)).alias("_block"))
    found = rows.groupBy(name).agg(
        F.sum("_sq").alias("_total"), F.sort_array(F.collect_list(F.struct("df", "gram", "tf"))).alias("_grams"),
        *[F.sum(F.when(F.col("_block") == b, F.col("_sq")).otherwise(F.lit(0.0))).alias(f"_b{b}") for b in range(BLOCKS)])
    # a byte a block, rounded up; a hair more for sums in another order
    byte = lambda b: F.least(F.lit(255), F.ceil(F.sqrt(F.col(f"_b{b}") / F.col("_total")) * 255 + 1e-6)).cast("bigint")
    return found.select(name, "_total", _packed(byte, 0).alias("_s1"), _packed(byte, 8).alias("_s2"), "_grams")


def _packed(byte: Callable[[int], Column], begin: int) -> Column:
    """Eight bytes in a bigint (the last may set its sign)."""
    out = byte(begin)
    for i in range(1, 8):
        out = out.bitwiseOR(F.shiftleft(byte(begin + i), 8 * i))
    return out


def _within(one: tuple[str, str], other: tuple[str, str]) -> Column:
    """The products of two sketches: no similarity is above."""
    at = lambda c, i: F.shiftrightunsigned(F.col(c), 8 * i).bitwiseAND(F.lit(255))
    out = F.lit(0)
    for a, b in zip(one, other, strict=True):
        for i in range(8):
            out = out + at(a, i) * at(b, i)
    return out / F.lit(255.0 * 255.0)


def _entries(index: TitleIndex, least: Column) -> Column:
    """Of ``weighed`` rows the n-grams, rarest first, as long as ``tail``, the norm of the n-gram and
    all behind it, is ``least`` or more; with ``after``, the norm without it, and ``place`` (from 1)."""
    def step(s: Column, e: Column) -> Column:
        weight = e["weight"]
        tail = F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - s["before"]))
        after = F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - s["before"] - weight * weight))
        entry = F.struct(e["gram"].alias("gram"), weight.alias("weight"), tail.alias("tail"), after.alias("after"),
                         (F.size(s["done"]) + 1).alias("place"), e["df"].alias("df"))
        more = F.struct((s["before"] + weight * weight).alias("before"), F.concat(s["done"], F.array(entry)).alias("done"))
        return F.when(tail >= least, more).otherwise(s)

    start = F.struct(F.lit(0.0).alias("before"), F.array().cast(_ENTRY).alias("done"))
    weights = F.transform("_grams", lambda e: F.struct(e["gram"].alias("gram"), e["df"].alias("df"), (e["tf"] * index.idf(e["df"]) / F.sqrt("_total")).alias("weight")))
    return F.aggregate(weights, start, step, lambda s: s["done"])


def similarities(pairs: DataFrame, arrays: DataFrame, index: TitleIndex) -> DataFrame:
    """(_query, _cand, _sim): exact cosine of distinct pairs.  The candidate's n-grams are looked up
    in ``_qw`` of ``arrays``: (gram, weight), or a map of weights times idf."""
    if not isinstance(arrays.schema["_qw"].dataType, T.MapType):
        each = arrays.select("_query", F.inline("_qw")).join(index.grams.select("gram", "idf"), "gram")
        arrays = each.groupBy("_query").agg(F.map_from_entries(F.collect_list(F.struct("gram", F.col("weight") * F.col("idf")))).alias("_qw"))
    met = _meet(cut_lineage(pairs, "pairs"), index.table("titles").select("_cand", "_norm"), ["_cand"], index.salt_rows, "_query")
    met = met.join(arrays, "_query")  # last: an array goes with each pair to the score, not through a shuffle
    dot = F.aggregate(char_wb_ngrams("_cand", index.n_min, index.n_max), F.lit(0.0), lambda acc, g: acc + F.coalesce(F.element_at("_qw", g), F.lit(0.0)))
    return met.select("_query", "_cand", (dot / F.col("_norm")).alias("_sim"))


def query_arrays(titles: DataFrame, index: TitleIndex, name: str) -> DataFrame:
    """(_query, _total, _s1, _s2, _grams): a written row for each distinct title (``weighed``)."""
    titles = cut_lineage(titles.select(name), "titles")
    return cut_lineage(weighed(titles, index, name).withColumnRenamed(name, "_query"), "query-weights", "zstd")


def _each_gram(rows: DataFrame, index: TitleIndex, least: Column, *more: str) -> DataFrame:
    rows = rows.select("_query", "_s1", "_s2", *more, F.inline(_entries(index, least)))
    return rows.withColumn("parts", index.parts(F.col("df"))).drop("df")


def _norm(weight: str, after: str) -> Column:
    """The norm of an n-gram and all behind it."""
    w, a = F.col(weight).cast("double"), F.col(after).cast("double")
    return F.sqrt(w * w + a * a)


def query_weights(titles: DataFrame, index: TitleIndex, name: str) -> DataFrame:
    """(_query, gram, weight, tail, after, place, parts, best) of distinct titles."""
    return _each_gram(query_arrays(titles, index, name), index, F.lit(0.0)).join(index.grams.select("gram", "best"), "gram")


def seeds(rows: DataFrame, index: TitleIndex) -> DataFrame:
    """(_query, _cand): candidates that may be near.  The rarest whole word that a query shares names
    one, its rarest n-grams others where one of them is rarer than that word."""
    word = rows.select("_query", F.explode(F.array_distinct(words(F.lower("_query")))).alias("word")).join(index.words, "word")
    word = cut_lineage(word.groupBy("_query").agg(F.min(F.struct("df", "best")).alias("_w")).select("_query", "_w.*"), "seeds")
    grams = rows.select("_query", F.slice("_grams", 1, M.SEEDS).alias("_g")).join(word.select("_query", "df"), "_query", "left")
    grams = grams.where(F.col("df").isNull() | (F.col("_g")[0]["df"] < F.col("df"))).select("_query", F.explode("_g.gram").alias("gram"))
    return (word.select("_query", F.col("best").alias("_cand"))
                .unionByName(grams.join(index.grams.select("gram", F.col("best").alias("_cand")), "gram").select("_query", "_cand")).distinct())


def reaching_pairs(q: DataFrame, bounds: DataFrame, index: TitleIndex) -> DataFrame:
    """(_query, _cand): the pairs that can reach the query's bound."""
    return _reaching(q.join(bounds.withColumn("_bound", F.col("_bound") - M.SLACK), "_query"), index).select("_query", "_cand")


def _rest(asked: DataFrame, index: TitleIndex) -> DataFrame:
    """The postings that ``heads`` does not have; of an index without them only those that one of
    the rows ``asked`` can use."""
    if index.whole:
        return index.table("postings")
    needed = cut_lineage(asked.groupBy("gram").agg(F.min(F.col("_bound") / F.col("_tq")).alias("_least")), "needed")
    rows = weighed(_names(index), index, "_cand").select("_cand", F.inline(_entries(index, F.lit(0.0)))).where(F.col("tail") < HEAD)
    return (rows.join(needed, "gram").where(F.col("tail") >= F.col("_least"))
                .select("_cand", "gram", F.col("weight").cast("float").alias("_wc"), F.col("after").cast("float").alias("_ac"), _part(index).alias("part")))


def _reaching(q: DataFrame, index: TitleIndex) -> DataFrame:
    """(_query, _cand, _part, _rest): those pairs with the products summed, which is a lower bound
    of their similarity, and what can remain.  A pair that the sketches exclude goes as it is met."""
    rows = (q.where(F.col("tail") >= F.col("_bound"))
             .select("_query", "gram", F.col("weight").alias("_wq"), F.col("tail").alias("_tq"), F.col("after").alias("_aq"), "_bound",
                     F.col("_s1").alias("_q1"), F.col("_s2").alias("_q2"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")))
    rows = cut_lineage(rows, "query-postings")
    columns = ("_query", "_cand", "_wq", "_wc", "_tq", "_aq", "_ac", "_bound")
    met = _meet(rows, index.table("heads"), ["gram", "part"], index.salt_rows, "_query")
    met = met.where(_within(("_q1", "_q2"), ("_s1", "_s2")) >= F.col("_bound")).select(*columns)
    asked = rows.where(F.col("_tq") * HEAD >= F.col("_bound"))
    if not asked.isEmpty():
        asked = cut_lineage(asked.drop("_q1", "_q2"), "query-postings-behind")
        met = met.unionByName(_meet(asked, _rest(asked, index), ["gram", "part"], index.salt_rows, "_query").select(*columns))
    return (met.where(F.col("_tq") * _norm("_wc", "_ac") >= F.col("_bound"))
               .groupBy("_query", "_cand").agg(F.sum(F.col("_wq") * F.col("_wc")).alias("_part"),
                                               F.min(F.col("_aq") * F.col("_ac")).alias("_rest"), F.max("_bound").alias("_bound"))
               .where(F.col("_part") + F.col("_rest") >= F.col("_bound")).select("_query", "_cand", "_part", "_rest"))


def nearer_pairs(met: DataFrame, nearest: DataFrame) -> DataFrame:
    """(_query, _cand): of the pairs that reach a query's first bound those that can also reach the
    exact similarity of its ``nearest`` (_query, _cand, _sim) candidate, without that candidate."""
    least = nearest.select("_query", F.col("_cand").alias("_top"), (F.col("_sim") - M.SLACK).alias("_least"))
    return (met.join(least, "_query").where((F.col("_part") + F.col("_rest") >= F.col("_least")) & (F.col("_cand") != F.col("_top")))
               .select("_query", "_cand"))


def top1(titles: DataFrame, index: TitleIndex, name: str) -> DataFrame:
    """(``name``, matched_sales_name, similarity) for the distinct titles that share an n-gram
    with a title of the index: the greatest similarity, then the smallest title."""
    rows = query_arrays(titles, index, name)
    arrays = rows.select("_query", F.map_from_entries(F.transform(
        "_grams", lambda g: F.struct(g["gram"], g["tf"] * F.pow(index.idf(g["df"]), F.lit(2.0)) / F.sqrt("_total")))).alias("_qw"))
    bounds = cut_lineage(similarities(seeds(rows, index), arrays, index).groupBy("_query").agg((F.max("_sim") - M.SLACK).alias("_bound")), "bounds")
    met = cut_lineage(_reaching(_each_gram(rows.join(bounds, "_query"), index, F.col("_bound"), "_bound"), index), "reaching")
    # a query's array goes with each pair that is scored: first one pair a query, then what can be better
    first = met.groupBy("_query").agg(F.max(F.struct("_part", "_cand")).alias("_t")).select("_query", F.col("_t._cand").alias("_cand"))
    nearest = cut_lineage(similarities(first, arrays, index), "nearest")
    scored = nearest.unionByName(similarities(nearer_pairs(met, nearest), arrays, index))
    best = scored.groupBy("_query").agg(F.min(F.struct((-F.round("_sim", M.SIM_DIGITS)).alias("neg_sim"), F.col("_cand"))).alias("_b"))
    return best.select(F.col("_query").alias(name), F.col("_b._cand").alias("matched_sales_name"), (-F.col("_b.neg_sim")).alias("similarity"))
