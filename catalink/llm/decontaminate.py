"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A benchmark item gives windows of ``window`` consecutive words (an item with fewer words is
one window).  A window's set is its shingles of five words (fewer in shorter windows).  It
occurs in a document only if the document has all of them, so the prefix that must match is
one shingle: the window's rarest, by the number of its occurrences in the documents.
Documents' shingles are joined with that prefix; the position gives the one place where
the window can lie, which must be within the document (positional and length bound); there
the words are compared one by one.  Everything is DataFrame expressions.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Defined results: null and empty texts have no words, and items without words no windows;
a window that several items share counts for each; rows meet by the hash of the row, so
repeated rows each get their result; without benchmark rows nothing is hit; of the
documents' columns those not named like the result are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalink.llm.common import row_key, stage
from catalink.llm.urls import lower_ascii

WINDOW = 13
SHINGLE = 5
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 1_000_000
OWN = ("n_words", "n_hit", "items", "_key", "_found")


def words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN, -1), lambda w: w != "")


def item_windows(benchmark: DataFrame, window: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows: ``win`` (hash), ``words``, ``items`` (ids of the items that have it)."""
    rows = benchmark.select(F.col(item).alias("item"), words(F.col(text)).alias("_w")).where(F.size("_w") > 0)
    size = F.least(F.lit(window), F.size("_w"))
    rows = rows.select("item", "_w", size.alias("_n"), F.explode(F.sequence(F.lit(1), F.size("_w") - size + 1)).alias("_at"))
    return (rows.select("item", F.slice("_w", F.col("_at"), F.col("_n")).alias("words"))
            .groupBy("words").agg(F.collect_set("item").alias("items"))
            .select(F.xxhash64("words").alias("win"), "words", "items"))


def _size(n: Column) -> Column:
    return F.least(F.lit(SHINGLE), n)


def _shingles(ws: Column, size: Column) -> Column:
    """Hashes of the runs of ``size`` words (none where there are fewer words)."""
    at = F.when(F.size(ws) >= size, F.sequence(F.lit(1), F.size(ws) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.slice(ws, i, size)))


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
         key: tuple[str, ...] = ("doc_id",), item: str = "item_id") -> DataFrame:
    """All documents with ``n_words``, ``n_hit`` (words inside occurrences) and ``items``
    (sorted ids, as strings, of the items with an occurring window)."""
    keep = [c for c in docs.columns if c not in OWN]
    rows = docs.select(*keep, row_key(*dict.fromkeys([*key, text])).alias("_key"))
    windows = stage(item_windows(benchmark, window, item), "item-windows")
    parts = stage(windows.select("win", F.size("words").alias("len"), F.posexplode(_shingles(F.col("words"), _size(F.size("words"))))
                                 .alias("offset", "h")), "item-shingles")
    sizes = sorted(r[0] for r in windows.select(_size(F.size("words"))).distinct().collect())  # at most SHINGLE numbers
    few = parts.select("h").distinct()
    few = F.broadcast(few) if parts.count() <= BROADCAST_ROWS else few

    # where the documents have a shingle of some window
    split = rows.select("_key", words(F.col(text)).alias("_w"))
    own = F.concat(*[F.transform(_shingles(F.col("_w"), F.lit(s)), lambda h, i: F.struct(i.alias("pos"), h.alias("h")))
                     for s in sizes]) if sizes else F.array().cast("array<struct<pos:int,h:bigint>>")
    hits = stage(split.select("_key", F.size("_w").alias("n"), F.inline(own)).join(few, "h", "left_semi"), "shingle-hits")

    # the rarest shingle of each window; a window with a shingle that no document has can't occur
    count = hits.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    rarest = (parts.join(count, "h", "left").withColumn("df", F.coalesce("df", F.lit(0)))
              .groupBy("win", "len").agg(F.min(F.struct("df", "h", "offset")).alias("m"))
              .where("m.df > 0").select("win", "len", F.col("m.h").alias("h"), F.col("m.offset").alias("offset")))
    placed = (hits.join(rarest, "h").select("_key", "n", "win", "len", (F.col("pos") - F.col("offset")).alias("start"))
              .where("start >= 0 and start + len <= n"))
    found = (placed.select("_key", "win", "start").distinct().join(windows, "win")
             .groupBy("_key").agg(F.collect_list(F.struct("start", "words", "items")).alias("_found")))

    joined = rows.join(found, "_key", "left").withColumn("_w", words(F.col(text)))
    real = F.filter(F.coalesce("_found", F.array()), lambda c: F.slice(F.col("_w"), c["start"] + 1, F.size(c["words"])) == c["words"])
    joined = joined.select(*keep, F.size("_w").alias("n_words"), F.array_sort(real).alias("_real"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def cover(acc: Column, c: Column) -> Column:
        end = c["start"] + F.size(c["words"])
        return F.struct(F.greatest(acc["end"], end).alias("end"),
                        (acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], c["start"]))).alias("n"))

    items = F.array_sort(F.array_distinct(F.transform(F.flatten(F.transform("_real", lambda c: c["items"])), lambda x: x.cast("string"))))
    return joined.select(*keep, F.col("n_words").cast("long").alias("n_words"),
                         F.aggregate("_real", zero, cover, lambda a: a["n"]).cast("long").alias("n_hit"), items.alias("items"))


def contaminated(share: int = 20) -> Column:
    """Whether at least one in ``share`` of a document's words is hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))
