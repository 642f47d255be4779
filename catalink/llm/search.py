"""Ranked lexical search with a length-stratified index.

A document's normaliser ``m = 50 + (50 * n * N) div L`` depends on its number of terms n only
(N documents with terms, L terms in all), and the impact of a term in it,
``(1000000000 * tf) div (1000 * tf + 20 * m)``, on m and tf.  So documents of equal m form a
stratum, and within it a term's postings are kept by tf, highest first: one impact serves all
documents of a (stratum, tf), and the first one bounds the term in the stratum.

* Index: one row per block of a stratum (at most about ``BLOCK`` documents, dealt in turn, so
  that a stratum with very many documents is many rows): its documents, its terms, and per
  term the tfs, their counts and the documents by tf.
* Bounds: an item's score in a stratum is at most the sum of its terms' weights times their
  first impacts there.
* Search: each item visits its strata by falling bound, in waves that grow by ``GROWTH``; from
  the second wave on only strata whose bound reaches the item's score at ``limit`` so far.
  Every stratum that can hold a result is visited, so results are exact.

Items are asked in blocks of bounded size against the index.  The number of strata is at most
about 10 * sqrt(N) (their sizes differ, and sum up to L), so tables of strata are small.

Defined results: null and blank texts have no terms: such documents are not counted and never
found, such items find nothing; a document row is a result of its own, repeated rows
included (equal scores: ascending id, null last, then any order); an item is a distinct
(id, text), and items that share an id have rows of their own; without documents or items
there are no rows; columns not named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalink.llm.common import stage, string_buffers, text_column, text_slices

SCALE = 1_000_000_000
#: Documents in a block of a stratum, about.
BLOCK = 4096
#: Terms of items that are asked together, and terms that an index may be restricted to.
ASKED = 1_000_000
#: Documents in the strata of the first wave, at least; the next waves are larger by the factor.
FIRST = 2000
GROWTH = 16
SLICE = 2 << 20

_BYTES = np.arange(256)
_TERM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 0x80)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def terms_of(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All terms of the texts, lower-cased, in order, and the first term of each text (n + 1
    numbers)."""
    offsets, raw = string_buffers(texts)
    inside = _TERM[raw]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(raw)]
    start[heads] = inside[heads]
    starts = np.flatnonzero(start)
    letters = np.ascontiguousarray(_LOWER[raw[inside]])
    bounds = np.append((np.cumsum(inside, dtype=np.int64))[starts] - 1, len(letters)).astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    return terms, np.searchsorted(starts, offsets)


COUNTS = T.StructType([T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.StringType())),
                       T.StructField("tfs", T.ArrayType(T.LongType()))])


def count_terms(df: DataFrame, keep: tuple[str, ...], text: str = "text", only: pa.Array | None = None) -> DataFrame:
    """Columns ``keep``, the number ``n`` of terms of each row, its distinct ``terms`` (of the given
    ones) and how often each occurs (``tfs``)."""
    schema = T.StructType([*(df.schema[c] for c in keep), *COUNTS.fields])
    asked = df.sparkSession.sparkContext.broadcast(only) if only is not None else None  # at most ASKED terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "_text", SLICE):
                terms, first = terms_of(text_column(batch, "_text"))
                coded = terms.dictionary_encode()
                words = coded.dictionary
                ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
                if asked is not None:
                    found = pc.is_in(words, value_set=asked.value).to_numpy(zero_copy_only=False)[ids]
                    doc, ids = doc[found], ids[found]
                pairs, tfs = np.unique(doc * max(len(words), 1) + ids, return_counts=True)
                doc, ids = np.divmod(pairs, max(len(words), 1))
                at = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), pa.array(np.diff(first).astype(np.int64)),
                     pa.ListArray.from_arrays(at, words.take(pa.array(ids)).cast(pa.string())),
                     pa.ListArray.from_arrays(at, pa.array(tfs.astype(np.int64)))], names=[*keep, *COUNTS.names])

    return df.select(*keep, df[text].alias("_text")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Index:
    """``blocks``: one row per block; ``strata``: documents and blocks of each stratum m."""

    blocks: DataFrame
    strata: DataFrame
    n_docs: int


LISTS = ("docs", "terms", "tops", "n_docs", "tfs", "counts", "postings")
BLOCKS = T.StructType([
    T.StructField("m", T.LongType()), T.StructField("block", T.LongType()), T.StructField("docs", T.ArrayType(T.LongType())),
    T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("tops", T.ArrayType(T.LongType())),
    T.StructField("n_docs", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType())),
    T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("postings", T.ArrayType(T.IntegerType()))])


def _block(table: pa.Table) -> pa.Table:
    """Postings of a block's documents: by term, then by tf (highest first), then by document."""
    table = table.combine_chunks()
    n = table.num_rows
    terms, tfs = (table.column(c).combine_chunks() for c in ("terms", "tfs"))
    doc = np.repeat(np.arange(n), pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64))
    coded = terms.flatten().dictionary_encode()
    term, tf = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), tfs.flatten().to_numpy(zero_copy_only=False)
    by = np.lexsort((doc, -tf, term))
    doc, term, tf = doc[by], term[by], tf[by]
    new_term = np.append(True, term[1:] != term[:-1])[: len(term)]
    new_tf = new_term | np.append(True, tf[1:] != tf[:-1])[: len(term)]
    entry, first = np.flatnonzero(new_tf), np.flatnonzero(new_term)
    values = {
        "docs": table.column("doc").to_pylist(), "terms": coded.dictionary.to_pylist(), "tops": tf[first], "n_docs": np.diff(np.append(first, len(term))),
        "tfs": tf[entry], "counts": np.diff(np.append(entry, len(term))), "postings": doc}
    kinds = {f.name: pa.list_(pa.string() if f.name == "terms" else pa.int32() if f.dataType.elementType == T.IntegerType() else pa.int64())
             for f in BLOCKS.fields if f.name in LISTS}
    return pa.Table.from_arrays([pa.array([table.column(c)[0].as_py()], pa.int64()) for c in ("m", "block")]
                                + [pa.array([values[c]], kinds[c]) for c in LISTS], names=BLOCKS.names)


def build(docs: DataFrame, key: str = "doc_id", text: str = "text", only: pa.Array | None = None, block: int = BLOCK) -> Index:
    """Index of all documents; with ``only``, of these terms (at most ``ASKED``) in all documents.
    ``key`` is a column of whole numbers."""
    counted = stage(count_terms(docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")), ("doc",), only=only)
                    .where("n > 0"), "search-terms")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.lit(50) + F.expr(f"(50 * n * {n_docs}L) div {max(n_terms, 1)}L")
    rows = counted.withColumn("m", m)
    strata = stage(rows.groupBy("m").agg(F.count(F.lit(1)).alias("n_in")).withColumn("n_blocks", F.ceil(F.col("n_in") / block).cast("long")),
                   "search-strata")
    dealt = rows.join(F.broadcast(strata), "m").withColumn("block", F.pmod(F.monotonically_increasing_id(), F.col("n_blocks")))
    blocks = dealt.select("m", "block", "doc", "terms", "tfs").groupBy("m", "block").applyInArrow(_block, BLOCKS)
    return Index(stage(blocks, "search-index"), strata, n_docs)


def weight(n_docs: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


HITS = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("score", T.LongType())])


def _visit(asked, limit: int):
    """Scores of a block's documents for the items that visit it: the best ``limit`` of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = asked.value
        for batch in batches:
            for r in range(batch.num_rows):
                cell = lambda c: batch.column(c)[r].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                m = batch.column("m")[r].as_py()
                docs = batch.column("docs")[r].as_py()
                id_order = np.array([(1, 0) if d is None else (0, d) for d in docs], dtype=[("none", "i1"), ("id", "i8")])
                place = np.empty(len(docs), dtype=np.int64)
                place[np.argsort(id_order)] = np.arange(len(docs))
                where = {t: i for i, t in enumerate(batch.column("terms")[r].as_py())}
                tfs, postings = cell("tfs"), cell("postings").astype(np.int64)
                impacts = SCALE * tfs // (1000 * tfs + 20 * m)  # once per tf
                impact = np.repeat(impacts, cell("counts"))
                ends = np.append(0, np.cumsum(cell("n_docs")))
                found = []
                for visit in batch.column("visits")[r].as_py():
                    score = np.zeros(len(docs), dtype=np.int64)
                    for t, w in items[visit["item"]]:
                        i = where.get(t)
                        if i is not None:  # a document occurs once in a term's postings
                            score[postings[ends[i]: ends[i + 1]]] += w * impact[ends[i]: ends[i + 1]]
                    good = np.flatnonzero(score >= max(visit["least"], 1))
                    if len(good) > limit:
                        good = good[np.lexsort((place[good], -score[good]))[:limit]]
                    found.append((np.full(len(good), visit["item"]), good, score[good]))
                if found:
                    item, at, score = (np.concatenate(x) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array([docs[k] for k in at.tolist()], pa.int64()),
                                                      pa.array(score, pa.int64())], names=HITS.names)
    return run


def _best(hits: DataFrame, limit: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct items: ``item_id``, ``item`` (hash of id and text) and their distinct ``terms``."""
    rows = items.select(F.col(item).alias("item_id"), F.col(text).alias("text")).distinct()
    rows = rows.withColumn("item", F.xxhash64("item_id", "text"))
    return count_terms(rows, ("item_id", "item")).select("item_id", "item", "terms").where(F.size("terms") > 0)


def asked_terms(asked: DataFrame) -> pa.Array | None:
    """The terms of all items if they are at most ``ASKED``, else None (an index of all terms)."""
    terms = asked.select(F.explode("terms").alias("term")).distinct()
    rows = terms.limit(ASKED + 1).toArrow().column("term").combine_chunks()
    return rows.cast(pa.large_string()) if len(rows) <= ASKED else None


def search(index: Index, asked: DataFrame, limit: int = 50, first: int = FIRST, growth: int = GROWTH) -> DataFrame:
    """The ``limit`` best documents of each item (of ``item_terms``): ``item_id``, ``rank``, ``doc_id``
    and ``score``."""
    asked = stage(asked, "search-items")
    n_terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    parts = 1 + n_terms // ASKED
    found = [_search(index, asked.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == p), limit, first, growth) for p in range(parts)]
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    return asked.select("item_id", "item").join(best, "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score")


def _search(index: Index, asked: DataFrame, limit: int, first: int, growth: int) -> DataFrame:
    spark = asked.sparkSession
    terms = asked.select("item", F.explode("terms").alias("term"))
    held = index.blocks.select("m", F.explode(F.arrays_zip("terms", "tops", "n_docs")).alias("t"))
    held = held.select("m", F.col("t.terms").alias("term"), F.col("t.n_docs").alias("n_docs"), F.col("t.tops").alias("tf"))
    held = stage(held.join(terms.select("term").distinct(), "term").groupBy("m", "term")
                 .agg(F.sum("n_docs").alias("n_docs"), F.max("tf").alias("tf")), "search-held")
    df = held.groupBy("term").agg(F.sum("n_docs").alias("df"))
    weighted: dict[int, list[tuple[str, int]]] = {}
    for r in terms.join(df, "term").collect():  # at most about ASKED rows
        weighted.setdefault(r.item, []).append((r.term, weight(index.n_docs, r.df)))
    shared = spark.sparkContext.broadcast(weighted)
    weights = F.floor(F.lit(1000) * F.log(F.lit(2.0 * index.n_docs + 2) / (2 * F.col("df") + 1)))
    impact = F.expr(f"({SCALE}L * tf) div (1000 * tf + 20 * m)")
    # one more on each weight: a logarithm of the other library may round the other way
    bounds = (held.join(terms.join(df, "term").select("item", "term", (weights + 1).alias("w")), "term")
              .groupBy("item", "m").agg(F.sum(F.col("w") * impact).alias("bound")).join(F.broadcast(index.strata), "m"))
    ahead = F.coalesce(F.sum("n_in").over(Window.partitionBy("item").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bounds = stage(bounds.withColumn("ahead", ahead), "search-bounds")
    best, begin, end = None, 0, first
    while begin < max(index.n_docs, 1):
        wave = bounds.where((F.col("ahead") >= begin) & (F.col("ahead") < end))
        if best is not None:
            least = best.groupBy("item").agg(F.when(F.count(F.lit(1)) >= limit, F.min("score")).alias("least"))
            wave = wave.join(F.broadcast(least), "item", "left").where("least is null or bound >= least")
        else:
            wave = wave.withColumn("least", F.lit(None).cast("long"))
        visits = (wave.select("item", F.coalesce("least", F.lit(0)).alias("least"), "m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"))
                  .groupBy("m", "block").agg(F.collect_list(F.struct("item", "least")).alias("visits")))
        hits = index.blocks.join(visits, ["m", "block"]).mapInArrow(_visit(shared, limit), HITS)
        if best is not None:
            hits = hits.unionByName(best.select(*HITS.names))
        best = stage(_best(hits, limit), "search-best")
        begin, end = end, end * growth
    return best
