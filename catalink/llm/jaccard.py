"""N-gram Jaccard join: a token-group matrix finds which documents can be similar.

A document's tokens are the hashes of its five-word shingles.  Documents with equal sets are
one class.  Classes are put into groups of similar ones (those that share a minimum hash),
and the matrix says which tokens each group's union has.  A query document and a group can
only have a link if the query's overlap with the union reaches the threshold's share of the
query's size; groups that qualify are opened and their members compared exactly.

Exactness and size:

* The matrix is stored sparsely, as (token, group) rows.  In any fixed order of tokens, two
  sets that link share at least k tokens among the first ``n - ceil(0.8 n) + k`` of each, so
  only those prefixes are joined, and a query must meet k tokens of a group.  k is a
  twentieth of the size, which keeps documents apart that merely share a passage; tokens
  that many documents have come last in the order.  (The order needs a count of tokens; it
  is kept by a fixed number of hash buckets.)
* Members of a group are compared within it, queries with the other groups they meet.
  Groups are kept to about ``GROUP_TOKENS`` tokens, so what one task opens is bounded;
  copies are one class, and near copies meet as groups, so no pairs are listed.
* An opened pair of groups gives the edges of a spanning forest of its links; connected
  components come from alternating star contractions, written to the shared folder.

Defined results: null texts and texts without words have no tokens, link with nothing, and
are a component of their own; with fewer than five words the whole sequence is one shingle;
``component_id`` is the smallest ``doc_id`` (nulls ignored) that links lead to, the document's
own included; repeated rows are each returned.  Tokens are 64-bit hashes and classes 128-bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalink.llm.common import mix64, partitions, row_key, stage, string_buffers, text_column, text_slices

WORDS = 5
PERCENT = 80
BANDS = 4
GROUP_TOKENS = 200_000
#: A linked pair must share one in so many of its tokens within the prefixes.
SHARE = 20
BUCKET_BITS = 18
SLICE = 2 << 20
#: Rows of a class that meet its component in one part.
CLASS_ROWS = 1_000
BROADCAST_BYTES = 64 << 20

_SEEDS = mix64(np.arange(1, 33, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_hashes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lower-cased, between blanks) and the bounds of texts in words."""
    offsets, raw = string_buffers(texts)
    raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    inside = ~((raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D)))
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, np.uint64), np.zeros(len(offsets), dtype=np.int64)
    begin = np.ones(len(at), dtype=bool)
    begin[1:] = np.diff(at) > 1
    head = np.zeros(len(raw) + 1, dtype=bool)
    head[offsets] = True
    begin |= head[at]
    first = np.flatnonzero(begin)
    sizes = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, sizes)
    weight = mix64(np.arange(int(sizes.max()) + 1, dtype=np.uint64) + np.uint64(0x51ED2701)) | np.uint64(1)
    sums = np.add.reduceat(weight[place] * (raw[at].astype(np.uint64) + np.uint64(1)), first)
    return mix64(sums + sizes.astype(np.uint64) * _SEEDS[20]), np.searchsorted(at[first], offsets)


def token_sets(texts: pa.LargeStringArray, words: int = WORDS) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    hashes, bounds = word_hashes(texts)
    padded = np.append(hashes, np.zeros(words, dtype=np.uint64))
    n = len(hashes)
    sums = np.full(n, _SEEDS[words + 8], dtype=np.uint64)
    for j in range(words):
        sums += padded[j: j + n] * _SEEDS[j]
    shingles = mix64(sums)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(shingles[a: b - words + 1]))
        elif b > a:
            whole = np.sum(hashes[a:b] * _SEEDS[: b - a], dtype=np.uint64, keepdims=True)
            out.append(mix64(whole + _SEEDS[8 + b - a: 9 + b - a]))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """Length of the prefix in which a linked set must share ``max(1, n // SHARE)`` tokens."""
    return n + (-n * percent) // 100 + max(1, n // SHARE) if n else 0


def least_shared(n: Column, percent: int) -> Column:
    """Tokens that a set of size n shares at least with any linked set within the prefixes:
    the other's size is at least ``percent`` of n."""
    return F.greatest(F.lit(1), F.floor(F.ceil(n * percent / 100) / SHARE))


def class_id(tokens: np.ndarray) -> bytes:
    """128-bit hash of a set."""
    low = np.sum(mix64(tokens + _SEEDS[30]), dtype=np.uint64) if len(tokens) else np.uint64(0)
    high = np.bitwise_xor.reduce(mix64(tokens ^ _SEEDS[31])) if len(tokens) else np.uint64(0)
    return np.array([low, high], dtype=np.uint64).tobytes()


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for whole in batches:
        for batch in text_slices(whole, "_text", SLICE):
            yield batch, token_sets(text_column(batch, "_text"), words)


def token_weights(rows: DataFrame, words: int, bits: int) -> np.ndarray:
    """Logarithm of the number of documents with a token of each hash bucket (2**bits bytes,
    whatever the corpus); it only orders tokens, common ones last."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for _, sets in _sets(batches, words):
            flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            total += np.bincount((flat >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    got = rows.select("_text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << bits, dtype=np.uint8)
    out[got["bucket"].to_numpy()] = np.log2(got["n"].to_numpy(dtype=np.float64)).astype(np.uint8)
    return out


def describe(rows: DataFrame, weights: np.ndarray, words: int, percent: int, bits: int) -> DataFrame:
    """``_key, doc_id, cls, h`` (the first half of ``cls``), ``n``, the minimum hashes ``b0 ..``
    and the ``prefix`` of each row."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)
    low = [f"b{i}" for i in range(BANDS)]
    schema = f"_key long, doc_id long, cls binary, h long, n long, {', '.join(f'{x} long' for x in low)}, prefix array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, words):
            weight = shared.value
            bands, prefixes = [], []
            for tokens in sets:
                if len(tokens):
                    bands.append([int(mix64(tokens ^ _SEEDS[10 + b]).min().view(np.int64)) for b in range(BANDS)])
                    order = np.argsort(weight[(tokens >> np.uint64(64 - bits)).astype(np.int64)], kind="stable")
                    prefixes.append(tokens[order[: prefix_size(len(tokens), percent)]].view(np.int64))
                else:
                    bands.append([None] * BANDS)
                    prefixes.append(np.empty(0, np.int64))
            ids = [class_id(t) for t in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("doc_id"), pa.array(ids, pa.binary()),
                 pa.array(np.array([np.frombuffer(x[:8], np.int64)[0] for x in ids], dtype=np.int64)),
                 pa.array([len(t) for t in sets], pa.int64()), *(pa.array(list(b), pa.int64()) for b in zip(*bands)),
                 pa.array(prefixes, pa.list_(pa.int64()))], names=["_key", "doc_id", "cls", "h", "n", *low, "prefix"])

    return rows.mapInArrow(run, schema)


def group_classes(classes: DataFrame, group_tokens: int) -> DataFrame:
    """``cls, h, n, _key, grp``: a class joins the largest set of classes with one of its minimum
    hashes that has at most ``group_tokens`` tokens; where all are larger, the smallest of
    them, cut by hash; where none has another class, it is a group of its own."""
    cells = classes.select("cls", "h", "n", F.posexplode(F.array(*[f"b{i}" for i in range(BANDS)])).alias("band", "low"))
    sets = (cells.groupBy("band", "low").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("tokens")).where("size > 1")
            .withColumn("parts", F.ceil(F.col("tokens") / group_tokens)))
    fits = F.col("tokens") <= group_tokens
    best = (cells.select("cls", "band", "low").join(sets, ["band", "low"])
            .groupBy("cls").agg(F.max(F.struct(fits.alias("fits"), F.when(fits, F.col("tokens")).otherwise(-F.col("tokens")).alias("rank"),
                                               "band", "low", "parts")).alias("s")))
    grp = F.when(F.col("s").isNull(), F.xxhash64("cls")).otherwise(F.xxhash64("s.band", "s.low", F.pmod("h", "s.parts")))
    return classes.select("cls", "h", "n", "_key").join(best, "cls", "left").select("cls", "h", "n", "_key", grp.alias("grp"))


def meetings(members: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    """``cls, grp, other``: a class and the groups (its own included) of which other members
    of a size that could link have enough tokens of its prefix."""
    n = partitions(members.sparkSession)
    tokens = described.select("h", F.explode("prefix").alias("token")).repartition(n, "token").distinct()
    shared = tokens.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("m > 1").select("token", "h")
    rows = stage(shared.join(members.select("cls", "h", "n", "grp"), "h"), "jaccard-tokens")
    matrix = (rows.groupBy("token", "grp").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count(F.lit(1)).alias("m"))
              .withColumnRenamed("grp", "other"))
    fits = (F.col("hi") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("lo") * percent)
    return (rows.join(matrix, "token").where(fits & ((F.col("grp") != F.col("other")) | (F.col("m") > 1)))
            .groupBy("cls", "grp", "other", "n").agg(F.count(F.lit(1)).alias("met"))
            .where(F.col("met") >= least_shared(F.col("n"), percent)).select("cls", "grp", "other"))


def compare(ids: list[bytes], sets: list[np.ndarray], side: np.ndarray, both: bool, percent: int) -> list[tuple[bytes, bytes]]:
    """Edges of a spanning forest of the links between queries (``side`` true) and the group's
    members (``side`` false), or among all where ``both``."""
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    member = np.arange(len(ids)) if both else np.flatnonzero(~side)
    query = np.arange(len(ids)) if both else np.flatnonzero(side)
    sizes = np.array([len(s) for s in sets])
    tokens = np.concatenate([sets[m] for m in member])
    owner = np.repeat(np.arange(len(member)), sizes[member])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    union, start = np.unique(tokens, return_index=True)  # the group's row of the matrix
    ends = np.append(start[1:], len(tokens))
    edges = []
    for q in query.tolist():
        at = np.minimum(np.searchsorted(union, sets[q]), len(union) - 1)
        at = at[union[at] == sets[q]]
        if len(at) * 100 < percent * sizes[q]:
            continue  # no member can reach the threshold
        lengths = ends[at] - start[at]
        posts = owner[np.repeat(start[at] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())]
        common = np.bincount(posts, minlength=len(member))
        linked = common * 100 >= percent * (sizes[q] + sizes[member] - common)
        for m in member[linked].tolist():
            a, b = find(q), find(m)
            if a != b:
                root[a] = b
                edges.append((ids[q], ids[m]))
    return edges


def link(units: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges ``u, v`` (classes) of the links within each unit (``a``, ``b``: two groups).  The
    units' rows name the document (``_key``) whose text gives the tokens of a class."""
    out = pa.schema([("u", pa.binary()), ("v", pa.binary())])

    def open_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, words):
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "cls", "side")),
                                              pa.array([t.tobytes() for t in sets], pa.binary())],
                                             names=["a", "b", "cls", "side", "tokens"])

    def verify(table: pa.Table) -> pa.Table:
        ids = table.column("cls").to_pylist()
        tokens = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in table.column("tokens").combine_chunks()]
        both = table.column("a")[0] == table.column("b")[0]
        side = table.column("side").to_numpy().astype(bool)
        edges = compare(ids, tokens, side, both, percent) if both or (side.any() and not side.all()) else []
        return pa.Table.from_pylist([{"u": u, "v": v} for u, v in edges], schema=out)

    texts = rows.select("_key", "_text").join(units, "_key").select("a", "b", "cls", "side", "_text")
    opened = texts.mapInArrow(open_sets, "a long, b long, cls binary, side boolean, tokens binary")
    # repeated rows of a document bring its tokens once
    opened = opened.repartition(partitions(rows.sparkSession), "a", "b").dropDuplicates(["a", "b", "cls", "side"])
    return opened.groupBy("a", "b").applyInArrow(verify, "u binary, v binary")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of all nodes of the edges ``u, v``: the smallest node of each connected
    component, by alternating large-star and small-star contractions."""
    pairs = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "edges")
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stage(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        done = stage(small.select("e.u", "e.v").where("u != v").distinct(), "edges")
        # finished when every node has one neighbour below it and none above: a star
        again = done.groupBy("u").count().where("count > 1").limit(1).count() or done.join(
            done.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        pairs = done
        if not again:
            stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return stars.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def component_rows(full: DataFrame, classes: DataFrame, of_class: DataFrame, class_rows: int = CLASS_ROWS) -> DataFrame:
    """The rows ``cls, doc_id, n`` with the ``component_id`` of their class.  Classes of more
    than ``class_rows`` rows (one in so many rows at most) are split into parts."""
    parts = F.ceil(F.col("size") / class_rows).cast("bigint")
    large = classes.where(F.col("size") > class_rows).select("cls", parts.alias("parts"))
    if large.count() * 64 <= BROADCAST_BYTES:  # beyond that an ordinary join
        large = F.broadcast(large)
    rows = full.select("cls", "doc_id", "n", F.monotonically_increasing_id().alias("_at")).join(large, "cls", "left")
    rows = rows.withColumn("part", F.pmod(F.col("_at"), F.coalesce("parts", F.lit(1).cast("bigint"))))
    split = of_class.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    return rows.join(split, ["cls", "part"]).select("doc_id", "n", "component_id")


def _described(rows: DataFrame, words: int, percent: int, bits: int) -> DataFrame:
    return stage(describe(rows, token_weights(rows, words, bits), words, percent, bits), "jaccard-rows")


def _classes(full: DataFrame) -> DataFrame:
    """One row for each class of equal sets; equal rows share a key."""
    return stage(full.groupBy("cls").agg(F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("first"), F.min("_key").alias("_key"),
                                         F.min("h").alias("h"), F.min("n").alias("n"), *[F.min(f"b{i}").alias(f"b{i}") for i in range(BANDS)]), "jaccard-classes")


def _nodes(rows: DataFrame, full: DataFrame, classes: DataFrame, words: int, percent: int, group_tokens: int) -> DataFrame:
    """``node, root``: the linked classes and the class that names their component."""
    members = stage(group_classes(classes, group_tokens), "jaccard-groups")
    met = meetings(members, full, percent)
    units = met.select(F.least("grp", "other").alias("a"), F.greatest("grp", "other").alias("b"), "cls",
                       (F.col("grp") < F.col("other")).alias("side"))
    units = stage(units.join(members.select("cls", "_key"), "cls"), "jaccard-units")
    return components(link(units, rows, words, percent))


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, group_tokens: int = GROUP_TOKENS,
         bits: int = BUCKET_BITS, key: str = "doc_id", text: str = "text", class_rows: int = CLASS_ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row of ``docs``."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"), row_key(key, text).alias("_key"))
    described = _described(rows, words, percent, bits)
    full = described.where("n > 0")
    classes = _classes(full)
    nodes = _nodes(rows, full, classes, words, percent, group_tokens)
    linked = nodes.join(classes.select(F.col("cls").alias("node"), "first"), "node")
    smallest = linked.groupBy("root").agg(F.min("first").alias("smallest"))
    found = linked.join(smallest, "root").select(F.col("node").alias("cls"), "smallest")
    of_class = classes.join(found, "cls", "left").select("cls", "size", F.coalesce("smallest", "first").alias("component_id"))
    alone = described.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    rows = component_rows(full, classes, of_class, class_rows).union(alone)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def representatives(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, group_tokens: int = GROUP_TOKENS,
                    bits: int = BUCKET_BITS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key`` (``row_key(key, text)``) of one row of each component: that with the smallest
    key (null last), among equal ones that with the smallest ``_key``.  Components are told
    apart by their sets, so null and repeated keys don't matter; a row without tokens stands
    for itself and its copies."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"), row_key(key, text).alias("_key"))
    described = _described(rows, words, percent, bits)
    full = described.where("n > 0")
    nodes = _nodes(rows, full, _classes(full), words, percent, group_tokens)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_key"))
    least = full.groupBy("cls").agg(first.alias("s")).join(nodes, F.col("cls") == F.col("node"), "left")
    kept = least.groupBy(F.coalesce("root", "cls").alias("root")).agg(F.min("s").alias("s")).select("s._key")
    return kept.union(described.where("n = 0").select("_key")).distinct()
