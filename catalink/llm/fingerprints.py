"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line that isn't blank; its digest is a 64-bit hash, and a text's set of
digests goes into a sketch of cells (three tables; each digest is in one cell of each).  A
cell has the number of its digests, their exclusive or, and the exclusive or of a check
hash.  Two sketches subtract cell by cell, so that what both texts have vanishes; cells with
one digest left give it away, it is taken out of its other cells, and so on (peeling), until
the digests that only one text has are recovered.  Where that fails, the difference being too
large for the cells, it is tried again with four times the cells, and at the last size
(``SIZES``) digests are compared as sets, so the result is always exact.  The likeness is
the Jaccard similarity of the sets of digests.  Everything is DataFrame expressions; the
larger sizes are evaluated for the rows that need them only.

Defined results: null texts are empty; a text without paragraphs has an empty sketch, and
two such texts have likeness 1; a line repeated within a text counts once; equal texts have
equal fingerprints.  ``next_texts``: rows of equal ``doc_id`` follow each other by text,
null ids come last; a single document is next to itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalink.llm.common import partitions, range_number

#: Numbers of cells to try, each divisible by three.
SIZES = (36, 144, 576, 2304)
ROUNDS = 16


def digests(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.trim(x) != "")
    return F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))


def _check(key: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("check"), key), F.lit(1 << 32))


def _placed(key: Column, n: Column, cells: int) -> Column:
    """A digest with its check and its cell in each table."""
    third = cells // 3
    spots = [(F.pmod(F.xxhash64(F.lit(i), key), F.lit(third)) + i * third).cast("int").alias(f"i{i}") for i in range(3)]
    return F.struct(n.alias("n"), key.alias("k"), _check(key).alias("c"), *spots)


def _here(p: Column, at: Column) -> Column:
    return (p["i0"] == at) | (p["i1"] == at) | (p["i2"] == at)


def _cell(n: Column, k: Column, c: Column) -> Column:
    return F.struct(n.cast("bigint").alias("n"), k.alias("k"), c.alias("c"))


def sketch(keys: Column, cells: int) -> Column:
    """Sketch of an array of distinct digests."""
    placed = F.transform(keys, lambda k: _placed(k, F.lit(1).cast("bigint"), cells))
    zero = F.lit(0).cast("bigint")
    whole = F.struct(placed.alias("p"))

    def fill(at: Column, ps: Column) -> Column:
        return F.aggregate(F.filter(ps, lambda p: _here(p, at)), _cell(zero, zero, zero),
                           lambda a, p: _cell(a["n"] + 1, a["k"].bitwiseXOR(p["k"]), a["c"].bitwiseXOR(p["c"])))

    # the placed digests are bound once, not once a cell
    return F.get(F.transform(F.array(whole), lambda w: F.transform(F.sequence(F.lit(0), F.lit(cells - 1)), lambda at: fill(at, w["p"]))), 0)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _cell(x["n"] - y["n"], x["k"].bitwiseXOR(y["k"]), x["c"].bitwiseXOR(y["c"])))


def peel(difference: Column, cells: int) -> Column:
    """Digests of a difference with their signs (1: first text only, -1: second), as an
    array of structs (n, k); null where cells are left that can't be peeled."""
    none = F.array().cast("array<struct<n:bigint,k:bigint>>")

    def step(acc: Column, _: Column) -> Column:
        pure = F.filter(acc["cells"], lambda c: (F.abs(c["n"]) == 1) & (_check(c["k"]) == c["c"]))
        found = F.array_distinct(F.transform(pure, lambda c: _placed(c["k"], c["n"], cells)))

        def remove(ps: Column) -> Column:
            left = F.transform(acc["cells"], lambda c, at: F.aggregate(
                F.filter(ps, lambda p: _here(p, at)), c,
                lambda a, p: _cell(a["n"] - p["n"], a["k"].bitwiseXOR(p["k"]), a["c"].bitwiseXOR(p["c"]))))
            got = F.concat(acc["got"], F.transform(ps, lambda p: F.struct(p["n"].alias("n"), p["k"].alias("k"))))
            return F.struct(left.alias("cells"), got.alias("got"), (F.size(ps) > 0).alias("more"))

        once = F.get(F.transform(F.array(F.struct(found.alias("p"))), lambda w: remove(w["p"])), 0)
        return F.when(acc["more"], once).otherwise(acc)

    start = F.struct(difference.alias("cells"), none.alias("got"), F.lit(True).alias("more"))
    empty = lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["c"] == 0)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step,
                       lambda a: F.when(F.forall(a["cells"], empty), a["got"]))


def recovered(a: Column, b: Column, first: Column, sizes: tuple[int, ...] = SIZES) -> Column:
    """Differing digests of two arrays of digests: peeled from ``first`` (the difference of
    their sketches of the first size), then from larger ones, at last compared as sets."""
    tries = [peel(first, sizes[0])]
    tries += [peel(subtract(sketch(a, n), sketch(b, n)), n) for n in sizes[1:]]
    sign = lambda s: lambda k: F.struct(F.lit(s).cast("bigint").alias("n"), k.alias("k"))
    plain = F.concat(F.transform(F.array_except(a, b), sign(1)), F.transform(F.array_except(b, a), sign(-1)))
    return F.coalesce(*tries, plain)


def likeness(n_a: Column, differing: Column) -> Column:
    """Jaccard similarity from the first set's size and the differing digests."""
    gone = F.size(F.filter(differing, lambda d: d["n"] > 0))
    new = F.size(differing) - gone
    return F.when(n_a + new == 0, 1.0).otherwise((n_a - gone) / (n_a + new))


def text_form(cells: Column) -> Column:
    """A sketch as text: number.keys.checks of each cell, the last two in hex."""
    return F.array_join(F.transform(cells, lambda c: F.when(c["n"] == 0, "").otherwise(
        F.concat_ws(".", c["n"], F.lower(F.hex(c["k"])), F.lower(F.hex(c["c"]))))), ",")


def next_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``text`` and ``next``: the text of the row after it in descending order (after
    the last row the first).  Ranges of the key are ordered on their own; the last row of a
    range takes the first of the next lower one."""
    n = 4 * partitions(docs.sparkSession)
    rows = docs.select(key, F.coalesce(text, F.lit("")).alias("text"), range_number(docs.select(key), key, n).alias("range"))
    heads = rows.groupBy("range").agg(F.max(key).alias("_head"))  # a row for each range
    heads = (rows.join(F.broadcast(heads.withColumnRenamed("range", "_range")),
                       (F.col("range") == F.col("_range")) & F.col(key).eqNullSafe(F.col("_head")))
             .groupBy("range").agg(F.min("text").alias("_first")))
    order = Window.orderBy(F.desc("range"))
    ends = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("range", F.coalesce(F.lead("_first").over(order), F.first("_first").over(ends)).alias("_first"))
    inside = Window.partitionBy("range").orderBy(F.desc_nulls_last(key), "text")
    return (rows.withColumn("next", F.lead("text").over(inside)).join(heads, "range")
            .select(key, "text", F.coalesce("next", "_first").alias("next")))


def compare(rows: DataFrame, other: str, name: str, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """Add ``name``: the likeness of the columns ``text`` and ``other``; needs their digests
    (``_d_*``) and sketches (``_s_*``)."""
    first = subtract(F.col("_s_text"), F.col(f"_s_{other}"))
    differing = recovered(F.col("_d_text"), F.col(f"_d_{other}"), first, sizes)
    return rows.withColumn("_diff", differing).withColumn(name, likeness(F.size("_d_text"), F.col("_diff"))).drop("_diff")


def fingerprint(rows: DataFrame, texts: tuple[str, ...], sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """Add to each text column its digests (``_d_<name>``) and sketch (``_s_<name>``)."""
    rows = rows.withColumns({f"_d_{t}": digests(F.col(t)) for t in texts})
    return rows.withColumns({f"_s_{t}": sketch(F.col(f"_d_{t}"), sizes[0]) for t in texts})
