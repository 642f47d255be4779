"""Periodic runs of words: seeds on diagonals, extended along their lag.

A run is a stretch of words in which words ``q`` apart are identical, ``q`` being its smallest
period, of at least ``LEAST`` words and ``TIMES * q``, that no neighbouring word extends.  A run
of period q and length n is a match of n - q words between positions i and i + q, a stretch
of the diagonal of lag q.  Periods are taken in ranges (1, 2, 3-4, 5-8, ...); k is the overlap
that the shortest run of a range is sure to have on its diagonal (5, 6, 9, 15, ... words).

* Index: k-grams are named exactly, by doubling (the name of 2h words is the pair of names
  of its halves), and only grams that recur in their document are kept, so ordinary text
  drops out after the first levels.
* Pairs: occurrences of a k-gram in one document are paired with the next one only.  That is
  enough, and linear: as k >= q, a nearer occurrence inside a run would give the run a
  smaller period.
* Furthest covered: seeds are sorted by lag and position; a seed next to its predecessor on
  the lag is covered by it and not extended again, so a chain of seeds is one extension.  It
  is as long as the match: where the diagonal went on, there would be one more seed.  Its lag
  is the smallest period for the same reason as above.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; null, empty and blank texts have no words
and no runs and collapse to the empty string; a text is handled whole, and a slice holds one
text at least; rows are mapped one by one, so repeated rows, ties and further columns don't
matter, and columns of the input other than ``keep`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from catalink.llm.common import string_buffers, text_column, text_slices

LEAST = 6
TIMES = 4
#: Bytes of text handled together.
SLICE = 2 << 20

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
                       T.StructField("collapsed", T.StringType())])


def split_words(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A number for each word (equal words share it), the first word of each text (n + 1
    numbers), the bytes of all words and the bounds of each."""
    offsets, raw = string_buffers(texts)
    inside = ~_WHITE[raw]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(raw)]
    start[heads] = inside[heads]
    starts = np.flatnonzero(start)
    letters = np.ascontiguousarray(raw[inside])
    before = np.cumsum(inside, dtype=np.int64)
    bounds = np.append(before[starts] - 1, len(letters)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return ids, np.searchsorted(starts, offsets), letters, bounds


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by key, and whether each of the ordered keys equals the one before."""
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), dtype=bool)
    again[1:] = key[order[1:]] == key[order[:-1]]
    return order, again


def _rename(at: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Names (-1 for none) of the grams at ``at`` that occur more than once, and their places."""
    names = np.full(n, -1, dtype=np.int64)
    order, again = _groups(key)
    more = again.copy()
    more[:-1] |= again[1:]
    names[at[order]] = np.where(more, np.cumsum(~again), -1)
    return names, np.flatnonzero(names >= 0)


def find_runs(ids: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period; ``first`` bounds the texts
    in ``ids`` and starts count from the first word of all."""
    n = len(ids)
    sizes = np.diff(first)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    end = first[1:][doc]
    names, alive = _rename(np.arange(n), doc * (ids.max(initial=0) + 1) + ids, n)
    size, lo, hi = 1, 1, 1
    found = [np.empty((0, 3), dtype=np.int64)]
    while len(alive) and max(least, times * lo) <= sizes.max(initial=0):
        k = min(max(least - q, (times - 1) * q) for q in range(lo, min(hi, least) + 1)) if lo <= least else (times - 1) * lo
        while 2 * size <= k and len(alive):
            at = alive[alive + 2 * size <= end[alive]]
            at = at[names[at + size] >= 0]
            names, alive = _rename(at, names[at] * (n + 1) + names[at + size], n)
            size *= 2
        at = alive[alive + k <= end[alive]]
        at = at[names[at + k - size] >= 0]
        order, again = _groups(names[at] * (n + 1) + names[at + k - size])
        here = at[order]
        lag = here[1:] - here[:-1]
        seed = again[1:] & (lag >= lo) & (lag <= hi)
        table = np.sort(lag[seed] * (n + 1) + here[:-1][seed])  # by lag, then position
        if len(table):
            fresh = np.append(True, np.diff(table) != 1)  # not covered by the seed before on its lag
            period, start = np.divmod(table[fresh], n + 1)
            last = table[np.append(fresh[1:], True)] % (n + 1)
            length = last + k - start + period
            long = length >= np.maximum(least, times * period)
            found.append(np.stack([start, length, period], axis=1)[long])
        lo, hi = hi + 1, 2 * hi
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapse(runs: np.ndarray, first: np.ndarray, letters: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts of the words that stay (of a run, its first period), joined by one blank: all
    bytes and their bounds by text."""
    n = len(bounds) - 1
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    stays = np.cumsum(edge[:-1]) == 0
    sizes = np.diff(bounds) + 1
    spaced = np.full(len(letters) + n, 0x20, dtype=np.uint8)
    letter = np.ones(len(spaced), dtype=bool)
    letter[np.cumsum(sizes) - 1] = False
    spaced[letter] = letters
    kept = np.repeat(stays, sizes)
    ends = np.append(0, np.cumsum(sizes))
    last = np.where(stays, np.arange(n), -1)
    last = np.maximum.accumulate(last)[first[1:][first[1:] > first[:-1]] - 1]  # a text's first word always stays
    kept[ends[last + 1] - 1] = False
    return spaced[kept], np.append(0, np.cumsum(kept, dtype=np.int64))[ends[first]]


def find(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Columns ``keep``, ``n_words``, ``runs`` (start, length and period in words, by start and
    period) and ``collapsed``: the text's words but those that a run repeats."""
    schema = T.StructType([*(df.schema[c] for c in keep), *RESULT.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "_text", SLICE):
                ids, first, letters, bounds = split_words(text_column(batch, "_text"))
                runs = find_runs(ids, first, least, times)
                out, at = collapse(runs, first, letters, bounds)
                row = np.searchsorted(first, runs[:, 0], side="right") - 1
                lists = np.searchsorted(runs[:, 0], first).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(runs[:, 0] - first[row]), pa.array(runs[:, 1]), pa.array(runs[:, 2])],
                                                   names=RUN.names)
                texts = pa.Array.from_buffers(pa.large_string(), batch.num_rows,
                                              [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(out))])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), pa.array(np.diff(first).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(lists), spans), texts.cast(pa.string())], names=[*keep, *RESULT.names])

    return df.select(*keep, df[text].alias("_text")).mapInArrow(run, schema)
