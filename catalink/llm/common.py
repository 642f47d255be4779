"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalink.session import cut_lineage, ensure_checkpoint_dir, table_path

#: Characters of text handled at once inside a task, whatever the batch Spark hands over.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once under the shared checkpoint folder and read back (lineage cut)."""
    return cut_lineage(df, f"llm-{name}")


def shared_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder of its own below the shared checkpoint folder (not yet made)."""
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/catalink-llm-{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of Spark's default file system where it has none, so that
    executors don't take it for one of their own folders."""
    if "://" in path:
        return path
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and "://" not in whole else whole


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_number(df: DataFrame, key: str, n: int) -> Column:
    """Number (from 0, below ``n``) of the range that ``key`` falls in: ranges of about
    equally many rows, cut at approximate quantiles of the narrow column (at most n values
    come to the driver).  Looked up in two steps, so that many ranges stay cheap; null is 0."""
    cuts = df.select(F.percentile_approx(key, [i / n for i in range(1, n)], 20 * n)).first()[0] if n > 1 else None
    cuts = sorted(set(cuts or []))
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i: i + step] for i in range(0, len(cuts), step)]
    below = lambda bounds: F.size(F.filter(bounds, lambda c: c < F.col(key)))
    whole = below(F.array(*[F.lit(g[-1]) for g in groups]))
    rest = F.get(F.array(*[F.array(*map(F.lit, g)) for g in groups]), whole)
    inside = whole * step + below(rest)
    return F.coalesce(F.when(whole < len(groups), inside).otherwise(F.lit(len(cuts))), F.lit(0))


def row_key(*cols: str) -> Column:
    """Key of a row by the hash of some columns; equal rows share it."""
    return F.xxhash64(*cols)


def text_column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.LargeStringArray:
    """A text column with nulls as empty strings."""
    col = batch.column(name)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.large_string()), "")


def text_slices(batch: pa.RecordBatch, name: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``limit`` bytes of text (one row at least),
    so that working arrays stay bounded by the limit and the longest text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start, n = 0, batch.num_rows
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def string_buffers(col: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 (n + 1) and the bytes of a large_string array."""
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[col.offset: col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]: offsets[-1]]


_BYTES = np.arange(256)
_LETTER = ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122))
_MARK = (_BYTES > 0x20) & (_BYTES < 0x7F) & ~_LETTER & ~((_BYTES >= 48) & (_BYTES <= 57)) & (_BYTES != 0x27)
#: Bytes that begin a character which is surely not white space.
_VISIBLE = ((_BYTES > 0x20) & (_BYTES < 0x7F)) | ((_BYTES >= 0xC3) & ((_BYTES < 0xE1) | (_BYTES > 0xE3)))


def word_chunks(col: pa.LargeStringArray, finer: bool = False) -> tuple[np.ndarray, pa.LargeStringArray]:
    """Cut each text before every blank or line feed that follows a character other than
    white space; if ``finer`` also between an ASCII letter and a punctuation mark (but the
    apostrophe), and on both sides of a line feed before a character other than white space
    (a run of white space gives its last character away there).

    Returns for each text the number of its first chunk (n + 1 numbers) and all chunks.
    Joined, the chunks of a text give the text.  After characters that may be white space
    outside ASCII (or share their lead byte) there is no cut, which only makes chunks longer.
    """
    offsets, raw = string_buffers(col)
    cut = np.zeros(len(raw) + 1, dtype=bool)
    if len(raw) > 1:
        prev = raw[:-1]
        white = (prev == 0x20) | ((prev >= 0x09) & (prev <= 0x0D)) | ((prev >= 0x1C) & (prev <= 0x1F))
        high = prev >= 0x80
        two = np.zeros(len(prev), dtype=bool)
        two[1:] = raw[:-2] == 0xC2
        three = np.zeros(len(prev), dtype=bool)
        three[2:] = (raw[:-3] >= 0xE1) & (raw[:-3] <= 0xE3)
        cut[1:-1] = ((raw[1:] == 0x20) | (raw[1:] == 0x0A)) & ~white & ~(high & (two | three))
        if finer:
            head = np.zeros(len(raw) + 1, dtype=bool)
            head[offsets] = True
            feed = _VISIBLE[raw[1:]] & (prev == 0x0A) & ~head[1:-1]  # not at the end of a text
            cut[1:-1] |= (_MARK[raw[1:]] & _LETTER[prev]) | feed
            cut[:-2] |= feed
    cut[offsets] = True
    cut[-1] = False
    starts = np.flatnonzero(cut)
    if not len(raw):
        starts = np.empty(0, np.int64)
    bounds = np.append(starts, len(raw)).astype(np.int64)
    chunks = pa.Array.from_buffers(pa.large_string(), len(starts),
                                   [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw))])
    return np.searchsorted(starts, offsets), chunks


def ragged_take(flat: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the pieces ``flat[bounds[r]:bounds[r + 1]]`` for each r of ``rows``;
    also returns the bounds of the pieces in the result."""
    sizes = (bounds[1:] - bounds[:-1])[rows]
    out = np.zeros(len(rows) + 1, dtype=np.int64)
    np.cumsum(sizes, out=out[1:])
    index = np.arange(out[-1], dtype=np.int64) + np.repeat(bounds[:-1][rows] - out[:-1], sizes)
    return flat[index], out


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (splitmix64), elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def list_array(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(bounds.astype(np.int64)), pa.array(values, type=kind))
