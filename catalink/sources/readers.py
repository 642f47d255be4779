"""Readers for dirty CSV sources and typed Parquet tables.

Columns are bound by the names in the file's header, whatever their order and whatever
other columns there are; a name that the header lacks is an error.  Everything is read as
text.  ``escape`` says how quotes inside quoted fields are written: doubled (``DOUBLED``),
after a backslash (``BACKSLASH``), or either way, even in one file (``EITHER``).  Spark's
parser knows one way at a time and takes a multi-line file in one task, so ``EITHER`` has a
parser of its own, in which every split of a file is parsed apart (``splits``); files in an
encoding that is not based on ASCII are brought into one task each and stream by there.  (A
quote that is never closed takes the rest of its file, less a line feed at the very end.)

Rows with fewer fields than the header are filled with nulls and fields beyond it are left
out, as Spark's parser does; ``rows="fail"`` (``EITHER`` only) makes either an error.

``with_file_order`` captures the physical order of rows (file, block start, position) in
``_seq`` so keep-first deduplication can honour file order.
"""

from __future__ import annotations

import csv
import io
import itertools
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalink.functions.expressions import strip
from catalink.sources import splits


#: What the long tables' sources write for a missing value.
LONG_MISSING = ("", "NA", "N/A", "NaN", "nan", "None", "null", "NULL", "n/a", "<NA>", "#N/A")
DOUBLED, BACKSLASH, EITHER = '"', "\\", "either"


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def header_of(spark: SparkSession, path: str, encoding: str = "UTF-8", escape: str = DOUBLED) -> list[str]:
    """Column names of the first file's header line (no pass over the data)."""
    lines = (spark.read.option("encoding", encoding).option("quote", '"')
             .option("escape", DOUBLED if escape == EITHER else escape).csv(path))
    return [(c or "").lstrip("\ufeff").strip() for c in lines.limit(1).first() or ()]


class _Joined(io.RawIOBase):
    """Bytes of a file from runs of its lines, read one after the other."""

    def __init__(self, runs: Iterator[bytes]):
        self.runs, self.left, self.begun = runs, memoryview(b""), False

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not len(self.left):
            run = next(self.runs, None)
            if run is None:
                return 0
            self.left, self.begun = memoryview(b"\n" + run if self.begun else run), True
        n = min(len(buffer), len(self.left))
        buffer[:n], self.left = self.left[:n], self.left[n:]
        return n


def _parse_either(spark: SparkSession, path: str, names: Sequence[str], encoding: str) -> DataFrame:
    """All columns and ``_seq`` (file, block, pos) of files that escape quotes either way."""
    seq = pa.struct([("file", pa.string()), ("block", pa.int64()), ("pos", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(splits.FIELD_LIMIT)
        runs = ((file, b"\n".join(x for _, x in rows)) for batch in batches for file, rows in itertools.groupby(
            zip(batch.column("file").to_pylist(), batch.column("line").to_pylist()), lambda r: r[0]))
        for file, mine in itertools.groupby(runs, lambda r: r[0]):
            text = io.TextIOWrapper(io.BufferedReader(_Joined(x for _, x in mine), 1 << 16), encoding=encoding, newline="")
            lines = csv.reader(text, doublequote=True, escapechar="\\")
            next(lines, None)
            pos = 0
            while rows := [r for r in itertools.islice(lines, 10_000)]:
                rows = [[x or None for x in (r + [""] * len(names))[: len(names)]] for r in rows if r]
                place = [{"file": file, "block": 0, "pos": pos + i} for i in range(len(rows))]
                pos += len(rows)
                cols = [pa.array(list(c), pa.string()) for c in zip(*rows)] or [pa.array([], pa.string())] * len(names)
                yield pa.RecordBatch.from_arrays([*cols, pa.array(place, seq)], names=[*names, "_seq"])

    fields = ", ".join(f"`{n}` string" for n in names)
    # the bytes between line feeds, undecoded; splits of a file meet again in its order
    lines = with_file_order(spark.read.option("lineSep", "\n").text(path))
    lines = lines.select("_seq.*", F.col("value").cast("binary").alias("line")).repartition("file").sortWithinPartitions("file", "block", "pos")
    return lines.select("file", "line").mapInArrow(run, f"{fields}, _seq struct<file:string,block:long,pos:long>")


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None, encoding: str = "UTF-8",
                  multiline: bool = True, escape: str = EITHER, missing: Sequence[str] = (), order: bool = False,
                  rows: str = splits.PAD) -> DataFrame:
    """CSV scan, every column as text; ``columns`` (all, if None) are chosen by header name.
    Empty fields and the texts in ``missing`` are null; ``order`` adds ``_seq``."""
    names = header_of(spark, path, encoding, escape)
    absent = [c for c in columns or () if c not in names]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}; its header is {', '.join(names)}")
    if escape == EITHER and splits.ascii_based(encoding):
        parsed = splits.parse(spark, path, names, encoding, rows)
    elif escape == EITHER:
        parsed = _parse_either(spark, path, names, encoding)
    else:
        parsed = (spark.read.schema(text_schema(names)).option("header", True).option("encoding", encoding)
                .option("multiLine", multiline).option("escape", escape).option("quote", '"').option("mode", "PERMISSIVE").csv(path))
        parsed = with_file_order(parsed) if order else parsed
    chosen = {c: F.col(f"`{c}`") for c in columns or names}
    if missing:
        chosen = {c: F.when(~x.isin(list(missing)), x) for c, x in chosen.items()}
    return parsed.select(*[x.alias(c) for c, x in chosen.items()], *(["_seq"] if order else []))


def with_file_order(df: DataFrame, name: str = "_seq") -> DataFrame:
    """Attach the physical row order (file path, block start, position)."""
    return df.withColumn(name, F.struct(F.col("_metadata.file_path").alias("file"),
                                        F.col("_metadata.file_block_start").alias("block"),
                                        F.monotonically_increasing_id().alias("pos")))


def read_long_csv(spark: SparkSession, path: str, key: str, value: str, encoding: str = "UTF-8",
                  missing: Sequence[str] = LONG_MISSING) -> DataFrame:
    """Long (key, value) table with doubled quotes: drop rows missing either, key to bigint,
    value stripped."""
    raw = read_csv_text(spark, path, [key, value], encoding, escape=DOUBLED, missing=missing)
    return (raw.where(F.col(key).isNotNull() & F.col(value).isNotNull())
               .select(F.col(key).try_cast("bigint").alias(key), strip(value).alias(value)))


def read_required(spark: SparkSession, path: str, columns: Sequence[str],
                  required: Sequence[str], encoding: str = "UTF-8",
                  dedupe_first: bool = True, escape: str = EITHER) -> DataFrame:
    """CSV with required columns: drop rows missing any, keep the first row
    per value of the first required column (file order)."""
    from catalink.operators.dedupe import keep_first
    df = read_csv_text(spark, path, columns, encoding, escape=escape, order=True)
    for c in required:
        df = df.where(F.col(c).isNotNull())
    if dedupe_first:
        df = keep_first(df, [required[0]], ["_seq"])
    return df.drop("_seq")


def read_parquet(spark: SparkSession, path: str, date_columns: Sequence[str] = ()) -> DataFrame:
    """Typed reload; text dates become dates (unparsable ones null)."""
    df = spark.read.parquet(path)
    if date_columns:
        df = df.withColumns({c: F.col(c).try_cast("date") for c in date_columns})
    return df


def land_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a CSV-read source once as Parquet (splittable, typed, pruned scans)."""
    df.write.mode(mode).parquet(path)


__all__ = ["DOUBLED", "BACKSLASH", "EITHER", "header_of", "read_csv_text", "with_file_order", "read_long_csv", "read_required", "read_parquet",
           "land_parquet"]
