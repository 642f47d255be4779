"""Quoted CSV in splits: every split of a file is parsed on its own.

A line feed ends a record only outside quotes, so what a split's first line is depends on
everything before it in the file.  That dependence is a function of three values only, the
state in which a line begins (a record, a quoted field, a field whose line feed was escaped):

1. every split folds its lines to that function (begin state to end state, and whether a
   record ends in it), in parallel;
2. a prefix pass over the few rows of each file composes the functions, which gives each split
   its begin state, and the split in which the record open there began (its owner);
3. every split parses the records that begin and end in it; the ends of records that cross
   splits are joined by owner and parsed apart.

Quotes inside quoted fields may be doubled or escaped by a backslash, even in one file, as
Python's csv module reads them.  A record is the largest value held.  Works for encodings in
which the bytes of ASCII characters stand for nothing else.
"""

from __future__ import annotations

import codecs
import csv
import io
import itertools
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalink.session import cut_lineage

RECORD, QUOTED, ESCAPED = 0, 1, 2
#: Splits whose begin states are broadcast (about 100 bytes each); beyond, lines are joined by split.
BROADCAST_SPLITS = 200_000
#: Longest field, in characters; a longer one is an error.
FIELD_LIMIT = 1 << 30
PAD, FAIL = "pad", "fail"

_SPECIAL = re.compile(rb'["\\]')
_START = (0x2C, 0x0D)


def ascii_based(encoding: str) -> bool:
    name = codecs.lookup(encoding).name
    return name in ("utf-8", "utf-8-sig", "ascii") or name.startswith(("iso8859", "cp125", "latin"))


def after_line(line: bytes, state: int) -> int:
    """State in which the next line begins."""
    if b'"' not in line and b"\\" not in line:
        return QUOTED if state == QUOTED else RECORD
    n, at = len(line), 0
    quoted = state == QUOTED
    closed, free = -1, 0  # place behind a closing quote; first byte that no escape covers
    begin = state == RECORD
    while at < n and (m := _SPECIAL.search(line, at)):
        at = m.start()
        quote = line[at] == 0x22
        if quoted:
            if not quote:
                at += 2  # an escaped line feed stays in the field too
            elif at + 1 < n and line[at + 1] == 0x22:
                at += 2
            else:
                quoted, at = False, at + 1
                closed = free = at
        elif quote:
            quoted = (begin and at == 0) or (at > free and line[at - 1] in _START)
            at += 1
        elif at == closed:
            at += 1  # behind a closing quote a backslash is a character like others
        else:
            if at + 1 == n:
                return ESCAPED
            at += 2
            free = at
    return QUOTED if quoted else RECORD


def _records(lines: Iterator[bytes], state: int) -> Iterator[tuple[str, list[bytes]]]:
    """``lead`` (the lines up to the end of the record that is open at the begin), ``record`` (the
    lines of each whole record) and ``tail`` (the lines of a record that doesn't end)."""
    held: list[bytes] = []
    open_first = state != RECORD
    for line in lines:
        held.append(line)
        state = after_line(line, state)
        if state == RECORD:
            yield "lead" if open_first else "record", held
            held, open_first = [], False
    if held:
        yield "lead" if open_first else "tail", held


def _runs(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, Iterator[bytes]]]:
    """The lines of each split, with the split's values of some columns."""
    rows = (r for batch in batches for r in zip(zip(*(batch.column(c).to_pylist() for c in names)), batch.column("line").to_pylist()))
    for key, mine in itertools.groupby(rows, lambda r: r[0]):
        yield key, (line for _, line in mine)


STATES = "file string, block long, ends array<int>, closes array<boolean>"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, block), lines in _runs(batches, "file", "block"):
        states, closes = [RECORD, QUOTED, ESCAPED], [False] * 3
        for line in lines:
            if b'"' not in line and b"\\" not in line:  # most lines
                states = [QUOTED if s == QUOTED else RECORD for s in states]
            else:
                known = {s: after_line(line, s) for s in set(states)}
                states = [known[s] for s in states]
            closes = [c or s == RECORD for c, s in zip(closes, states)]
        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block], pa.int64()), pa.array([states], pa.list_(pa.int32())),
                                          pa.array([closes])], names=["file", "block", "ends", "closes"])


def _prefix(table: pa.Table) -> pa.Table:
    """Begin state and owner of each split of a file."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("block", "ends", "closes"))))
    state, owner, out = RECORD, -1, []
    for block, ends, closes in rows:
        out.append((block, state, owner))
        if ends[state] != RECORD and (state == RECORD or closes[state]):
            owner = block  # the record open at its end began here
        state = ends[state]
    file = table.column("file")[0].as_py()
    return pa.table({"file": [file] * len(out), "block": [r[0] for r in out], "state": pa.array([r[1] for r in out], pa.int32()),
                     "owner": [r[2] for r in out]})


def parse(spark: SparkSession, path: str, names: Sequence[str], encoding: str = "UTF-8", rows: str = PAD) -> DataFrame:
    """All columns as text and ``_seq`` (file, block, pos).  The first record of each file is its
    header.  Records with fewer fields than ``names`` are filled with nulls and the fields beyond
    are left out (``rows="pad"``), or either is an error (``rows="fail"``)."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    begins = cut_lineage(lines.mapInArrow(_fold, STATES).groupBy("file").applyInArrow(
        _prefix, "file string, block long, state int, owner long"), "csv-splits")
    few = begins.count() <= BROADCAST_SPLITS
    if few:
        tagged = lines.join(F.broadcast(begins), ["file", "block"])
    else:  # a split's lines stay together and in order
        numbered = lines.withColumn("_n", F.monotonically_increasing_id())
        tagged = numbered.join(begins, ["file", "block"]).sortWithinPartitions("file", "block", "_n")
    seq = pa.struct([("file", pa.string()), ("block", pa.int64()), ("pos", pa.int64())])
    fields = ", ".join(f"`{n}` string" for n in names)
    schema = f"{fields}, _seq struct<file:string,block:long,pos:long>"

    def table_of(records: list[list[str]], places: list[dict]) -> pa.RecordBatch:
        if rows == FAIL and (bad := next((i for i, r in enumerate(records) if len(r) != len(names)), None)) is not None:
            raise ValueError(f"{places[bad]} has {len(records[bad])} fields, the header {len(names)}")
        full = [[x or None for x in (r + [""] * len(names))[: len(names)]] for r in records]
        cols = [pa.array(list(c), pa.string()) for c in zip(*full)] or [pa.array([], pa.string())] * len(names)
        return pa.RecordBatch.from_arrays([*cols, pa.array(places, seq)], names=[*names, "_seq"])

    def texts(chunks: Iterator[list[bytes]]) -> Iterator[str]:
        for chunk in chunks:
            yield from io.StringIO((b"\n".join(chunk) + b"\n").decode(encoding), newline="")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(FIELD_LIMIT)
        for (file, block, state), mine in _runs(batches, "file", "block", "state"):
            reader = csv.reader(texts(held for kind, held in _records(mine, state) if kind == "record"), doublequote=True, escapechar="\\")
            if block == 0:
                next(reader, None)
            pos = 0
            while some := list(itertools.islice(reader, 10_000)):
                kept = [(r, {"file": file, "block": block, "pos": pos + i}) for i, r in enumerate(some) if r]
                pos += len(some)
                if kept:
                    yield table_of([r for r, _ in kept], [p for _, p in kept])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block, state, owner), mine in _runs(batches, "file", "block", "state", "owner"):
            header = block == 0  # whether the file's first record is still to come
            for kind, held in _records(mine, state):
                if kind != "record":
                    yield pa.RecordBatch.from_pydict({"file": [file], "owner": [owner if kind == "lead" else block], "block": [block],
                                                      "part": [b"\n".join(held)], "header": [header]})
                header = False

    def joined(table: pa.Table) -> pa.Table:
        csv.field_size_limit(FIELD_LIMIT)
        parts = sorted(zip(*(table.column(c).to_pylist() for c in ("block", "part", "header"))))
        file, owner = (table.column(c)[0].as_py() for c in ("file", "owner"))
        text = b"\n".join(p for _, p, _ in parts).decode(encoding)
        found = [r for r in csv.reader(io.StringIO(text, newline=""), doublequote=True, escapechar="\\") if r]
        found = found[1:] if parts[0][2] else found
        places = [{"file": file, "block": owner, "pos": (1 << 62) + i} for i in range(len(found))]
        return pa.Table.from_batches([table_of(found, places)])

    crossing = tagged.select("file", "block", "state", "owner", "line").mapInArrow(
        ends, "file string, owner long, block long, part binary, header boolean").groupBy("file", "owner").applyInArrow(joined, schema)
    return tagged.select("file", "block", "state", "line").mapInArrow(whole, schema).unionByName(crossing)
