"""Token ids in binary files: Arrow streams of fixed-size lists.

A table's texts are encoded, put in ascending ``doc_id`` order over range partitions, and
the ids of each partition's documents, one after the other, are cut into sequences of equal
length.  A file is an Arrow stream whose record batches hold ``ids`` (fixed-size lists of
unsigned integers) and ``mask`` (fixed-size lists of bits: which ids count).  All batches but
the last have the same number of sequences, hence the same size in bytes, so that any
sequence is found by arithmetic and, on a memory-mapped file, read without a copy.  A second
stream beside it lists the documents (``doc_id``, ``start`` in the file, ``n_tokens``).

Executors may be lost or tasks run twice: each attempt writes files of its own names, and
only those that the manifest lists (a Parquet table that Spark commits) belong to the output.

Defined results: null texts are empty and hold the end id alone; null ``doc_id`` come first;
rows of equal ``doc_id`` are ordered by their ids; an empty table gives no files; columns
other than ``doc_id`` and ``text`` are not carried.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs, ipc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalink.llm.common import partitions, qualified, ragged_take, range_number, stage, text_column, text_slices, word_chunks

SEQUENCE = 2048
#: Sequences of a record batch (a batch of 16-bit ids then has 1 MB).
BATCH = 256
#: Bytes of text whose distinct words are encoded together.
SLICE = 12 << 20
#: Words whose ids a Python worker remembers between slices; beyond that it keeps the last slice's.
REMEMBERED = 600_000
#: Words that are encoded as one line.
LINE = 1000
PLAIN = r"^ ?[\p{L}\p{N}\p{P}\p{S}]+$"
MANIFEST = "part long, path string, n_docs long, n_tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"

_tokenizers: dict = {}
_remembered: dict[str, tuple[pa.LargeStringArray, np.ndarray, np.ndarray]] = {}


def _tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        from tokenizers import Tokenizer
        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def _encode_words(tokenizer, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words and their bounds.  Words of visible characters, with a blank before them
    at most, are encoded in lines of many words: a line feed between two such words is a
    token of its own, at which the ids are cut again (and where the count doesn't fit, the
    words of the line are encoded one by one, as all other words are)."""
    feed = tokenizer.encode("\n", add_special_tokens=False).ids
    plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False) & (len(feed) == 1)
    index = np.flatnonzero(plain)
    lines = [index[k: k + LINE] for k in range(0, len(index), LINE)]
    texts = ["\n".join(words.take(pa.array(x)).to_pylist()) for x in lines]
    parts, sizes, order, alone = [], [], [], [np.flatnonzero(~plain)]
    for line, got in zip(lines, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
        ids = np.array(got.ids, dtype=np.uint32)
        at = np.flatnonzero(ids == feed[0])
        if len(at) != len(line) - 1:
            alone.append(line)
            continue
        parts.append(ids[ids != feed[0]])
        sizes.append(np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1)
        order.append(line)
    rest = np.concatenate(alone)
    for got in tokenizer.encode_batch_fast(words.take(pa.array(rest)).to_pylist(), add_special_tokens=False):
        parts.append(np.array(got.ids, dtype=np.uint32))
        sizes.append(np.array([len(got.ids)]))
    order.append(rest)
    bounds = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(np.concatenate(sizes) if sizes else np.empty(0, np.int64), out=bounds[1:])
    place = np.empty(len(words), dtype=np.int64)
    place[np.concatenate(order)] = np.arange(len(words))
    return ragged_take(np.concatenate(parts) if parts else np.empty(0, np.uint32), bounds, place)


def encode_texts(path: str, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts and their bounds by text.  The tokenizer's pattern never joins a
    blank to the character before it, nor a mark to a letter, so a text's ids are those of
    its chunks, and each distinct chunk is encoded once."""
    tokenizer = _tokenizer(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    finer = not any(pc.any(pc.match_substring(texts, x)).as_py() for x in special)  # these may hold marks
    first, chunks = word_chunks(texts, finer)
    coded = chunks.dictionary_encode()
    words, flat, bounds = _remembered.get(path) or (pa.array([], pa.large_string()), np.empty(0, np.uint32), np.zeros(1, np.int64))
    at = pc.index_in(coded.dictionary, value_set=words).fill_null(-1).to_numpy().astype(np.int64)
    new = at < 0
    fresh = coded.dictionary.filter(pa.array(new))
    more, ends = _encode_words(tokenizer, fresh)
    at[new] = len(words) + np.arange(len(fresh))
    words, flat, bounds = pa.concat_arrays([words, fresh]), np.concatenate([flat, more]), np.concatenate([bounds, bounds[-1] + ends[1:]])
    ids, out = ragged_take(flat, bounds, at[coded.indices.to_numpy(zero_copy_only=False)])
    if len(words) > REMEMBERED:
        words, (flat, bounds) = coded.dictionary, ragged_take(flat, bounds, at)
    _remembered[path] = (words, flat, bounds)
    return ids, out[first]


def encode(df: DataFrame, path: str, end_id: int, width: str = "<u2") -> DataFrame:
    """``doc_id``, ``ids`` (binary, little-endian ids of ``width``, the end id last).  Ids that
    don't fit the width are an error."""
    most = np.iinfo(np.dtype(width)).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text", SLICE):
                ids, bounds = encode_texts(path, text_column(batch, "text"))
                rows = len(bounds) - 1
                if max(end_id, int(ids.max(initial=0))) > most:
                    raise ValueError(f"an id is larger than {most}: choose a wider type than {width}")
                out = np.empty(len(ids) + rows, dtype=width)
                ends = bounds[1:] + np.arange(rows)
                keep = np.ones(len(out), dtype=bool)
                keep[ends] = False
                out[keep], out[ends] = ids, end_id
                cut = np.concatenate([[0], ends + 1]).astype(np.int64) * out.itemsize
                packed = pa.Array.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(cut), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), packed.cast(pa.binary())], ["doc_id", "ids"])

    return df.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class SequenceWriter:
    """Writes ids as equal-length sequences with masks."""

    def __init__(self, sink, length: int = SEQUENCE, batch: int = BATCH, kind: pa.DataType | None = None):
        self.length, self.batch, self.kind = length, batch, kind or pa.uint16()
        self.schema = pa.schema([("ids", pa.list_(self.kind, length)), ("mask", pa.list_(pa.bool_(), length))],
                                metadata={"sequence": str(length), "batch": str(batch)})
        self.writer = ipc.new_stream(sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.held = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.parts.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        full = self.length * self.batch
        if self.held >= full:
            held = np.concatenate(self.parts)
            for k in range(0, self.held - full + 1, full):
                self._write(held[k: k + full])
            self.held %= full
            self.parts = [held[len(held) - self.held:]]

    def _write(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        padded = np.zeros(rows * self.length, dtype=self.kind.to_pandas_dtype())
        padded[: len(ids)] = ids
        mask = np.arange(len(padded)) < len(ids)
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (padded, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._write(np.concatenate(self.parts))
        self.writer.close()


class SequenceFile:
    """Random access to a file of sequences; on a local path batches are views of the mapped file."""

    def __init__(self, uri: str):
        system, path = _filesystem(uri)
        self.file = pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path)
        self.file.seek(0)
        self.schema = ipc.read_schema(self.file)
        self.origin = self.file.tell()
        meta = self.schema.metadata
        self.length, self.batch_rows = int(meta[b"sequence"]), int(meta[b"batch"])
        self.end = self.file.size()
        self.size = 0
        self.held = (-1, None)

    def batch(self, k: int) -> pa.RecordBatch:
        """Record batch k; all before the last are of equal size."""
        if self.held[0] != k:
            if k and not self.size:
                self.batch(0)
            self.file.seek(self.origin + k * self.size)
            got = ipc.read_record_batch(ipc.read_message(self.file), self.schema)
            if not k:
                self.size = self.file.tell() - self.origin
            self.held = (k, got)
        return self.held[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence i."""
        rows = self.batch(i // self.batch_rows).slice(i % self.batch_rows, 1)
        return rows.column("ids").flatten().to_numpy(), rows.column("mask").flatten().to_numpy(zero_copy_only=False)

    def tokens(self, start: int, n: int) -> np.ndarray:
        """The n ids from position ``start`` of the file on."""
        out, per = [], self.length * self.batch_rows
        while n > 0:
            k, at = divmod(start, per)
            ids = self.batch(k).column("ids").flatten().to_numpy()[at: at + n]
            if not len(ids):
                raise EOFError(f"position {start} is past the end")
            out.append(ids)
            start, n = start + len(ids), n - len(ids)
        return np.concatenate(out) if out else np.empty(0, np.uint16)


def write(encoded: DataFrame, folder: str, length: int = SEQUENCE, batch: int = BATCH, width: str = "<u2",
          ids: DataFrame | None = None) -> DataFrame:
    """Write ``doc_id``, ``ids`` rows as sequence files in ascending doc_id order, and the
    manifest; returns the manifest (one row a file, ``part`` in doc_id order).  ``ids``: a
    narrow table with the same ``doc_id`` for the ranges, so that encoding isn't done twice."""
    n = partitions(encoded.sparkSession)
    ordered = (encoded.withColumn("part", range_number(ids if ids is not None else encoded, "doc_id", n).cast("int"))
               .repartitionById(n, F.col("part")).sortWithinPartitions("doc_id", "ids"))
    kind = pa.from_numpy_dtype(np.dtype(width))
    folder = qualified(encoded.sparkSession, folder)
    listing = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
    manifest = pa.schema([("part", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = index = None
        docs = part = 0
        for rows in batches:
            if not rows.num_rows:
                continue
            if writer is None:
                system, base = _filesystem(folder)
                system.create_dir(base, recursive=True)
                part = rows.column("part")[0].as_py()
                name = f"part-{part:06d}-{uuid.uuid4().hex}"  # an attempt's own
                sinks = [system.open_output_stream(f"{base}/{name}{x}") for x in (".ids.arrows", ".docs.arrows")]
                writer = SequenceWriter(sinks[0], length, batch, kind)
                index = ipc.new_stream(sinks[1], listing)
            starts, sizes = [], []
            for blob in rows.column("ids"):
                ids = np.frombuffer(blob.as_buffer(), dtype=width)
                starts.append(writer.total)
                sizes.append(len(ids))
                writer.add(ids)
            docs += rows.num_rows
            index.write_batch(pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(starts, pa.int64()),
                                                          pa.array(sizes, pa.int64())], schema=listing))
        if writer is not None:
            writer.close()
            index.close()
            for x in sinks:
                x.close()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([f"{folder}/{name}"]), pa.array([docs]),
                                              pa.array([writer.total])], schema=manifest)

    return stage(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """One row a document, read from the files: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens``, ``ids_crc32`` (of the ids as little-endian 32-bit integers)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for path, base in zip(rows.column("path").to_pylist(), rows.column("base").to_pylist()):
                data = SequenceFile(f"{path}.ids.arrows")
                system, where = _filesystem(f"{path}.docs.arrows")
                with system.open_input_stream(where) as source, ipc.open_stream(source) as listing:
                    for docs in listing:
                        spans = zip(docs.column("start").to_pylist(), docs.column("n_tokens").to_pylist())
                        crc = [zlib.crc32(data.tokens(a, n).astype("<u4")) for a, n in spans]
                        starts = docs.column("start").to_numpy() + base
                        yield pa.RecordBatch.from_arrays([docs.column("doc_id"), pa.array(starts), docs.column("n_tokens"),
                                                          pa.array(crc, pa.int64())], schema=out)

    return files.repartition(partitions(manifest.sparkSession)).mapInArrow(run, DOCUMENTS)


def write_documents(spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Encode, write and list: the manifest of the files of ``docs``."""
    return write(encode(docs, tokenizer, end_id), folder, ids=docs.select("doc_id"))
