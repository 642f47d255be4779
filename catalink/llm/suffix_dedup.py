"""Removal of repeated byte strings by suffix arrays.

A byte of a text goes if a string of ``LENGTH`` bytes that covers it also starts in a document
with a smaller id; matches never cross documents and are judged on the whole input.

* Shards: a task cuts its texts into shards of bounded size (long texts into overlapping
  segments).  Each gets a suffix array by Larsson-Sadakane refinement: sorted by the first
  eight bytes, then only groups still tied are sorted by the rank of what follows, doubling
  the depth until it reaches ``LENGTH``; and common prefixes by Kasai's rule, all lanes of
  the text advancing together.  Neighbours that share ``LENGTH`` bytes are one string.  Starts of
  a string that a smaller document of the shard has are marked there and go no further:
  passages that very many documents share are thus reduced before anything is shuffled, and
  the most repeated ones ride along into the task's next shards.
* Across shards: comparing shards of documents by pairs would be quadratic.  So each start
  that is left is filed by content: under the least hash of the 16-byte grams of its string
  (equal strings have equal least hashes; starts in a row with one least hash are one piece).
  First only hashes travel: of pieces that are equal (96 bits and the length) all but the
  smallest document's are marked, and pieces under hashes of one document alone are done.  The
  bytes of what is left, the ends of shared passages, are fetched and meet in content shards,
  in blocks of whole hashes, each a suffix array of its own.  A hash with more pieces than a
  block holds is cut into several blocks, whose sorted distinct strings are merged by binary
  search.

Defined results: null and empty texts have nothing to remove; texts shorter than ``LENGTH``
stay whole; rows with the same id don't remove from each other, so repeated rows have equal
results; a null id is greater than all others; what remains is binary, for a cut may fall
inside a character.  Other columns are kept, but those named like the result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalink.llm.common import mix64, ragged_take, string_buffers, text_column, text_slices

LENGTH = 50
#: Bytes of a hashed gram; every string of ``LENGTH`` bytes holds ``LENGTH - GRAM + 1`` of them.
GRAM = 16
#: Bytes of text in a shard of documents, and of pieces in a block of a content shard (with
#: what is added, below 2^21: then ranks fit the fast sort).
SHARD = 7 << 18
BLOCK = 7 << 18
#: Bytes of text whose pieces make up a content shard.
CONTENT = 24 << 20
#: Bytes of much repeated text that ride along from shard to shard of a task.
CARRY = 128 << 10
MANY = 8
#: Numbers that are hashed together: few enough to stay in a core's cache between the steps.
STRETCH = 1 << 15
LAST = np.iinfo(np.int64).max
OWN = ("_order", "_k1", "_k2", "_text", "_more", "marks", "pieces", "n_bytes", "n_removed", "spans", "kept")
_STEPS = np.array([1 << s for s in range(8, 64, 8)], dtype=np.uint64)


def words8(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number (zeros behind the end),
    with enough zeros behind for reads past the end."""
    n = len(raw)
    padded = np.zeros(n + 8 + 2 * LENGTH + 64, dtype=np.uint8)
    padded[:n] = raw
    out = padded.astype(np.uint64)
    for width in (1, 2, 4):
        out = (out[:-width] << np.uint64(8 * width)) | out[width:]
    return out[: n + 2 * LENGTH + 64]


def _ordered(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by key (of so many bits) and the sorted keys: keys and places sorted as one
    number where they fit, which is several times faster."""
    room = max(len(key) - 1, 1).bit_length()
    if bits + room > 64:
        order = np.argsort(key)
        return order, key[order]
    packed = (key.astype(np.uint64) << np.uint64(room)) | np.arange(len(key), dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << room) - 1)).astype(np.int64), packed >> np.uint64(room)


def suffix_array(raw: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions sorted by their first ``depth`` bytes at least (ties beyond that in any order);
    which places share the last depth but one with the place before; that depth."""
    n = len(raw)
    room = max(n + 1, 1).bit_length()
    used = np.zeros(256, dtype=bool)
    used[raw] = True
    code = np.cumsum(used).astype(np.uint64)  # few bits a byte: more bytes in the first key; 0 is the end
    bits = max(int(used.sum()), 1).bit_length()
    h = max(1, min((64 - room) // bits, 8))
    letters = np.zeros(n + h, dtype=np.uint64)
    letters[:n] = code[raw]
    key, width = letters, 1
    while 2 * width <= h:
        key = (key[:-width] << np.uint64(bits * width)) | key[width:]
        width *= 2
    while width < h:
        key = (key[:n + h - width] << np.uint64(bits)) | letters[width: n + h]
        width += 1
    sa, key = _ordered(key[:n], bits * h)
    # of the group, 1 at least; 0 behind the end
    rank = np.zeros(n + depth + 8, dtype=np.int32 if n < (1 << 31) - 1 else np.int64)

    def groups(places: np.ndarray, at: np.ndarray, sorted_key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rank the groups of equal keys at the places; places still tied, what is there and its rank."""
        head = np.ones(len(places) + 1, dtype=bool)
        np.not_equal(sorted_key[1:], sorted_key[:-1], out=head[1:-1])
        ranks = np.maximum.accumulate((places + 1) * head[:-1])
        rank[at] = ranks
        some = np.flatnonzero(~(head[:-1] & head[1:]))
        return places[some], at[some], ranks[some]

    tied, at, ranks = groups(np.arange(n), sa, key)
    alike = np.zeros(n, dtype=bool)
    while True:
        if 2 * h >= depth and len(tied):
            alike[tied[1:]] = ranks[1:] == ranks[:-1]
        if len(tied):
            order, key = _ordered((ranks << room) | rank[at + h], 2 * room)
            at = at[order]
            sa[tied] = at
            tied, at, ranks = groups(tied, at, key)
        if 2 * h >= depth:
            return sa, alike, h
        h *= 2


def common_prefixes(words: np.ndarray, sa: np.ndarray, alike: np.ndarray, shared: int, cap: int) -> np.ndarray:
    """For each place of the suffix array the bytes shared with the place before, ``cap`` at
    most, where ``alike`` says that it is ``shared`` at least; 0 elsewhere.  Kasai's rule (a
    suffix shares at least one byte less than the suffix one byte to the left), in lanes of
    the text that advance together; a value that reached the cap says nothing about order
    beyond it, so there the count starts anew."""
    n = len(sa)
    places = np.flatnonzero(alike)
    steps = max(1, min(256, n // 1024))
    lanes = -(-n // steps)
    step, at = sa[places] % steps, sa[places] // steps
    order = _ordered(step * lanes + at, max(steps * lanes, 1).bit_length())[0]  # a step of all lanes after the other
    places, at = places[order], at[order]
    edge = np.append(0, np.cumsum(np.bincount(step, minlength=steps)))
    have = np.zeros(lanes, dtype=np.int64)
    out = np.zeros(n, dtype=np.int64)
    for s in range(steps):
        now = slice(edge[s], edge[s + 1])
        lane = at[now]
        i, j = sa[places[now]], sa[places[now] - 1]
        h = have[lane]
        h = np.where(h >= cap, shared, np.maximum(h - 1, shared))
        live = np.arange(len(lane))
        while len(live):
            x = words[i[live] + h[live]] ^ words[j[live] + h[live]]
            h[live] += 8
            part = x != 0
            h[live[part]] -= np.searchsorted(_STEPS, x[part], side="right") + 1
            live = live[~part]
            live = live[h[live] < cap]
        have[:] = 0
        have[lane] = h
        out[places[now]] = np.minimum(h, cap)
    return out


def strings(raw: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all strings of ``length`` bytes inside the texts, sorted by string; where in
    them each distinct string begins; the text of each start; the eight-byte words of the input."""
    words = words8(raw)
    n = len(raw)
    sa, alike, shared = suffix_array(raw, length)
    new = common_prefixes(words, sa, alike, shared, length) < length
    text = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    ends = np.repeat(bounds[1:], np.minimum(np.diff(bounds), length - 1))
    inside = np.ones(n, dtype=bool)
    inside[ends - 1 - runs_count(np.minimum(np.diff(bounds), length - 1))] = False
    good = np.flatnonzero(inside[sa])
    starts = sa[good]
    string = np.cumsum(new, dtype=np.int32 if n < 1 << 31 else np.int64)[good]
    first = np.flatnonzero(np.append(True, string[1:] != string[:-1])) if len(starts) else np.empty(0, np.int64)
    return starts, first, text[starts], words


def runs_count(sizes: np.ndarray) -> np.ndarray:
    """Numbers from 0 within each of the runs of these sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def gram_hashes(words: np.ndarray, n: int, length: int) -> np.ndarray:
    """Hashes of the grams that begin at each position or within a string's reach behind."""
    n += length - GRAM + 1
    out = np.empty(n, dtype=np.uint64)
    for a in range(0, n, STRETCH):
        b = min(a + STRETCH, n)
        out[a:b] = mix64(words[a:b] ^ mix64(words[a + 8: b + 8] + np.uint64(1)) ^ (words[a + GRAM - 8: b + GRAM - 8] * np.uint64(0x9E3779B97F4A7C15)))
    return out


def least_hashes(grams: np.ndarray, n: int, length: int) -> np.ndarray:
    """For each position the least hash of the grams of its string of ``length`` bytes."""
    span = length - GRAM + 1
    out = np.empty(n, dtype=grams.dtype)
    for a in range(0, n, STRETCH):
        b = min(a + STRETCH, n)
        part, width = grams[a: b + span], 1
        while 2 * width <= span:
            part = np.minimum(part[:-width], part[width:])
            width *= 2
        np.minimum(part[:b - a], part[span - width: span - width + b - a], out=out[a:b])
    return out


def piece_hashes(grams: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the pieces whose strings start from ``begin`` up to ``end``: sums of their grams'
    hashes times powers of an odd number, shifted to the piece's beginning."""
    up, down = _powers(len(grams) + 1)
    sums = np.zeros(len(grams) + 1, dtype=np.uint64)
    np.cumsum(grams * up[:-1], out=sums[1:])
    return mix64((sums[end + length - GRAM] - sums[begin]) * down[begin])


@functools.lru_cache(maxsize=1)
def _all_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    odd = 0x9E3779B97F4A7C15
    return tuple(np.append(np.uint64(1), np.cumprod(np.full(n - 1, x, dtype=np.uint64), dtype=np.uint64))
                 for x in (odd, pow(odd, -1, 1 << 64)))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _all_powers(1 << (n - 1).bit_length())
    return up[:n], down[:n]


def runs_of(mask: np.ndarray, *alike: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of true values in which each of ``alike`` is constant."""
    at = np.flatnonzero(mask)
    if not len(at):
        return at, at
    cut = np.diff(at) != 1
    for values in alike:
        cut |= values[at[1:]] != values[at[:-1]]
    edge = np.flatnonzero(cut)
    return at[np.append(0, edge + 1)], at[np.append(edge, len(at) - 1)] + 1


class Shards:
    """Cuts a task's texts into shards and emits their marks and the hashes of their pieces."""

    def __init__(self, n_content: int, length: int, shard: int):
        self.n, self.length, self.shard = n_content, length, shard
        self.carried: list[tuple[bytes, int]] = []
        self.turn = 0

    def segments(self, offsets: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
        """Shards as lists of (row, first byte, bytes); long texts are cut with an overlap."""
        now, size = [], 0
        for row, total in enumerate(np.diff(offsets).tolist()):
            for a in range(0, max(total - self.length + 1, 0), self.shard):
                part = min(total - a, self.shard + self.length - 1)
                if now and size + part > self.shard + self.length:
                    yield now
                    now, size = [], 0
                now.append((row, a, part))
                size += part
        if now:
            yield now

    def emit(self, offsets: np.ndarray, raw: np.ndarray, ids: np.ndarray, k1: np.ndarray, k2: np.ndarray,
             shard: list[tuple[int, int, int]]) -> Iterator[tuple]:
        length = self.length
        rows, begin, size = (np.array(x, dtype=np.int64) for x in zip(*shard))
        own = len(rows)
        more = [np.frombuffer(x, dtype=np.uint8) for x, _ in self.carried]
        data, bounds = ragged_take(raw, np.stack([offsets[rows] + begin, offsets[rows] + begin + size], 1).ravel(),
                                   2 * np.arange(own))
        data = np.concatenate([data, *more])
        bounds = np.append(bounds, bounds[-1] + np.cumsum([len(x) for x in more], dtype=np.int64)).astype(np.int64)
        order = np.append(ids[rows], np.array([o for _, o in self.carried], dtype=np.int64))
        starts, first, text, words = strings(data, bounds, length)
        if not len(starts):
            return
        count = np.diff(np.append(first, len(starts)))
        order_of = order[text]
        gone = order_of > np.repeat(np.minimum.reduceat(order_of, first), count)
        n_own = bounds[own]
        state = np.zeros(len(data), dtype=np.uint8)  # of the strings: 1 gone, 2 left, 3 left of many
        state[starts] = np.where(gone, np.uint8(1), np.repeat((2 + (count >= MANY)).astype(np.uint8), count))
        marked, left, often = state[:n_own] == 1, state[:n_own] >= 2, state == 3  # own texts come first
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))

        a, b = runs_of(marked, owner)
        if len(a):
            seg = owner[a]
            shift = begin[seg] - bounds[seg]
            self.turn += 1
            spans = np.stack([a + shift, b - 1 + length + shift], 1).astype("<i4").tobytes()
            yield (self.turn % self.n, *_docs(rows[seg], ids, k1, k2), spans, None)

        grams = gram_hashes(words, len(data), length)
        least = least_hashes(grams, n_own, length)
        a, b = runs_of(left, owner, least)
        if len(a):
            seg = owner[a]
            hashes = mix64(least[a])  # least hashes are small: mixed anew they spread
            yield from filed((hashes % np.uint64(self.n)).astype(np.int64), rows[seg], a - bounds[seg] + begin[seg], b - a,
                             hashes >> np.uint64(32), ids, k1, k2, whole=piece_hashes(grams, a, b, length))

        # what many documents repeat rides along to the next shards of the task
        a, b = runs_of(often, owner)
        self.carried, room = [], CARRY
        for s, e in sorted(zip(a.tolist(), b.tolist()), key=lambda x: x[0] - x[1]):
            piece = data[s: e - 1 + length]
            if len(piece) <= room:
                self.carried.append((piece.tobytes(), int(order[owner[s]])))
                room -= len(piece)


def _docs(rows: np.ndarray, ids: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> tuple[bytes, bytes]:
    """The documents (id, two hashes) of some spans, and which of them each span is in."""
    used, which = np.unique(rows, return_inverse=True)
    return np.stack([ids[used], k1[used], k2[used]], 1).astype("<i8").tobytes(), _ints(which)


def _ints(values: np.ndarray) -> bytes:
    """Whole numbers as differences, first all lowest bytes, then the next (they pack well)."""
    return np.ascontiguousarray(np.diff(values, prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_ints(data: bytes, at: int = 0, n: int | None = None) -> np.ndarray:
    n = len(data) // 4 if n is None else n
    planes = np.frombuffer(data, np.uint8, 4 * n, at).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i4")[:, 0], dtype=np.int64)


def filed(shard: np.ndarray, rows: np.ndarray, place: np.ndarray, count: np.ndarray, head: np.ndarray, ids: np.ndarray,
          k1: np.ndarray, k2: np.ndarray, whole: np.ndarray | None = None, data: np.ndarray | None = None,
          at: np.ndarray | None = None, length: int = 0) -> Iterator[tuple]:
    """Pieces (row, first start, number of starts, hash) by content shard, with the hashes of
    the ``whole`` pieces or their bytes, which begin at ``at`` in ``data``."""
    by = np.argsort(shard, kind="stable")
    edge = np.append(np.flatnonzero(np.append(True, np.diff(shard[by]) != 0)), len(by))
    for x, y in zip(edge[:-1].tolist(), edge[1:].tolist()):
        r = by[x:y]
        parts = [_ints(place[r]), _ints(count[r]), head[r].astype("<u4").tobytes()]
        if whole is not None:
            parts.append(whole[r].astype("<u8").tobytes())
        else:
            size = count[r] + length - 1
            parts.append(ragged_take(data, np.stack([at[r], at[r] + size], 1).ravel(), 2 * np.arange(len(r)))[0].tobytes())
        yield (int(shard[r[0]]), *_docs(rows[r], ids, k1, k2), None, b"".join(parts))


PIECES = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("docs", T.BinaryType()), T.StructField("doc", T.BinaryType()),
                       T.StructField("marks", T.BinaryType()), T.StructField("pieces", T.BinaryType())])
#: A document's packed marks (first byte and end) and wanted pieces (with their content shard).
FOUND = T.StructType([*(T.StructField(c, T.LongType()) for c in ("_order", "_k1", "_k2")),
                      T.StructField("marks", T.BinaryType()), T.StructField("pieces", T.BinaryType())])
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
PIECE = np.dtype([("place", "<i4"), ("count", "<i4"), ("head", "<u4"), ("shard", "<i4")])


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3).compress
    shard, docs, doc, marks, pieces = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(shard, pa.int32()), *(pa.array([None if x is None else squeeze(x) for x in c], pa.binary()) for c in (docs, doc, marks, pieces))],
        names=PIECES.names)


def _unpacked(table: pa.Table) -> tuple[np.ndarray, list[tuple], list[tuple]]:
    """Documents, marks (documents, spans) and pieces (documents, places, counts, heads, rest)."""
    import zstandard

    inflate = zstandard.ZstdDecompressor().decompress
    docs, marks, pieces = [np.empty((0, 3), np.int64)], [], []
    n_docs = 0
    for batch in table.to_batches():
        for r in range(batch.num_rows):
            d, doc, spans, packed = (batch.column(c)[r].as_py() for c in ("docs", "doc", "marks", "pieces"))
            d = np.frombuffer(inflate(d), dtype="<i8").reshape(-1, 3)
            doc = _from_ints(inflate(doc)) + n_docs
            docs.append(d)
            n_docs += len(d)
            if spans is not None:
                marks.append((doc, np.frombuffer(inflate(spans), dtype="<i4").reshape(-1, 2).astype(np.int64)))
                continue
            k = len(doc)
            data = inflate(packed)
            pieces.append((doc, _from_ints(data, 0, k), _from_ints(data, 4 * k, k), np.frombuffer(data, "<u4", k, 8 * k), np.frombuffer(data, np.uint8, offset=12 * k)))
    return np.concatenate(docs), marks, pieces


def _anchors(n_content: int, length: int, shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Shards(n_content, length, shard)
        for batch in batches:
            offsets, raw = string_buffers(text_column(batch, "_text"))
            ids, k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_order", "_k1", "_k2"))
            for part in cutter.segments(offsets):
                out = list(cutter.emit(offsets, raw, ids, k1, k2, part))
                if out:
                    yield _packed(out)
    return run


def _of_many(order: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Pieces under hashes that several documents have, by hash and document."""
    by = np.lexsort((order, head))
    head, order = head[by], order[by]
    first = np.flatnonzero(np.append(True, head[1:] != head[:-1]))
    many = np.minimum.reduceat(order, first) != np.maximum.reduceat(order, first)
    return by[np.repeat(many, np.diff(np.append(first, len(head))))]


def _numbered(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct documents, sorted, and the number of each given one among them."""
    by = np.lexsort(docs.T[::-1])
    new = np.ones(len(docs), dtype=bool)
    new[1:] = (docs[by[1:]] != docs[by[:-1]]).any(axis=1)
    number = np.empty(len(docs), dtype=np.int64)
    number[by] = np.cumsum(new) - 1
    return docs[by[new]], number


def _buckets(docs: np.ndarray, shard: int, n: int, marks: list[tuple], pieces: tuple | None = None) -> pa.Table:
    """What a content shard found, packed by buckets of documents."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3).compress
    docs, number = _numbered(docs)
    bucket = (docs[:, 1].astype(np.uint64) % np.uint64(n)).astype(np.int64)
    which, spans = (np.concatenate(x) for x in zip(*marks)) if marks else (np.empty(0, np.int64), np.empty((0, 2), np.int64))
    tables = [(number[which], spans)]
    if pieces is not None:
        tables.append((number[pieces[0]], np.stack(pieces[1:], axis=1).astype(np.int64)))
    out: dict[int, list] = {}
    for kind, (doc, cols) in enumerate(tables):
        by = np.lexsort((cols[:, 0], doc, bucket[doc]))
        doc, cols = doc[by], cols[by]
        edge = np.append(np.flatnonzero(np.append(True, np.diff(bucket[doc]) != 0)), len(doc)) if len(doc) else np.zeros(1, np.int64)
        for x, y in zip(edge[:-1].tolist(), edge[1:].tolist()):
            used, at = np.unique(doc[x:y], return_inverse=True)
            data = b"".join([_ints(at), *(_ints(c[x:y]) for c in cols.T)])
            out.setdefault(int(bucket[doc[x]]), [None] * 4)[2 * kind: 2 * kind + 2] = squeeze(docs[used].astype("<i8").tobytes()), squeeze(data)
    return pa.Table.from_arrays([pa.array(list(out), pa.int32()), pa.array([shard] * len(out), pa.int32()),
                                 *(pa.array([v[k] for v in out.values()], pa.binary()) for k in range(4))], names=BUCKETS.names)


BUCKETS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("shard", T.IntegerType()),
                        *(T.StructField(c, T.BinaryType()) for c in ("marks_docs", "marks", "pieces_docs", "pieces"))])


def _unite(table: pa.Table) -> pa.Table:
    """One row for each document of a bucket."""
    import zstandard

    inflate = zstandard.ZstdDecompressor().decompress
    docs, n_docs, found = [], 0, {"marks": [], "pieces": []}
    for batch in table.to_batches():
        for r in range(batch.num_rows):
            for kind, width in (("marks", 3), ("pieces", 4)):
                packed = batch.column(kind)[r].as_py()
                if packed is not None:
                    docs.append(np.frombuffer(inflate(batch.column(kind + "_docs")[r].as_py()), dtype="<i8").reshape(-1, 3))
                    data = inflate(packed)
                    k = len(data) // (4 * width)
                    cols = [_from_ints(data, 4 * k * c, k) for c in range(width)]
                    cols[0] += n_docs
                    n_docs += len(docs[-1])
                    if kind == "pieces":
                        cols.append(np.full(k, batch.column("shard")[r].as_py()))
                    found[kind].append(np.stack(cols, axis=1))
    docs, number = _numbered(np.concatenate(docs))
    out = []
    for kind, width in (("marks", 3), ("pieces", 5)):
        rows = np.concatenate(found[kind]) if found[kind] else np.empty((0, width), np.int64)
        rows[:, 0] = number[rows[:, 0]]
        by = np.lexsort(rows.T[::-1])
        rows = rows[by]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]).any(axis=1)  # repeated rows of documents find the same
        rows = rows[new]
        data = np.ascontiguousarray(rows[:, 1:].astype("<i4"))
        at = np.searchsorted(rows[:, 0], np.arange(len(docs) + 1)) * 4 * (width - 1)
        out.append(pa.Array.from_buffers(pa.large_binary(), len(docs), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary()))
    return pa.Table.from_arrays([*(pa.array(docs[:, c], pa.int64()) for c in range(3)), *out], names=FOUND.names)


def _shared(length: int, n: int):
    return lambda table: _shared_of(table, length, n)


def _shared_of(table: pa.Table, length: int, n: int) -> pa.Table:
    """Of a content shard: marks of the pieces that a smaller document has whole, and the
    pieces whose hash, but not all of them, other documents have; by document."""
    shard = table.column("shard")[0].as_py()
    docs, marks, pieces = _unpacked(table)
    del table
    wanted = None
    if pieces:
        doc, place, count, head = (np.concatenate(x) for x in list(zip(*pieces))[:4])
        whole = np.concatenate([x[4].view("<u8") for x in pieces])
        del pieces
        some = _of_many(docs[doc, 0], head)
        doc, place, count, head, whole = doc[some], place[some], count[some], head[some], whole[some]
        by = np.lexsort((docs[doc, 0], count, whole, head))
        doc, place, count, head, whole = doc[by], place[by], count[by], head[by], whole[by]
        order = docs[doc, 0]
        new = np.ones(len(by), dtype=bool)
        new[1:] = (head[1:] != head[:-1]) | (whole[1:] != whole[:-1]) | (count[1:] != count[:-1])
        first = np.flatnonzero(new)
        least = np.repeat(order[first], np.diff(np.append(first, len(order)))) if len(first) else order
        gone = order > least
        marks.append((doc[gone], np.stack([place[gone], place[gone] + count[gone] + length - 1], 1)))
        doc, place, count, head, order = (x[~gone] for x in (doc, place, count, head, order))
        rest = _of_many(order, head) if len(order) else np.empty(0, np.int64)
        wanted = (doc[rest], place[rest], count[rest], head[rest].view("<i4"))
    return _buckets(docs, shard, n, marks, wanted)


def _fetch(length: int, limit: int):
    """Bytes of the wanted pieces of documents, by content shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, raw = string_buffers(text_column(batch, "_text"))
            ids, k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_order", "_k1", "_k2"))
            now, size = [], 0
            for row, wanted in enumerate(batch.column("pieces").to_pylist()):
                now.append((row, np.frombuffer(wanted, dtype=PIECE)))
                size += int(now[-1][1]["count"].sum()) + length * len(now[-1][1])
                if size >= limit:
                    yield _packed(_chosen(now, offsets, raw, ids, k1, k2, length))
                    now, size = [], 0
            if now:
                yield _packed(_chosen(now, offsets, raw, ids, k1, k2, length))
    return run


def _chosen(now: list[tuple], offsets: np.ndarray, raw: np.ndarray, ids: np.ndarray, k1: np.ndarray, k2: np.ndarray, length: int) -> list[tuple]:
    rows = np.repeat([r for r, _ in now], [len(x) for _, x in now])
    pieces = np.concatenate([x for _, x in now])
    place = pieces["place"].astype(np.int64)
    return list(filed(pieces["shard"].astype(np.int64), rows, place, pieces["count"].astype(np.int64), pieces["head"],
                      ids, k1, k2, data=raw, at=offsets[rows] + place, length=length))


def _locate(table: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of rows in a sorted table of rows (both of numbers, compared in order):
    the place of each, and whether it is there."""
    lo = np.zeros(len(rows), dtype=np.int64)
    hi = np.full(len(rows), len(table), dtype=np.int64)
    while (live := np.flatnonzero(lo < hi)).size:
        mid = (lo[live] + hi[live]) >> 1
        x, y = table[mid], rows[live]
        differ = x != y
        at = differ.argmax(axis=1)[:, None]
        less = differ.any(axis=1) & (np.take_along_axis(x, at, 1) < np.take_along_axis(y, at, 1))[:, 0]
        lo[live] = np.where(less, mid + 1, lo[live])
        hi[live] = np.where(less, hi[live], mid)
    same = np.zeros(len(rows), dtype=bool)
    inside = lo < len(table)
    same[inside] = (table[lo[inside]] == rows[inside]).all(axis=1)
    return lo, same


def _sorted_strings(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Strings as rows of numbers that compare like their bytes."""
    cols = [words[starts + k] for k in range(0, length - 7, 8)]
    if length % 8:
        cols.append(words[starts + length - length % 8] >> np.uint64(64 - 8 * (length % 8)))
    return np.stack(cols, axis=1)


def repeats(blocks: list[tuple], length: int) -> list[np.ndarray]:
    """Of the pieces in a block (bytes, bounds, documents), which starts have their string in a
    smaller document.  Several blocks under one hash: their sorted distinct strings, each with
    its smallest document, are merged by binary search, then looked up again from each block."""
    found, table, least = [], None, None
    for raw, bounds, order, _ in blocks:
        starts, first, text, words = strings(raw, bounds, length)
        mine = np.minimum.reduceat(order[text], first) if len(starts) else np.empty(0, np.int64)
        if len(blocks) == 1:
            found.append((starts, first, text, mine))
            break
        rows = _sorted_strings(words, starts[first], length)
        if table is None:
            table, least = rows, mine.copy()
        else:
            at, there = _locate(table, rows)
            least[at[there]] = np.minimum(least[at[there]], mine[there])
            table = np.insert(table, at[~there], rows[~there], axis=0)
            least = np.insert(least, at[~there], mine[~there])
        found.append((starts, first, text, rows))
    out = []
    for (raw, _, order, _), (starts, first, text, rows) in zip(blocks, found):
        mine = rows if len(blocks) == 1 else least[_locate(table, rows)[0]]
        marked = np.zeros(len(raw), dtype=bool)
        marked[starts[order[text] > np.repeat(mine, np.diff(np.append(first, len(starts))))]] = True
        out.append(marked)
    return out


def _content(length: int, block: int, n: int):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        docs, _, pieces = _unpacked(table)
        del table
        doc, place, count, head = (np.concatenate(x) for x in list(zip(*pieces))[:4])
        data = np.concatenate([x[4] for x in pieces])
        del pieces
        size = count + length - 1
        at = np.append(0, np.cumsum(size)).astype(np.int64)
        by = np.argsort(head, kind="stable")
        order, size, head = docs[doc[by], 0], size[by], head[by]
        spans = [(np.empty(0, np.int64), np.empty((0, 2), np.int64))]
        for rows in _blocks(head, size, block):
            cuts = np.flatnonzero(np.diff((np.cumsum(size[rows]) - 1) // block)) + 1
            subs = []
            for sub in (np.split(rows, cuts) if head[rows[0]] == head[rows[-1]] else [rows]):
                raw, bounds = ragged_take(data, at, by[sub])
                subs.append((raw, bounds, order[sub], sub))
            for (_, bounds, _, sub), marked in zip(subs, repeats(subs, length)):
                a, b = runs_of(marked, np.repeat(np.arange(len(sub)), np.diff(bounds)))
                piece = sub[np.searchsorted(bounds, a, side="right") - 1]
                shift = place[by[piece]] - bounds[piece - sub[0]]
                spans.append((doc[by[piece]], np.stack([a + shift, b - 1 + length + shift], 1)))
        return _buckets(docs, shard, n, spans)
    return run


def _blocks(head: np.ndarray, size: np.ndarray, block: int) -> Iterator[np.ndarray]:
    """Rows (ordered by hash) in blocks of whole hashes: as many hashes as stay within the
    size, or one."""
    if not len(head):
        return
    first = np.append(np.flatnonzero(np.append(True, np.diff(head) != 0)), len(head))
    ends = np.append(0, np.cumsum(size))[first]
    i = 0
    while i < len(first) - 1:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + block, side="right")) - 1)
        yield np.arange(first[i], first[j])
        i = j


def _cut(keep: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, text, SHARD):
                offsets, raw = string_buffers(text_column(batch, text))
                n = batch.num_rows
                marks = [(x or b"") + (y or b"") for x, y in zip(*(batch.column(c).to_pylist() for c in ("marks", "_more")))]
                row = np.repeat(np.arange(n), [len(m) // 8 for m in marks])
                begin, end = np.frombuffer(b"".join(marks), dtype="<i4").astype(np.int64).reshape(-1, 2).T + offsets[row]
                by = np.lexsort((begin, row))
                row, begin, end = row[by], begin[by], np.maximum.accumulate(end[by]) if len(by) else end
                new = np.ones(len(row), dtype=bool)
                new[1:] = (begin[1:] > end[:-1]) | (row[1:] != row[:-1])
                last = np.append(new[1:], True)[: len(new)]
                where, a, b = row[new], begin[new], end[last]
                stays = np.ones(len(raw), dtype=bool)
                for x, y in zip(a.tolist(), b.tolist()):
                    stays[x:y] = False
                gone = np.zeros(n, dtype=np.int64)
                np.add.at(gone, where, b - a)
                total = np.diff(offsets)
                spans = pa.StructArray.from_arrays([pa.array(a - offsets[where]), pa.array(b - offsets[where])], names=["start", "end"])
                lists = pa.array(np.searchsorted(where, np.arange(n + 1)).astype(np.int32))
                bounds = np.append(0, np.cumsum(total - gone)).astype(np.int64)
                kept = np.ascontiguousarray(raw[stays])
                binary = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds), pa.py_buffer(kept)])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(total), pa.array(gone),
                                                  pa.ListArray.from_arrays(lists, spans), binary.cast(pa.binary())],
                                                 names=[*keep, "n_bytes", "n_removed", "spans", "kept"])
    return run


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] | None = None, length: int = LENGTH,
                   shard: int = SHARD, content: int = CONTENT, block: int = BLOCK) -> DataFrame:
    """Columns ``keep`` (all but those named like the result), ``n_bytes``, ``n_removed``, ``spans``
    (maximal removed runs of bytes) and ``kept`` (the remaining bytes).  ``key`` is a column of
    whole numbers; ``length`` is ``GRAM`` at least."""
    keep = tuple(c for c in (keep or df.columns) if c not in OWN)
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n_content = 1 + total // content
    rows = df.select(*keep, *([text] if text not in keep else []),
                     F.coalesce(F.col(key).cast("long"), F.lit(int(LAST))).alias("_order"),
                     F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), text).alias("_k2"))
    key_of = ["_order", "_k1", "_k2"]
    anchors = rows.select(*key_of, F.col(text).alias("_text")).mapInArrow(_anchors(n_content, length, shard), PIECES)
    found = anchors.groupBy("shard").applyInArrow(_shared(length, n_content), BUCKETS).groupBy("bucket").applyInArrow(_unite, FOUND)
    # the joins below read one shuffle of the texts and one of what was found
    asked = found.where(F.length("pieces") > 0)
    fetched = rows.join(asked, key_of).withColumn("_text", F.col(text)).mapInArrow(_fetch(length, block), PIECES)
    more = (fetched.groupBy("shard").applyInArrow(_content(length, block, n_content), BUCKETS)
            .groupBy("bucket").applyInArrow(_unite, FOUND).select(*key_of, F.col("marks").alias("_more")))
    joined = (rows.join(found.drop("pieces"), key_of, "left").join(more, key_of, "left")
              .select(*keep, F.coalesce(text, F.lit("")).alias("_text"), "marks", "_more"))
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("spans", SPAN), T.StructField("kept", T.BinaryType())])
    return joined.mapInArrow(_cut(list(keep), "_text"), schema)
