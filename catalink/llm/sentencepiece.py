"""SentencePiece encoding and decoding: batched numpy Viterbi.

Texts are cut into words (a run of blanks and what follows), distinct words of a batch
are segmented once, and all words of the same length advance together, one character at
a time.  For every end position the substrings that end there are looked up by a rolling
hash in the sorted hashes of the pieces, each candidate gets a score from its start
position, and the row-wise maximum stores a backpointer.

The score of an edge depends on the kind of the model:

* unigram: best score at the start plus the piece's log probability;
* BPE: a candidate counts only if merging would leave it and the piece that ends at its
  start apart.  A prefix of a word has one BPE segmentation, so exactly one candidate
  counts at each position, and the path equals the merge loop's result.  (Maximising the
  sum of a BPE model's scores would give other segmentations than the model's own.)

Words with pieces of equal score, whose merge order depends on position, take the plain
merge loop; in usual models those are runs of blanks.

Defined results: null and empty texts have no ids and decode to the empty string; a text
is preceded by one blank (dummy prefix), which decoding removes; characters outside the
vocabulary become byte pieces, or the unknown id where the model has none.  A text that
holds U+2581 itself decodes with a blank there, as the library does.  Repeated rows,
ties and extra columns don't matter: rows are mapped one by one.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from catalink.llm.common import list_array, mix64, ragged_take, text_column, text_slices, word_chunks

BLANK = "▁"
NO_MERGE = np.int64(1 << 40)
#: Cells (words times length) of a table that advances together.
CELLS = 100_000
#: Bytes of text whose distinct words are segmented together.
SLICE = 3 << 20
#: Ids that are decoded together.
DECODED = 200_000


@dataclass(frozen=True)
class PieceModel:
    """Tables of a model; ``size`` is the id of an unknown character inside the tables."""

    kind: str
    size: int
    unk_id: int
    byte_first: int          # id of <0x00>, or -1 without byte fallback
    scores: np.ndarray
    keys: np.ndarray         # hashes of the pieces found in text, sorted by leading bits
    key_ids: np.ndarray
    piece_chars: np.ndarray  # code points by id, padded with 0
    piece_len: np.ndarray
    bigrams: np.ndarray      # sorted pairs of characters that some piece has in a row
    pair_keys: np.ndarray    # left * (size + 1) + right of pairs that merge, sorted likewise
    pair_rank: np.ndarray
    left_sym: np.ndarray     # by id: symbols from the first character up to the piece
    left_rank: np.ndarray    # and the rank at which each of them is used up
    right_sym: np.ndarray
    right_rank: np.ndarray
    rank: np.ndarray
    tied: np.ndarray
    bytes_flat: np.ndarray   # what each id decodes to
    bytes_bounds: np.ndarray
    key_first: np.ndarray    # by leading bits: where the keys with them begin (most probes end here)
    pair_first: np.ndarray


SEEN_BITS = 20


def _lead(keys: np.ndarray) -> np.ndarray:
    return (keys.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - SEEN_BITS)


def _by_lead(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of ``keys`` by their leading bits, and where those of each lead begin (-1: none)."""
    lead = _lead(keys)
    order = np.argsort(lead, kind="stable")
    first = np.full(1 << SEEN_BITS, -1, dtype=np.int32)
    first[lead[order][::-1]] = np.arange(len(keys))[::-1]
    return order, first


def _probe(keys: np.ndarray, first: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``keys`` are in ``table`` (sorted by leading bits), and where."""
    at = first[_lead(keys)]
    may = np.flatnonzero(at >= 0)
    at = at[may]
    hits, spots = [], []
    while len(may):
        same = table[at] == keys[may]
        hits.append(may[same])
        spots.append(at[same])
        may, at = may[~same], at[~same] + 1
        on = at < len(table)
        may, at = may[on], at[on]
        on = _lead(table[at]) == _lead(keys[may])
        may, at = may[on], at[on]
    return np.concatenate(hits) if hits else may, np.concatenate(spots) if spots else at


def _hash_power(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)


def _hash_rows(chars: np.ndarray) -> np.ndarray:
    """Hashes H[:, i] of the first i characters; a substring's hash is H[e] - H[s] * P**(e-s)."""
    base = np.uint64(0x9E3779B97F4A7C15)
    out = np.zeros((chars.shape[0], chars.shape[1] + 1), dtype=np.uint64)
    c = mix64(chars.astype(np.uint64) + np.uint64(1))
    for i in range(chars.shape[1]):
        out[:, i + 1] = out[:, i] * base + c[:, i]
    return out


def merge_loop(symbols: list[int], pair: dict[tuple[int, int], int], rank: np.ndarray) -> list[tuple]:
    """Plain BPE: merge the pair of best rank, leftmost first.  Returns nodes
    (id, left node, right node); leaves have no children."""
    node: list = [(s, None, None) for s in symbols]
    nxt = list(range(1, len(node))) + [-1]
    prv = list(range(-1, len(node) - 1))
    heap: list = []

    def push(i: int) -> None:
        j = nxt[i]
        if j >= 0 and (m := pair.get((node[i][0], node[j][0]))) is not None:
            heapq.heappush(heap, (int(rank[m]), i, node[i], node[j], m))

    for i in range(len(node)):
        push(i)
    while heap:
        _, i, a, b, m = heapq.heappop(heap)
        if node[i] is not a or nxt[i] < 0 or node[nxt[i]] is not b:
            continue
        j = nxt[i]
        node[i], node[j] = (m, a, b), None
        nxt[i] = nxt[j]
        if nxt[j] >= 0:
            prv[nxt[j]] = i
        push(i)
        if prv[i] >= 0:
            push(prv[i])
    return [x for x in node if x is not None]


def load_model(path: str, kind: str = "bpe", proto: bytes | None = None) -> PieceModel:
    """Read a model's pieces (with the sentencepiece library) and derive the tables.

    ``kind`` is ``bpe`` or ``unigram``."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor()
    if proto is not None:
        sp.LoadFromSerializedProto(proto)
    else:
        sp.Load(path)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    scores = np.array([sp.get_score(i) for i in range(n)], dtype=np.float64)
    normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))]
    if any(sp.is_unused(i) for i in normal):
        raise ValueError("models with unused pieces are not supported")
    by_piece = {pieces[i]: i for i in normal}
    byte_ids = [i for i in range(n) if sp.is_byte(i)]
    longest = max(len(p) for p in by_piece)

    chars = np.zeros((n + 1, longest), dtype=np.uint32)
    length = np.ones(n + 1, dtype=np.int64)
    for p, i in by_piece.items():
        cps = np.frombuffer(p.encode("utf-32-le"), dtype=np.uint32)
        chars[i, : len(cps)] = cps
        length[i] = len(cps)
    ids = np.array(normal, dtype=np.int64)
    hashes = _hash_rows(chars[ids])[np.arange(len(ids)), length[ids]] + mix64(length[ids])
    if len(np.unique(hashes)) < len(hashes):
        raise ValueError("two pieces share a hash")
    bigrams = np.unique(np.array([(ord(a) << 32) | ord(b) for p in by_piece for a, b in zip(p, p[1:])] or [0],
                                 dtype=np.uint64))

    distinct, rank = np.unique(-scores, return_inverse=True)
    rank = np.append(rank.astype(np.int64), NO_MERGE)
    pair: dict[tuple[int, int], int] = {}
    for p, i in by_piece.items():
        for k in range(1, len(p)):
            a, b = by_piece.get(p[:k]), by_piece.get(p[k:])
            if a is not None and b is not None:
                pair[a, b] = i
    width = longest + 1
    left_sym = np.full((n + 1, width), n, dtype=np.int32)
    right_sym = left_sym.copy()
    left_rank = np.full((n + 1, width), NO_MERGE, dtype=np.int64)
    right_rank = left_rank.copy()
    tied = np.zeros(n + 1, dtype=bool)
    multi = [i for p, i in by_piece.items() if len(p) > 1]
    values, counts = np.unique(scores[multi] if multi else np.empty(0), return_counts=True)
    shared = set(values[counts > 1].tolist())
    dead = np.zeros(n + 1, dtype=bool)
    if kind == "bpe":
        for p, i in by_piece.items():
            if len(p) > 1 and scores[i] in shared:
                tied[i] = True
                continue
            symbols = [by_piece.get(c, n) for c in p]
            end = merge_loop(symbols, pair, rank)
            if len(end) != 1 or end[0][0] != i:
                dead[i] = True  # merging never makes this piece
                continue
            todo = [end[0]]
            while todo:  # a part must be made before the whole for the walk along the edges
                x = todo.pop()
                for y in x[1:]:
                    if y is not None:
                        tied[i] |= y[1] is not None and rank[y[0]] >= rank[x[0]]
                        todo.append(y)
            for side, sym, used in ((1, left_sym, left_rank), (2, right_sym, right_rank)):
                spine, x = [], end[0]
                while x is not None:
                    spine.append(x[0])
                    x = x[side]
                spine.reverse()
                sym[i, : len(spine)] = spine
                used[i, : len(spine) - 1] = rank[spine[1:]]
    ids, hashes = ids[~dead[ids]], hashes[~dead[ids]]
    order, key_first = _by_lead(hashes)
    pk = np.array([a * (n + 1) + b for a, b in pair] or [-1], dtype=np.int64)
    pr = np.array([rank[m] for m in pair.values()] or [NO_MERGE], dtype=np.int64)
    po, pair_first = _by_lead(pk)
    texts = [b""] * n
    for i in normal:
        texts[i] = pieces[i].replace(BLANK, " ").encode()
    for k, i in enumerate(byte_ids):
        texts[i] = bytes([k])
    if not byte_ids:
        texts[sp.unk_id()] = " ⁇ ".encode()
    bounds = np.zeros(n + 1, dtype=np.int64)
    np.cumsum([len(x) for x in texts], out=bounds[1:])
    return PieceModel(kind, n, sp.unk_id(), byte_ids[0] if byte_ids else -1, np.append(scores, scores[normal].min() - 10),
                      hashes[order], ids[order], chars, length, bigrams, pk[po], pr[po],
                      left_sym, left_rank, right_sym, right_rank, rank, tied,
                      np.frombuffer(b"".join(texts), dtype=np.uint8), bounds, key_first, pair_first)


def _apart(m: PieceModel, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether merging the text of pieces a and b leaves the border between them: walk up
    the symbols at the border in the order in which they are made and look for a pair that
    would merge across it earlier (at equal rank the pair further left goes first)."""
    ok = np.ones(len(a), dtype=bool)
    live = np.arange(len(a))
    i = np.zeros(len(a), dtype=np.int64)
    j = np.zeros(len(a), dtype=np.int64)
    while len(live):
        x, y = a[live], b[live]
        p, q = m.right_rank[x, i], m.left_rank[y, j]
        key = m.right_sym[x, i].astype(np.int64) * (m.size + 1) + m.left_sym[y, j]
        hit, at = _probe(key, m.pair_first, m.pair_keys)
        r = np.full(len(key), NO_MERGE)
        r[hit] = m.pair_rank[at]
        bad = (r < p) & (r <= q)
        ok[live[bad]] = False
        go = ~bad & ((p < NO_MERGE) | (q < NO_MERGE))
        step = p <= q
        i, j, live = (i + step)[go], (j + ~step)[go], live[go]
    return ok


def _advance(m: PieceModel, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment words of one length (rows of ``chars``).  Returns the ids in a row, the
    number of ids of each word and the words left to the merge loop."""
    n, size = chars.shape
    longest = min(size, m.piece_chars.shape[1])
    h = _hash_rows(chars)
    power = _hash_power(longest)
    found = np.full((n, size, longest), -1, dtype=np.int32)  # by start and length - 1
    for k in range(1, longest + 1):
        key = h[:, k:] - h[:, : size + 1 - k] * power[k - 1] + mix64(np.array([k]))[0]
        hit, at = _probe(key.ravel(), m.key_first, m.keys)
        ids = m.key_ids[at]
        row, col = np.divmod(hit, size + 1 - k)
        same = m.piece_len[ids] == k
        for c in range(k):
            same &= m.piece_chars[ids, c] == chars[row, col + c]
        found[row[same], col[same], k - 1] = ids[same]
    slow = (m.tied[found] & (found >= 0)).any(axis=(1, 2)) if m.kind == "bpe" else np.zeros(n, dtype=bool)
    unknown = found[:, :, 0] < 0
    found[:, :, 0][unknown] = m.size

    last = np.full((n, size + 1), -1, dtype=np.int64)
    best = np.full((n, size + 1), -np.inf)
    best[:, 0] = 0
    rows = np.arange(n)
    for e in range(1, size + 1):
        k = np.arange(min(e, longest), 0, -1)  # longest first: argmax takes the first of equals
        cand = found[:, e - k, k - 1]
        before = best[:, e - k]
        score = np.where((cand >= 0) & np.isfinite(before), 0.0, -np.inf)
        if m.kind == "unigram":
            score += before + m.scores[cand]
        else:
            r, c = np.nonzero(np.isfinite(score) & (e - k > 0)[None, :])
            apart = _apart(m, last[r, (e - k)[c]], cand[r, c])
            score[r[~apart], c[~apart]] = -np.inf
        pick = score.argmax(axis=1)
        best[:, e] = score[rows, pick]
        last[:, e] = np.where(np.isfinite(best[:, e]), cand[rows, pick], -1)
    steps = np.full((n, size), -1, dtype=np.int64)
    spot = np.full((n, size), -1, dtype=np.int64)
    at = np.where(slow, 0, size)
    for s in range(size):
        on = np.flatnonzero(at > 0)
        if not len(on):
            break
        tok = last[on, at[on]]
        at[on] -= m.piece_len[tok]
        steps[on, s] = tok
        spot[on, s] = at[on]
    steps, spot = steps[:, ::-1], spot[:, ::-1]
    keep = steps >= 0
    flat = steps[keep]
    cps = chars[np.nonzero(keep)[0], spot[keep]]
    ids, per = _expand(m, flat, cps)
    counts = np.zeros(n, dtype=np.int64)
    np.add.at(counts, np.nonzero(keep)[0], per)
    return ids, counts, np.flatnonzero(slow)


def _expand(m: PieceModel, ids: np.ndarray, cps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unknown characters as byte pieces (or the unknown id); ids per input id."""
    unknown = ids == m.size
    if m.byte_first < 0:
        return np.where(unknown, m.unk_id, ids), np.ones(len(ids), dtype=np.int64)
    c = cps.astype(np.int64)
    wide = np.where(c < 0x80, 1, np.where(c < 0x800, 2, np.where(c < 0x10000, 3, 4)))
    per = np.where(unknown, wide, 1)
    ends = np.cumsum(per)
    src = np.repeat(np.arange(len(ids)), per)
    k = np.arange(len(src)) - np.repeat(ends - per, per)
    w, cc = wide[src], c[src]
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[w]
    byte = np.where(k == 0, lead | (cc >> (6 * (w - 1))), 0x80 | ((cc >> np.maximum(6 * (w - 1 - k), 0)) & 0x3F))
    return np.where(unknown[src], m.byte_first + byte, ids[src]), per


class _Pairs:
    """The piece that two pieces merge to, looked up in the model's sorted tables."""

    def __init__(self, m: PieceModel):
        self.m, self.seen = m, {}

    def get(self, ab: tuple[int, int]) -> int | None:
        if ab not in self.seen:
            m, (a, b) = self.m, ab
            hit, _ = _probe(np.array([a * (m.size + 1) + b], dtype=np.int64), m.pair_first, m.pair_keys)
            text = np.concatenate([m.piece_chars[a, : m.piece_len[a]], m.piece_chars[b, : m.piece_len[b]]])
            self.seen[ab] = _piece(m, text) if len(hit) else None
        return self.seen[ab]


def _piece(m: PieceModel, text: np.ndarray) -> int | None:
    """Id of the piece with these code points."""
    key = _hash_rows(text[None, :])[:, len(text)] + mix64(np.array([len(text)]))
    _, at = _probe(key, m.key_first, m.keys)
    for i in m.key_ids[at].tolist():
        if m.piece_len[i] == len(text) and (m.piece_chars[i, : len(text)] == text).all():
            return i
    return None


def _merge_words(m: PieceModel, words: list[np.ndarray]) -> list[np.ndarray]:
    """The merge loop for words whose pieces tie."""
    pairs, out = _Pairs(m), []
    for w in words:
        one = {int(c): _piece(m, np.array([c], dtype=w.dtype)) for c in np.unique(w)}
        symbols = [m.size if one[int(c)] is None else one[int(c)] for c in w]
        nodes = merge_loop(symbols, pairs, m.rank)
        ids = np.array([x[0] for x in nodes], dtype=np.int64)
        at = np.cumsum(m.piece_len[ids]) - m.piece_len[ids]
        out.append(_expand(m, ids, w[at])[0])
    return out


def segment(m: PieceModel, chars: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words given by their code points; returns all ids and their bounds by word."""
    n = len(bounds) - 1
    if not len(chars):
        return np.empty(0, np.int64), np.zeros(n + 1, dtype=np.int64)
    cut = np.zeros(len(chars) + 1, dtype=bool)
    cut[bounds] = True
    pairs = (chars[:-1].astype(np.uint64) << np.uint64(32)) | chars[1:]
    at = np.minimum(np.searchsorted(m.bigrams, pairs), len(m.bigrams) - 1)
    cut[1:-1] |= m.bigrams[at] != pairs  # no piece spans this border
    part = np.flatnonzero(cut)
    sizes = np.diff(part)
    start = part[:-1]
    all_ids, all_part = [], []  # 32 bits each: a slice has fewer parts
    counts = np.zeros(len(start), dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    edges = np.flatnonzero(np.diff(sizes[order])) + 1
    for group in np.split(order, edges):
        size = int(sizes[group[0]])
        step = max(1, CELLS // size)
        for k in range(0, len(group), step):
            rows = group[k: k + step]
            block = chars[start[rows][:, None] + np.arange(size)]
            ids, per, slow = _advance(m, block)
            counts[rows] = per
            all_ids.append(ids.astype(np.int32))
            all_part.append(np.repeat(rows.astype(np.int32), per))
            if len(slow):
                for r, x in zip(rows[slow], _merge_words(m, [block[s] for s in slow])):
                    counts[r] = len(x)
                    all_ids.append(x.astype(np.int32))
                    all_part.append(np.full(len(x), r, dtype=np.int32))
    flat, owner = np.concatenate(all_ids), np.concatenate(all_part)
    flat = flat[np.argsort(owner, kind="stable")]
    ends = np.zeros(len(start) + 1, dtype=np.int64)
    np.cumsum(counts, out=ends[1:])
    return flat, ends[np.searchsorted(start, bounds)]


def encode_texts(m: PieceModel, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts and their bounds by text."""
    blank = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ").cast(pa.large_string())
    first, chunks = word_chunks(pc.binary_join_element_wise(blank, texts, pa.scalar("", pa.large_string())))
    coded = chunks.dictionary_encode()
    words = coded.dictionary
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = "".join(words.to_pylist()).replace(" ", BLANK)
    chars = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    bounds = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=bounds[1:])
    flat, ends = segment(m, chars, bounds)
    ids, out = ragged_take(flat.astype(np.int32), ends, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
    return ids, out[first]


def decode_ids(m: PieceModel, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Texts of rows of ids: pieces and bytes joined, the dummy prefix removed."""
    out: list[str] = []
    row, rows = 0, len(bounds) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + DECODED, side="right")) - 1)
        raw, ends = ragged_take(m.bytes_flat, m.bytes_bounds, ids[bounds[row]: bounds[stop]])
        at = ends[bounds[row: stop + 1] - bounds[row]].tolist()
        data = raw.tobytes()
        out += [data[a:b].decode("utf-8", errors="replace") for a, b in zip(at[:-1], at[1:])]
        row = stop
    return [x[1:] if x.startswith(" ") else x for x in out]


def _lossless(m: PieceModel, ids: np.ndarray, bounds: np.ndarray, texts: pa.LargeStringArray) -> list[bool]:
    """Whether the ids of each text decode to it; some rows are held decoded at a time."""
    same: list[bool] = []
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + DECODED, side="right")) - 1)
        decoded = decode_ids(m, ids[bounds[row]: bounds[stop]], bounds[row: stop + 1] - bounds[row])
        same += [a == b for a, b in zip(decoded, texts.slice(row, stop - row).to_pylist())]
        row = stop
    return same


RESULT = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("lossless", T.BooleanType()),
])


def encode(df: DataFrame, model: PieceModel, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Columns ``keep``, the ids, their number, the crc32 of the ids as little-endian
    32-bit integers, and whether decoding them gives the text back."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # as large as the vocabulary
    schema = T.StructType([*(df.schema[c] for c in keep), *RESULT.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for batch in text_slices(whole, "_text", SLICE):
                texts = text_column(batch, "_text")
                ids, bounds = encode_texts(m, texts)
                small = ids.astype("<u4")
                crc = [zlib.crc32(small[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                same = _lossless(m, ids, bounds, texts)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(small.view("<i4")))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), lists, pa.array(np.diff(bounds)), pa.array(crc, pa.int64()),
                     pa.array(same, pa.bool_())], names=[*keep, *RESULT.names])
                del texts, ids, small, lists
                pa.default_memory_pool().release_unused()

    return df.select(*keep, df[text].alias("_text")).mapInArrow(run, schema)


def decode(df: DataFrame, model: PieceModel, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """Columns ``keep`` and the ``text`` of each row's ids (null ids: the empty string)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x or [] for x in batch.column("_ids").to_pylist()]
            bounds = np.zeros(len(rows) + 1, dtype=np.int64)
            np.cumsum([len(x) for x in rows], out=bounds[1:])
            flat = np.array([i for x in rows for i in x], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(decode_ids(shared.value, flat, bounds), pa.string())],
                names=[*keep, "text"])

    return df.select(*keep, df[ids].alias("_ids")).mapInArrow(run, schema)
