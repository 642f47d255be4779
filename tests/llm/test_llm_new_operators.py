"""Operators 11 to 13 on awkward tables against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalink.llm import periodic, search, suffix_dedup
from catalink.llm import queries as Q
from catalink.llm.common import table

SF = "/root/testdata/sf0.001"


# --- 11: periodic runs -----------------------------------------------------------

def runs_of(words):
    """All runs, by trying every period."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            smaller = any(all(words[x] == words[x + p] for x in range(s, s + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                found.append((s, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def test_runs_against_every_period():
    rnd = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(rnd.randint(1, 4)):
            letters, words = rnd.choice(["ab", "abcd"]), []
            while len(words) < rnd.randint(0, 130):
                words += [rnd.choice(letters) for _ in range(rnd.randint(1, 12))] * rnd.randint(1, 8)
            texts.append(rnd.choice([" ", "\n", "  "]).join(words))
        texts.insert(rnd.randint(0, len(texts)), rnd.choice(["", "  ", "x"]))
        ids, first, letters, bounds = periodic.split_words(pa.array(texts, pa.large_string()))
        runs = periodic.find_runs(ids, first)
        out, at = periodic.collapse(runs, first, letters, bounds)
        for d, text in enumerate(texts):
            want = runs_of(split(text))
            assert [(s - first[d], n, q) for s, n, q in runs.tolist() if first[d] <= s < first[d + 1]] == want
            assert bytes(out[at[d]: at[d + 1]]).decode() == collapsed(split(text), want)


def test_runs_of_awkward_documents(spark):
    texts = [None, "", " \t\n", "la " * 9, "la " * 5, "é ü " * 4, "one two three " * 300 + "end", "x\xa0y " * 6, "\x00 " * 7]
    rows = [(None if i == 2 else i, t, "clash", 1) for i, t in enumerate(texts)] + [(3, texts[3], "clash", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int").repartition(3)
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.find(docs).collect())
    want = sorted((str(d), len(split(t)), runs_of(split(t)), collapsed(split(t), runs_of(split(t)))) for d, t, _, _ in rows)
    assert got == want
    assert periodic.find(docs.limit(0)).count() == 0


def test_op11(spark):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = {r.doc_id: tuple(r) for r in Q.op11_periodic_runs(spark, SF).collect()}
    for r in table(spark, SF, "documents").collect():
        words, h = split(r.text), zlib.crc32(str(r.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = runs_of(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        assert got[r.doc_id] == (r.doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                                 sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(collapsed(words, runs)))


# --- 12: ranked search -----------------------------------------------------------

def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def ranked(docs, items, limit):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_all, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for d, c in counts:
            m = 50 + 50 * sum(c.values()) * n_all // total
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        for rank, (score, none, d) in enumerate(sorted(scored)[:limit], 1):
            out.append((item, rank, None if none else d, -score))
    return sorted(out, key=str)


@pytest.mark.parametrize("block,first,growth,asked", [(4096, 2000, 16, 1_000_000), (3, 2, 2, 1_000_000), (5, 4, 3, 7)])
def test_search_against_all_documents(spark, monkeypatch, block, first, growth, asked):
    monkeypatch.setattr(search, "ASKED", asked)  # 7: an index of all terms, items in several parts
    rnd = random.Random(2)
    words = ["Mesa", "mesa2", "É", "o'clock", "日本", "de", "la", "zu"] + [f"w{i}" for i in range(25)]
    prose = lambda n: rnd.choice([" ", ", ", "\n"]).join(rnd.choice(words) for _ in range(n))
    docs = [(i, prose(rnd.choice([1, 5, 5, 5, 20, 60]))) for i in range(90)]
    docs += docs[:6] + [(None, prose(5)), (None, None), (200, ""), (201, "!!"), (202, prose(900)), (203, docs[5][1])]
    items = [(i, prose(6)) for i in range(9)] + [(3, prose(2)), (4, None), (5, ""), (None, prose(4)), (6, "absent")]
    items.append(items[0])
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, score int").repartition(4)
    asking = search.item_terms(spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, terms string"))
    only = search.asked_terms(asking)
    assert (only is None) == (asked == 7)
    index = search.build(df, only=only, block=block)
    got = sorted((tuple(r) for r in search.search(index, asking, 8, first, growth).collect()), key=str)
    assert got == ranked(docs, items, 8)


def test_search_in_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        asking = search.item_terms(i)
        assert search.search(search.build(d, only=search.asked_terms(asking)), asking).count() == 0


# --- 13: suffix arrays -----------------------------------------------------------

def test_suffix_array_and_common_prefixes():
    rnd = random.Random(3)
    for _ in range(150):
        data = bytes(rnd.choice(rnd.choice([b"ab", b"abcdefgh", bytes(range(1, 256))])) for _ in range(rnd.randint(1, 300)))
        data = data + data[: rnd.randint(0, len(data))] + data if rnd.random() < 0.5 else data
        raw = np.frombuffer(data, np.uint8)
        sa, alike, shared = suffix_dedup.suffix_array(raw, 50)
        keys = [data[i: i + 50] for i in sa]
        assert keys == sorted(keys)
        common = suffix_dedup.common_prefixes(suffix_dedup.words8(raw), sa, alike, shared, 50)
        for r in range(1, len(data)):
            k = next((x for x, (a, b) in enumerate(zip(keys[r - 1], keys[r])) if a != b), min(len(keys[r - 1]), len(keys[r])))
            assert common[r] == (k if k >= shared else 0)


def without_repeats(docs, length=50):
    least, big = {}, suffix_dedup.LAST
    for d, t in docs:
        data = (t or "").encode()
        for i in range(len(data) - length + 1):
            s = data[i: i + length]
            least[s] = min(least.get(s, big), big if d is None else d)
    out = []
    for d, t in docs:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if least[data[i: i + length]] < (big if d is None else d):
                gone[i: i + length] = b"\1" * length
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((str(d), len(data), sum(gone), spans, bytes(x for x, g in zip(data, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"shard": 700, "content": 3000, "block": 400}])
def test_repeats_against_all_strings(spark, sizes):
    rnd = random.Random(4)
    words = ["mesa", "ö", "la", "tion", "ñ", "日本", "x"] + [f"w{i}" for i in range(40)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared = [prose(30) for _ in range(6)]
    docs = [(None, None), (3, ""), (3, None), (5, "short"), (None, shared[0] + prose(20)), (None, shared[0])]
    for _ in range(80):
        parts = [prose(rnd.randint(0, 40))]
        for _ in range(rnd.randint(0, 3)):
            parts += [rnd.choice(shared)[rnd.randint(0, 40):], prose(rnd.randint(0, 10))]
        docs.append((rnd.randint(0, 100), "\n".join(parts)))
    docs += docs[10:20] + [(200, "a" * 3000), (201, "ab" * 900), (202, "a" * 100 + "\x00" * 80 + "b"), (199, "\x00" * 60 + "a" * 51),
                           (300, docs[20][1]), (301, " ".join(shared)), (302, prose(4000) + shared[1])]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, kept string, marks int").repartition(5)
    found = suffix_dedup.remove_repeats(df, **sizes)
    assert found.columns == ["doc_id", "text", "n_bytes", "n_removed", "spans", "kept"]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in found.collect())
    assert got == without_repeats(docs)
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_a_shard_hashes_each_byte_once(monkeypatch):
    """The grams (two steps) of each place, and of least hashes only those that begin a piece."""
    rnd = random.Random(6)
    texts = [" ".join(f"w{rnd.randint(0, 900)}" for _ in range(2000)) for _ in range(8)]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    ids = np.arange(8)
    hashed, mix = [], suffix_dedup.mix64
    monkeypatch.setattr(suffix_dedup, "mix64", lambda x: hashed.append(len(x)) or mix(x))
    cutter = suffix_dedup.Shards(3, 50, suffix_dedup.SHARD)
    rows = [r for part in cutter.segments(offsets) for r in cutter.emit(offsets, raw, ids, ids, ids, part)]
    n_pieces = sum(len(suffix_dedup._from_ints(r[2])) for r in rows if r[4] is not None)
    assert n_pieces and sum(hashed) <= 2 * (len(raw) + 50) + 2 * n_pieces


def test_hot_hashes_are_merged_by_binary_search():
    """Pieces of one hash in several blocks."""
    rnd = random.Random(5)
    base = bytes(rnd.choice(b"abc") for _ in range(90))
    blocks, pieces = [], []
    for order in range(12):
        data = [base[rnd.randint(0, 20):] + bytes([rnd.choice(b"xyz")]) * rnd.randint(0, 9) for _ in range(4)]
        pieces.append([(order % 7, x) for x in data])
        blocks.append((np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum([len(x) for x in data])),
                       np.full(4, order % 7), None))
    least = {}
    for o, x in (p for b in pieces for p in b):
        for i in range(len(x) - 49):
            least[x[i: i + 50]] = min(least.get(x[i: i + 50], 99), o)
    for (raw, bounds, _, _), marked, block in zip(blocks, suffix_dedup.repeats(blocks, 50), pieces):
        for k, (o, x) in enumerate(block):
            want = [i + 50 <= len(x) and least[x[i: i + 50]] < o for i in range(len(x))]
            assert marked[bounds[k]: bounds[k + 1]].tolist() == want


def test_queries_leave_out_nothing(spark):
    n = table(spark, SF, "documents").count()
    assert Q.op13_suffix_dedup(spark, SF).agg(F.count(F.lit(1))).first()[0] == n
