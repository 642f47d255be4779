"""The registered queries of this folder at sf0.001: SQL twins where they exist, else brute
force; the pipeline stage by stage."""

import hashlib
import math
import os
import re
import sys
import zlib

import duckdb
import numpy as np
import pytest
import sentencepiece as spm

SF = "/root/testdata/sf0.001"
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from catalink.llm import langid, queries as Q, secrets  # noqa: E402
from catalink.llm.common import stage, table  # noqa: E402


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = Q.queries()[name](spark, SF)
    found = con.execute(Q.oracle_sql()[name])
    cols = [c[0] for c in found.description]
    assert sorted(cols) == sorted(df.columns)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(found.fetchall(), cols)


def documents(spark):
    return sorted(((r.doc_id, r.text or "", r.lang) for r in table(spark, SF, "documents").collect()), key=lambda r: r[0])


def test_op1(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=Q.vocabulary(Q.PIECES))
    got = {r.doc_id: r for r in Q.op1_sentencepiece(spark, SF).collect()}
    for d, text, _ in documents(spark):
        assert list(got[d].ids) == sp.encode(text) and got[d].lossless


def test_op2(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(Q.vocabulary(Q.BYTES))
    want, start = [], 0
    for d, text, _ in documents(spark):
        ids = [*tok.encode(text, add_special_tokens=False).ids, 0]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in Q.op2_token_files(spark, SF).collect()) == want


def test_op6(spark):
    rows = documents(spark)[::-1]
    got = {r.doc_id: r for r in Q.op6_fingerprints(spark, SF).collect()}
    lines = lambda t: {x for x in t.split("\n") if x.strip(" ")}
    by_text = {}
    for (d, text, _), (_, after, _) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for near, other in ((r.near_edited, edited), (r.near_next, after)):
            a, b = lines(text), lines(other)
            assert abs(near - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-9
        by_text.setdefault(text, set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert len({x for v in by_text.values() for x in v}) > 0.9 * len(by_text)


def test_op8(spark):
    langs = {d: lang for d, _, lang in documents(spark)}
    rows = Q.op8_language_id(spark, SF).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.9 * len(held)


def buckets(text):
    """Hash buckets of a text's 1- to 3-grams, one by one."""
    low, out, mask = text.lower(), [], 0xFFFFFFFF
    for n in (1, 2, 3):
        for i in range(len(low) - n + 1):
            h = 0x9E3779B1 * n & mask
            for c in low[i: i + n]:
                h = (h ^ ord(c)) * 0x85EBCA6B & mask
                h ^= h >> 15
            out.append((h * 0xC2B2AE35 & mask) >> 16)
    return out


def test_op8_against_a_dense_model(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in table(spark, SF, "documents").collect()]
    sample = {(t, lang) for d, t, lang in rows if lang is not None and t is not None and zlib.crc32(str(d).encode()) % 3 != 1}
    langs, size = sorted({lang for _, lang in sample}), 1 << 16
    counts = {lang: np.zeros(size) for lang in langs}
    for t, lang in sample:
        counts[lang] += np.bincount(buckets(t), minlength=size)
    logs = {lang: np.log((c + 0.5) / (c.sum() + 0.5 * size)) for lang, c in counts.items()}
    prior = {lang: math.log(sum(x == lang for _, x in sample) / len(sample)) for lang in langs}
    want = {}
    for d, t, _ in rows:
        if not any(c.isalpha() for c in t or ""):
            want[d] = (langid.UNKNOWN, 0.0)
            continue
        total = np.array([prior[lang] + logs[lang][buckets(t)].sum() for lang in langs])
        want[d] = (langs[int(total.argmax())], 1 / np.exp(total - total.max()).sum())
    got = {r.doc_id: (r.lang_pred, r.score) for r in Q.op8_language_id(spark, SF).collect()}
    assert set(got) == set(want)
    assert all(got[d][0] == want[d][0] and abs(got[d][1] - want[d][1]) < 1e-3 for d in want)


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def one_of_each_group(texts):
    """Ids that stay when of each component of similar texts the smallest does."""
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {d: shingles(t) for d, t in texts.items()}
    least = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return {d for d in sets if least[d] == d}


def not_contaminated(texts, items):
    """Ids of texts of which less than a twentieth of the words lie in items' windows."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = set()
    for w in map(words, items):
        n = min(13, len(w))
        windows |= {tuple(w[i: i + n]) for i in range(len(w) - n + 1 if n else 0)}
    sizes = {len(w) for w in windows}
    out = set()
    for d, t in texts.items():
        w, hit = words(t), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i: i + n]) in windows:
                    hit |= set(range(i, i + n))
        if not hit or 20 * len(hit) < len(w):
            out.add(d)
    return out


def redacted(text):
    """The text with the spans of all rules, found by Python's expressions, marked."""
    spans = []
    for rule in secrets.RULES:
        flags = re.A | (re.I if rule.any_case else 0)
        spans += [(m.start(), m.end()) for m in re.finditer(rule.pattern, text, flags) if len(m[rule.group]) >= rule.least]
    at, out = 0, ""
    for start, end in sorted(spans):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_pipeline(spark):
    """Each stage against brute force on what the one before kept."""
    docs = table(spark, SF, "documents")
    bench = [r.text for r in table(spark, SF, "benchmark").collect()]
    before = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = stage(function(spark, before, SF), "test")
        assert after.columns == docs.columns and after.schema == docs.schema
        rows, kept = ({r.doc_id: r for r in df.collect()} for df in (before, after))
        texts = {d: r.text for d, r in rows.items()}
        if function is corpus_pipeline.language:
            stays = {d for d, t in texts.items() if any(c.isalpha() for c in t or "")}
        elif function is corpus_pipeline.near_duplicates:
            stays = one_of_each_group(texts)
        elif function is corpus_pipeline.decontaminated:
            stays = not_contaminated(texts, bench)
        else:
            stays, texts = set(texts), {d: redacted(t) for d, t in texts.items()}
            assert any(texts[d] != rows[d].text for d in rows)
        assert set(kept) == stays and {d: r.text for d, r in kept.items()} == {d: texts[d] for d in stays}, name
        assert function in (corpus_pipeline.language, corpus_pipeline.without_secrets) or len(stays) < len(texts)
        assert all((r.lang, r.source) == (rows[d].lang, rows[d].source) for d, r in kept.items())
        before = after
    last = {r.doc_id: r for r in corpus_pipeline.encoded(spark, before, SF).collect()}
    library = spm.SentencePieceProcessor(model_file=Q.vocabulary(Q.PIECES))
    assert set(last) == {r.doc_id for r in before.collect()}
    for r in before.collect():
        assert list(last[r.doc_id]["ids"]) == library.encode(r.text)


def test_pipeline_on_awkward_documents(spark):
    schema = table(spark, SF, "documents").schema
    rows = [(1, None, None, None, None), (1, "", "en", "s", 0), (2, "plain words in a text that is short", "en", None, 35),
            (2, "plain words in a text that is short", "en", None, 35), (None, "plain words in a text that is short", None, "s", 35)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for _, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, SF), "test")
        assert [r.doc_id for r in docs.collect()] == ([2] if some else [])


def test_near_duplicates_with_null_and_repeated_ids(spark):
    words = lambda x: " ".join(f"{x}{i}" for i in range(40))
    one, two, three, four = map(words, ("a", "b", "c", "d"))
    rows = [(None, one), (None, one + " tail"), (None, one),  # null ids only: one stays
            (None, two), (7, two + " tail"),  # the id goes before null
            (5, three), (5, three + " tail"), (9, three),  # two texts of one id: one stays
            (5, four), (3, four + " tail"),  # not the one whose id is kept elsewhere
            (None, None), (None, ""), (None, ""), (4, None), (4, "")]  # without words: each once
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], table(spark, SF, "documents").schema).repartition(3)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    by = {x: [(d, t) for d, t in got if (t or " ")[0] == x] for x in "abcd "}
    assert len(by["a"]) == 1 and by["a"][0] in rows[:3]
    assert by["b"] == [(7, two + " tail")]
    assert len(by["c"]) == 1 and by["c"][0] in rows[5:7]
    assert by["d"] == [(3, four + " tail")]
    assert sorted(by[" "], key=str) == sorted([(None, None), (None, ""), (4, None), (4, "")], key=str)


def test_queries_need_only_what_they_name():
    assert [n.split("_")[0] for n in Q.queries()] == [f"op{i}" for i in range(1, 14)]
    assert langid.UNKNOWN == "und"
