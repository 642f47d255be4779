"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the hashed 1- to 3-grams of lower-cased text by language in numpy, Spark
sums the counts, and the model goes to all tasks as the counts that are not zero.  Scoring
makes log probabilities of them (buckets x languages), gathers the rows of a batch's n-grams
and sums them by document; the best language gets its posterior probability as score.  Any
number of languages does: they are collected, and scored, so many (``AT_ONCE``) at a time.
(Counts that are not zero are bounded by the n-grams of the sample, 11 bytes each.)

Training reads labelled rows only, at most about ``max_rows`` different ones, chosen by a
hash of text and label (all where there are fewer); copies count once, so a large group of
them can't fill the sample.  Scores cover whole texts.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is
everything where no labelled row exists; ties go to the first language by name; rows are
mapped one by one, so repeated rows and extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalink.llm.common import stage, string_buffers, text_column, text_slices

BUCKET_BITS = 16
GRAMS = (1, 2, 3)
MAX_ROWS = 20_000
SAMPLE_STEPS = 1 << 60
#: Languages (at most 256) whose log probabilities are held at once.
AT_ONCE = 64
UNKNOWN = "und"
SLICE = 1 << 20


@dataclass(frozen=True)
class Shard:
    """Counts of some languages' n-grams, those that are not zero."""

    size: int           # languages
    bucket: np.ndarray  # uint16
    lang: np.ndarray    # uint8, within the shard
    count: np.ndarray   # int64

    def log_table(self) -> np.ndarray:
        """(buckets + 1) x languages; the last row is zero."""
        n = 1 << BUCKET_BITS
        whole = np.log(np.bincount(self.lang, weights=self.count, minlength=self.size) + 0.5 * n)
        out = np.empty((n + 1, self.size), dtype=np.float32)
        out[:n] = np.log(0.5) - whole
        out[self.bucket, self.lang] = np.log(self.count + 0.5) - whole[self.lang]
        out[n] = 0
        return out

    @cached_property
    def kept_table(self) -> np.ndarray:
        return self.log_table()


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    prior: np.ndarray   # log share of documents
    shards: tuple[Shard, ...]  # of the languages in their order


def gram_buckets(texts: pa.LargeStringArray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each n the bucket of the n-gram at every character (one past the buckets where
    it would leave its text), and the bounds of the texts in characters."""
    low = pc.utf8_lower(texts)
    sizes = pc.utf8_length(low).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=bounds[1:])
    _, raw = string_buffers(low)
    chars = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    left = np.repeat(bounds[1:], sizes) - np.arange(len(chars))  # characters to the end of the text
    out = []
    for n in GRAMS:
        h = np.full(len(chars), 0x9E3779B1 * n & 0xFFFFFFFF, dtype=np.uint32)
        for k in range(n):
            h[: len(chars) - k] = (h[: len(chars) - k] ^ chars[k:]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        bucket = (h * np.uint32(0xC2B2AE35) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)
        bucket[left < n] = 1 << BUCKET_BITS
        out.append(bucket)
    return out, bounds


def train(df: DataFrame, text: str = "text", lang: str = "lang", max_rows: int = MAX_ROWS) -> LanguageModel | None:
    """Fit on the rows of ``df`` whose ``lang`` and ``text`` are not null; None without any."""
    rows = df.select(F.col(text).alias("_text"), F.col(lang).alias("_lang")).where("_text is not null and _lang is not null")
    below = min(SAMPLE_STEPS, SAMPLE_STEPS * max_rows // max(1, rows.count()))
    rows = rows.where(F.pmod(F.xxhash64("_text", "_lang", F.lit(7)), F.lit(SAMPLE_STEPS)) < below).distinct()
    n = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for name, mine in sums.items():
                hit = np.flatnonzero(mine[:n])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * (len(hit) + 1)), pa.array(np.append(hit, -1)), pa.array(np.append(mine[hit], docs[name]))],
                    names=["lang", "bucket", "n"])
            sums.clear()
            docs.clear()

        for whole in batches:
            for batch in text_slices(whole, "_text", SLICE):
                langs = batch.column("_lang").dictionary_encode()
                code = langs.indices.to_numpy(zero_copy_only=False)
                grams, bounds = gram_buckets(text_column(batch, "_text"))
                of = np.repeat(code, np.diff(bounds))
                order = np.argsort(of, kind="stable")
                ends = np.searchsorted(of[order], np.arange(len(langs.dictionary) + 1))
                for i, name in enumerate(langs.dictionary.to_pylist()):
                    if len(sums) >= AT_ONCE and name not in sums:
                        yield from counted()
                    mine = sums.setdefault(name, np.zeros(n + 1, dtype=np.int64))
                    docs[name] = docs.get(name, 0) + int((code == i).sum())
                    at = order[ends[i]: ends[i + 1]]
                    for g in grams:
                        mine += np.bincount(g[at], minlength=n + 1)
        yield from counted()

    counts = stage(rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "languages")
    share = {r.lang: r.n for r in counts.where("bucket < 0").collect()}  # at most as many as sampled rows
    if not share:
        return None
    languages = tuple(sorted(share))
    shards = []
    for k in range(0, len(languages), AT_ONCE):
        names = languages[k: k + AT_ONCE]
        part = counts.where(F.col("lang").between(names[0], names[-1]) & (F.col("bucket") >= 0))
        got = part.join(F.broadcast(df.sparkSession.createDataFrame(list(zip(names, range(len(names)))), "lang string, number int")), "lang")
        got = got.select("bucket", "number", "n").toPandas()  # at most buckets x AT_ONCE rows
        shards.append(Shard(len(names), got["bucket"].to_numpy(np.uint16), got["number"].to_numpy(np.uint8), got["n"].to_numpy(np.int64)))
    prior = np.array([share[x] for x in languages], dtype=np.float64)
    return LanguageModel(languages, np.log(prior / prior.sum()), tuple(shards))


def score_texts(model: LanguageModel, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Best language (its number) and posterior probability of each text."""
    grams, bounds = gram_buckets(texts)
    rows, at = len(bounds) - 1, 0
    full = np.flatnonzero(np.diff(bounds))
    best, most, mass = np.zeros(rows, dtype=np.int64), np.full(rows, -np.inf), np.zeros(rows)
    for shard in model.shards:
        total = np.repeat(model.prior[None, at: at + shard.size], rows, axis=0)
        if len(full):
            table = shard.kept_table if len(model.shards) == 1 else shard.log_table()
            for g in grams:
                total[full] += np.add.reduceat(table[g], bounds[full], axis=0, dtype=np.float64)
        top = total.max(axis=1)
        best = np.where(top > most, at + total.argmax(axis=1), best)  # ties stay with the first
        more = np.maximum(most, top)
        mass = mass * np.exp(most - more) + np.exp(total - more[:, None]).sum(axis=1)
        most, at = more, at + shard.size
    return best, 1.0 / mass


def predict(df: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """All columns of ``df`` but those named ``lang_pred`` and ``score``, then these two."""
    keep = [c for c in df.columns if c not in ("lang_pred", "score")]
    rows = df.select(*keep)
    if model is None:
        return rows.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    shared = df.sparkSession.sparkContext.broadcast(model)  # buckets x languages
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    at = keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], dtype=object)
        for whole in batches:
            for batch in text_slices(whole, keep[at], SLICE):
                texts = text_column(batch, keep[at])
                best, score = score_texts(m, texts)
                letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
                best[~letters], score[~letters] = len(m.languages), 0.0
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names[best], pa.string()), pa.array(score)],
                                                 names=[*keep, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)
