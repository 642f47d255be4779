"""A pipeline over ``documents`` made of the operators in ``catalink.llm``.

Each stage takes the documents that the one before kept; all but the last return the columns
of ``documents``.  Stages are written as Parquet and read again by whoever runs them
(``run`` does so under the shared checkpoint folder).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalink.llm import decontaminate, jaccard, langid, secrets, sentencepiece
from catalink.llm.common import row_key, stage, table
from catalink.llm.queries import PIECES, vocabulary

#: SQL has no language model and no Viterbi segmentation; the tests compare with brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without text or letters (``und``) go.  The model
    learns from the labelled documents of the stage's input."""
    found = langid.predict(docs, langid.train(docs))
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest ``doc_id``.  One row stays
    of a group whatever its ids: rows with a ``doc_id`` go before those without, and among
    equal ids (or where all are null) the smallest hash of id and text decides; repeated rows
    count as copies."""
    kept = jaccard.representatives(docs.select("doc_id", "text"))
    rows = docs.withColumn("_key", row_key("doc_id", "text"))
    return rows.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are passages of the benchmark."""
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.contaminated()).select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark (``n_chars`` follows the text)."""
    found = secrets.scan(docs)
    clean = F.when(F.size("secrets") > 0, secrets.redact(F.col("text"), F.col("secrets"))).otherwise(F.col("text"))
    found = found.withColumn("text", clean)
    return found.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, with its language and source."""
    return sentencepiece.encode(docs, sentencepiece.load_model(vocabulary(PIECES)), keep=("doc_id", "lang", "source"))


STAGES = [("language ID", language), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontaminated),
          ("secret scans", without_secrets), ("SentencePiece encoding", encoded)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
