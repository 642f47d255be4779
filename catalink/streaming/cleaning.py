"""Stateless cleaning on streaming DataFrames.

The analysed project is batch-only; its cleaning expressions are stateless
columns, so the same staged typing runs unchanged on ``readStream`` sources
(new files landing in a folder).  No state, watermark or window is needed.
The query's checkpoint lives under the cluster's shared checkpoint folder, so
a restarted or re-scheduled query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from catalink import config as C
from catalink.operators.cleaning import typed_columns
from catalink.sources.sinks import scratch_path


def read_text_stream(spark: SparkSession, folder: str, columns: Sequence[str],
                     fmt: str = "csv", max_files_per_trigger: int = 100, escape: str = "\\") -> DataFrame:
    """Stream of all-text rows from files landing in ``folder``.  CSV files must have the
    columns in this order (a header that differs fails the batch); ``escape`` is what stands
    before a quote inside a quoted field."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = (reader.option("header", True).option("enforceSchema", False).option("escape", escape).option("quote", '"')
                        .option("multiLine", True))
    return reader.format(fmt).load(folder)


def clean_stream(stream: DataFrame, longs: Sequence[str] = (), doubles: Sequence[str] = (),
                 prices: Sequence[str] = (), tokens: Sequence[str] = C.MISSING_TOKENS) -> DataFrame:
    """Strip, tokens to null and typed numbers: the batch cleaner's stateless part."""
    return typed_columns(stream, longs, doubles, prices, tokens)


def write_stream_once(stream: DataFrame, path: str, checkpoint: str | None = None,
                      fmt: str = "parquet") -> StreamingQuery:
    """Process everything available now, then stop (incremental batch)."""
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "stream-ckpt")
    query = (stream.writeStream.format(fmt).outputMode("append")
                   .option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True).start(path))
    query.awaitTermination()
    return query
