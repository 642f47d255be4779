"""Sinks: tables to Parquet/CSV, reports as long tables, table shapes."""

from __future__ import annotations

import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalink.operators.ranking import SortKey, sort_rows
from catalink.session import ensure_checkpoint_dir


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", escape: str = '"') -> None:
    """Parquet by default; ``csv`` writes a header and doubles (or escapes) quotes inside fields."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).option("escape", escape).option("quote", '"').csv(path)
    else:
        w.format(fmt).save(path)


def write_report(report: DataFrame, path: str, as_text: bool = False) -> None:
    """A report is a long table (section, metric, value); text output puts one
    ``section | metric | value`` line per row."""
    if as_text:
        line = F.concat_ws(" | ", *[F.col(c).cast("string") for c in report.columns])
        report.select(line.alias("value")).write.mode("overwrite").text(path)
    else:
        report.write.mode("overwrite").parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a local temp dir)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/catalink-{name}-{uuid.uuid4().hex}"


def write_sorted(df: DataFrame, path: str, keys: Sequence[SortKey], fmt: str = "parquet") -> None:
    """Write a table whose part files follow one another in the order of ``keys`` ((column,
    descending) pairs, nulls last): Spark's range partitioning gives each task the next range,
    and part files are numbered by task.  No task holds more than a range."""
    write_table(sort_rows(df, keys), path, fmt)


def read_sorted(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """A Parquet table written by ``write_sorted``, with each row's ``position`` (from 1) in its
    order.  Reading gives files to tasks by size, so the order comes from the part numbers: rows
    before a file are a prefix sum over one count a file, to which the row's place is added."""
    rows = spark.read.parquet(path).withColumns({
        "_part": F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("bigint"),
        "_place": F.col("_metadata.row_index")})
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))  # one row a file
    return (rows.join(F.broadcast(ahead), "_part").withColumn(position, F.col("_ahead") + F.col("_place") + 1)
                .drop("_part", "_place", "_ahead"))


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans answer counts, minima and maxima
    from file footers (no option of the caller's session is changed)."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def column_extremes(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """(column, rows, min, max) of numeric columns of a Parquet table, from its footers alone;
    min and max leave nulls out and are null for a column without values.  The files must carry
    statistics of the columns (writers give none for a chunk that holds NaN: Spark raises then)."""
    df = footer_session(spark).read.parquet(path)
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[f(F.col(c)).alias(f"_{name}{i}") for i, c in enumerate(columns)
                                                for name, f in (("min", F.min), ("max", F.max))])
    items = [F.struct(F.lit(c).alias("column"), F.col("_n").alias("rows"), F.col(f"_min{i}").cast("double").alias("min"),
                      F.col(f"_max{i}").cast("double").alias("max")) for i, c in enumerate(columns)]
    return row.select(F.inline(F.array(*items)))


def file_shapes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``table_shapes`` of Parquet tables by path, with the rows counted from their footers."""
    own = footer_session(spark)
    return table_shapes({name: own.read.parquet(path) for name, path in paths.items()})


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table, one row per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"))
        out = one if out is None else out.unionByName(one)
    return out
