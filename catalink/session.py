"""Session helpers.

The library never creates a session behind the caller's back: functions take
DataFrames.  ``get_session`` is for scripts, tests and the bench; it keeps
whatever a cluster already configured (master, checkpoint folder, memory) and
only fills in settings that are unset.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings we want on every session.  AQE re-plans joins from runtime sizes
# (broadcast only below the measured threshold, otherwise sort-merge), splits
# skewed shuffle partitions and coalesces tiny ones.
_SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "catalink") -> SparkSession:
    """Return the active session, or build one for local use."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in _SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_code(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, a folder that every executor can reach.

    Where it is unset, only a local session gets a fresh temporary folder; on a cluster a
    machine-local folder would lose data, so that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir() if hasattr(
            spark.sparkContext, "getCheckpointDir") else None
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="catalink-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    # setCheckpointDir creates a fresh sub-folder on every call: only once per context
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, which may run where it is not installed (once
    per context; Spark's driver serves the archive, executors share no folder with it)."""
    import zipfile

    context = spark.sparkContext
    if getattr(context, "_catalink_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="catalink-code-"), "catalink.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.join("catalink", os.path.relpath(path, root)))
    context.addPyFile(archive)
    context._catalink_shipped = True


def cut_lineage(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table under the shared checkpoint folder
    and return a DataFrame reading it.

    One computation (a reliable RDD checkpoint computes the plan twice: once
    for its eager count, once for the write), a plan without the upstream
    lineage (lost executors re-read files instead of recomputing the
    upstream), and reads with column pruning and filter push-down.
    """
    import uuid

    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/catalink-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.parquet(path)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of jobs started inside are removed when the job is done, not when the driver
    collects garbage: for steps that write their results (``cut_lineage``), each of which would
    leave its shuffles on the disk beside those of the next."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    if before == "true":  # of a caller, who puts it back
        yield
        return
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")

