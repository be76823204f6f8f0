"""Intermediate tables in the folder that all executors share.

Multi-step operators cut lineage by writing a table below ``spark.checkpoint.dir`` and
reading it back: columns, so each reader takes only what it needs, and a lost executor costs a
re-run of one step and never a result.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: At most so many rows of keys are broadcast, counted first: some 50 MB as a hash table.
BROADCAST_ROWS = 500_000
#: Rows of a table that one task derives others from.
TASK_ROWS = 1 << 17
#: Bytes of a batch that goes to a Python worker.
BATCH_BYTES = 4 << 20
_METHOD = "spark.sql.codegen.hugeMethodLimit"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever folder they start in.

    Batches on their way to a worker are limited by their bytes as well as their rows, for texts can
    be long; a limit that the session has of its own stays.
    """
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    if spark.conf.get(_BATCH) == "67108864b":  # Spark's own default
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def small_methods(spark: SparkSession) -> None:
    """Let wide projections be compiled: HotSpot interprets methods of over 8,000 bytes, and Spark makes larger ones unless told; a limit that the session has of its own stays."""
    if spark.conf.get(_METHOD) == "65535":  # Spark's own default
        spark.conf.set(_METHOD, "8000")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a fresh temporary one only on a local master with none configured."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="winnow-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def hadoop(spark: SparkSession, path: str):
    """(file system, path) on the JVM side."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def file_system(uri: str):
    """(Arrow's file system of a URI or local path, the path in it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


_local = threading.local()  # a stream's batches run in a thread of their own


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """What is settled inside is deleted at its end. What it returns must be written or collected by then."""
    outer, _local.paths = getattr(_local, "paths", None), []
    try:
        yield
    finally:
        made, _local.paths = _local.paths, outer
        for path in made:
            delete(spark, path)


def scoped(stage):
    """A stage (spark, ...) whose intermediate tables go when it ends, well or not."""

    @wraps(stage)
    def run(spark: SparkSession, *args, **kw):
        with scope(spark):
            return stage(spark, *args, **kw)

    return run


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; it is deleted when the scope or else the JVM ends."""
    on_workers(spark)
    path = f"{shared_dir(spark)}/winnow-{uuid.uuid4().hex}-{name}"
    fs, p = hadoop(spark, path)
    fs.deleteOnExit(p)
    if getattr(_local, "paths", None) is not None:
        _local.paths.append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.delete(p, True)


def settle(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more, before the JVM ends."""
    for t in tables:
        for folder in {f.rpartition("/")[0] for f in t.inputFiles()}:
            delete(t.sparkSession, folder)


def spread(df: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """``df`` dealt out to a task for each core, and to more where one would have over ``rows`` rows; counted by the files' footers."""
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def computed(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``column``, whose value is computed once a row: what filters on it does not compute it anew, with all that it is made of."""
    one = df.withColumn("__wk_one", F.explode(F.array(column)))
    return one.select(*[F.col("__wk_one").alias(c) if c == column else c for c in df.columns])


def small(df: DataFrame, weight: Column | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """A settled table of keys, marked for broadcast if its rows (or their weights) are counted and few enough."""
    n = df.count() if weight is None else df.agg(F.sum(weight)).first()[0] or 0
    return F.broadcast(df) if n <= most else df


def drop_matches(docs: DataFrame, value: Column, dropped: DataFrame, column: str) -> DataFrame:
    """The rows of ``docs`` whose ``value`` isn't in ``column`` of the settled table ``dropped``.

    Rows of docs stay where they are as long as ``dropped`` is small enough to broadcast; beyond
    that the two meet in a shuffle. A null value matches nothing.
    """
    out = docs.withColumn("__wk_value", value)
    keys = small(dropped.select(F.col(column).alias("__wk_dropped")))
    return out.join(keys, F.col("__wk_value") == F.col("__wk_dropped"), "left_anti").drop("__wk_value")
