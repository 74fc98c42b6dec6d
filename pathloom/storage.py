"""Where results that several steps read are kept, and when a table may be broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def work_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pathloom-"))
    return spark.sparkContext.getCheckpointDir()


# With this setting Spark deletes the shuffle files of a query when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Drop the shuffle files of every query inside as soon as it ends. Only for queries whose
    result is written; a data frame that ran inside is not run again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


# Without this setting a join takes a partitioning by some of its keys as it is, such as that of buckets.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Joins inside use a partitioning by fewer keys than theirs where there is one. Only for queries whose result is written; results
    do not depend on it."""
    before = spark.conf.get(ALL_KEYS, None)
    spark.conf.set(ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.unset(ALL_KEYS) if before is None else spark.conf.set(ALL_KEYS, before)


# Folders to delete, one list for each open ``scratch`` block.
_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was stored inside. Results are lazy and read it, so they have to
    be written before the block ends."""
    _scratch.append([])
    try:
        yield
    finally:
        for folder in _scratch.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(spark: SparkSession, name: str = "pathloom") -> str:
    """A folder of its own below the shared one."""
    folder = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append(folder)
    return folder


def freeze(rows: DataFrame) -> DataFrame:
    """Write the rows once and read them back: later steps share the work, see only the
    columns they need, and a lost executor cannot change what was written. Shuffle files
    go when the rows are written."""
    spark = rows.sparkSession
    target = new_folder(spark)
    with shuffle_cleanup(spark):
        rows.write.parquet(target)
    stored = spark.read.schema(rows.schema).parquet(target)
    stored._frozen = True
    return stored


def broadcast_if_small(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """A table for the small side of a join. Stored, so that Spark knows its bytes and broadcasts it only below
    ``spark.sql.autoBroadcastJoinThreshold``; with a ``limit``, hinted after counting that it has no more rows."""
    if limit is not None:
        return F.broadcast(rows) if rows.limit(limit + 1).count() <= limit else rows
    return rows if getattr(rows, "_frozen", False) else freeze(rows)
