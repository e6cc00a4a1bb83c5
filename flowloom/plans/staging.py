"""Tables written once to the shared folder, and joins to small tables.

A staged table cuts lineage (a lost executor rereads files instead of replaying
the whole job) and has a known size on disk, so Spark's own broadcast threshold
decides whether it is shipped to every executor.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster: ``spark.checkpoint.dir``.

    Only a local session, where no such folder is named, gets a temporary one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="flowloom-"))
    return context.getCheckpointDir().rstrip("/")


# Folders handed out within :func:`temporary_tables`, innermost last.
_SCOPES: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, what was staged in it; frames that read it must be done by then."""
    folders: list[str] = []
    _SCOPES.append(folders)
    try:
        yield
    finally:
        _SCOPES.remove(folders)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def leaves_nothing(job: Callable[..., None]) -> Callable[..., None]:
    """A job that writes its results, after which nothing that it has staged is needed."""

    @functools.wraps(job)
    def run(*args, **named) -> None:
        with temporary_tables(SparkSession.active()):
            job(*args, **named)

    return run


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    folder = f"{shared_dir(spark)}/flowloom/{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(folder)
    return f"{folder}/{name}"


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written within the block leaves no shuffle files behind; else they stay until the driver collects its garbage."""
    switch = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(switch, None)
    spark.conf.set(switch, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(switch)
        else:
            spark.conf.set(switch, before)


def stage_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back; ``compression`` of the files, if not that of the session."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with dropped_shuffles(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def join_staged(facts: DataFrame, dimension: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join ``facts`` to a table of usually few rows without a broadcast hint.

    ``dimension`` is staged, so its size is its file size: below
    ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast and ``facts`` are not
    shuffled; above it Spark sort-merges, and adaptive execution splits the
    partitions of hot keys.
    """
    return facts.join(stage_table(dimension, "dimension"), on, how)
