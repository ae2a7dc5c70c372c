"""Session helper, table loader and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "millrace", master: str | None = None, **conf: object) -> SparkSession:
    """Session with the settings the library is tested with.

    Shuffle partitions are left to AQE coalescing; pass any Spark setting as a
    keyword with dots written as double underscores.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder of ``<name>.parquet`` files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


FEW_FILES = 16


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of a few files that make fewer partitions than cores to all cores; any other input stays as it is.

    For small inputs in unsplittable files that costly expressions follow.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) > FEW_FILES or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A cluster has to name it in ``spark.checkpoint.dir``; only a local master
    may fall back to a folder of its own machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="millrace-")
        context.setCheckpointDir(folder)
    elif not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; two calls never share one."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what :func:`materialize` writes inside the block at its end, for jobs that run again and again.

    Nothing made inside may be read afterwards, but for tables stored with ``outer``. Blocks may be nested.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove_folder(spark, path)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is missing."""
    system, place = _file_system(spark, path)
    return [s.getPath().getName() for s in system.listStatus(place) if s.isDirectory()] if system.exists(place) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    system, place = _file_system(spark, path)
    system.delete(place, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """What a write inside the block shuffles is removed when it ends, not when the driver happens to collect its garbage.

    For results that are read from files: jobs of many steps else hold the shuffle files of all of them.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, *, outer: bool = False) -> DataFrame:
    """Compute once into a table in the shared folder, so that the result outlives its executors.

    A written table is computed in one pass (an RDD checkpoint takes two) and is
    read back with column pruning and pushed filters. With ``outer`` it outlives the innermost
    :func:`scratch_scope` and belongs to the one around it, if there is one.
    """
    path = scratch_path(df.sparkSession, "stage")
    if len(_scopes) > outer:
        _scopes[-1 - outer].append(path)
    with _shuffle_files_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
