"""Shared folders and durable intermediate tables.

Every job that must read an intermediate result twice writes it as a Parquet
table in the folder the cluster names in ``spark.checkpoint.dir``; where that is
unset, in the warehouse, which the driver and the executors share as well.  A
written table survives the loss of any executor and has one fixed content, which
the range-partitioned ranking in :mod:`tidemark.operators.ranking` depends on.

All tables of an application lie in one folder, which goes when its driver ends.
A job that has written its own output can drop its tables earlier: ``scope``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_MARKED: set[str] = set()
_SCOPES: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The application's folder below the cluster's checkpoint or warehouse folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or _warehouse(
        spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master)
    folder = f"{named.rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"
    if folder not in _MARKED:
        path, files = _file_system(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _MARKED.add(folder)
    return folder


def _warehouse(folder: str, master: str) -> str:
    """The warehouse as the shared folder, which a folder of the driver's machine is only without a cluster."""
    one_machine = master == "local" or master.startswith("local[")
    if not one_machine and (":" not in folder.split("/")[0] or folder.startswith("file:")):
        raise ValueError(f"executors do not see {folder}: name a shared folder in spark.checkpoint.dir")
    return folder


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Drops the tables written inside when the block ends; use it around a whole job."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for folder in _SCOPES.pop():
            path, files = _file_system(spark, folder)
            files.delete(path, True)


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fan_out(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Spread a file scan that arrives in fewer splits than there are cores.

    For heavy per-row work only.  A large input has more splits than cores and
    is returned as it is, so nothing is shuffled at scale.  ``scan`` must be a
    plain scan: counting its partitions then runs no job.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *keys)
