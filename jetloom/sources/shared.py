"""The folder that driver and executors share, and tables in it that cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """This application's part of the folder in ``spark.checkpoint.dir``, without a last slash.

    Where the setting is absent a temporary folder is made, and removed at exit, but only in local mode, where
    driver and executors are one machine; on a cluster that is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="jetloom-")
        atexit.register(shutil.rmtree, where, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where.rstrip('/')}/jetloom-{spark.sparkContext.applicationId}"


_RECORDINGS: ContextVar[tuple[list[str], ...]] = ContextVar("recordings", default=())


@contextmanager
def recording() -> Iterator[list[str]]:
    """Lists the paths that the block itself is given, in any depth, so that their owner can remove them when nothing reads them any more.

    Each thread has its own: what runs beside the block is not listed.
    """
    made: list[str] = []
    token = _RECORDINGS.set((*_RECORDINGS.get(), made))
    try:
        yield made
    finally:
        _RECORDINGS.reset(token)


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _RECORDINGS.get():
        made.append(path)
    return path


def written(df: DataFrame, name: str, few_files: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    ``few_files``: a task writes several of the last shuffle's partitions, one after
    another, so that there are at most two files for each core of the cluster.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if few_files:
        df = df.coalesce(2 * spark.sparkContext.defaultParallelism)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Deletes tables of the shared folder; what still reads them must have been written before."""
    for where in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
