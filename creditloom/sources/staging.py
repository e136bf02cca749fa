"""Written intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

A staged table cuts lineage, is columnar (later passes read only the columns they need) and
survives the loss of any executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Row, SparkSession


_FOLDER: ContextVar[str] = ContextVar("folder", default="session")


def staging_root(spark: SparkSession) -> str:
    """Folder for this application's staged tables, below the session's checkpoint folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="creditloom-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return f"{configured.rstrip('/')}/creditloom-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{_FOLDER.get()}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_one_by_one(df: DataFrame, name: str = "rows") -> Iterator[Row]:
    """The rows of ``df``, brought to the driver a partition at a time.

    They are written first: with ``fileCleanup`` on, a query's shuffle files go when it returns, and ``toLocalIterator``
    returns before its partitions are read.
    """
    return stage(df, name).toLocalIterator()


def _delete(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block at its end, when its results have been written."""
    folder = uuid.uuid4().hex
    token = _FOLDER.set(folder)
    try:
        yield
    finally:
        _FOLDER.reset(token)
        _delete(spark, f"{staging_root(spark)}/{folder}")


def drop_staged(spark: SparkSession) -> bool:
    """Delete every table this application staged."""
    return _delete(spark, staging_root(spark))
