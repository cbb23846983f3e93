"""Written tables that cut lineage, in the folder the cluster shares.

A staged table is plain Parquet: losing executors costs nothing that is already
written, and later scans read only the columns they need.
"""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_log = logging.getLogger(__name__)
_local_root: str | None = None
_staged_here: ContextVar[list[str] | None] = ContextVar("staged_here", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine; on
    a cluster the executors would not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="starweir-")
        _log.warning("spark.checkpoint.dir is not set; staging in %s", _local_root)
    return _local_root


def _file_system(spark: SparkSession, location: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, removed when the session's JVM ends, or
    with the enclosing :func:`temporary` block."""
    location = f"{scratch_root(spark)}/starweir/{name}-{uuid.uuid4().hex}"
    files, path = _file_system(spark, location)
    files.mkdirs(path)
    files.deleteOnExit(path)
    open_block = _staged_here.get()
    if open_block is not None:
        open_block.append(location)
    return location


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Remove what this thread stages inside the block when the block ends.

    For a result that is written elsewhere before then.
    """
    locations: list[str] = []
    token = _staged_here.set(locations)
    try:
        yield
    finally:
        _staged_here.reset(token)
        for location in locations:
            files, path = _file_system(spark, location)
            files.delete(path, True)


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and return the written table."""
    location = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(location, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(location)
