"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session(app: str = "jobsignals", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all executors share.

    It is whatever the cluster names in spark.checkpoint.dir. Only where that
    is unset, as in local tests, a temporary folder stands in.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="jobsignals-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str, at_exit: bool = False) -> None:
    """Remove a folder of ours, now or when the application ends."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if at_exit:
        files.deleteOnExit(where)
    else:
        files.delete(where, True)


@contextmanager
def temporary(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh path below the shared folder that is removed afterwards."""
    path = scratch(spark, name)
    try:
        yield path
    finally:
        delete(spark, path)


def until_exit(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder that is removed when the application ends."""
    path = scratch(spark, name)
    delete(spark, path, at_exit=True)
    return path


def enable_checkpoints(spark: SparkSession) -> None:
    """Let iterative training cut its lineage in the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
