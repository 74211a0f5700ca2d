"""Folders for what a query writes and reads back: below the shared folder that spark.checkpoint.dir names."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession


def folder(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, deleted when the driver ends. A local session without one gets a folder of its own."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="corpusloom-")
    path = f"{top.rstrip('/')}/corpusloom-{tag}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    try:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except (AttributeError, Py4JError, OSError):  # the session has ended; the folder is left to the cluster's clean-up
        pass
