"""A folder for tables that a query writes on its way."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

from helixframe.operators import table


def _gone(spark: SparkSession, path: str) -> None:
    try:
        table.remove(spark, path)
    except Exception:  # the JVM may be gone at exit
        pass


def folder(spark: SparkSession, name: str) -> str:
    """In the folder that the cluster shares (spark.checkpoint.dir); one of our own only in local mode. It goes when the driver ends."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints", f"helixframe-{os.getpid()}")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(_gone, spark, path)
    return path
