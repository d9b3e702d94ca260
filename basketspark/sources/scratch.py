"""A folder for tables that are written and read again within a query."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster shares (``spark.checkpoint.dir``); a session on this machine alone may do
    without one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return f"{sc.getCheckpointDir()}/{name}-{uuid4().hex}"
