"""Partitions of exchanges in proportion to the input."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Lines that a partition of an exchange is dealt, and MB of it (compressed) that one task reads, so that a task's sorts and sums stay as
#: they are when the tables grow.
ROWS, TASK_MB = 250_000, 16
_PARTS, _SIZE = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def sized(spark: SparkSession, rows: int) -> None:
    """Have the session deal exchanges of so many rows into enough partitions, which adaptive execution joins up to ``TASK_MB``. The number of
    partitions is only ever raised, as plans that were made before use the session's settings too."""
    parts = max(int(spark.conf.get(_PARTS, None) or 0), int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS))
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_PARTS, parts)
    spark.conf.set(_SIZE, f"{TASK_MB}m")
