"""Blocks of consecutive rows, cut by row count.

Windows over one key (a location, or all messages) cannot be split by the key, and
clock buckets do not bound what one instant, or a missing time, may hold.  Rows are
therefore dealt out by ranges of their whole order (key, time, tiebreak): a block is
a stretch of that order of about as many rows as any other, whatever the times are.
A window by (block, key) is then bounded, and what enters a block is composed from
one small row per (block, key).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermograph.session import scratch_path

# Ranges are cut from a sample: they are aimed at half of the target.
SLACK = 2
# Fewer rows than this are not worth a block of their own.
LEAST_ROWS = 256
BLOCK = "_blk"


def target_rows(df: DataFrame, default: int) -> int:
    """Most rows of a key that one task should window
    (``spark.thermograph.bucketRows``)."""
    conf = df.sparkSession.conf.get("spark.thermograph.bucketRows", None)
    return int(conf) if conf else default


def row_blocks(df: DataFrame, order: list[str], target: int, name: str) -> DataFrame:
    """``df`` with ``_blk``: blocks of at most about ``target`` rows (``LEAST_ROWS``
    at least), ascending in ``order``; written to the shared folder, so that all
    readers see the same blocks.  Rows that are equal in ``order`` share a block."""
    spark = df.sparkSession
    n = df.count()
    blocks = max(1, -(-n * SLACK // max(target, LEAST_ROWS)))
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    out = df.repartitionByRange(blocks, *order).withColumn(BLOCK, F.spark_partition_id())
    out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)
