"""Columnar copy of landed lines, partitioned by topic, day and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import day_of, hour_of

PARTITION_COLUMNS = ["topic", "day", "hour"]


def partitioned(lines: DataFrame, time: str = "bucket_ms") -> DataFrame:
    return lines.withColumns({"day": day_of(F.col(time)).cast("string"), "hour": hour_of(F.col(time))})


def write_dataset(lines: DataFrame, root: str, fmt: str = "parquet", mode: str = "append", time: str = "bucket_ms"):
    """Write lines under ``topic=/day=/hour=`` folders.

    The rebalance hint brings a folder's rows together so that it gets few files, and lets
    adaptive execution spread a hot folder over several tasks.
    """
    spread = partitioned(lines, time).hint("rebalance", *[F.col(c) for c in PARTITION_COLUMNS])
    spread.sortWithinPartitions(*PARTITION_COLUMNS, "arrival_seq").write.partitionBy(*PARTITION_COLUMNS).mode(
        mode
    ).format(fmt).save(root)


def read_dataset(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Filters on topic, day and hour prune folders."""
    return spark.read.format(fmt).load(root)
