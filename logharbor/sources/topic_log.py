"""Scanning a topic log from its resume offsets: a broker where the connector exists, else a folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import TP

LOG_DDL = (
    "topic string, partition int, offset bigint, high_watermark bigint, arrival_seq bigint, "
    "arrival_ms bigint, value binary"
)


def starting_offsets(start: DataFrame) -> str:
    """``startingOffsets`` JSON of the broker connector: one row per partition, gathered on the driver."""
    plan: dict[str, dict[str, int]] = {}
    for row in start.select("topic", "partition", "start_offset").toLocalIterator():
        plan.setdefault(row.topic, {})[str(row.partition)] = row.start_offset
    return json.dumps(plan)


def from_broker(reader, servers: str, start: DataFrame | None = None, topics: list[str] | None = None, **options):
    """Topic log rows from the Kafka connector; ``reader`` is ``spark.read`` or ``spark.readStream``.

    The connector does not report the high watermark per record, so it is NULL here; see
    :func:`with_watermarks`.  Offsets double as the arrival sequence.
    """
    source = reader.format("kafka").option("kafka.bootstrap.servers", servers)
    if topics is not None:
        source = source.option("subscribe", ",".join(topics))
    if start is not None:
        source = source.option("startingOffsets", starting_offsets(start))
    rows = source.options(**options).load()
    return rows.select(
        "topic", "partition", "offset", F.lit(None).cast("bigint").alias("high_watermark"),
        F.col("offset").alias("arrival_seq"), F.unix_millis("timestamp").alias("arrival_ms"), "value",
    )


def with_watermarks(log: DataFrame, bounds: DataFrame) -> DataFrame:
    """Fill in unknown high watermarks from ``bounds (topic, partition, latest)``, one row per partition."""
    ends = bounds.select(*TP, F.col("latest").alias("_latest"))
    filled = F.coalesce("high_watermark", "_latest")
    return log.join(ends, TP, "left").withColumn("high_watermark", filled).select(*log.columns)


def from_folder(spark: SparkSession, path: str, streaming: bool = False, files_per_trigger: int | None = None):
    """Topic log rows from Parquet files of the log's own shape."""
    if not streaming:
        return spark.read.schema(LOG_DDL).parquet(path)
    stream = spark.readStream.schema(LOG_DDL)
    if files_per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    return stream.parquet(path)


def scan_from(log: DataFrame, start: DataFrame) -> DataFrame:
    """Rows at or after each partition's ``start_offset``; partitions without one start at 0."""
    seeds = start.select(*TP, F.col("start_offset").alias("_start"))
    joined = log.join(seeds, TP, "left")
    return joined.filter(F.col("offset") >= F.coalesce("_start", F.lit(0))).drop("_start")
