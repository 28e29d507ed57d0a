"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

BATCH_ROWS = 256        # rows per Arrow batch, so that batches of very long texts stay small


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """``df``, after bounding the Arrow batches of its session by rows.

    The setting is read when a plan runs, so it has to stay set. Texts have no length limit; a
    batch of 10,000 of them, the default, can exceed a worker's memory.
    """
    spark = df.sparkSession
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))
    return df


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back.

    This cuts the lineage, survives lost executors, and gives the planner a measured size, by
    which it decides whether a later join may broadcast the table.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` stored in buckets by ``keys``, so that later joins on them shuffle the other side alone.

    The files lie in the cluster's shared folder; the catalog only names them for this session.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_dir(spark, name)
    label = "dealt_" + path.rsplit("-", 1)[1]
    df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(label)
    return spark.table(label)


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker (tasks share it).

    Functions reach workers by value with globals of their own, so module globals would last for
    one task only.
    """
    return sys.modules.setdefault("_worker_state", types.ModuleType("_worker_state")).__dict__


def unsigned_crc32(text: Column) -> Column:
    """CRC-32 of the UTF-8 bytes; null text counts as empty."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; null for a null id."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(modulus))
