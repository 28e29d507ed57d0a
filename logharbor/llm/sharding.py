"""Proportional stratified interleaving: shards that each hold the same mixture of sources.

Rows are shuffled by a seeded hash inside their source and ranked; rank ``r`` of ``n`` becomes the
fraction ``(2r + 1) / 2n``. All rows sorted by fraction are a sequence in which every stretch has
the sources in proportion, and it is cut into shards of equal row counts (one apart at most).

Built-in functions only. Ranks come from bucketed running counts (``order.py``), so neither a hot
source nor the whole table is ever sorted in one task. A null source is a source of its own; null
texts have size 1; repeated rows get slots of their own; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import unsigned_crc32
from .order import bucket_count, hash_bucket, running, shuffle_hash

SEED = 17


def stratified_shards(documents: DataFrame, shards: int = 16, seed: int = SEED) -> DataFrame:
    """``doc_id, source, size, text_crc32, shard, slot`` for every row."""
    total = documents.count()
    buckets = bucket_count(total)
    rows = documents.select(
        "doc_id", "source", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_key"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"), unsigned_crc32(F.col("text")).alias("text_crc32"),
        shuffle_hash(seed, F.col("doc_id"), F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("_h"),
    ).withColumn("_bucket", hash_bucket(F.col("_h"), buckets))
    ranked = running(rows, ["_key"], "_bucket", ["_h", "doc_id"], F.lit(1), "_rank", "_n")
    fraction = (2 * F.col("_rank") + 1).cast("double") / (2 * F.col("_n")).cast("double")
    placed = ranked.withColumn("_fraction", fraction).withColumn(
        "_stretch", F.least(F.floor(F.col("_fraction") * buckets), F.lit(buckets - 1)).cast("bigint"))
    ordered = running(placed, [], "_stretch", ["_fraction", "_key"], F.lit(1), "_place", "_all")
    shard = F.expr(f"CAST(_place * {shards} DIV _all AS INT)")
    start = F.expr(f"(shard * _all + {shards - 1}) DIV {shards}")
    return ordered.withColumn("shard", shard).withColumn("slot", (F.col("_place") - start).cast("bigint")).select(
        "doc_id", "source", "size", "text_crc32", "shard", "slot")
