"""Ranks and running sums over hash-shuffled rows, without gathering a key in one task.

A row's place in a shuffled order is a 60-bit hash. Rows of a key are cut into buckets by the
leading part of the hash, as many as keep a bucket small whatever share of the rows the key has;
bucket totals are summed up over the (few) buckets, and rows are ordered inside their bucket only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 4096


def shuffle_hash(seed: object, *columns: Column) -> Column:
    """60 bits of the MD5 of the seed and the columns; SQL engines agree on it."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("-")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def bucket_count(rows: int) -> int:
    return max(1, -(-rows // BUCKET_ROWS))


def hash_bucket(h: Column, buckets: int) -> Column:
    return F.shiftright(F.shiftright(h, 28) * F.lit(buckets).cast("bigint"), 32)


def running(df: DataFrame, keys: list[str], bucket: str, order: list[str], weight: Column, before: str, total: str) -> DataFrame:
    """``df`` with ``before``, the weight of all earlier rows of its key, and ``total`` of the key.

    ``bucket`` has to follow ``order``. With no keys the whole table is one key; its bucket totals
    (one row per bucket) then meet in one task.
    """
    spread = df.withColumn("_weight", weight.cast("bigint"))
    over = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    sums = spread.groupBy(*keys, bucket).agg(F.sum("_weight").alias("_sum")).withColumn(
        "_earlier", F.coalesce(F.sum("_sum").over(over.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn(total, F.sum("_sum").over(over)).drop("_sum")
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = spread.withColumn("_own", F.coalesce(F.sum("_weight").over(within), F.lit(0)))
    return placed.join(sums, [*keys, bucket]).withColumn(before, F.col("_earlier") + F.col("_own")).drop("_weight", "_earlier", "_own")
