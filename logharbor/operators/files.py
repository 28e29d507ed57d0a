"""Which file a line belongs to: time bucket, shift, roll, name, and handling of skewed clocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import int_div, time_bucket
from .common import ROLL_ROWS, TP

SHIFT_SECONDS = 3600
FILE_KEY = [*TP, "bucket_ms", "shift_ms", "roll"]
EXTENSION = ".bm"


def file_keys(
    lines: DataFrame, seconds: int = SHIFT_SECONDS, roll_rows: int = ROLL_ROWS, shift: Column | None = None
) -> DataFrame:
    """Add the file key ``bucket_ms, shift_ms, roll``, and ``file_name, opened_ms`` of its first line.

    A file holds one event-time bucket of one partition written in one shift.  ``shift``
    replaces the arrival-time shift (a stream passes its batch id).  Files also roll at
    every ``roll_rows`` marks of the arrival sequence, so no file, and no group of the
    operators keyed by file, can grow without bound; late lines open a new file in their
    old bucket and are never dropped.  Audited lines already carry their ``roll`` and are
    partitioned by it, which the windows here and in the block operators build on.
    """
    keyed = lines.withColumns({
        "bucket_ms": time_bucket(F.col("ts_ms"), seconds),
        "shift_ms": time_bucket(F.col("arrival_ms"), seconds) if shift is None else shift,
    })
    if "roll" not in lines.columns:
        keyed = keyed.withColumn("roll", int_div(F.col("arrival_seq"), roll_rows))
    opening = Window.partitionBy(*FILE_KEY).orderBy("arrival_seq")
    return keyed.withColumns({
        "file_name": F.concat(
            "topic", F.lit("-"), F.col("partition").cast("string"), F.lit("-"),
            F.first(F.col("offset") + 1).over(opening).cast("string"), F.lit(EXTENSION),
        ),
        "opened_ms": F.first("arrival_ms").over(opening),
    })


def skew(
    lines: DataFrame,
    now_ms: Column | int | None = None,
    future_s: int | None = None,
    past_s: int | None = None,
    prefix: str | None = None,
    data_dir: str | None = None,
    dir_to_now: bool = False,
) -> DataFrame:
    """Mark files whose bucket start lies too far from ``now_ms`` and move them aside.

    Adds ``skewed, file_prefix, data_dir, dir_ms``.  A threshold of None is off; without
    ``now_ms`` the arrival of the file's first line is taken.
    """
    now = F.col("opened_ms") if now_ms is None else (now_ms if isinstance(now_ms, Column) else F.lit(now_ms))
    bucket = F.col("bucket_ms")
    flag = F.lit(False)
    if future_s is not None:
        flag = flag | (bucket > now + future_s * 1000)
    if past_s is not None:
        flag = flag | (bucket < now - past_s * 1000)
    skewed = F.col("skewed")
    return lines.withColumn("skewed", flag).withColumns({
        "file_prefix": F.when(skewed, F.lit(prefix or "")).otherwise(F.lit("")),
        "data_dir": F.when(skewed, F.lit(data_dir).cast("string")),
        "dir_ms": F.when(skewed & F.lit(dir_to_now), now).otherwise(bucket).cast("long"),
    })
