"""Shifts (arrival-time intervals per partition) and the ledger of offsets and times they leave."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import int_div, time_bucket
from .common import TP
from .files import SHIFT_SECONDS

GRACE_MS = 30_000


def shift_spine(log: DataFrame, seconds: int = SHIFT_SECONDS, until_ms: int | None = None) -> DataFrame:
    """Every shift of every partition, also those without a row.

    ``topic, partition, shift, shift_start, shift_end``; shifts run from the partition's first
    arrival to its last one, or to the shift holding ``until_ms``, and are numbered from 1.
    """
    width = seconds * 1000
    ends = log.groupBy(*TP).agg(F.min("arrival_ms").alias("_first"), F.max("arrival_ms").alias("_last"))
    last = F.col("_last") if until_ms is None else F.greatest("_last", F.lit(until_ms))
    starts = F.sequence(time_bucket(F.col("_first"), seconds), time_bucket(last, seconds), F.lit(width).cast("long"))
    return ends.select(*TP, F.posexplode(starts).alias("_n", "shift_start")).select(
        *TP, (F.col("_n") + 1).alias("shift"), "shift_start", (F.col("shift_start") + width).alias("shift_end")
    )


def shift_totals(lines: DataFrame, seconds: int = SHIFT_SECONDS, parsed_only: bool = False) -> DataFrame:
    """Per shift with rows: ``next_offset, max_ts_ms, consumed``.

    Dropped lines move the offset and count as consumed, but leave no time.  ``parsed_only``
    keeps fallback times out of the maximum.
    """
    timed = F.col("decode_status") != "short_envelope"
    if parsed_only:
        timed = timed & (F.col("ts_source") == "parsed")
    return lines.groupBy(*TP, time_bucket(F.col("arrival_ms"), seconds).alias("shift_start")).agg(
        F.max_by("next_offset", "arrival_seq").alias("next_offset"),
        F.max(F.when(timed, F.col("ts_ms"))).alias("max_ts_ms"),
        F.count("*").alias("consumed"),
    )


def shift_ledger(
    lines: DataFrame,
    spine: DataFrame,
    as_of_ms: int,
    seconds: int = SHIFT_SECONDS,
    parsed_only: bool = False,
    final_only: bool = False,
    grace_ms: int = GRACE_MS,
    start: int = 0,
) -> DataFrame:
    """One row per shift: ``next_offset, max_ts_ms, offset_ts_ms, consumed``.

    ``lines`` are accepted, decoded rows.  A shift without a time stores its own end, one with
    a time in the future stores ``as_of_ms``; a shift without rows carries the offset on.
    ``final_only`` leaves out shifts whose grace period is not over at ``as_of_ms``.
    """
    totals = shift_totals(lines, seconds, parsed_only)
    return ledger_from_totals(totals, spine, as_of_ms, final_only, grace_ms, start)


def merge_totals(totals: DataFrame, order: str = "batch_id") -> DataFrame:
    """One row per shift out of the totals several batches left for it."""
    return totals.groupBy(*TP, "shift_start").agg(
        F.max_by("next_offset", order).alias("next_offset"),
        F.max("max_ts_ms").alias("max_ts_ms"),
        F.sum("consumed").alias("consumed"),
    )


def ledger_from_totals(
    totals: DataFrame, spine: DataFrame, as_of_ms: int,
    final_only: bool = False, grace_ms: int = GRACE_MS, start: int = 0,
) -> DataFrame:
    """:func:`shift_ledger` from totals per shift, as a landing stream leaves them."""
    latest = F.col("max_ts_ms")
    carried = Window.partitionBy(*TP).orderBy("shift_start").rowsBetween(Window.unboundedPreceding, 0)
    ledger = (
        spine.join(totals, [*TP, "shift_start"], "left")
        .withColumns({
            "next_offset": F.coalesce(F.last("next_offset", ignorenulls=True).over(carried), F.lit(start).cast("long")),
            "consumed": F.coalesce("consumed", F.lit(0).cast("long")),
            "offset_ts_ms": F.when(latest.isNull(), F.col("shift_end")).otherwise(F.least(latest, F.lit(as_of_ms))),
            "max_ts_ms": F.coalesce(latest, F.lit(-1).cast("long")),
        })
    )
    if final_only:
        ledger = ledger.filter(F.lit(as_of_ms) >= F.col("shift_end") + grace_ms)
    return ledger.select(
        *TP, "shift", "shift_start", "shift_end", "next_offset", "max_ts_ms", "offset_ts_ms", "consumed"
    )


def current_ledger(ledger: DataFrame, order: str = "shift_start") -> DataFrame:
    """The newest ledger row of each partition."""
    rest = [c for c in ledger.columns if c not in TP]
    newest = ledger.groupBy(*TP).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return newest.select(*TP, "_row.*")


def first_shifts(log: DataFrame, seconds: int = SHIFT_SECONDS) -> DataFrame:
    """``first_shift``, the start of each partition's first shift."""
    return log.groupBy(*TP).agg(time_bucket(F.min("arrival_ms"), seconds).alias("first_shift"))


def shift_number(log: DataFrame, firsts: DataFrame, seconds: int = SHIFT_SECONDS) -> DataFrame:
    """Rows with their shift number; ``firsts`` comes from :func:`first_shifts`, best as a stored table."""
    bucket = time_bucket(F.col("arrival_ms"), seconds)
    return (
        log.join(firsts.select(*TP, F.col("first_shift").alias("_first")), TP)
        .withColumn("shift", (int_div(bucket - F.col("_first"), seconds * 1000) + 1))
        .drop("_first")
    )
