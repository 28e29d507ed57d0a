"""Whole jobs composed of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import int_div
from ..functions.wire import decode, landable
from ..operators.blocks import log_blocks
from ..operators.configs import render_paths
from ..operators.common import ROLL_ROWS
from ..operators.files import FILE_KEY, SHIFT_SECONDS, file_keys, skew
from ..operators.offsets import accepted_rows, offset_audit, range_scan, strict_offsets
from ..operators.readiness import due_hours, low_water, placed_dirs, ready_flags
from ..operators.reports import HISTOGRAM_TEMPLATE, timestamp_histogram
from ..sources import containers as boxes
from ..sources.markers import write_flags


def timestamp_report(
    log: DataFrame, topic: str, partition: int, lo: int, hi: int, as_of_year: int,
    template: str = HISTOGRAM_TEMPLATE,
) -> DataFrame:
    """Timestamp histogram of one partition's offset range; fails on an offset anomaly."""
    audited = offset_audit(range_scan(log, topic, partition, lo, hi), lo)
    return timestamp_histogram(decode(strict_offsets(audited), as_of_year), template)


def export_range(
    log: DataFrame, topic: str, partition: int, lo: int, hi: int, path: str, as_of_year: int,
    level: int = boxes.DEFLATE_LEVEL, roll_rows: int = ROLL_ROWS,
) -> None:
    """Write one partition's offset range to the single container file ``path``.

    An existing file is replaced, a failed job leaves none.  Blocks are built and deflated in
    parallel slices of the range; only appending the finished bytes is one task, since the
    result is one file.
    """
    audited = offset_audit(range_scan(log, topic, partition, lo, hi), lo)
    lines = landable(decode(strict_offsets(audited), as_of_year)).withColumn(
        "roll", int_div(F.col("offset") - lo, roll_rows)
    )
    folder, name = path.rsplit("/", 1)
    blocks = log_blocks(lines.withColumn("file", F.lit(name)), ["roll"], keep=["file"])
    before = Window.orderBy("roll").rowsBetween(Window.unboundedPreceding, -1)     # one row per slice
    firsts = blocks.groupBy("roll").agg(F.count("*").alias("_n")).select(
        "roll", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    numbered = blocks.join(firsts, "roll").withColumn("block_number", F.col("block_number") + F.col("_first"))
    pieces = boxes.packed(boxes.containers(numbered, "file", ["roll"]), level)
    boxes.write_containers(pieces.repartition(1), folder, mode="append", is_packed=True)


def prepared_lines(
    log: DataFrame, start: DataFrame | int, as_of_year, seconds: int = SHIFT_SECONDS, drop_truncated: bool = False,
    shift: Column | None = None, skew_options: dict | None = None, roll_rows: int = ROLL_ROWS,
) -> DataFrame:
    """Audit, decode and assign files: the lines a landing writes."""
    decoded = decode(accepted_rows(offset_audit(log, start, roll_rows)), as_of_year)
    return skew(file_keys(landable(decoded, drop_truncated), seconds, shift=shift), **(skew_options or {}))


def land(
    lines: DataFrame, configs: DataFrame, root: str, level: int = boxes.DEFLATE_LEVEL, **block_options
) -> None:
    """Write prepared lines of configured topics as containers in their templated folders under ``root``."""
    placed = render_paths(lines, configs).withColumn(
        "file", F.concat("path", F.lit("/"), "file_prefix", "file_name")
    )
    boxes.write_lines(placed, root, "file", level, file_key=FILE_KEY, **block_options)


def readiness(
    partitions: DataFrame, ledger: DataFrame, configs: DataFrame, flags: DataFrame, dirs: DataFrame, as_of_ms: int,
    strict: bool = False,
) -> DataFrame:
    """The scheduled readiness job: markers of all four levels from stored tables, the log is not read.

    ``ledger`` holds the newest row of each partition, ``dirs`` the hours a topic has data in.
    """
    due = due_hours(low_water(partitions, ledger), configs, flags, as_of_ms, strict=strict)
    return ready_flags(due, flags, placed_dirs(dirs, configs))


def mark_ready(markers: DataFrame, base: str = "") -> int:
    """Write the markers a readiness job found; doing it again changes nothing."""
    return write_flags(markers, base)
