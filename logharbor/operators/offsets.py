"""Offset operators: range scan, resume planning, order audit and its strict and resetting forms.

One topic-partition may hold a large share of all rows, so nothing here gathers a
partition: rows are grouped by slices of the arrival sequence, each slice is summed up in
one row, the summaries are scanned, and the result seeds the slice's own window.  A slice
is also a roll of the output files (column ``roll``), so the one shuffle made here is
the one that blocks and file writing use, too.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import int_div
from ..session import stored
from .common import ROLL_BYTES, ROLL_ROWS, STEP_ROWS, STRETCH_STEPS, TP, before

ANOMALIES = ("gap", "beyond_hw")
_SLICE = [*TP, "roll"]


def range_scan(log: DataFrame, topic: str, partition: int, lo: int, hi: int) -> DataFrame:
    """One partition's rows from offset ``lo`` to ``hi``, both included."""
    return log.filter(
        (F.col("topic") == topic) & (F.col("partition") == partition) & F.col("offset").between(lo, hi)
    )


def resume_offsets(
    partitions: DataFrame, ledger: DataFrame, overrides: DataFrame, allow_overrides: bool = True
) -> DataFrame:
    """Where each partition resumes: ``stored_offset, resume_offset, override_consumed``.

    ``ledger`` holds ``next_offset`` and ``overrides`` holds ``offset_override``, one row per
    partition.  A partition that never stored an offset starts at 0, even with an override.
    """
    stored, override = F.col("stored_offset"), F.col("offset_override")
    used = stored.isNotNull() & override.isNotNull() & F.lit(allow_overrides)
    return (
        partitions.select(*TP)
        .join(ledger.select(*TP, F.col("next_offset").alias("stored_offset")), TP, "left")
        .join(overrides.select(*TP, "offset_override"), TP, "left")
        .withColumn(
            "resume_offset",
            F.when(stored.isNull(), F.lit(0).cast("long")).when(used, override).otherwise(stored),
        )
        .withColumn("override_consumed", used)
        .drop("offset_override")
    )


def reset_out_of_range(resume: DataFrame, bounds: DataFrame, policy: str = "smallest") -> DataFrame:
    """Move a resume offset outside ``[earliest, latest]`` to one end, by ``policy``."""
    if policy not in ("smallest", "largest"):
        raise ValueError(f"unknown reset policy {policy!r}")
    end = F.col("earliest" if policy == "smallest" else "latest")
    asked = F.col("resume_offset")
    outside = (asked < F.col("earliest")) | (asked > F.col("latest"))
    return (
        resume.join(bounds.select(*TP, "earliest", "latest"), TP, "left")
        .withColumn("was_reset", F.coalesce(outside, F.lit(False)))
        .withColumn("start_offset", F.when(F.col("was_reset"), end).otherwise(asked))
    )


def log_bounds(log: DataFrame) -> DataFrame:
    return log.groupBy(*TP).agg(
        F.min("offset").alias("earliest"), F.max("high_watermark").alias("latest")
    )


def _with_start(summaries: DataFrame, start: DataFrame | int) -> DataFrame:
    if isinstance(start, int):
        return summaries.withColumn("_start", F.lit(start).cast("long"))
    seeds = start.select(*TP, F.col("start_offset").alias("_start"))
    return summaries.join(seeds, TP, "left").withColumn("_start", F.coalesce("_start", F.lit(0).cast("long")))


def _slices(log: DataFrame, slice_rows: int) -> DataFrame:
    """Slices of the arrival sequence; a log that carries its ``roll`` (:func:`byte_rolls`) keeps it."""
    return log if "roll" in log.columns else log.withColumn("roll", int_div(F.col("arrival_seq"), slice_rows))


def byte_rolls(
    log: DataFrame, roll_bytes: int = ROLL_BYTES, roll_rows: int = ROLL_ROWS, step_rows: int = STEP_ROWS, value: str = "value"
) -> DataFrame:
    """Add ``roll``, slices of the arrival sequence with a bound in rows and in bytes.

    Bytes are summed over steps of ``step_rows`` arrival positions, steps over stretches, and both
    sums run on, so no window follows a partition: it sees a stretch of ``STRETCH_STEPS`` steps, or one row per
    stretch. A slice ends where ``roll_bytes`` or ``roll_rows`` are reached at the end of a step, so it
    holds ``roll_bytes`` and one step at most. The audit, files and blocks take the slices as they are.
    """
    step = int_div(F.col("arrival_seq"), step_rows)
    steps = log.groupBy(*TP, step.alias("_step")).agg(F.sum(F.length(value)).alias("_bytes")).withColumn(
        "_stretch", int_div(F.col("_step"), STRETCH_STEPS))
    stretches = steps.groupBy(*TP, "_stretch").agg(F.sum("_bytes").alias("_all")).select(
        *TP, "_stretch", F.coalesce(F.sum("_all").over(before(TP, "_stretch")), F.lit(0)).alias("_ahead"))
    inside = F.coalesce(F.sum("_bytes").over(before([*TP, "_stretch"], "_step")), F.lit(0))
    borders = steps.withColumn("_inside", inside).join(stretches, [*TP, "_stretch"]).select(
        *TP, "_step", (int_div(F.col("_ahead") + F.col("_inside"), roll_bytes) + int_div(F.col("_step") * step_rows, roll_rows)).alias("roll"))
    return log.withColumn("_step", step).join(borders, [*TP, "_step"]).drop("_step")


def _floors(rows: DataFrame, start: DataFrame | int) -> DataFrame:
    """``_floor`` per slice: what its first row expects by the plain rule."""
    tops = rows.groupBy(*_SLICE).agg(F.max("offset").alias("_top"))
    seen = tops.select(*_SLICE, F.max("_top").over(before(TP, "roll")).alias("_seen"))
    return _with_start(seen, start).select(*_SLICE, F.greatest("_start", F.col("_seen") + 1).alias("_floor"))


def _status(offset: Column, expected: Column, watermark: Column) -> Column:
    return (
        F.when(offset > expected, "gap")
        .when(offset == expected, "ok")
        .when(watermark.isNull() | (expected < watermark), "early")
        .when(expected == watermark, "at_hw")
        .otherwise("beyond_hw")
    )


def _verdict(rows: DataFrame) -> DataFrame:
    offset, expected, watermark = F.col("offset"), F.col("expected"), F.col("high_watermark")
    accepted = offset >= expected
    return rows.withColumns({
        "status": _status(offset, expected, watermark),
        "accepted": accepted,
        "gap": F.greatest(offset - expected, F.lit(0).cast("long")),
        "next_offset": F.when(accepted, offset + 1).otherwise(expected),
        "lag": watermark - (offset + 1),
    })


def offset_audit(log: DataFrame, start: DataFrame | int = 0, slice_rows: int = ROLL_ROWS) -> DataFrame:
    """Compare every row with the offset its partition expects, in arrival order.

    Adds ``roll, expected, status, accepted, gap, next_offset, lag``.  ``start`` is the first
    expected offset: a number, or a table with ``start_offset`` per partition.  Where the
    watermark is not known (NULL), a row behind the expectation is plainly ``early``.
    """
    rows = _slices(log, slice_rows)
    earlier = F.max("offset").over(before(_SLICE, "arrival_seq"))
    return _verdict(
        rows.join(_floors(rows, start), _SLICE)
        .withColumn("expected", F.greatest("_floor", earlier + 1))
        .drop("_floor")
    )


def missing_ranges(audited: DataFrame) -> DataFrame:
    """One row per run of offsets that never arrived."""
    return audited.filter(F.col("status") == "gap").select(
        *TP, F.col("expected").alias("missing_from"), (F.col("offset") - 1).alias("missing_to"), "gap"
    )


def accepted_rows(audited: DataFrame) -> DataFrame:
    return audited.filter("accepted")


def strict_offsets(audited: DataFrame) -> DataFrame:
    """Accepted rows of a bounded job; a gap or an expectation beyond the watermark fails it."""
    message = F.concat_ws(
        " ", F.lit("offset anomaly:"), "status", "topic", F.col("partition").cast("string"),
        F.lit("expected"), F.col("expected").cast("string"), F.lit("got"), F.col("offset").cast("string"),
    )
    checked = F.when(F.col("status").isin(*ANOMALIES), F.raise_error(message).cast("boolean"))
    return audited.filter(checked.otherwise(F.col("accepted")))


# --- expectation that sinks to the high watermark --------------------------------------------
#
# One arriving row (offset o, watermark h) maps the expected offset e to
#     o + 1  if e <= o,      e  if o < e <= h,      h  if e > h
# which for h > o is a clamp of e to [o + 1, h], and otherwise a step at o.  Clamps and steps
# compose to clamps and steps, so a whole slice is one such function with three numbers.

_LOW, _HIGH = -(2**63), 2**63 - 1
POINTS = "_seq bigint, _to bigint, _nth bigint"


def _clamp(x: int, lo: int, hi: int) -> int:
    return min(max(x, lo), hi)


def _advance(e: int, o: int, h: int) -> int:
    if e <= o:
        return o + 1
    return h if e > h else e


def _compose(offsets, watermarks) -> tuple[bool, int, int, int]:
    """``(is_step, a, b, t)`` of a run of rows: a clamp to [a, b], or ``a if e <= t else b``."""
    step, a, b, t = False, _LOW, _HIGH, 0
    for o, h in zip(offsets, watermarks):
        if step:
            a, b = _advance(a, o, h), _advance(b, o, h)
        elif h > o:
            a, b = _clamp(a, o + 1, h), _clamp(b, o + 1, h)
        elif b <= o or a > o:
            step, t, a = True, 0, (o + 1 if b <= o else h)
            b = a
        else:
            step, t, a, b = True, o, o + 1, h
    return step, a, b, t


def _summarise(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("arrival_seq")
    summary = _compose(rows["offset"].tolist(), rows["_known"].tolist())
    return pd.DataFrame([(*key, *summary)], columns=[*_SLICE, "_step", "_a", "_b", "_t"])


def _walk_slices(key: tuple, slices: pd.DataFrame) -> pd.DataFrame:
    slices = slices.sort_values("roll")
    e, entry = int(slices["_start"].iloc[0]), []
    for step, a, b, t in zip(slices["_step"], slices["_a"].tolist(), slices["_b"].tolist(), slices["_t"].tolist()):
        entry.append(e)
        e = (a if e <= t else b) if step else _clamp(e, a, b)
    return slices[_SLICE].assign(_entry=entry)


def _resets(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of a slice at which the expectation drops to the watermark."""
    rows = rows.sort_values("arrival_seq")
    e, found = int(rows["_entry"].iloc[0]), []
    for seq, o, h in zip(rows["arrival_seq"].tolist(), rows["offset"].tolist(), rows["_known"].tolist()):
        if e > o and e > h:
            found.append((*key, seq, h, len(found)))
        e = _advance(e, o, h)
    return pd.DataFrame(found, columns=[*_SLICE, "_seq", "_to", "_nth"])


def sink_to_high_watermark(
    log: DataFrame, start: DataFrame | int = 0, slice_rows: int = ROLL_ROWS
) -> DataFrame:
    """The audit with the reset switched on: an expectation beyond the watermark drops to it.

    Same columns as :func:`offset_audit`; a row that triggers the reset has status
    ``beyond_hw`` and the watermark as ``next_offset``.  An unknown watermark (NULL) never
    resets.

    One pass over the narrow columns leaves a stored row per slice: its highest offset, its lowest
    watermark, and whether its own offsets alone pass a watermark. The plain expectation is never
    below the sinking one, so a slice whose plain entry and offsets stay within its watermarks
    cannot reset, and without any other slice the plain audit is the result. The narrow rows of
    risky slices are walked in Python, and what comes back is their reset points, a row each. Between
    two of those the plain rule holds again: points take their place among the rows of their slice,
    and a running maximum over (number of the last point, what is reached since) gives what a row
    expects. No row carries more than its own point. Only where other slices follow a risky one is
    it summed up first.
    """
    rows = _slices(log, slice_rows)
    narrow = rows.select(*_SLICE, "arrival_seq", "offset", F.coalesce("high_watermark", F.lit(_HIGH)).alias("_known"))
    types = narrow.schema
    key_ddl = ", ".join(f"{c} {types[c].dataType.simpleString()}" for c in _SLICE)
    earlier = F.max("offset").over(before(_SLICE, "arrival_seq"))
    sums = stored(narrow.withColumn("_over", F.coalesce(earlier + 1 > F.col("_known"), F.lit(False))).groupBy(*_SLICE).agg(
        F.max("offset").alias("_top"), F.min("_known").alias("_least"), F.bool_or("_over").alias("_over")), "slices")
    seen = F.max("_top").over(before(TP, "roll"))
    entered = _with_start(sums.withColumn("_seen", seen), start).withColumn("_floor", F.greatest("_start", F.col("_seen") + 1))
    judged = entered.withColumn("_risky", F.col("_over") | (F.col("_floor") > F.col("_least"))).withColumn(
        "_last", F.col("roll") == F.max("roll").over(Window.partitionBy(*TP)))
    entries, risky = entered.select(*_SLICE, F.col("_floor").alias("_entry")), judged.filter("_risky").select(*_SLICE)
    some = narrow.join(risky, _SLICE, "left_semi")
    if not judged.filter("_risky AND NOT _last").isEmpty():
        # Slices after a risky one begin where it ends.
        calm = judged.filter("NOT _risky").select(
            *_SLICE, F.lit(False).alias("_step"), (F.col("_top") + 1).alias("_a"), F.lit(_HIGH).alias("_b"), F.lit(0).cast("long").alias("_t"))
        some = stored(some, "riskyrows")
        walked = some.groupBy(*_SLICE).applyInPandas(_summarise, f"{key_ddl}, _step boolean, _a long, _b long, _t long")
        entries = stored(_with_start(calm.unionByName(walked), start).groupBy(*TP).applyInPandas(_walk_slices, f"{key_ddl}, _entry long"), "entries")
    reached = F.col("offset") + 1
    if risky.isEmpty():
        earlier = F.max(reached).over(before(_SLICE, "arrival_seq"))
        audited = _verdict(rows.join(entries, _SLICE).withColumn("expected", F.greatest("_entry", earlier)).drop("_entry"))
    else:
        points = some.join(entries, _SLICE).groupBy(*_SLICE).applyInPandas(_resets, f"{key_ddl}, {POINTS}")
        # A point comes after the rows that arrived with it, and its number tells its stretch from the one before.
        marks = points.select(*_SLICE, F.col("_seq").alias("arrival_seq"), "_nth", F.col("_to").alias("_reached"))
        both = rows.withColumn("_nth", F.lit(-1).cast("long")).withColumn("_reached", reached).unionByName(marks, allowMissingColumns=True)
        # A union forgets how its sides were dealt, so slices' entries join behind it: one shuffle serves join and windows.
        placed = both.join(entries, _SLICE)
        order = [F.col("arrival_seq"), F.col("_nth")]
        opened = F.max("_nth").over(Window.partitionBy(*_SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
        stretch = F.struct(F.col("_stretch").alias("stretch"), F.col("_reached").alias("reached"))
        latest = F.max(stretch).over(before(_SLICE, *order))
        expected = F.when(F.col("_latest.stretch") >= 0, F.col("_latest.reached")).otherwise(F.greatest("_entry", F.col("_latest.reached")))
        audited = _verdict(
            placed.withColumn("_stretch", opened).withColumn("_latest", latest).filter("_nth < 0").withColumn("expected", expected)
            .drop("_entry", "_nth", "_reached", "_stretch", "_latest")
        )
    sunk = F.col("status") == "beyond_hw"
    return audited.withColumn(
        "next_offset", F.when(sunk, F.col("high_watermark")).otherwise(F.col("next_offset"))
    )
