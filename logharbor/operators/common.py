"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Window

TP = ["topic", "partition"]
ROLL_ROWS = 1 << 20     # arrival positions per slice of a partition, and per output file at most
ROLL_BYTES = 1 << 30    # bytes per slice where slices are cut by size, too
STEP_ROWS = 256         # arrival positions whose bytes are summed up before such a cut
STRETCH_STEPS = 1 << 14 # steps whose sums are run up in one window


def before(keys: Sequence[str], *order: str):
    """Window over all earlier rows of a key."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
