"""Sizes of zig-zag variable-length integers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zigzag(n: Column) -> Column:
    return F.shiftleft(n.cast("long"), 1).bitwiseXOR(F.shiftright(n.cast("long"), 63))


def varint_len(n: Column, most: int = 10) -> Column:
    """Encoded size in bytes of a long that takes at most ``most`` bytes."""
    z = zigzag(n)
    size = F.lit(most)
    for groups in range(most - 1, 0, -1):
        size = F.when(F.shiftrightunsigned(z, 7 * groups) == 0, F.lit(groups)).otherwise(size)
    return size
