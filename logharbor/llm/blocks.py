"""Comparing every two rows of a list in blocks of bounded size.

Rows of a list go to chunks by a hash; each two chunks, and each chunk with itself, are a block.
A block is one stretch of a sorted partition, so a worker holds one block at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches


def in_blocks(rows: DataFrame, keys: list[str], node: str, block_rows: int) -> DataFrame:
    """``rows`` dealt out by block, sorted by it: ``keys``, ``low``, ``high``, ``right`` and the rest.

    Lists of one row are left out: they have no pair. A row of a list of ``c`` chunks is in ``c``
    blocks.
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    chunks = F.ceil(F.col("_n") / block_rows).cast("int")
    placed = rows.join(sizes, keys).withColumn("_c", chunks).withColumn("_mine", F.pmod(F.xxhash64(node), F.col("_c")).cast("int"))
    spread = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_c") - 1)))
    blocks = spread.withColumn("low", F.least("_mine", "_other")).withColumn("high", F.greatest("_mine", "_other")) \
        .withColumn("right", F.col("_mine") > F.col("_other")).drop("_n", "_c", "_mine", "_other")
    return blocks


def per_block(blocks: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` on the table of each block; a block with itself has ``low = high``."""
    marks = [*keys, "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in marks], axis=1)
            cuts = [0, *(np.flatnonzero((cols[1:] != cols[:-1]).any(axis=1)) + 1).tolist(), len(cols)]
            for lo, hi in zip(cuts, cuts[1:]):
                now = tuple(cols[lo].tolist())
                if now != key and held:
                    out = fn(pa.Table.from_batches(held))
                    if out is not None and out.num_rows:
                        yield out
                    held = []
                key = now
                held.append(batch.slice(lo, hi - lo))
        if held:
            out = fn(pa.Table.from_batches(held))
            if out is not None and out.num_rows:
                yield out

    dealt = blocks.repartition(*marks).sortWithinPartitions(*marks, "right")
    return small_batches(dealt, 4096).mapInArrow(run, schema)


def sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of the rows on either side of a block, and whether both are the same chunk."""
    same = table.column("low")[0] == table.column("high")[0]
    right = table.column("right").to_numpy(zero_copy_only=False).astype(bool)
    every = np.arange(len(right))
    return (every, every, True) if same else (np.flatnonzero(~right), np.flatnonzero(right), False)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest place of its component) that connect what the pairs ``i, j`` connect."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]
