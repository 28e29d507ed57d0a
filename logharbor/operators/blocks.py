"""Packing lines into per-second blocks, and the canonical order of lines read back."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.encoding import varint_len
from ..functions.times import int_div
from .files import FILE_KEY

CAP_BYTES = 1_048_535       # room for lines in one block
LINE_RESERVE = 20           # a line may need two ten-byte numbers in front of it
SPAN_BYTES = 16 << 20       # bodies of the blocks handed on at once
BLOCK_DDL = "second bigint, create_time bigint, block_number bigint, log_lines array<struct<ms:bigint,message:binary>>"


# --- the greedy cut -----------------------------------------------------------------------------


def greedy_cuts(costs: np.ndarray, sizes: np.ndarray, cap: int, max_lines: int | None = None, used: int = 0, held: int = 0) -> list[int]:
    """Where new blocks begin in a stretch of lines of one second.

    ``held`` lines of ``used`` bytes are in the open block already; without any the stretch begins one
    at 0, which is not listed. A line fits while the costs before it and its own size stay below a
    mark; as a line costs no less than its size, that sum never falls from line to line, so a binary
    search finds the next cut: one step per block, however many lines it has.
    """
    ends = np.concatenate([[0], np.cumsum(costs)])
    marks = ends[:-1] + sizes
    cuts, at = [], 0
    while True:
        found = int(np.searchsorted(marks, ends[at] - used + cap - LINE_RESERVE, "right"))
        if max_lines is not None:
            found = min(found, at + max_lines - held)
        at = max(found, at if held else at + 1)     # a block takes its first line whatever its size
        if at >= len(costs):
            return cuts
        cuts.append(at)
        used = held = 0


def _pack(names: Sequence[str], cap: int, max_lines: int | None, span_bytes: int) -> Callable:
    """Rows in order of file and arrival to blocks. Only the open block is kept from one batch to the next."""
    def rows(batch: pa.RecordBatch, starts: np.ndarray, end: int, numbers: np.ndarray) -> pa.RecordBatch:
        first = int(starts[0])
        part = batch.slice(first, end - first)
        entries = pa.StructArray.from_arrays([part.column("_ms"), part.column("body")], ["ms", "message"])
        places = pa.array(starts)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(places) for c in (*names, "_second", "arrival_ms")), pa.array(numbers, pa.int64()),
             pa.ListArray.from_arrays(pa.array([*(starts - first).tolist(), end - first], pa.int32()), entries)],
            names=[*names, "second", "create_time", "block_number", "log_lines"])

    def closed(pieces: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        whole = pieces[0] if len(pieces) == 1 else pa.Table.from_batches(pieces).combine_chunks().to_batches()[0]
        return rows(whole, np.zeros(1, np.int64), whole.num_rows, np.array([number]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[pa.RecordBatch] = []
        used, held, number, last = 0, 0, -1, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            opening = batch.column("_n").to_numpy() == 1
            second, cost = batch.column("_second").to_numpy(), batch.column("_cost").to_numpy()
            sizes = batch.column("_size").to_numpy()
            begin = opening.copy()
            begin[1:] |= second[1:] != second[:-1]
            begin[0] |= second[0] != last
            bounds = np.union1d(np.flatnonzero(begin), [0])
            total = np.add.reduceat(cost, bounds)
            length = np.diff(np.append(bounds, n))
            if not begin[0]:
                total[0] += used
                length[0] += held
            full = total > cap - LINE_RESERVE
            if max_lines is not None:
                full |= length > max_lines
            for k in np.flatnonzero(full).tolist():
                lo, hi = int(bounds[k]), int(bounds[k + 1]) if k + 1 < len(bounds) else n
                goes_on = (used, held) if k == 0 and not begin[0] else (0, 0)
                for at in greedy_cuts(cost[lo:hi], sizes[lo:hi], cap, max_lines, *goes_on):
                    begin[lo + at] = True
            starts = np.flatnonzero(begin)
            if not len(starts):
                open_.append(batch)
                used, held = used + int(cost.sum()), held + n
                continue
            # Numbers run on through a file and restart with the next.
            place = np.arange(len(starts))
            since = np.maximum.accumulate(np.where(opening[starts], place, -1))
            numbers = np.where(since >= 0, place - since, number + 1 + place)
            if starts[0] > 0:
                open_.append(batch.slice(0, int(starts[0])))
            if open_:
                yield closed(open_, number)
            weight = np.cumsum(np.add.reduceat(sizes, starts)) // span_bytes
            edges = [0, *(np.flatnonzero(np.diff(weight[:-1])) + 1).tolist(), len(starts) - 1] if len(starts) > 1 else []
            for a, b in zip(edges, edges[1:]):
                yield rows(batch, starts[a:b], int(starts[b]), numbers[a:b])
            at = int(starts[-1])
            open_, used, held = [batch.slice(at)], int(cost[at:].sum()), n - at
            number, last = int(numbers[-1]), second[-1]
        if open_:
            yield closed(open_, number)

    return run


def log_blocks(
    lines: DataFrame,
    file_key: Sequence[str] = FILE_KEY,
    keep: Sequence[str] = (),
    cap_bytes: int = CAP_BYTES,
    max_lines: int | None = None,
    span_bytes: int = SPAN_BYTES,
) -> DataFrame:
    """One row per block: ``file_key, keep, second, create_time, block_number, log_lines``.

    Consecutive lines of a file (arrival order) with the same second form a block; a block
    that would outgrow ``cap_bytes`` is filled greedily and continued in the next one.
    ``keep`` names columns that are constant per file.

    Spark sizes the lines and brings them in order of file and arrival, over the partitioning
    that files have already. One pass over the ordered rows then cuts them: sums of costs and a
    binary search per block, and blocks are stretches of the Arrow arrays that came in. What a
    worker holds is the open block and one batch, so the weight of a second does not matter;
    ``span_bytes`` bounds the bodies it hands on at once.
    """
    key = [*file_key, *keep]
    ms, size = F.col("ts_ms") % 1000, F.length("body").cast("long")
    ordered = lines.select(
        *key, "arrival_ms", int_div(F.col("ts_ms"), 1000).alias("_second"), ms.cast("long").alias("_ms"), size.alias("_size"),
        (varint_len(ms, 2) + varint_len(size, 5) + size).cast("long").alias("_cost"), "body",
        F.row_number().over(Window.partitionBy(*file_key).orderBy("arrival_seq")).alias("_n"))
    types = lines.select(*key).schema
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in types)
    return ordered.mapInArrow(_pack(key, cap_bytes, max_lines, span_bytes), ddl + BLOCK_DDL)


def explode_blocks(blocks: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per line of a block table, as the container reader returns them."""
    return blocks.select(
        *keep, "second", "create_time", "block_number", F.posexplode("log_lines").alias("idx", "_line")
    ).select(
        *keep, "second", "create_time", "block_number", "idx",
        (F.col("second") * 1000 + F.col("_line.ms")).alias("ts_ms"), F.col("_line.message").alias("message"),
    )


def canonical_order(lines: DataFrame, file: str = "file") -> DataFrame:
    """Global order: timestamp, block creation, block number, position; the file breaks ties."""
    return lines.orderBy("ts_ms", "create_time", "block_number", "idx", file)
