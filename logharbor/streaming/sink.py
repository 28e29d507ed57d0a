"""Landing by Structured Streaming alone: keyed offset state, and a sink with a commit per micro-batch.

``audited`` keeps one value per topic-partition, the offset it expects next, in the state store and
compares the rows of each micro-batch with it. ``landing_sink`` decodes what is accepted and writes
it by the streaming writer below: tasks write data files and side files, the commit of the
micro-batch publishes them under the number of the batch (:mod:`..sources.manifests`). A batch that
fails leaves nothing visible, and one that runs again after its commit changes nothing. State,
progress and published batches follow one checkpoint.

A micro-batch's rows of one partition pass one task, as arrival order is what the audit goes by;
how many those are is set by the source's admission limit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter
from pyspark.sql.streaming import StatefulProcessor

from ..functions.times import time_bucket
from ..functions.wire import decode, landable
from ..operators.blocks import CAP_BYTES, greedy_cuts
from ..operators.common import TP
from ..operators.configs import render_paths
from ..operators.files import EXTENSION, SHIFT_SECONDS
from ..operators.offsets import _HIGH, _advance
from ..session import qualified
from ..sources.containers import DEFLATE_LEVEL
from ..sources.manifests import ManifestCommit, Part, pack, write_boxes
from ..sources.topic_log import LOG_DDL

FORMAT = "line_manifest_stream"
FLUSH_BYTES = 64 << 20      # bodies a writer gathers before it encodes them
AUDIT_DDL = LOG_DDL + ", expected bigint, status string, accepted boolean, gap bigint, next_offset bigint, lag bigint"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# --- keyed offset state -------------------------------------------------------------------------


def expectations(offsets: np.ndarray, watermarks: np.ndarray, start: int, sink: bool) -> tuple[np.ndarray, int]:
    """What each row finds expected, in arrival order, and what is expected after the last.

    ``watermarks`` of unknown height are the largest number. The plain rule is a running maximum;
    rows are walked one by one only where a batch could reset.
    """
    plain = np.maximum.accumulate(np.concatenate([[start], offsets + 1]))
    if not sink or (plain[:-1] <= watermarks).all():
        return plain[:-1], int(plain[-1])
    out, e = [], start
    for o, h in zip(offsets.tolist(), watermarks.tolist()):
        out.append(e)
        e = _advance(e, o, h)
    return np.array(out, np.int64), e


def verdicts(rows: pd.DataFrame, start: int, sink: bool) -> tuple[pd.DataFrame, int]:
    """Audit columns of the rows of one partition, and its next expectation."""
    rows = rows.sort_values("arrival_seq", kind="stable", ignore_index=True)
    offset = rows["offset"].to_numpy(np.int64)
    known = rows["high_watermark"].notna().to_numpy()
    height = np.where(known, rows["high_watermark"].fillna(0).to_numpy(np.int64), _HIGH)
    expected, after = expectations(offset, height, start, sink)
    accepted = offset >= expected
    status = np.select(
        [offset > expected, offset == expected, ~known | (expected < height), expected == height],
        ["gap", "ok", "early", "at_hw"], "beyond_hw")
    follows = np.where(accepted, offset + 1, expected)
    if sink:
        follows = np.where(status == "beyond_hw", height, follows)
    out = rows.assign(
        expected=expected, status=status, accepted=accepted, gap=np.maximum(offset - expected, 0), next_offset=follows,
        lag=pd.array(np.where(known, height - (offset + 1), 0), "Int64"))
    out.loc[~known, "lag"] = pd.NA
    return out, after


class OffsetAudit(StatefulProcessor):
    """One value per topic-partition: the offset it expects next."""

    def __init__(self, sink: bool):
        self.sink = sink

    def init(self, handle) -> None:
        self.next = handle.getValueState("next_offset", "next_offset bigint")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.next.update((int(initialState["start_offset"].iloc[0]),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        start = self.next.get()[0] if self.next.exists() else 0
        out, after = verdicts(pd.concat(rows), start, self.sink)
        self.next.update((after,))
        yield out

    def close(self) -> None:
        pass


def audited(log: DataFrame, start: DataFrame | None = None, sink: bool = False) -> DataFrame:
    """A streaming topic log with the audit's columns; the expectation lives in the state store.

    ``start (topic, partition, start_offset)`` seeds the state of a new checkpoint; partitions
    without a row begin at 0. ``sink`` lets an expectation beyond the watermark drop to it.
    """
    seeds = None if start is None else start.select(*TP, F.col("start_offset").cast("bigint").alias("start_offset")).groupBy(*TP)
    columns = [c.split()[0] for c in LOG_DDL.split(", ")]
    return log.select(*columns).groupBy(*TP).transformWithStateInPandas(
        OffsetAudit(sink), AUDIT_DDL, "Append", "None", initialState=seeds)


@contextmanager
def state_store(spark: SparkSession):
    """Keyed state needs the RocksDB store; the session's own setting comes back afterwards."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


# --- the sink -----------------------------------------------------------------------------------


def line_blocks(lines: pa.Table, numbers: dict[str, int], cap: int = CAP_BYTES) -> pa.RecordBatch:
    """Blocks of lines as the record encoder takes them; ``numbers`` keeps the next block number of each file.

    Lines of a file go in arrival order, and each block holds consecutive lines of one second.
    """
    lines = lines.sort_by([("file", "ascending"), ("arrival_seq", "ascending")]).combine_chunks()
    file = lines.column("file").combine_chunks().dictionary_encode()
    codes = file.indices.to_numpy()
    stamp = lines.column("ts_ms").to_numpy()
    second = np.where(stamp < 0, -(-stamp // 1000), stamp // 1000)
    ms = stamp - second * 1000
    body = lines.column("body").combine_chunks()
    sizes = pc.binary_length(body).to_numpy().astype(np.int64)
    cost = sizes + _varint_sizes(ms) + _varint_sizes(sizes)
    fresh = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (second[1:] != second[:-1])]))
    starts = []
    for lo, hi in zip(fresh.tolist(), [*fresh[1:].tolist(), len(stamp)]):
        starts += [lo, *(lo + at for at in greedy_cuts(cost[lo:hi], sizes[lo:hi], cap))]
    names, block_numbers = file.take(pa.array(starts)).to_pylist(), []
    for name in names:
        block_numbers.append(numbers.get(name, 0))
        numbers[name] = block_numbers[-1] + 1
    places = np.array(starts, np.int64)
    entries = pa.StructArray.from_arrays([pa.array(ms), body], ["ms", "message"])
    log_lines = pa.ListArray.from_arrays(pa.array([*starts, len(stamp)], pa.int32()), entries)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(np.zeros(len(places), np.int64)), pa.array(block_numbers, pa.int64()), pa.array(second[places]),
         lines.column("arrival_ms").combine_chunks().take(pa.array(places)), log_lines],
        names=["file", "_key", "block_number", "second", "create_time", "log_lines"])


def _varint_sizes(n: np.ndarray) -> np.ndarray:
    z = (n.astype(np.int64) << 1) ^ (n.astype(np.int64) >> 63)
    size = np.ones(len(z), np.int64)
    for bits in range(7, 63, 7):
        size += z >= 1 << bits
    return size


def gathered(batches: Iterable[pa.RecordBatch], flush_bytes: int = FLUSH_BYTES) -> Iterator[pa.RecordBatch]:
    """Lines of a task as blocks; what is gathered before it is encoded is bounded."""
    held: list[pa.RecordBatch] = []
    weight, numbers = 0, {}
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            weight += batch.column("body").nbytes
        if held and weight >= flush_bytes:
            yield line_blocks(pa.Table.from_batches(held), numbers)
            held, weight = [], 0
    if held:
        yield line_blocks(pa.Table.from_batches(held), numbers)


class StreamSink(ManifestCommit, DataSourceStreamArrowWriter):
    """Writes ``file, arrival_seq, arrival_ms, ts_ms, body`` rows of micro-batches."""

    def __init__(self, root: str, level: int, name: str):
        self.root, self.level, self.name = root, level, name

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        return write_boxes(self.root, self.level, pack(gathered(iterator)))

    def commit(self, messages: list[Part | None], batchId: int) -> None:
        self.commit_key(f"{self.name}-{batchId:019}", messages)

    def abort(self, messages: list[Part | None], batchId: int) -> None:
        self.abort_parts(messages)


class StreamSinkSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> StreamSink:
        return StreamSink(self.options["path"], int(self.options.get("level", DEFLATE_LEVEL)), self.options.get("name", "batch"))


# --- the whole landing --------------------------------------------------------------------------


@dataclass
class SinkOptions:
    """Settings of a landing: folders, the length of a bucket, and how the audit goes.

    ``name`` tells apart streams that land in one tree; it belongs to the checkpoint.
    """

    root: str
    checkpoint: str
    as_of_year: int
    seconds: int = SHIFT_SECONDS
    level: int = DEFLATE_LEVEL
    drop_truncated: bool = False
    sink_to_watermark: bool = False
    start: DataFrame | None = None
    name: str = "batch"


def sink_lines(log: DataFrame, configs: DataFrame, options: SinkOptions) -> DataFrame:
    """What the sink writes: accepted, decoded lines of configured topics with their file.

    A file holds a bucket of a topic-partition in one micro-batch; its name ends with the bucket's start.
    """
    rows = audited(log, options.start, options.sink_to_watermark).filter("accepted")
    lines = landable(decode(rows, options.as_of_year), options.drop_truncated)
    placed = render_paths(lines.withColumn("dir_ms", time_bucket(F.col("ts_ms"), options.seconds)), configs, data_dir=None)
    name = F.concat("path", F.lit("/"), "topic", F.lit("-"), F.col("partition").cast("string"), F.lit("-"), F.col("dir_ms").cast("string"), F.lit(EXTENSION))
    return placed.select(name.alias("file"), "arrival_seq", "arrival_ms", "ts_ms", "body")


def landing_sink(log: DataFrame, configs: DataFrame, options: SinkOptions, trigger: dict | None = None):
    """Start the stream: source, keyed audit, decode, sink."""
    spark = log.sparkSession
    spark.dataSource.register(StreamSinkSource)
    with state_store(spark):
        writer = sink_lines(log, configs, options).writeStream.format(FORMAT).outputMode("append")
        writer = writer.option("level", options.level).option("name", options.name).option("checkpointLocation", options.checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start(qualified(spark, options.root))
