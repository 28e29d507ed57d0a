"""A landed topic log in segments with an index, and a stream that reads it from given offsets.

``land_segments`` writes a log as Parquet files that hold consecutive segments of one topic-partition
each, and publishes an index of the segments: topic, partition, file, first and last offset, rows. One
index row per ``SEGMENT_ROWS`` messages is all the driver sees. Small segments share a file of up to
``FILE_ROWS`` offsets, so the number of files follows the messages, not the segments.

``from_segments`` starts at the offset given for each partition (the earliest one where none is
given), ends before the offset given as end, and admits up to ``max_offsets`` new offsets in a
micro-batch, shared out by what the partitions have waiting. The source plans: its rows name
segments and ranges of offsets, and the messages are read where these rows go, on the executors.
Stream offsets are JSON, ``{topic: {partition: next offset}}``; a restarted stream goes on from its
checkpoint, and a micro-batch that runs again reads the same ranges.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..functions.times import int_div
from ..operators.common import TP
from ..session import qualified
from .containers import filesystem
from .topic_log import LOG_DDL, starting_offsets

FORMAT = "log_segments"
INDEX = "_index"
SEGMENT_ROWS = 1 << 20
FILE_ROWS = 1 << 18         # offsets of a file that holds more than one segment
GROUP_ROWS = 1 << 14        # rows of a row group, the least that is read
PLAN_ROWS = 1 << 16         # rows of a file that are read in one go
PLAN_DDL = "topic string, partition int, path string, first bigint, last bigint"
LOG_COLUMNS = [c.split()[0] for c in LOG_DDL.split(", ")]

Offsets = dict[str, dict[str, int]]


# --- landing ------------------------------------------------------------------------------------


def land_segments(log: DataFrame, root: str, key: str, segment_rows: int = SEGMENT_ROWS) -> None:
    """Add a log to the segments under ``root``; a key that is published already is left as it is.

    Files get a folder of this attempt's own and become visible with the index, which is one
    small file under its final name.
    """
    spark = log.sparkSession
    base = qualified(spark, root).rstrip("/")
    fs, inner = filesystem(base)
    if fs.get_file_info(f"{inner}/{INDEX}/{key}.json").type != pafs.FileType.NotFound:
        return
    folder = f"{key}-{uuid.uuid4().hex}"
    parts = [*TP, "_slice"]
    file_rows = max(1, FILE_ROWS // segment_rows) * segment_rows
    sliced = log.select(*LOG_COLUMNS).withColumn("_slice", int_div(F.col("offset"), file_rows))
    for name in TP:
        sliced = sliced.withColumn(f"_{name}", F.col(name))
    folders = ["_topic", "_partition", "_slice"]
    sliced.repartition(*parts).sortWithinPartitions(*parts, "offset", "arrival_seq").write.partitionBy(*folders) \
        .option("parquet.block.row.count.limit", GROUP_ROWS).parquet(f"{base}/{folder}")
    below = F.regexp_replace(F.col("_metadata.file_path"), f"^.*?/{folder}/", f"{folder}/")
    rows = spark.read.schema(LOG_DDL).parquet(f"{base}/{folder}").groupBy(
        *TP, below.alias("path"), int_div(F.col("offset"), segment_rows).alias("_segment")).agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count("*").alias("rows")).drop("_segment").collect()
    fs.create_dir(f"{inner}/{INDEX}", recursive=True)
    temporary = f"{inner}/{INDEX}/.{folder}"
    with fs.open_output_stream(temporary) as out:
        out.write(json.dumps([r.asDict() for r in rows]).encode())
    fs.move(temporary, f"{inner}/{INDEX}/{key}.json")


def segments(root: str) -> list[dict]:
    """The published index."""
    fs, inner = filesystem(root)
    out: list[dict] = []
    for info in fs.get_file_info(pafs.FileSelector(f"{inner}/{INDEX}", allow_not_found=True)):
        if info.base_name.endswith(".json"):
            with fs.open_input_stream(info.path) as source:
                out += json.loads(source.read())
    return sorted(out, key=lambda s: (s["topic"], s["partition"], s["first"], s["path"]))


# --- planning -----------------------------------------------------------------------------------


def _bounds(index: list[dict]) -> tuple[Offsets, Offsets]:
    """Earliest offset and next offset of each partition."""
    low: Offsets = {}
    high: Offsets = {}
    for s in index:
        t, p = s["topic"], str(s["partition"])
        low.setdefault(t, {})[p] = min(s["first"], low.get(t, {}).get(p, s["first"]))
        high.setdefault(t, {})[p] = max(s["last"] + 1, high.get(t, {}).get(p, 0))
    return low, high


def admitted(start: Offsets, high: Offsets, limit: int | None) -> Offsets:
    """Where a micro-batch ends: everything up to ``high``, or ``limit`` offsets shared out by what waits.

    A partition that has something waiting gets one offset at least, the sum stays within the limit
    as long as that is no smaller than the number of such partitions.
    """
    waiting = {(t, p): h - start[t][p] for t, ps in high.items() for p, h in ps.items() if h > start[t][p]}
    total = sum(waiting.values())
    end = {t: dict(ps) for t, ps in start.items()}
    left = total if limit is None else min(limit, total)
    for k, ((t, p), n) in enumerate(sorted(waiting.items(), key=lambda w: (w[1], w[0]))):
        share = n if limit is None or total <= limit else max(1, min(n, limit * n // total, left - (len(waiting) - k - 1)))
        end[t][p] = start[t][p] + share
        left -= share
    return end


class SegmentPlans(SimpleDataSourceStreamReader):
    """Rows of :data:`PLAN_DDL`, one for each stretch of segments of a file that a micro-batch reads from."""

    def __init__(self, root: str, starting: Offsets, ending: Offsets, limit: int | None):
        self.root, self.starting, self.ending, self.limit = root, starting, ending, limit

    def _complete(self, offsets: Offsets, low: Offsets) -> Offsets:
        """``offsets`` with the partitions that are new: from the start table, or their earliest."""
        out = {t: dict(ps) for t, ps in offsets.items()}
        for t, ps in low.items():
            for p, first in ps.items():
                out.setdefault(t, {}).setdefault(p, self.starting.get(t, {}).get(p, first))
        return out

    def initialOffset(self) -> dict:
        return self.starting or {}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        index = segments(self.root)
        low, high = _bounds(index)
        begun = self._complete(start, low)
        for t, ps in self.ending.items():
            for p, stop in ps.items():
                if p in high.get(t, {}):
                    high[t][p] = min(high[t][p], stop)
        end = admitted(begun, high, self.limit)
        return iter(self._plans(index, begun, end)), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        index = segments(self.root)
        return iter(self._plans(index, self._complete(start, _bounds(index)[0]), end))

    def _plans(self, index: list[dict], start: Offsets, end: Offsets) -> list[tuple]:
        out: list[list] = []
        open_: dict[str, tuple[list, int]] = {}     # by file: its last stretch, and the rows of that
        for s in index:
            t, p = s["topic"], str(s["partition"])
            lo, hi = start[t][p], end.get(t, {}).get(p, start[t][p])
            first, last = max(lo, s["first"]), min(hi - 1, s["last"])
            if first > last:
                continue
            stretch, held = open_.get(s["path"], (None, 0))
            if stretch is not None and held + s["rows"] <= PLAN_ROWS:
                stretch[4] = last
            else:
                stretch, held = [t, s["partition"], s["path"], first, last], 0
                out.append(stretch)
            open_[s["path"]] = stretch, held + s["rows"]
        return [tuple(row) for row in out]


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return PLAN_DDL

    def simpleStreamReader(self, schema) -> SegmentPlans:
        starting, ending = (json.loads(self.options.get(k, "{}")) for k in ("startingOffsets", "endingOffsets"))
        limit = self.options.get("maxOffsetsPerTrigger")
        return SegmentPlans(self.options["path"], starting, ending, int(limit) if limit else None)


# --- reading ------------------------------------------------------------------------------------


def read_plans(plans: DataFrame, root: str) -> DataFrame:
    """Messages of planned ranges, in offset order within a segment; row groups outside a range are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = filesystem(root)
        for batch in batches:
            for row in batch.to_pylist():
                inside = (pc.field("offset") >= row["first"]) & (pc.field("offset") <= row["last"])
                for part in pads.dataset(f"{inner}/{row['path']}", filesystem=fs, format="parquet").to_batches(columns=LOG_COLUMNS, filter=inside):
                    if part.num_rows:
                        yield part

    return plans.mapInArrow(run, LOG_DDL)


def from_segments(
    spark: SparkSession, root: str, start: DataFrame | None = None, end: DataFrame | None = None, max_offsets: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """A streaming topic log. ``start`` and ``end`` hold ``start_offset`` per partition; an end is not read itself."""
    spark.dataSource.register(SegmentSource)
    base = qualified(spark, root).rstrip("/")
    reader = spark.readStream.format(FORMAT)
    if start is not None:
        reader = reader.option("startingOffsets", starting_offsets(start))
    if end is not None:
        reader = reader.option("endingOffsets", starting_offsets(end))
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    plans = reader.load(base).repartition(tasks or spark.sparkContext.defaultParallelism, "path", "first")
    return read_plans(plans, base)
