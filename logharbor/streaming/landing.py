"""Continuous landing: a micro-batch is a shift, files are committed before the ledger."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyarrow import fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.wire import decode, landable
from ..operators.blocks import SPAN_BYTES
from ..operators.common import ROLL_ROWS, TP
from ..operators.files import SHIFT_SECONDS, file_keys, skew
from ..operators.ledger import merge_totals, shift_totals
from ..operators.offsets import accepted_rows, offset_audit, sink_to_high_watermark
from ..plans.jobs import land
from ..session import qualified
from ..sources.containers import DEFLATE_LEVEL, filesystem

LEDGER_DDL = (
    "topic string, partition int, shift_start bigint, next_offset bigint, max_ts_ms bigint, "
    "consumed bigint, batch_id bigint"
)
OFFSETS_DDL = "topic string, partition int, start_offset bigint"
SNAPSHOTS = "snapshots"


@dataclass
class LandingOptions:
    """Settings of a landing stream (job parameters, not a table).

    ``start`` says where the first batch begins (``topic, partition, start_offset``, as resume
    planning and range resets give it); partitions without a row begin at 0. Later batches go on
    from what the batch before stored, so an override is used once.

    ``roll_rows`` bounds a file: it rolls at every so many arrival positions of its partition.
    ``span_bytes`` bounds the bodies that packing hands on at once; it does not change blocks.
    The ledger is compacted as soon as ``compact_every`` batches lie beside its snapshot.
    """

    root: str
    ledger: str
    checkpoint: str
    as_of_year: int
    seconds: int = SHIFT_SECONDS
    level: int = DEFLATE_LEVEL
    drop_truncated: bool = False
    sink_to_watermark: bool = False
    skew: dict = field(default_factory=dict)
    start: DataFrame | None = None
    roll_rows: int = ROLL_ROWS
    span_bytes: int = SPAN_BYTES
    compact_every: int = 64


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _snapshots(fs: pafs.FileSystem, root: str) -> list[int]:
    found = fs.get_file_info(pafs.FileSelector(f"{root}/{SNAPSHOTS}", allow_not_found=True))
    return sorted(int(i.base_name.removesuffix(".done")) for i in found if i.base_name.endswith(".done"))


def _batches(fs: pafs.FileSystem, folder: str) -> list[int]:
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return sorted(int(i.base_name.split("=")[1]) for i in found if i.base_name.startswith("batch_id="))


def ledger_folders(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    """The newest snapshot (the last batch it covers) and the batches after it: what a reader has to open."""
    fs, root = filesystem(qualified(spark, path))
    done = _snapshots(fs, root)
    upto = done[-1] if done else None
    return upto, [b for b in _batches(fs, f"{root}/shifts") if upto is None or b > upto]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Totals per shift and batch; empty before the first batch.

    Batches that a snapshot covers come as its merged rows, under the number of the last of them.
    """
    upto, tail = ledger_folders(spark, path)
    out = spark.createDataFrame([], LEDGER_DDL)
    if tail:
        folders = [f"{path}/shifts/batch_id={b}" for b in tail]
        out = spark.read.schema(LEDGER_DDL).option("basePath", f"{path}/shifts").parquet(*folders)
    if upto is None:
        return out
    covered = spark.read.schema(LEDGER_DDL).parquet(f"{path}/{SNAPSHOTS}/upto={upto}")
    return covered.unionByName(out) if tail else covered


def compact_ledger(spark: SparkSession, path: str, keep: int = 1) -> int | None:
    """Merge all batches but the last ``keep`` into a new snapshot; returns the last batch it covers.

    The switch is one empty marker file, written after the snapshot is complete; until then, and after a
    crash in between, readers see the old snapshot and its tail. The last batch is never merged,
    since a stream may run it again. Folders that the snapshot before this one covers are
    deleted, so readers that began before the switch still find theirs.
    """
    if keep < 1:
        raise ValueError("the last batch may run again and has to stay")
    fs, root = filesystem(qualified(spark, path))
    before, tail = ledger_folders(spark, path)
    if len(tail) <= keep:
        return before
    upto = tail[-keep - 1]
    rows = read_ledger(spark, path).filter(F.col("batch_id") <= upto)
    merged = rows.groupBy(*TP, "shift_start").agg(
        F.max_by("next_offset", "batch_id").alias("next_offset"), F.max("max_ts_ms").alias("max_ts_ms"),
        F.sum("consumed").alias("consumed")).withColumn("batch_id", F.lit(upto).cast("bigint"))
    columns = [c.split()[0] for c in LEDGER_DDL.split(", ")]
    merged.select(*columns).write.mode("overwrite").parquet(f"{path}/{SNAPSHOTS}/upto={upto}")
    fs.open_output_stream(f"{root}/{SNAPSHOTS}/{upto:019}.done").close()
    if before is not None:
        for folder in ("shifts", "offsets"):
            for b in _batches(fs, f"{root}/{folder}"):
                if b <= before:
                    fs.delete_dir(f"{root}/{folder}/batch_id={b}")
        for old in _snapshots(fs, root):
            if old < before:
                fs.delete_file(f"{root}/{SNAPSHOTS}/{old:019}.done")
                fs.delete_dir(f"{root}/{SNAPSHOTS}/upto={old}")
    return upto


def read_offsets(spark: SparkSession, path: str, after_batch: int) -> DataFrame:
    """``start_offset`` of every partition seen up to and including ``after_batch``: one small folder.

    A stream that has begun must find what its last batch stored: going on from 0 would land
    everything again.
    """
    try:
        return spark.read.schema(OFFSETS_DDL).parquet(f"{path}/offsets/batch_id={after_batch}")
    except AnalysisException as error:
        if not _missing(error):
            raise
        raise ValueError(f"no offsets of batch {after_batch} under {path}") from error


def _starts(spark: SparkSession, batch_id: int, options: LandingOptions) -> DataFrame:
    if batch_id > 0:
        return read_offsets(spark, options.ledger, batch_id - 1)
    if options.start is not None:
        return options.start.select(*TP, F.col("start_offset").cast("long").alias("start_offset"))
    return spark.createDataFrame([], OFFSETS_DDL)


def offset_state(audited: DataFrame, start: DataFrame) -> DataFrame:
    """What each partition expects after a batch: the last audited row in arrival order decides.

    Rows that were not accepted count, too: one of them may have reset the expectation.
    """
    moved = audited.groupBy(*TP).agg(F.max_by("next_offset", "arrival_seq").alias("_moved"))
    return start.join(moved, TP, "full").select(*TP, F.coalesce("_moved", "start_offset").alias("start_offset"))


def land_batch(batch: DataFrame, batch_id: int, configs: DataFrame, options: LandingOptions) -> None:
    """Land one micro-batch; running it again for the same batch leaves the same files and ledger.

    The expected offsets are those the previous batch left, file names come from the lines,
    and the batch's ledger rows have folders of their own that are replaced.  The ledger
    belongs to the stream's checkpoint, as batch numbers do.  A job without a stream lands the
    same way, with the number of its run.
    """
    spark = batch.sparkSession
    start = _starts(spark, batch_id, options)
    audit = sink_to_high_watermark if options.sink_to_watermark else offset_audit
    # The body is a slice of the value, so only the body is kept for the passes below.
    audited = decode(audit(batch, start, options.roll_rows), options.as_of_year).drop("value").persist()
    try:
        decoded = accepted_rows(audited)
        shift = F.lit(batch_id).cast("long")
        keyed = file_keys(landable(decoded, options.drop_truncated), options.seconds, shift=shift)
        land(skew(keyed, **options.skew), configs, options.root, options.level, span_bytes=options.span_bytes)
        # The files come first, then the ledger rows, and the offsets that end the batch last.
        totals = shift_totals(decoded, options.seconds)
        totals.write.mode("overwrite").parquet(f"{options.ledger}/shifts/batch_id={batch_id}")
        offset_state(audited, start).write.mode("overwrite").parquet(f"{options.ledger}/offsets/batch_id={batch_id}")
        if len(ledger_folders(spark, options.ledger)[1]) > options.compact_every:
            compact_ledger(spark, options.ledger)
    finally:
        audited.unpersist()


def landing_stream(log: DataFrame, configs: DataFrame, options: LandingOptions, trigger: dict | None = None):
    """Start landing a streaming topic log; no watermark is set, so late lines are never dropped."""
    def each(batch: DataFrame, batch_id: int) -> None:
        land_batch(batch, batch_id, configs, options)

    writer = log.writeStream.foreachBatch(each).option("checkpointLocation", options.checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def landed_shifts(spark: SparkSession, path: str) -> DataFrame:
    """One row per shift from a stream's ledger, the input of the scheduled readiness job."""
    return merge_totals(read_ledger(spark, path))
