"""Container trees whose files are visible by manifest: written once, published at once, never moved.

A tree ``root`` holds

* data files, written by tasks under names of their attempt in the folders they belong to;
* ``_stats/``: side files, one per task, with a row for each container block: where it lies, its
  lines, sizes and the seconds it covers;
* ``_commits/<key>.json``: the manifests. A commit publishes one, which lists the side files of its
  tasks; before that nothing of the job is visible, and publishing moves no data file.

A key is published once. A job or micro-batch that runs again under a published key leaves the
tree as it is and takes back what it wrote. What killed attempts leave is not visible, and
:func:`sweep` removes it. Reports on sizes read the side files alone; readers take positions from
them, so only blocks whose seconds match are read.

The driver handles one line per task and commit. :func:`compact` replaces many by few.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, EqualTo, Filter, GreaterThan,
    GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage,
)

from ..operators.blocks import log_blocks
from ..operators.files import EXTENSION, FILE_KEY
from ..session import qualified
from .containers import (
    CONTAINER_BYTES, DEFLATE_LEVEL, LINE_DDL, SPLIT_BYTES, SYNC_BYTES, Box, _deflate, _header, _lines,
    _long_bytes, _Packer, _placed, _read_long, bounded_batches, filesystem,
)

FORMAT = "line_manifest"
COMMITS, STATS = "_commits", "_stats"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
STATS_DDL = (
    "file string, path string, position bigint, bytes bigint, records bigint, lines bigint, raw_bytes bigint, "
    "compressed_bytes bigint, min_second bigint, max_second bigint"
)
_STATS_SCHEMA = pa.schema([
    (name, pa.string() if kind == "string" else pa.int64())
    for name, kind in (c.split() for c in STATS_DDL.split(", "))
])


# --- manifests ----------------------------------------------------------------------------------


@dataclass
class Part(WriterCommitMessage):
    """A side file below ``_stats``, with what it sums up to."""

    stats: str
    files: int
    blocks: int
    lines: int
    bytes: int
    min_second: int
    max_second: int


def _read_json(fs: pafs.FileSystem, path: str) -> dict:
    with fs.open_input_stream(path) as source:
        return json.loads(source.read())


def visible(fs: pafs.FileSystem, root: str) -> dict[str, list[Part]]:
    """Published keys and their parts, without those that a later manifest replaces."""
    found = fs.get_file_info(pafs.FileSelector(f"{root}/{COMMITS}", allow_not_found=True))
    names = [i.base_name.removesuffix(".json") for i in found if i.base_name.endswith(".json")]
    manifests = {n: _read_json(fs, f"{root}/{COMMITS}/{n}.json") for n in names}
    gone = {n for m in manifests.values() for n in m["replaces"]}
    return {n: [Part(**p) for p in m["parts"]] for n, m in sorted(manifests.items()) if n not in gone}


def _published(fs: pafs.FileSystem, root: str, key: str) -> bool:
    return fs.get_file_info(f"{root}/{COMMITS}/{key}.json").type != pafs.FileType.NotFound


def publish(fs: pafs.FileSystem, root: str, key: str, parts: Sequence[Part], replaces: Sequence[str] = ()) -> None:
    """Make parts visible: one small file, complete under a temporary name before it gets its own."""
    fs.create_dir(f"{root}/{COMMITS}", recursive=True)
    temporary = f"{root}/{COMMITS}/.{key}.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as out:
        out.write(json.dumps({"parts": [asdict(p) for p in parts], "replaces": list(replaces)}).encode())
    fs.move(temporary, f"{root}/{COMMITS}/{key}.json")


def _take_back(fs: pafs.FileSystem, root: str, parts: Iterable[Part]) -> None:
    """Delete what tasks of a job without a manifest wrote."""
    for part in parts:
        side = f"{root}/{STATS}/{part.stats}"
        if fs.get_file_info(side).type == pafs.FileType.NotFound:
            continue
        for path in pc.unique(pq.read_table(side, columns=["path"], filesystem=fs)["path"]).to_pylist():
            if fs.get_file_info(f"{root}/{path}").type != pafs.FileType.NotFound:
                fs.delete_file(f"{root}/{path}")
        fs.delete_file(side)


# --- writing ------------------------------------------------------------------------------------


class TaskFiles:
    """Data files and the side file of one task attempt."""

    def __init__(self, root: str, level: int):
        self.fs, self.root = filesystem(root)
        self.level, self.attempt = level, uuid.uuid4().hex
        self.name, self.out, self.path, self.at, self.sync = None, None, "", 0, b""
        self.opened: list[str] = []
        self.rows: list[tuple] = []

    def add(self, box: Box) -> None:
        if box.file != self.name:
            self._open(box.file)
        data = _deflate(box.raw, self.level)
        block = _long_bytes(box.records) + _long_bytes(len(data)) + data
        self.out.write(block + self.sync)
        self.rows.append((box.file, self.path, self.at, len(block), box.records, box.lines, len(box.raw), len(data), box.min_second, box.max_second))
        self.at += len(block) + SYNC_BYTES

    def _open(self, name: str) -> None:
        self._close()
        stem = name.lstrip("/").removesuffix(EXTENSION)
        self.name, self.path = name, f"{stem}.{self.attempt}-{len(self.opened)}{EXTENSION}"
        full = f"{self.root}/{self.path}"
        self.fs.create_dir(full.rsplit("/", 1)[0], recursive=True)
        self.opened.append(full)
        self.out = self.fs.open_output_stream(full)
        self.sync = uuid.uuid4().bytes
        head = _header(self.sync)
        self.out.write(head)
        self.at = len(head)

    def _close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None

    def finish(self) -> Part:
        """What was written; a task without rows has no side file."""
        self._close()
        if not self.rows:
            return Part("", 0, 0, 0, 0, 0, 0)
        table = pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*self.rows), _STATS_SCHEMA)], schema=_STATS_SCHEMA)
        side = f"{self.attempt}.parquet"
        self.fs.create_dir(f"{self.root}/{STATS}", recursive=True)
        pq.write_table(table, f"{self.root}/{STATS}/{side}", filesystem=self.fs)
        return Part(side, len(self.opened), len(self.rows), pc.sum(table["lines"]).as_py(), pc.sum(table["compressed_bytes"]).as_py(),
                    pc.min(table["min_second"]).as_py(), pc.max(table["max_second"]).as_py())

    def discard(self) -> None:
        self._close()
        for path in self.opened:
            if self.fs.get_file_info(path).type != pafs.FileType.NotFound:
                self.fs.delete_file(path)


def write_boxes(root: str, level: int, boxes: Iterable[Box]) -> Part:
    """One task: all its boxes, or nothing."""
    files = TaskFiles(root, level)
    try:
        for box in boxes:
            files.add(box)
        return files.finish()
    except BaseException:
        files.discard()
        raise


def pack(batches: Iterable[pa.RecordBatch], container_bytes: int = CONTAINER_BYTES) -> Iterator[Box]:
    packer = _Packer(container_bytes)
    for batch in batches:
        yield from packer.feed(batch)
    last = packer.finish()
    if last:
        yield last


class ManifestCommit:
    """The second phase, the same for batch jobs and micro-batches."""

    root: str

    def commit_key(self, key: str, messages: Sequence[Part | None], replace_all: bool = False) -> None:
        fs, root = filesystem(self.root)
        parts = [m for m in messages if m is not None and m.stats]
        if _published(fs, root, key):
            _take_back(fs, root, parts)
            return
        publish(fs, root, key, parts, [k for k in visible(fs, root)] if replace_all else ())

    def abort_parts(self, messages: Sequence[Part | None]) -> None:
        fs, root = filesystem(self.root)
        _take_back(fs, root, [m for m in messages if m is not None and m.stats])


class ManifestWriter(ManifestCommit, DataSourceArrowWriter):
    def __init__(self, root: str, level: int, key: str, overwrite: bool):
        self.root, self.level, self.key, self.overwrite = root, level, key, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        return write_boxes(self.root, self.level, pack(iterator))

    def commit(self, messages: list[Part | None]) -> None:
        self.commit_key(self.key, messages, self.overwrite)

    def abort(self, messages: list[Part | None]) -> None:
        self.abort_parts(messages)


# --- reading ------------------------------------------------------------------------------------


@dataclass
class Share(InputPartition):
    """Share ``number`` of ``shares`` of a side file's blocks, by compressed bytes."""

    stats: str
    number: int
    shares: int


class ManifestReader(DataSourceReader):
    """Lines of the visible blocks whose seconds overlap ``[first, last]``."""

    def __init__(self, root: str, split_bytes: int, first: int | None = None, last: int | None = None):
        self.root, self.split_bytes, self.first, self.last = root, split_bytes, first, last

    def partitions(self) -> Sequence[InputPartition]:
        fs, root = filesystem(self.root)
        out: list[InputPartition] = []
        for parts in visible(fs, root).values():
            for p in parts:
                if (self.first is None or p.max_second >= self.first) and (self.last is None or p.min_second <= self.last):
                    shares = max(1, -(-p.bytes // self.split_bytes))
                    out += [Share(p.stats, k, shares) for k in range(shares)]
        return out or [Share("", 0, 1)]

    def blocks(self, share: Share) -> pa.Table:
        """Rows of the side file that a task reads."""
        fs, root = filesystem(self.root)
        if not share.stats:
            return _STATS_SCHEMA.empty_table()
        table = pq.read_table(f"{root}/{STATS}/{share.stats}", filesystem=fs, schema=_STATS_SCHEMA).sort_by(
            [("path", "ascending"), ("position", "ascending")])
        if share.shares > 1:
            size = table["compressed_bytes"]
            before = pc.subtract(pc.cumulative_sum(size), size)
            whole = max(1, pc.sum(size).as_py())
            table = table.filter(pc.equal(pc.divide(pc.multiply(before, share.shares), whole), share.number))
        if self.first is not None:
            table = table.filter(pc.greater_equal(table["max_second"], self.first))
        if self.last is not None:
            table = table.filter(pc.less_equal(table["min_second"], self.last))
        return table

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(self.root)
        current, source = None, None
        try:
            for row in self.blocks(partition).to_pylist():
                if row["path"] != current:
                    if source is not None:
                        source.close()
                    current, source = row["path"], fs.open_input_file(f"{root}/{row['path']}")
                source.seek(row["position"])
                block = source.read(row["bytes"])
                records, used = _read_long(block, 0)
                length, used = _read_long(block, used)
                if records != row["records"] or len(block) - used != length:
                    raise ValueError(f"broken block at {row['position']} of {row['path']}")
                yield _lines(f"{root}/{row['file'].lstrip('/')}", zlib.decompress(block[used:], -15), records)
        finally:
            if source is not None:
                source.close()


class PushingReader(ManifestReader):
    """Narrows its bounds by the conditions on ``second`` and ``ts_ms`` that Spark offers.

    The conditions are left to Spark, too, since a block holds other seconds besides.
    """

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in ("second", "ts_ms") and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                second = f.value // 1000 if name == "ts_ms" else f.value
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.first = second if self.first is None else max(self.first, second)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.last = second if self.last is None else min(self.last, second)
            yield f


class ManifestSource(DataSource):
    """``line_manifest``: batch reader and writer of a manifest tree."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LINE_DDL

    def reader(self, schema) -> ManifestReader:
        bounds = [int(self.options[k]) if k in self.options else None for k in ("firstSecond", "lastSecond")]
        kind = PushingReader if self.options.get("pushdown") == "true" else ManifestReader
        return kind(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)), *bounds)

    def writer(self, schema, overwrite: bool) -> ManifestWriter:
        key = self.options.get("key") or f"run-{uuid.uuid4().hex}"
        return ManifestWriter(self.options["path"], int(self.options.get("level", DEFLATE_LEVEL)), key, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ManifestSource)


def write_lines(
    lines: DataFrame, root: str, file: str = "file", level: int = DEFLATE_LEVEL, mode: str = "append", key: str | None = None,
    file_key: Sequence[str] = FILE_KEY, **block_options,
) -> None:
    """Lines to blocks to files of a manifest tree: one shuffle, by file key.

    ``key`` names the job: run again under the same key it changes nothing. ``mode="overwrite"``
    replaces all that is visible in the same step in which the new files appear.
    """
    blocks = log_blocks(lines, file_key, keep=[file], **block_options)
    rows = _placed(blocks, file, file_key)
    spark = rows.sparkSession
    register(spark)
    with bounded_batches(spark):
        writer = rows.write.format(FORMAT).option("level", level).mode(mode)
        (writer.option("key", key) if key else writer).save(qualified(spark, root))


def read_lines(
    spark: SparkSession, root: str, first_ms: int | None = None, last_ms: int | None = None, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Visible lines, those from ``first_ms`` to ``last_ms`` (both included) if given; other blocks are not read.

    Where the session pushes filters to Python sources (``PUSHDOWN``), conditions on ``ts_ms`` or
    ``second`` set after this do the same.
    """
    register(spark)
    reader = spark.read.format(FORMAT).option("splitBytes", split_bytes)
    reader = reader.option("pushdown", spark.conf.get(PUSHDOWN, "false"))
    if first_ms is not None:
        reader = reader.option("firstSecond", first_ms // 1000)
    if last_ms is not None:
        reader = reader.option("lastSecond", last_ms // 1000)
    rows = reader.load(qualified(spark, root))
    if first_ms is not None:
        rows = rows.filter(F.col("ts_ms") >= first_ms)
    return rows if last_ms is None else rows.filter(F.col("ts_ms") <= last_ms)


def container_stats(spark: SparkSession, root: str, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per visible container block (of the given commits), from the side files: no container is opened."""
    base = qualified(spark, root)
    fs, inner = filesystem(base)
    sides = [f"{base.rstrip('/')}/{STATS}/{p.stats}" for key, parts in visible(fs, inner).items() if keys is None or key in keys for p in parts]
    if not sides:
        return spark.createDataFrame([], STATS_DDL)
    return spark.read.schema(STATS_DDL).parquet(*sides)


# --- upkeep -------------------------------------------------------------------------------------


def compact(spark: SparkSession, root: str, parts: int = 1) -> str:
    """Rewrite the side files of all visible manifests as ``parts`` files ordered by time, behind one manifest.

    Data files stay where they are. The switch is the publication of the new manifest, which names
    those it replaces; a commit that lands meanwhile stays visible beside it. Returns the key.
    """
    base = qualified(spark, root)
    fs, inner = filesystem(base)
    before = visible(fs, inner)
    key = f"compact-{uuid.uuid4().hex}"
    stats = container_stats(spark, root).repartitionByRange(parts, "min_second", "path", "position")
    stats.sortWithinPartitions("min_second", "path", "position").write.parquet(f"{base.rstrip('/')}/{STATS}/{key}")
    rows = spark.read.schema(STATS_DDL).parquet(f"{base.rstrip('/')}/{STATS}/{key}").groupBy(
        F.regexp_extract(F.col("_metadata.file_path"), "[^/]+$", 0).alias("name")
    ).agg(F.countDistinct("path").alias("files"), F.count("*").alias("blocks"), F.sum("lines").alias("lines"),
          F.sum("compressed_bytes").alias("bytes"), F.min("min_second").alias("lo"), F.max("max_second").alias("hi")).collect()
    publish(fs, inner, key, [Part(f"{key}/{r.name}", r.files, r.blocks, r.lines, r.bytes, r.lo, r.hi) for r in rows], list(before))
    return key


def leftovers(spark: SparkSession, root: str) -> DataFrame:
    """``path`` (below the root) of data files that no visible manifest knows."""
    base = qualified(spark, root).rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{EXTENSION}").load(base)
    below = F.regexp_replace("path", f"^.*?{re.escape(filesystem(base)[1])}/", "")
    known = container_stats(spark, root).select("path").distinct()
    return files.select(below.alias("path")).join(known, "path", "left_anti")


def sweep(spark: SparkSession, root: str) -> int:
    """Delete the leftovers of killed attempts; call it while nothing is being written. Returns how many."""
    base = qualified(spark, root)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = filesystem(base)
        gone = 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                if fs.get_file_info(f"{inner}/{path}").type != pafs.FileType.NotFound:
                    fs.delete_file(f"{inner}/{path}")
                    gone += 1
        yield pa.RecordBatch.from_pydict({"gone": pa.array([gone], pa.int64())})

    return leftovers(spark, root).mapInArrow(remove, "gone long").agg(F.coalesce(F.sum("gone"), F.lit(0))).first()[0]
