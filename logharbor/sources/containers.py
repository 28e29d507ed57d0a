"""Reading and writing line containers (``.bm``): Avro object container files of line blocks.

Writing: Spark builds the blocks, one shuffle away from the lines; the Python writer encodes
them as records, two megabytes per container block, deflates and appends.  Files get a temporary
name in the task and their real one in the commit.

Reading: one input split per byte range, cut at sync markers, so large files parallelise.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

from ..operators.blocks import log_blocks
from ..operators.files import EXTENSION, FILE_KEY
from ..session import qualified

# Fixed values of the file format: magic, metadata keys, codec, sync size, record schema.
MAGIC = b"Obj\x01"
SYNC_BYTES = 16
CODEC = b"deflate"
SCHEMA = {
    "type": "record", "name": "logBlock",
    "fields": [
        {"name": "second", "type": "long"},
        {"name": "createTime", "type": "long"},
        {"name": "blockNumber", "type": "long"},
        {"name": "logLines", "type": {"type": "array", "items": {
            "type": "record", "name": "messageWithMillis",
            "fields": [{"name": "ms", "type": "long"}, {"name": "message", "type": "string"}],
        }}},
    ],
}
CONTAINER_BYTES = 2 << 20
DEFLATE_LEVEL = 6
WRITE_ROWS = 4096               # rows per batch handed to a writer or packer
WRITE_BYTES = 64 << 20          # and their bytes: a block or container may be megabytes, so rows alone bound nothing
SPLIT_BYTES = 16 << 20          # deflated bytes, which a task decodes in Python: half a million lines or so
HEAD_BYTES = 64 << 10           # first read of a file; more where its header is longer
OPEN_COST_BYTES = 256 << 10     # what opening one more file is taken to cost when packing splits
FORMAT = "line_container"
TEMPORARY = "_tmp_"

LINE_DDL = (
    "file string, second bigint, create_time bigint, block_number bigint, idx int, ts_ms bigint, message binary"
)
STATS_DDL = "file string, position bigint, records bigint, raw_bytes bigint, compressed_bytes bigint"
CONTAINER_DDL = "file string, container bigint, records bigint, raw binary"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a local path or a URI (hdfs, s3, gs, file)."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


# --- building container blocks -----------------------------------------------------------------


def _placed(blocks: DataFrame, file: str, file_key: Sequence[str]) -> DataFrame:
    """Blocks as the encoder takes them: a file's blocks together and in order."""
    keys = list(file_key) or [file]
    narrow = blocks.select(
        F.col(file).alias("file"), F.xxhash64(*keys).alias("_key"), "block_number", "second", "create_time", "log_lines")
    if not file_key:
        narrow = narrow.repartition("file")
    return narrow.sortWithinPartitions("file", "_key", "block_number")


def containers(
    blocks: DataFrame, file: str = "file", file_key: Sequence[str] = (), container_bytes: int = CONTAINER_BYTES
) -> DataFrame:
    """``file, container, records, raw``: record bytes of each container block, uncompressed.

    ``file`` is the column naming the output file; ``container`` is the number of its first
    block, which orders a file's containers.  With ``file_key`` (columns the blocks are
    already partitioned by, one file per key) no further shuffle is needed.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(container_bytes)
        for batch in batches:
            for box in packer.feed(batch):
                yield _box_batch([box])
        last = packer.finish()
        if last:
            yield _box_batch([last])

    return _placed(blocks, file, file_key).mapInArrow(encode, CONTAINER_DDL)


def _box_batch(boxes: list[Box]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.binary())
    columns = zip(*((b.file, b.container, b.records, b.raw) for b in boxes))
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(columns, types)], ["file", "container", "records", "raw"])


class Box(NamedTuple):
    """Record bytes of a container block; ``container`` is the number of its first line block."""

    file: str
    container: int
    records: int
    raw: bytes
    lines: int
    min_second: int
    max_second: int


class _Packer:
    """Encodes blocks as records and gathers those that start in the same stretch of a file."""

    def __init__(self, container_bytes: int):
        self.room = container_bytes
        self.key, self.at, self.box, self.first, self.parts = None, 0, 0, 0, []
        self.lines, self.seconds = 0, []

    def feed(self, batch: pa.RecordBatch) -> Iterator[Box]:
        columns = [batch.column(c).to_pylist() for c in ("file", "_key", "block_number", "second")]
        sizes = batch.column("log_lines").value_lengths().to_pylist()
        for name, key, number, second, size, record in zip(*columns, sizes, _records(batch)):
            if (name, key) != self.key:
                last = self.finish()
                if last:
                    yield last
                self.key, self.at, self.box, self.first = (name, key), 0, 0, number
            elif self.at // self.room != self.box:
                yield self.finish()
                self.box, self.first = self.at // self.room, number
            self.parts.append(record)
            self.seconds.append(second)
            self.lines += size
            self.at += len(record)

    def finish(self) -> Box | None:
        if not self.parts:
            return None
        out = Box(self.key[0], self.first, len(self.parts), b"".join(self.parts), self.lines, min(self.seconds), max(self.seconds))
        self.parts, self.lines, self.seconds = [], 0, []
        return out


def _records(batch: pa.RecordBatch) -> Iterator[bytes]:
    """Record bytes of each block of a batch; numbers below 8,192 come from a table."""
    table = _small_numbers()

    def number(n: int) -> bytes:
        return table[n] if 0 <= n < 8192 else _long_bytes(n)

    lists = batch.column("log_lines")
    ends = lists.offsets.to_pylist()
    lines = lists.values
    times, texts = lines.field("ms").to_pylist(), lines.field("message").to_pylist()
    heads = zip(*[batch.column(c).to_pylist() for c in ("second", "create_time", "block_number")])
    for k, head in enumerate(heads):
        lo, hi = ends[k], ends[k + 1]
        parts = [_long_bytes(n) for n in head]
        if hi > lo:
            parts.append(number(hi - lo))
            for ms, text in zip(times[lo:hi], texts[lo:hi]):
                parts += (number(ms), number(len(text)), text)
        parts.append(b"\0")
        yield b"".join(parts)


def _deflate(raw: bytes, level: int) -> bytes:
    """Raw deflate; level 0 stores blocks of 65,535 bytes, so its size follows from the input's."""
    if level == 0:
        raw = memoryview(raw).cast("B")
        parts = []
        for at in range(0, max(1, len(raw)), 65_535):
            part = raw[at:at + 65_535]
            head = bytes((at + 65_535 >= len(raw),)) + len(part).to_bytes(2, "little") + (65_535 - len(part)).to_bytes(2, "little")
            parts += [head, bytes(part)]
        return b"".join(parts)
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    return squeeze.compress(raw) + squeeze.flush()


def packed(boxes: DataFrame, level: int = DEFLATE_LEVEL) -> DataFrame:
    """Container blocks with ``raw`` already deflated, for a writer that only appends."""
    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            small = [_deflate(r, level) for r in batch.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(small, pa.binary())], batch.schema.names)

    return boxes.mapInArrow(squeeze, boxes.schema)


def container_sizes(boxes: DataFrame, level: int = DEFLATE_LEVEL) -> DataFrame:
    """What each container block would take on disk, without writing it."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column("raw").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("container"), batch.column("records"),
                 pa.array([len(r) for r in raws], pa.int64()),
                 pa.array([len(_deflate(r, level)) for r in raws], pa.int64())],
                ["file", "position", "records", "raw_bytes", "compressed_bytes"],
            )

    return boxes.mapInArrow(measure, STATS_DDL)


# --- bytes -------------------------------------------------------------------------------------


def _long_bytes(n: int) -> bytes:
    z, out = (n << 1) ^ (n >> 63), bytearray()
    while z > 0x7F:
        out.append((z & 0x7F) | 0x80)
        z >>= 7
    out.append(z)
    return bytes(out)


@lru_cache
def _small_numbers() -> list[bytes]:
    return [_long_bytes(n) for n in range(8192)]


def _read_long(data, pos: int) -> tuple[int, int]:
    b = data[pos]
    pos += 1
    z, shift = b & 0x7F, 7
    while b > 0x7F:
        b = data[pos]
        pos += 1
        z |= (b & 0x7F) << shift
        shift += 7
    return (z >> 1) ^ -(z & 1), pos


def _header(sync: bytes) -> bytes:
    def text(b: bytes) -> bytes:
        return _long_bytes(len(b)) + b

    schema = json.dumps(SCHEMA, separators=(",", ":")).encode()
    return b"".join([
        MAGIC, _long_bytes(2), text(b"avro.schema"), text(schema), text(b"avro.codec"), text(CODEC),
        _long_bytes(0), sync,
    ])


# --- writer ------------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]    # (temporary path, final path)


class ContainerWriter(DataSourceArrowWriter):
    def __init__(self, root: str, level: int, overwrite: bool, form: str = "raw", container_bytes: int = CONTAINER_BYTES):
        self.root, self.level, self.overwrite, self.form, self.container_bytes = root, level, overwrite, form, container_bytes

    def _boxes(self, iterator: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
        """File, record count and deflated bytes of each container block."""
        if self.form == "blocks":
            packer = _Packer(self.container_bytes)
            for batch in iterator:
                for box in packer.feed(batch):
                    yield box.file, box.records, _deflate(box.raw, self.level)
            last = packer.finish()
            if last:
                yield last.file, last.records, _deflate(last.raw, self.level)
            return
        for batch in iterator:
            for name, records, raw in zip(*[batch.column(c) for c in ("file", "records", "raw")]):
                data = raw.as_py()
                yield name.as_py(), records.as_py(), data if self.form == "packed" else _deflate(data, self.level)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = filesystem(self.root)
        attempt = uuid.uuid4().hex
        files: list[tuple[str, str]] = []
        current, out, sync = None, None, b""
        try:
            for name, records, block in self._boxes(iterator):
                if name != current:
                    if out is not None:
                        out.close()
                    current = name
                    final = f"{root}/{current.lstrip('/')}"
                    folder, base = final.rsplit("/", 1)
                    temporary = f"{folder}/{TEMPORARY}{base}.{attempt}"
                    fs.create_dir(folder, recursive=True)
                    files.append((temporary, final))
                    out = fs.open_output_stream(temporary)
                    sync = os.urandom(SYNC_BYTES)
                    out.write(_header(sync))
                out.write(_long_bytes(records) + _long_bytes(len(block)) + block + sync)
            if out is not None:
                out.close()
        except BaseException:
            if out is not None:
                out.close()
            _discard(fs, [t for t, _ in files])
            raise
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = filesystem(self.root)
        files = [pair for m in messages if m is not None for pair in m.files]
        if len({final for _, final in files}) != len(files):
            self.abort(messages)
            raise ValueError("two tasks wrote the same file: partition the containers by file")
        finals = {final for _, final in files}
        stale = [p for p in _data_files(fs, root) if p not in finals] if self.overwrite else []

        def publish(pair: tuple[str, str]) -> None:
            temporary, final = pair
            if fs.get_file_info(final).type != pafs.FileType.NotFound:
                fs.delete_file(final)
            fs.move(temporary, final)

        with ThreadPoolExecutor(16) as pool:
            list(pool.map(publish, files))
            # Attempts whose task was killed could not remove what they had begun.
            list(pool.map(lambda folder: _sweep(fs, folder, finals), {f.rsplit("/", 1)[0] for f in finals}))
        _discard(fs, stale)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = filesystem(self.root)
        _discard(fs, [t for m in messages if m is not None for t, _ in m.files])


def _sweep(fs: pafs.FileSystem, folder: str, finals: set[str]) -> None:
    """Remove temporary files in ``folder`` of files that are published now."""
    for info in fs.get_file_info(pafs.FileSelector(folder)):
        name = info.base_name
        if name.startswith(TEMPORARY) and f"{folder}/{name.removeprefix(TEMPORARY).rsplit('.', 1)[0]}" in finals:
            fs.delete_file(info.path)


def _discard(fs: pafs.FileSystem, paths: Sequence[str]) -> None:
    for path in paths:
        if fs.get_file_info(path).type != pafs.FileType.NotFound:
            fs.delete_file(path)


def _data_files(fs: pafs.FileSystem, root: str) -> list[str]:
    return [i.path for i in _list(fs, root)]


def _list(fs: pafs.FileSystem, root: str) -> list[pafs.FileInfo]:
    """Data files under ``root`` (or the file ``root``), leaving out hidden and temporary names."""
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [info]
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))

    def visible(i: pafs.FileInfo) -> bool:
        parts = i.path[len(root):].strip("/").split("/")
        return not any(p.startswith(("_", ".")) for p in parts)

    return [i for i in found if i.type == pafs.FileType.File and i.path.endswith(EXTENSION) and visible(i)]


# --- reader ------------------------------------------------------------------------------------


@dataclass
class Range:
    path: str
    start: int
    end: int


@dataclass
class Split(InputPartition):
    ranges: list[Range]


def pack_splits(files: Iterable[tuple[str, int]], split_bytes: int) -> list[Split]:
    """Cut large files into ranges and put small ones together, up to ``split_bytes`` per split."""
    splits, current, weight = [], [], 0
    opening = min(OPEN_COST_BYTES, split_bytes)
    for path, size in files:
        for start in range(0, size, split_bytes):
            piece = Range(path, start, min(start + split_bytes, size))
            cost = piece.end - piece.start + opening
            if current and weight + cost > split_bytes + opening:
                splits.append(Split(current))
                current, weight = [], 0
            current.append(piece)
            weight += cost
    return [*splits, Split(current)]


class ContainerReader(DataSourceReader):
    def __init__(self, root: str, mode: str, split_bytes: int):
        self.root, self.mode, self.split_bytes = root, mode, split_bytes

    def partitions(self) -> Sequence[InputPartition]:
        files = []
        for root in self.root.split(","):
            fs, inner = filesystem(root)
            files += sorted((i.path, i.size) for i in _list(fs, inner))
        return pack_splits(files, self.split_bytes)

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(self.root.split(",")[0])
        for part in partition.ranges:
            with fs.open_input_file(part.path) as source:
                sync, first = _open_container(source, part.path)
                for position, records, packed in _container_blocks(source, sync, first, part):
                    raw = zlib.decompress(packed, -15)
                    if self.mode == "containers":
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([part.path])]
                            + [pa.array([n], pa.int64()) for n in (position, records, len(raw), len(packed))],
                            ["file", "position", "records", "raw_bytes", "compressed_bytes"],
                        )
                    else:
                        yield _lines(part.path, raw, records)


def _open_container(source, path: str) -> tuple[bytes, int]:
    """Sync marker and position of the first block; reads on until the header is whole."""
    want = HEAD_BYTES
    while True:
        source.seek(0)
        head = source.read(want)
        if head[:4] != MAGIC:
            raise ValueError(f"not an object container file: {path}")
        try:
            codec, pos = _header_end(head)
        except IndexError:
            if len(head) < want:
                raise ValueError(f"header cut short: {path}") from None
            want *= 8
            continue
        if codec != CODEC:
            raise ValueError(f"unexpected codec {codec!r} in {path}")
        return head[pos:pos + SYNC_BYTES], pos + SYNC_BYTES


def _header_end(head: bytes) -> tuple[bytes | None, int]:
    """Codec and the position of the sync marker; IndexError if ``head`` ends before it does."""
    pos, meta = len(MAGIC), {}
    while True:
        entries, pos = _read_long(head, pos)
        if entries == 0:
            break
        if entries < 0:
            entries, (_, pos) = -entries, _read_long(head, pos)
        for _ in range(entries):
            size, pos = _read_long(head, pos)
            key, pos = head[pos:pos + size], pos + size
            size, pos = _read_long(head, pos)
            meta[key], pos = head[pos:pos + size], pos + size
    if pos + SYNC_BYTES > len(head):
        raise IndexError
    return meta.get(b"avro.codec"), pos


def _container_blocks(source, sync: bytes, first: int, part: Range):
    """Blocks whose preceding sync marker starts inside the range: (position, records, bytes)."""
    size = source.size()
    if part.start <= first - SYNC_BYTES:
        position = first
    else:
        position = _next_sync(source, sync, part.start, size)
    while position < size and position - SYNC_BYTES < part.end:
        source.seek(position)
        head = source.read(20)
        records, used = _read_long(head, 0)
        length, used = _read_long(head, used)
        source.seek(position + used)
        packed = source.read(length)
        marker = source.read(SYNC_BYTES)
        if len(packed) != length or marker != sync:
            raise ValueError(f"broken block at {position} of {part.path}")
        yield position, records, packed
        position += used + length + SYNC_BYTES


def _next_sync(source, sync: bytes, start: int, size: int, step: int = 1 << 20) -> int:
    position, tail = start, b""
    while position < size:
        source.seek(position)
        chunk = source.read(step)
        found = (tail + chunk).find(sync)
        if found >= 0:
            return position - len(tail) + found + SYNC_BYTES
        tail = (tail + chunk)[-(SYNC_BYTES - 1):]
        position += len(chunk)
    return size


def _lines(path: str, data: bytes, records: int) -> pa.RecordBatch:
    seconds, created, numbers, indexes, stamps, messages = [], [], [], [], [], []
    pos = 0
    for _ in range(records):
        second, pos = _read_long(data, pos)
        create_time, pos = _read_long(data, pos)
        number, pos = _read_long(data, pos)
        idx, base = 0, second * 1000
        while True:
            count, pos = _read_long(data, pos)
            if count == 0:
                break
            if count < 0:
                count, (_, pos) = -count, _read_long(data, pos)
            indexes.extend(range(idx, idx + count))
            for _ in range(count):
                # Numbers of one or two bytes, nearly all of them, are read in place.
                z = data[pos]
                if z < 0x80:
                    pos += 1
                    ms = (z >> 1) ^ -(z & 1)
                elif data[pos + 1] < 0x80:
                    z = (z & 0x7F) | (data[pos + 1] << 7)
                    pos += 2
                    ms = (z >> 1) ^ -(z & 1)
                else:
                    ms, pos = _read_long(data, pos)
                z = data[pos]
                if z < 0x80:
                    pos += 1
                    size = z >> 1
                elif data[pos + 1] < 0x80:
                    size = ((z & 0x7F) | (data[pos + 1] << 7)) >> 1
                    pos += 2
                else:
                    size, pos = _read_long(data, pos)
                stamps.append(base + ms)
                messages.append(data[pos:pos + size])
                pos += size
            idx += count
        seconds += [second] * idx
        created += [create_time] * idx
        numbers += [number] * idx
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(path), len(stamps)), pa.array(seconds, pa.int64()), pa.array(created, pa.int64()),
         pa.array(numbers, pa.int64()), pa.array(indexes, pa.int32()), pa.array(stamps, pa.int64()),
         pa.array(messages, pa.binary())],
        ["file", "second", "create_time", "block_number", "idx", "ts_ms", "message"],
    )


class LineContainerSource(DataSource):
    """``spark.read.format("line_container").load(path)``; option ``mode`` is lines or containers."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return STATS_DDL if self.options.get("mode") == "containers" else LINE_DDL

    def reader(self, schema) -> ContainerReader:
        split = int(self.options.get("splitBytes", SPLIT_BYTES))
        return ContainerReader(self.options["path"], self.options.get("mode", "lines"), split)

    def writer(self, schema, overwrite: bool) -> ContainerWriter:
        level = int(self.options.get("level", DEFLATE_LEVEL))
        return ContainerWriter(self.options["path"], level, overwrite, self.options.get("form", "raw"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LineContainerSource)


def read_lines(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines of the containers under ``path`` (a file, a folder, or several joined by commas)."""
    register(spark)
    return spark.read.format(FORMAT).option("splitBytes", split_bytes).load(_roots(spark, path))


def read_folders(
    spark: SparkSession, root: str, template: str, first_ms: int, last_ms: int, seconds: int = 3600,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Lines of the time folders from ``first_ms`` to ``last_ms``, both included, below ``root``.

    ``template`` names a folder (``%y %M %d %H``); no other folder is listed or opened, and those
    that do not exist have no lines.
    """
    step = seconds * 1000
    times = range(first_ms - first_ms % step, last_ms + 1, step)
    folders = dict.fromkeys(_render(template, ms) for ms in times)
    return read_lines(spark, ",".join(f"{root.rstrip('/')}/{f.strip('/')}" for f in folders), split_bytes)


def _render(template: str, ms: int) -> str:
    at = datetime.fromtimestamp(ms // 1000, timezone.utc)
    for token, text in (("%y", f"{at.year:04}"), ("%M", f"{at.month:02}"), ("%d", f"{at.day:02}"), ("%H", f"{at.hour:02}")):
        template = template.replace(token, text)
    return template


def read_container_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row per container block of the landed files, without decoding lines."""
    register(spark)
    return spark.read.format(FORMAT).option("mode", "containers").load(_roots(spark, path))


def _roots(spark: SparkSession, path: str) -> str:
    return ",".join(qualified(spark, p) for p in path.split(","))


def write_containers(
    boxes: DataFrame, root: str, level: int = DEFLATE_LEVEL, mode: str = "append", is_packed: bool = False
) -> None:
    """Write the result of :func:`containers`; all rows of a file must be in one partition.

    An existing file of the same name is replaced; ``mode="overwrite"`` also removes the
    other files under ``root`` after the new ones are in place.
    """
    ordered = boxes.sortWithinPartitions("file", "container")
    _save(ordered, root, level, mode, "packed" if is_packed else "raw")


def _save(rows: DataFrame, root: str, level: int, mode: str, form: str) -> None:
    spark = rows.sparkSession
    register(spark)
    with bounded_batches(spark):
        rows.write.format(FORMAT).option("level", level).option("form", form).mode(mode).save(qualified(spark, root))


@contextmanager
def bounded_batches(spark: SparkSession):
    """Arrow batches of the jobs run meanwhile, bounded by rows and bytes; the session's own settings come back.

    Most blocks are a line or two, a few are a megabyte, so neither bound would do alone.
    """
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": WRITE_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": WRITE_BYTES}
    before = {limit: spark.conf.get(limit) for limit in limits}
    for limit, value in limits.items():
        spark.conf.set(limit, str(value))
    try:
        yield
    finally:
        for limit, value in before.items():
            spark.conf.set(limit, value)


def write_lines(
    lines: DataFrame, root: str, file: str = "file", level: int = DEFLATE_LEVEL, mode: str = "append",
    file_key: Sequence[str] = FILE_KEY, **block_options,
) -> None:
    """Lines to blocks to files: one shuffle, by file key; the writer encodes, deflates and appends."""
    blocks = log_blocks(lines, file_key, keep=[file], **block_options)
    _save(_placed(blocks, file, file_key), root, level, mode, "blocks")
