"""Empty marker files that tell downstream jobs a folder is complete."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import render_template
from ..operators.readiness import LOOK_BACK_HOURS, candidate_hours
from ..session import qualified
from .containers import filesystem

FLAG_NAME = "_READY"


def _locator(base: str, name: str) -> Callable[[str], tuple[pafs.FileSystem, str]]:
    """Finds a folder's marker; the file system of ``base`` is opened once."""
    if not base:
        return lambda path: filesystem(f"{path.rstrip('/')}/{name}")
    fs, root = filesystem(base)
    return lambda path: (fs, f"{root.rstrip('/')}/{path.strip('/')}/{name}")


def write_flags(flags: DataFrame, base: str = "", name: str = FLAG_NAME) -> int:
    """Create a marker in every folder of column ``path`` (made if absent); returns how many.

    Each task creates its own; writing one again changes nothing, so retries are harmless.
    """
    base = qualified(flags.sparkSession, base) if base else base

    def create(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, locate = 0, _locator(base, name)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, inner = locate(path)
                fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                fs.open_output_stream(inner).close()
                made += 1
        yield pa.RecordBatch.from_pydict({"made": pa.array([made], pa.int64())})

    rows = flags.select("path").distinct().mapInArrow(create, "made long")
    return rows.agg(F.coalesce(F.sum("made"), F.lit(0))).first()[0]


def with_flag(dirs: DataFrame, base: str = "", path: str = "path", name: str = FLAG_NAME) -> DataFrame:
    """Add ``flagged``: whether the folder of each row holds a marker, looked up in the tasks."""
    names = dirs.columns
    base = qualified(dirs.sparkSession, base) if base else base

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        locate = _locator(base, name)
        for batch in batches:
            found = []
            for p in batch.column(path).to_pylist():
                fs, inner = locate(p)
                found.append(fs.get_file_info(inner).type == pafs.FileType.File)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.bool_())], [*names, "flagged"])

    schema = T.StructType([*dirs.schema.fields, T.StructField("flagged", T.BooleanType())])
    return dirs.mapInArrow(look, schema)


def recorded_flags(configs: DataFrame, as_of_ms: int, hours: int = LOOK_BACK_HOURS, base: str = "", name: str = FLAG_NAME) -> DataFrame:
    """``topic, hour_ms`` of the candidate hours whose topic folder holds a marker, as :func:`due_hours` takes them.

    Only the folders that could be due are looked up, in the tasks; the trees are not listed.
    """
    topics = configs.select(F.col("id").alias("topic"), "hdfsRootDir").withColumn("hour_ms", F.explode(candidate_hours(as_of_ms, hours)))
    folders = topics.select("topic", "hour_ms", render_template(F.col("hdfsRootDir"), F.col("hour_ms")).alias("path"))
    return with_flag(folders, base, "path", name).filter("flagged").select("topic", "hour_ms")


CHILD_DDL = "path string, child string, flagged boolean"


def children(folders: DataFrame, base: str = "", name: str = FLAG_NAME) -> DataFrame:
    """``path, child, flagged``: the folders inside each folder of ``path``, and whether they hold a marker.

    Each task lists its own folders. Folders that do not exist, and hidden ones, have no rows.
    """
    base = qualified(folders.sparkSession, base) if base else base

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        locate = _locator(base, name)
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                fs, marker = locate(path)
                for info in fs.get_file_info(pafs.FileSelector(marker.rsplit("/", 1)[0], allow_not_found=True)):
                    if info.type == pafs.FileType.Directory and not info.base_name.startswith(("_", ".")):
                        inside = fs.get_file_info(f"{info.path}/{name}").type == pafs.FileType.File
                        rows.append((path, info.base_name, inside))
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(columns, (pa.string(), pa.string(), pa.bool_()))], ["path", "child", "flagged"])

    return folders.select("path").distinct().mapInArrow(look, CHILD_DDL)


def folder_ready(folders: DataFrame, base: str = "", name: str = FLAG_NAME) -> DataFrame:
    """Per folder: how many folders are in it, how many of them hold a marker, and whether all do.

    This is how readiness climbs on the file system alone: an hour folder by its topics, a day folder by its hours.
    """
    return children(folders, base, name).groupBy("path").agg(
        F.count("*").alias("children"), F.count_if("flagged").alias("ready_children"), F.every("flagged").alias("ready"))
