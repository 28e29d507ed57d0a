"""Which hours and days are complete: low-water marks, due flags and their propagation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import HOUR_MS, render_template, time_bucket
from .common import TP

LOOK_BACK_HOURS = 24


def low_water(partitions: DataFrame, ledger: DataFrame) -> DataFrame:
    """Earliest stored time of a topic's partitions; one partition without a row blocks the topic."""
    stored = F.col("offset_ts_ms")
    return (
        partitions.select(*TP).join(ledger.select(*TP, "offset_ts_ms"), TP, "left")
        .groupBy("topic")
        .agg(
            F.when(F.count("*") == F.count(stored), F.min(stored)).alias("low_water_ms"),
            F.count("*").alias("partitions"),
            F.count(stored).alias("reporting"),
        )
    )


def candidate_hours(as_of_ms: int, hours: int = LOOK_BACK_HOURS) -> Column:
    """Starts of the last ``hours`` full hours before the current one, as an array."""
    current = as_of_ms - as_of_ms % HOUR_MS
    return F.sequence(
        F.lit(current - hours * HOUR_MS).cast("long"), F.lit(current - HOUR_MS).cast("long"), F.lit(HOUR_MS).cast("long")
    )


def due_hours(
    water: DataFrame, configs: DataFrame, flags: DataFrame, as_of_ms: int,
    hours: int = LOOK_BACK_HOURS, strict: bool = False,
) -> DataFrame:
    """Hours to flag per topic: ``topic, hour_ms, topic_path, data_path``.

    An hour is due once its start lies before the topic's low-water mark and it has no row in
    ``flags (topic, hour_ms)``; ``strict`` asks for its end instead.
    """
    ripe = F.col("hour_ms") + HOUR_MS <= F.col("low_water_ms") if strict else F.col("hour_ms") < F.col("low_water_ms")
    topics = water.join(
        configs.select(F.col("id").alias("topic"), "hdfsRootDir", "defaultDirectory"), "topic"
    )
    return (
        topics.withColumn("hour_ms", F.explode(candidate_hours(as_of_ms, hours)))
        .filter(ripe)
        .join(flags.select("topic", "hour_ms"), ["topic", "hour_ms"], "left_anti")
        .select(
            "topic", "hour_ms",
            render_template(F.col("hdfsRootDir"), F.col("hour_ms")).alias("topic_path"),
            render_template(F.concat_ws("/", "hdfsRootDir", "defaultDirectory"), F.col("hour_ms")).alias("data_path"),
        )
    )


def flag_paths(due: DataFrame) -> DataFrame:
    """Both folders that get a marker for a due hour."""
    return due.select(
        "topic", "hour_ms",
        F.explode(F.array(
            F.struct(F.lit("data").alias("level"), F.col("data_path").alias("path")),
            F.struct(F.lit("topic").alias("level"), F.col("topic_path").alias("path")),
        )).alias("_f"),
    ).select("_f.level", "topic", "hour_ms", "_f.path")


def topic_dirs(lines: DataFrame, key: list[str]) -> DataFrame:
    """Hour folders that hold data: distinct ``key, topic, hour_ms`` of landed lines."""
    return lines.select(*key, "topic", time_bucket(F.col("bucket_ms"), 3600).alias("hour_ms")).distinct()


def hour_ready(dirs: DataFrame, flags: DataFrame, key: list[str]) -> DataFrame:
    """Per hour folder: topics in it, topics flagged, and whether all of them are."""
    marked = flags.select("topic", "hour_ms").distinct().withColumn("_ready", F.lit(True))
    return (
        dirs.select(*key, "topic", "hour_ms").distinct().join(marked, ["topic", "hour_ms"], "left")
        .groupBy(*key, "hour_ms")
        .agg(
            F.count("*").alias("topics"),
            F.count("_ready").alias("ready_topics"),
            F.every(F.col("_ready").isNotNull()).alias("ready"),
        )
    )


def day_ready(hours: DataFrame, key: list[str]) -> DataFrame:
    """A day is ready when all hours that exist in it are, however many those are."""
    return hours.groupBy(*key, time_bucket(F.col("hour_ms"), 86_400).alias("day_ms")).agg(
        F.count("*").alias("hours"),
        F.count_if("ready").alias("ready_hours"),
        F.every("ready").alias("ready"),
    )


def folder_of(template: Column, token: str) -> Column:
    """The template up to the folder that holds ``token``; empty if it has none."""
    return F.regexp_extract(template, f"^(.*?{token}[^/]*)", 1)


def placed_dirs(dirs: DataFrame, configs: DataFrame) -> DataFrame:
    """Hour folders of ``dirs (topic, hour_ms)`` with ``hour_path`` and ``day_path``; unconfigured topics have none."""
    side = configs.select(F.col("id").alias("topic"), F.col("hdfsRootDir").alias("_root"))
    hour = F.col("hour_ms")
    return dirs.join(side, "topic").select(
        "topic", "hour_ms", render_template(folder_of(F.col("_root"), "%H"), hour).alias("hour_path"),
        render_template(folder_of(F.col("_root"), "%d"), hour).alias("day_path"),
    )


def ready_flags(due: DataFrame, flags: DataFrame, dirs: DataFrame) -> DataFrame:
    """Markers to write on all levels: ``level, topic, hour_ms, path``.

    ``due`` comes from :func:`due_hours`, ``flags`` holds the topic hours flagged before, ``dirs``
    comes from :func:`placed_dirs`. An hour folder is ready when all topics in it are flagged or
    due, a day folder when all its hour folders are. Their rows have no topic; a day's
    ``hour_ms`` is its start.
    """
    marked = flags.select("topic", "hour_ms").unionByName(due.select("topic", "hour_ms"))
    hours = hour_ready(dirs, marked, ["hour_path", "day_path"])
    days = day_ready(hours, ["day_path"])
    none = F.lit(None).cast("string").alias("topic")
    return (
        flag_paths(due)
        .unionByName(hours.filter("ready AND hour_path <> ''").select(
            F.lit("hour").alias("level"), none, "hour_ms", F.col("hour_path").alias("path")))
        .unionByName(days.filter("ready AND day_path <> ''").select(
            F.lit("day").alias("level"), none, F.col("day_ms").alias("hour_ms"), F.col("day_path").alias("path")))
    )
